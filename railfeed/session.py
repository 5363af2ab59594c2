"""Session defaults and the shared work folder."""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_LOCAL_BASE: dict[str, str] = {}


class _Scopes(threading.local):
    """Work folders of the open ``scratch`` blocks of a thread."""

    def __init__(self) -> None:
        self.open: list[list[str]] = []


_SCOPES = _Scopes()


def get_session(app: str = "railfeed", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Text formatting of times goes through the session zone, so it must be UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is used in local mode only, where all tasks share one disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_BASE:
        _LOCAL_BASE[app] = tempfile.mkdtemp(prefix="railfeed-")
    return _LOCAL_BASE[app]


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused, so replays cannot mix."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    if _SCOPES.open:
        _SCOPES.open[-1].append(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write to a work folder and read back, so that what follows does not compute it again."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Work folders made inside are deleted at the end; all that reads them must have run by then."""
    _SCOPES.open.append([])
    try:
        yield
    finally:
        for path in _SCOPES.open.pop():
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
