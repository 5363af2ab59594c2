"""Promotion from the volatile to the kept raw layer, and lineage over the layers."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from ..sources.snapshots import Conflict, Head, SnapshotTable, added, iso, removed
from ..sources.tables import RAW_SCHEMA

# Prefixes and formats of batch ids
TIMETABLE_PREFIXES = ("PLAN", "FCHG", "RCHG")


def make_batch_id(prefix: str, now: dt.datetime) -> str:
    """Timetable batches carry the second, JSON batches the second and a random tail."""
    if prefix in TIMETABLE_PREFIXES:
        return f"{prefix}_{now:%Y%m%d_%H%M%S}"
    return f"{prefix}_{now:%Y%m%d%H%M%S}_{uuid.uuid4().hex[:8]}"


def staging(spark: SparkSession, path: str) -> SnapshotTable:
    """Volatile raw layer: ids count from the batch's own start."""
    return SnapshotTable(spark, path, "raw_id BIGINT, payload STRING, ingested_at TIMESTAMP_NTZ", "ingest_date")


def kept(spark: SparkSession, path: str) -> SnapshotTable:
    """Kept raw layer, by the day a batch arrived."""
    return SnapshotTable(spark, path, RAW_SCHEMA, "ingest_date")


class Taken(Conflict):
    """The batch id is in use."""


def stage(
    stg: SnapshotTable, psa: SnapshotTable, rows: DataFrame, batch_id: str, now: dt.datetime | None, keep_ids: bool = False
) -> int:
    """Land ``raw_id, payload, ingested_at`` rows as one batch; returns their number.

    Ids are 0, 1, 2, ... in the files. Where they start is decided by the commit, which another writer's commit only
    sends round once more, so two processes may stage at a time and nothing is written twice. An id that is staged,
    kept, or staged by another process meanwhile is taken.
    """
    base = stg.version()  # before the kept layer is asked: what has been promoted by now is found there
    if any(not t.entries(v).filter(F.col("batch_id") == batch_id).isEmpty() for t, v in ((stg, base), (psa, None))):
        raise Taken(batch_id)
    day = F.lit("unknown" if now is None else f"{now:%Y-%m-%d}")
    folders = stg.put(rows.select("raw_id", "payload", "ingested_at").withColumn("ingest_date", day))
    n_rows = stg.open(list(folders.values())).count()
    entry = {"day": next(iter(folders), None), "batch_id": batch_id, "arrived_at": iso(now), "n_rows": n_rows}

    def change(head: Head) -> list[dict]:
        if any(line["action"] == "add" and line["batch_id"] == batch_id for line in head.later):
            raise Taken(batch_id)
        first = 0 if keep_ids else head.next_id
        return [added(f, first_id=first, **entry) for f in list(folders.values()) or [f"empty={batch_id}"]]

    stg.commit(change, base)
    return n_rows


def promote(stg: SnapshotTable, psa: SnapshotTable) -> dict[str, int]:
    """Copy every staged batch that is not kept yet, one commit each; returns the batches it added and their rows.

    A batch that a failed run left behind is a staged batch like any other. Repeating it, or running it twice at a time,
    leaves each batch in the kept layer once.
    """
    base = psa.version()
    staged = stg.entries().collect()  # staging holds the few batches since the last purge
    done = {e.batch_id for e in _kept_of(staged, psa, base)}
    out = {}
    for e in sorted(staged, key=lambda e: (e.first_id, e.batch_id)):
        if e.batch_id in done:
            continue
        rows = stg.open([e.folder] if e.n_rows else [])
        copy = rows.withColumns({"raw_id": F.col("raw_id") + e.first_id, "batch_id": F.lit(e.batch_id)})
        folders = psa.put(copy) if e.n_rows else {}
        entry = {"day": e.day, "batch_id": e.batch_id, "arrived_at": iso(e.arrived_at), "first_id": e.first_id, "n_rows": e.n_rows}

        def change(head: Head) -> list[dict]:
            out.pop(e.batch_id, None)
            if any(line["action"] == "add" and line["batch_id"] == e.batch_id for line in head.later):
                return []  # another process was faster
            out[e.batch_id] = e.n_rows
            return [added(f, **entry) for f in list(folders.values()) or [f"empty={e.batch_id}"]]

        psa.commit(change, base)
    return out


def _kept_of(staged: list[Row], psa: SnapshotTable, version: int | None = None) -> list[Row]:
    """Those of some staged entries whose batch the kept layer lists."""
    if not staged:
        return []
    found = psa.entries(version).filter(F.col("batch_id").isin([e.batch_id for e in staged])).select("batch_id").collect()
    ids = {r.batch_id for r in found}
    return [e for e in staged if e.batch_id in ids]


def purge(stg: SnapshotTable, psa: SnapshotTable) -> list[str]:
    """Take the staged batches out that are safe in the kept layer, and no others; returns them.

    Both logs say which; no payload is read. Files go with a later vacuum, so a process that still reads them can end.
    """
    base = stg.version()
    safe = _kept_of(stg.entries(base).collect(), psa)
    if not safe:
        return []

    def change(head: Head) -> list[dict]:
        gone = {line["folder"] for line in head.later if line["action"] == "remove"}
        return [removed(e.folder) for e in safe if e.folder not in gone]

    stg.commit(change, base)
    return sorted(e.batch_id for e in safe)


def latest_batch(raw: DataFrame) -> DataFrame:
    """Batch that was inserted last, by arrival and not by the text of its id."""
    return raw.filter(F.col("batch_id").isNotNull()).agg(
        F.max_by("batch_id", F.struct("ingested_at", "raw_id")).alias("batch_id")
    )


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Rows per layer."""
    out = None
    for name, df in layers.items():
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("layer"), "n_rows")
        out = one if out is None else out.unionAll(one)
    return out


def batch_trace(layers: dict[str, DataFrame], ledger: DataFrame) -> DataFrame:
    """One row per batch: rows in each layer and the last status of its run.

    Every side is reduced to one row per batch before it is joined.
    """
    out = None
    for name, df in layers.items():
        one = df.groupBy("batch_id").agg(F.count(F.lit(1)).alias(f"{name}_rows"))
        out = one if out is None else out.join(one, "batch_id", "full_outer")
    status = ledger.groupBy("batch_id").agg(
        F.max_by("status", F.struct("ts", F.col("event") == "end", "run_id")).alias("status"), F.count_distinct("run_id").alias("n_runs")
    )
    counts = [f"{name}_rows" for name in layers]
    return out.join(status, "batch_id", "left").select(
        "batch_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts], "status", F.coalesce("n_runs", F.lit(0)).alias("n_runs")
    )
