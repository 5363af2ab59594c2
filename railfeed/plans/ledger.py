"""Append-only logs of calls and runs, with the latest state as a view."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

RUN_SCHEMA = (
    "run_id STRING, process_name STRING, batch_id STRING, event STRING, status STRING, "
    "ts TIMESTAMP_NTZ, message STRING"
)
RUN_COLUMNS = ["run_id", "process_name", "batch_id", "event", "status", "ts", "message"]
CALL_COLUMNS = ["source", "endpoint", "params", "status_code", "response_time_ms", "result_count", "called_at"]
CALL_SCHEMA = (
    "source STRING, endpoint STRING, params STRING, status_code INT, response_time_ms INT, result_count INT, "
    "called_at TIMESTAMP_NTZ"
)


def api_call_rows(calls: DataFrame, params: list[str]) -> DataFrame:
    """Log rows of captured calls; ``params`` names the columns kept as JSON text."""
    return calls.withColumn("params", F.to_json(F.struct(*params))).select(*CALL_COLUMNS)


def call_succeeded(status: Column) -> Column:
    return status.between(200, 299)


def api_metrics(calls: DataFrame, by: list[str]) -> DataFrame:
    """Calls, successes and stored payloads per group.

    A call that raised is logged as status 500 and time 0 and stores nothing; an answer with an error
    status is stored like any other.
    """
    status = F.when(F.col("raised"), F.lit(500)).otherwise(F.col("status_code"))
    elapsed = F.when(F.col("raised"), F.lit(0)).otherwise(F.col("response_time_ms"))
    has_text = ~F.col("raised") & (F.coalesce(F.col("payload"), F.lit("")) != "")
    return calls.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_calls"),
        F.count_if(call_succeeded(status)).alias("n_success"),
        F.count_if(~F.col("raised")).alias("n_payloads"),
        F.count_if(has_text).alias("n_results"),
        F.sum(elapsed.cast("bigint")).alias("sum_elapsed_ms"),
    )


def process_state(events: DataFrame) -> DataFrame:
    """Current row of every run: its last event, with the time it began. One aggregate, so one shuffle."""
    is_end = F.col("event") == "end"
    last = F.max_by(
        F.struct("process_name", "batch_id", "status", F.when(is_end, F.col("ts")).alias("finished_at"), "message"),
        F.struct("ts", is_end, "status"),
    )
    runs = events.groupBy("run_id").agg(
        last.alias("last"), F.min(F.when(F.col("event") == "start", F.col("ts"))).alias("started_at")
    )
    return runs.select(
        "run_id", "last.process_name", "last.batch_id", "last.status", "started_at", "last.finished_at", "last.message"
    )


def succeeded_batches(ledger: DataFrame, process: str) -> DataFrame:
    return (
        ledger.filter((F.col("process_name") == process) & (F.col("status") == "success"))
        .select("batch_id")
        .distinct()
    )


def pending_batches(raw: DataFrame, ledger: DataFrame, process: str) -> DataFrame:
    """Batches with rows but without a successful run, all found at once."""
    batches = raw.filter(F.col("batch_id").isNotNull()).select("batch_id").distinct()
    return batches.join(succeeded_batches(ledger, process), "batch_id", "left_anti")


def run_decisions(raw: DataFrame, ledger: DataFrame, process: str) -> DataFrame:
    """Per batch: run it, or log it as skipped because it succeeded before."""
    batches = raw.filter(F.col("batch_id").isNotNull()).select("batch_id").distinct()
    done = succeeded_batches(ledger, process).withColumn("done", F.lit(True))
    return batches.join(done, "batch_id", "left").select(
        F.lit(process).alias("process_name"),
        "batch_id",
        F.when(F.col("done"), F.lit("skipped")).otherwise(F.lit("running")).alias("status"),
    )


class RunLedger:
    """Run log in a folder, by process and day; each call appends its events."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def _exists(self, path: str) -> bool:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder)

    def read(self, process: str | None = None) -> DataFrame:
        """All events once, or those of one process, which are a folder of their own."""
        if not self._exists(self.path):
            return self.spark.createDataFrame([], RUN_SCHEMA)
        events = self.spark.read.schema(f"{RUN_SCHEMA}, day STRING").parquet(self.path).select(*RUN_COLUMNS)
        return (events if process is None else events.filter(F.col("process_name") == process)).distinct()

    def append(self, events: list[tuple[str, str, str | None, str, str, str]]) -> None:
        """Add (run_id, process_name, batch_id, event, status, message) at the current time."""
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        rows = [(run, process, batch, event, status, now, message) for run, process, batch, event, status, message in events]
        added = self.spark.createDataFrame(rows, RUN_SCHEMA).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
        added.coalesce(1).write.mode("append").partitionBy("process_name", "day").parquet(self.path)

    def compact(self) -> int:
        """Join the small files of each process and day; returns how many there were.

        Only files seen at the start are read and, once their events are written anew, deleted. An event appended
        meanwhile is in a file of its own and stays. Readers see an event once even while it is stored twice.
        """
        if not self._exists(self.path):
            return 0
        stored = self.spark.read.schema(f"{RUN_SCHEMA}, day STRING").option("basePath", self.path)
        old = stored.parquet(self.path).inputFiles()
        # events of a process and day are joined into few files; the listing names them, so it is as long as they are many
        joined = stored.parquet(*old).distinct().hint("rebalance", "process_name", "day")
        joined.write.mode("append").partitionBy("process_name", "day").parquet(self.path)
        for name in old:
            file = self.spark._jvm.org.apache.hadoop.fs.Path(name)
            file.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(file, False)
        return len(old)

    def is_done(self, process: str, batch_id: str | None) -> bool:
        if batch_id is None:
            return False
        return not succeeded_batches(self.read(process), process).filter(F.col("batch_id") == batch_id).isEmpty()

    def skip(self, process: str, batch_id: str) -> str:
        self.append([(uuid.uuid4().hex, process, batch_id, "end", "skipped", "already transformed")])
        return "skipped"

    def run_all(self, process: str, batch_ids: list[str], job: Callable[[], str]) -> str:
        """Run one job over several batches and log its start and its end for each of them."""
        runs = [(uuid.uuid4().hex, process, batch_id) for batch_id in batch_ids]
        self.append([(*run, "start", "running", "start") for run in runs])
        try:
            message = job()
        except Exception as exc:
            self.append([(*run, "end", "failed", str(exc)) for run in runs])
            raise
        self.append([(*run, "end", "success", message) for run in runs])
        return "success"

    def run_batch(self, process: str, batch_id: str, job: Callable[[], str]) -> str:
        """Run ``job`` unless the batch succeeded before; returns the logged status."""
        if self.is_done(process, batch_id):
            return self.skip(process, batch_id)
        return self.run_all(process, [batch_id], job)
