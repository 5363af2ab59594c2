"""One parse, several outcomes: rows that read, payloads that do not, and values that do not."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import work_dir

ERROR_COLUMNS = ["raw_id", "batch_id", "field", "reason", "text"]


class Dealt:
    """Parsed rows, written once with their outcome, so that what follows reads its part and no payload again.

    ``rows`` carries ``raw_id`` and ``batch_id``, ``reject`` (why a payload or object gave no rows, else NULL) and
    ``errors``, the values of a row that could not be read, as (field, reason, text).
    """

    def __init__(self, rows: DataFrame):
        spark = rows.sparkSession
        self.path = work_dir(spark, "dealt")
        marked = rows.withColumn("outcome", F.when(F.col("reject").isNotNull(), "rejected").otherwise("read"))
        # a column and no folders: Spark would sort all rows by outcome to write these
        marked.write.parquet(self.path)
        self._all = spark.read.schema(marked.schema).parquet(self.path)
        self.rows = self._all.filter("outcome = 'read'").drop("reject", "errors", "outcome")

    def rejected(self, *columns: str) -> DataFrame:
        return self._all.filter("outcome = 'rejected'").select("raw_id", "batch_id", *columns)

    def errors(self) -> DataFrame:
        """One row per value that could not be read, with its field, the reason and its text."""
        read = self._all.filter("outcome = 'read'").select("raw_id", "batch_id", F.explode("errors").alias("e"))
        return read.select("raw_id", "batch_id", "e.*")

    def total(self, column: str, outcome: str | None = None) -> int:
        """Sum of a column over all rows or those of one outcome."""
        rows = self._all if outcome is None else self._all.filter(F.col("outcome") == outcome)
        return rows.agg(F.sum(column)).first()[0] or 0

    def counts(self) -> dict[str, str]:
        """Per batch with any: how many payloads were rejected and values not read, by reason, as a ledger message.

        As many rows come back as there are reasons and fields in the batches of one job.
        """
        what = F.when(F.col("reject").isNotNull(), F.array(F.concat(F.lit("rejected_"), F.col("reject.reason")))).otherwise(
            F.transform("errors", lambda e: F.concat(e["field"], F.lit("_"), e["reason"]))
        )
        found = self._all.select("batch_id", F.explode(what).alias("what")).groupBy("batch_id", "what").count().collect()
        out: dict[str, list[str]] = {}
        for r in sorted(found, key=lambda r: r.what):
            out.setdefault(r.batch_id, []).append(f"{r.what}={r['count']}")
        return {batch_id: ", ".join(parts) for batch_id, parts in out.items()}
