"""Importance resampling towards a target corpus by hashed n-grams, with Arrow kernels."""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railfeed.llm.common import schema_of, small_batches, staged, table, texts
from railfeed.operators.ranking import number_rows

#: All ASCII characters but digits and letters, between which words stand; letters are lower case by then.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of text in one pass of the kernels.
CHUNK = 4 << 20


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about CHUNK bytes of text, one row at least."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + CHUNK, side="right")))
            yield batch.slice(at, to - at)
            at = to


class Grams:
    """CRC-32 of all runs of 1 to ``longest`` words of some texts, and the text each run is of.

    Words are dictionary indices. A run of n words is the run of n - 1 words at its place and the word after it, told
    apart by one number made of both indices; the distinct ones get their CRC by going on from that of the shorter run.
    """

    def __init__(self, column: pa.Array, longest: int):
        lists = pc.split_pattern_regex(pc.ascii_lower(column), GAP)
        words, owner = pc.list_flatten(lists), pc.list_parent_indices(lists)
        full = pc.greater(pc.binary_length(words), 0)
        coded = words.filter(full).dictionary_encode()
        self.texts = len(column)
        owner, word = owner.filter(full).to_numpy(), coded.indices.to_numpy().astype(np.int64)
        spelled = coded.dictionary.cast(pa.binary()).to_pylist()
        after = [b" " + w for w in spelled]
        crcs = pa.array([crc32(w) for w in spelled], pa.int64())
        index, start = word, np.arange(len(word))
        self.by_length = [(owner, crcs.take(coded.indices))]
        for n in range(2, longest + 1):
            go = start[start + n - 1 < len(word)]
            inside = owner[go] == owner[go + n - 1]
            index, start = index[: len(go)][inside], go[inside]
            pairs = pa.array(index * max(1, len(spelled)) + word[start + n - 1]).dictionary_encode()
            left, right = np.divmod(pairs.dictionary.to_numpy(), max(1, len(spelled)))
            before = crcs.to_pylist()
            crcs = pa.array([crc32(after[b], before[a]) for a, b in zip(left.tolist(), right.tolist())], pa.int64())
            index = pairs.indices.to_numpy().astype(np.int64)
            self.by_length.append((owner[start], crcs.take(pairs.indices)))

    def sizes(self, n: int) -> np.ndarray:
        """Runs of n words per text."""
        return np.bincount(self.by_length[n - 1][0], minlength=self.texts)

    def sums(self, values: pa.Array, buckets: int) -> np.ndarray:
        """Sum over each text's runs of the value of their bucket, as whole numbers."""
        total = np.zeros(self.texts, np.int64)
        for owner, crcs in self.by_length:
            taken = values.take(pa.array(crcs.to_numpy() % buckets)).to_numpy()
            running = np.concatenate([[0], np.cumsum(taken)])  # owners ascend, so a text's runs are one segment
            total += running[np.searchsorted(owner, np.arange(self.texts), "right")] - running[np.searchsorted(owner, np.arange(self.texts))]
        return total


def bucket_counts(df: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """Runs per bucket over all rows of ``text``; every task adds its own up, the driver gets one number per bucket."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for part in _chunks(batches):
            for _, crcs in Grams(part.column("text"), longest).by_length:
                total += np.bincount(crcs.to_numpy() % buckets, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    got = df.select("text").mapInArrow(run, "bucket INT, n BIGINT").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> list[int]:
    """Per bucket 1000 times the log of how much likelier it is in the target, floored; one added to every count."""
    k, s_all, t_all = len(raw), int(raw.sum()), int(target.sum())
    return [math.floor(1000 * math.log((t + 1) * (s_all + k) / ((s + 1) * (t_all + k)))) for s, t in zip(raw.tolist(), target.tolist())]


def importance(docs: DataFrame, values: list[int], longest: int) -> DataFrame:
    """``(doc_id, n_words, n_features, weight)`` per row; the weight is the floored mean gain, 0 without words."""
    schema = schema_of(docs, "n_words BIGINT", "n_features BIGINT", "weight BIGINT")
    buckets = len(values)

    def run(batches):
        value = pa.array(values, pa.int64())
        for part in _chunks(batches):
            grams = Grams(part.column("text"), longest)
            sizes = [grams.sizes(n) for n in range(1, longest + 1)]
            n, total = sum(sizes), grams.sums(value, buckets)
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            columns = [part.column("doc_id"), *(pa.array(c.astype(np.int64)) for c in (sizes[0], n, weight))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(run, schema)


def resample(
    docs: DataFrame,
    target: DataFrame,
    longest: int = 2,
    buckets: int = 10_000,
    seed: int = 7,
    percent: int = 25,
    min_words: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` per row: drawn without replacement, likelier the closer to the target.

    Score is the weight and Gumbel noise from the id. Of the N rows with ``min_words`` words or more the highest
    floor(percent N / 100) scores are drawn and ranked 1, 2, 3, ..., ties by smaller id, then rows without one; the
    others have rank NULL. NULL and empty texts have no features and weight 0; a NULL id is written as nothing in the
    noise. Rows that repeat an id repeat its score and have ranks of their own. Empty tables count no features: without
    documents no row comes out, without a target every gain falls with the count of its bucket. Texts of any length
    are read whole. Other columns are ignored.
    """
    spark = docs.sparkSession
    raw = texts(docs, id_col, text_col)
    wanted = target.select(F.coalesce(F.col(target_col), F.lit("")).alias("text"))
    with small_batches(spark):
        values = gains(bucket_counts(raw, longest, buckets), bucket_counts(wanted, longest, buckets))
        rows = importance(raw, values, longest)
        name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
        h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
        noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
        rows = rows.withColumn("score", F.col("weight") + noise.cast("long"))
        rows = staged(rows.withColumn("at", F.monotonically_increasing_id()), "scores")
    drawn = rows.where(F.col("n_words") >= min_words).count() * percent // 100
    order = F.struct((F.col("n_words") < min_words).alias("out"), -F.col("score"), F.col("doc_id").isNull(), "doc_id", "at")
    placed = number_rows(rows.withColumn("order", order), "order", "place")
    rank = F.when(F.col("place") <= drawn, F.col("place")).cast("long")
    return placed.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
