"""Exact duplicates by a tree-merge of sorted digest runs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railfeed.llm.common import staged, table, texts

#: Every round merges up to 2^FAN runs and cuts what it made into 2^FAN parts of the digest space.
FAN = 3
#: A task that builds runs cuts them after this many rows, so that its memory is bounded.
RUN_ROWS = 1 << 18

EXACT_SQL = r"""
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256
FROM (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
WINDOW same AS (PARTITION BY text_sha256)
"""

_MAX = np.iinfo(np.int64).max
_BLOCK = "lot BIGINT, part BIGINT, digests BINARY, ids BINARY, known BINARY, places BINARY, sizes BINARY"


def text_digest(text: Column) -> Column:
    """SHA-256 of the text with every run of white space as one space; NULL counts as empty."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return F.unhex(F.sha2(plain.cast("binary"), 256))


class Run:
    """Distinct digests in ascending order, each with its least row, ``(no id, id, place)``, and its number of rows.

    A digest is four 64-bit numbers, so that comparing them compares its bytes.
    """

    def __init__(self, digests: np.ndarray, ids: np.ndarray, known: np.ndarray, places: np.ndarray, sizes: np.ndarray):
        self.digests, self.ids, self.known, self.places, self.sizes = digests, ids, known, places, sizes

    def columns(self) -> tuple[np.ndarray, ...]:
        return self.digests, self.ids, self.known, self.places, self.sizes

    def taken(self, rows) -> "Run":
        return Run(*(c[rows] for c in self.columns()))

    @staticmethod
    def merged(runs: list["Run"]) -> "Run":
        """All runs as one. Only entries whose whole digest agrees become one; the smallest row of them stays.

        The stable sort finds the ascending stretches and merges them. It looks at the first 64 bits; where these
        agree and the rest does not, it is done again by all of the digest.
        """
        whole = Run(*(np.concatenate(c) for c in zip(*(r.columns() for r in runs))))
        if not len(whole.ids):
            return whole
        order = np.argsort(whole.digests[:, 0], kind="stable")
        near = whole.digests[order]
        heads = near[1:, 0] == near[:-1, 0]
        if (near[1:][heads] != near[:-1][heads]).any():
            order = np.lexsort(whole.digests.T[::-1])
        whole = whole.taken(order)
        new = np.ones(len(order), bool)
        new[1:] = (whole.digests[1:] != whole.digests[:-1]).any(axis=1)
        first = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        ids = np.where(whole.known, whole.ids, _MAX)
        least, known = np.minimum.reduceat(ids, first), np.logical_or.reduceat(whole.known, first)
        here = (ids == least[group]) & (whole.known == known[group])
        places = np.minimum.reduceat(np.where(here, whole.places, _MAX), first)
        return Run(whole.digests[first], least, known, places, np.add.reduceat(whole.sizes, first))

    def packed(self) -> list[bytes]:
        kinds = (">u8", "<i8", "?", "<i8", "<i8")
        return [c.astype(k).tobytes() for c, k in zip(self.columns(), kinds)]

    @staticmethod
    def unpacked(digests: bytes, ids: bytes, known: bytes, places: bytes, sizes: bytes) -> "Run":
        numbers = np.frombuffer(digests, ">u8").astype(np.uint64).reshape(-1, 4)
        return Run(numbers, np.frombuffer(ids, "<i8"), np.frombuffer(known, "?"), np.frombuffer(places, "<i8"), np.frombuffer(sizes, "<i8"))

    def parts(self, bits: int) -> Iterator[tuple[int, "Run"]]:
        """The run cut by the first ``bits`` bits of its digests."""
        where = (self.digests[:, 0] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(self.ids), np.int64)
        cuts = np.flatnonzero(np.diff(where)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(where)]):
            if a < b:
                yield int(where[a]), self.taken(slice(a, b))


def _blocks(lot: int, run: Run, bits: int) -> Iterator[tuple]:
    for part, piece in run.parts(bits):
        yield (lot, part, *piece.packed())


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_ARROW = pa.schema([("lot", pa.int64()), ("part", pa.int64()), *[(n, pa.binary()) for n in ("digests", "ids", "known", "places", "sizes")]])


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted runs of a task's rows, by the partition the rows were first in, cut for the first round."""
    held, rows = [], 0

    def flush():
        whole = Run(*(np.concatenate(c) for c in zip(*(r.columns() for r in held))))
        lots = whole.places >> 33
        for lot in np.unique(lots).tolist():
            yield _batch(list(_blocks(lot, Run.merged([whole.taken(lots == lot)]), FAN)), _ARROW)

    for batch in batches:
        digests = b"".join(batch.column("digest").to_pylist())
        ids = batch.column("doc_id")
        known = ~ids.is_null().to_numpy(zero_copy_only=False)
        places = batch.column("place").to_numpy(zero_copy_only=False)
        numbers = np.frombuffer(digests, ">u8").astype(np.uint64).reshape(-1, 4)
        held.append(Run(numbers, ids.fill_null(_MAX).to_numpy(zero_copy_only=False), known, places, np.ones(len(places), np.int64)))
        rows += len(places)
        if rows >= RUN_ROWS:
            yield from flush()
            held, rows = [], 0
    if rows:
        yield from flush()


def _merge(bits: int):
    """Merge the blocks of one group of runs and one part of the digests, and cut the outcome by ``bits`` bits."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lot, runs = 0, []
        for batch in batches:
            lot = batch.column("lot")[0].as_py()
            packed = zip(*(batch.column(n).to_pylist() for n in _ARROW.names[2:]))
            runs += [Run.unpacked(*p) for p in packed]
        yield _batch(list(_blocks(lot, Run.merged(runs), bits)), _ARROW)

    return merge


def merge_runs(runs: DataFrame) -> DataFrame:
    """Rounds in which groups of 2^FAN runs exchange parts of the digest space, until every part is in one run.

    After round k a block belongs to a group of 2^(FAN k) runs and to one of as many parts of the space: the blocks
    stay as large as the first runs however many there are, and equal texts are one entry per group from then on.
    """
    lots = (runs.agg(F.max("lot")).first()[0] or 0) + 1
    rounds = 1
    while 1 << FAN * rounds < lots:
        rounds += 1
    for k in range(1, rounds + 1):
        runs = runs.withColumn("lot", F.shiftright("lot", FAN))
        runs = runs.groupBy("lot", "part").applyInArrow(_merge(FAN * (k + 1) if k < rounds else FAN * k), _BLOCK)
    return runs


def _entries(runs: DataFrame, fields: list[str]) -> DataFrame:
    """One row per entry of the blocks."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lot, _, *packed in zip(*(batch.column(n).to_pylist() for n in _ARROW.names)):
                run = Run.unpacked(*packed)
                made = {
                    "lot": pa.array(np.full(len(run.ids), lot)),
                    "digest": pa.FixedSizeBinaryArray.from_buffers(pa.binary(32), len(run.ids), [None, pa.py_buffer(packed[0])]).cast(pa.binary()),
                    "keep_id": pa.array(run.ids, mask=~run.known),
                    "keep_place": pa.array(run.places),
                    "group_size": pa.array(run.sizes),
                }
                yield pa.RecordBatch.from_arrays([made[f] for f in fields], names=fields)

    kinds = {"digest": "BINARY"}
    return runs.mapInArrow(unpack, ", ".join(f"{f} {kinds.get(f, 'BIGINT')}" for f in fields))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, digest, keep_id, group_size, kept)`` per row: its text's digest and the row that stays of equal texts.

    Texts are equal when they are identical with every run of white space as one space; a NULL text counts as empty.
    The smallest id stays, a NULL id only where no row of the group has one; of rows that repeat an id too, one stays.
    Long texts are hashed as a whole. An empty table gives no rows and other columns are ignored. Ids are integers.

    Rows get their answer by digest and first partition, so a text that fills a third of the table is joined in as
    many keys as it had partitions.
    """
    rows = texts(docs, id_col, text_col).select(F.col("doc_id").cast("long").alias("doc_id"), text_digest(F.col("text")).alias("digest"))
    rows = staged(rows.withColumn("place", F.monotonically_increasing_id()), "digests")
    runs = staged(rows.mapInArrow(_local, _BLOCK), "runs")
    groups = _entries(merge_runs(runs), ["digest", "keep_id", "keep_place", "group_size"])
    answers = _entries(runs, ["lot", "digest"]).distinct().join(groups, "digest")
    asked = rows.withColumn("lot", F.shiftright("place", 33))
    return asked.join(answers, ["lot", "digest"]).select(
        "doc_id", "digest", "keep_id", "group_size", (F.col("place") == F.col("keep_place")).alias("kept")
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """One row of each group of equal texts stays, with all its columns; of rows that repeat id and text any one."""
    kept = exact_groups(docs).where("kept").select("doc_id", "digest")
    inner, names = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]), docs.columns
    own_id, own_text = (F.col(f"c{names.index(n)}") for n in ("doc_id", "text"))
    marked = inner.withColumn("id_", own_id.cast("long")).withColumn("digest_", text_digest(own_text))
    same = marked.id_.eqNullSafe(kept.doc_id) & (marked.digest_ == kept.digest)
    return marked.join(kept, same, "left_semi").dropDuplicates(["id_", "digest_"]).drop("id_", "digest_").toDF(*names)


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))
