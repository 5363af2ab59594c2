"""Best-fit packing of documents into token sequences, by hierarchical merging of underfull bins."""

from __future__ import annotations

import zlib
from functools import partial

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railfeed.llm.common import schema_of, slices, staged, table, texts
from railfeed.llm.tokens import encoder


def tokenizer_path(name: str) -> str:
    """Place of a vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


class BestFit:
    """Bins of one capacity; an item goes into the fullest bin that has room, found by a bitmap of free room."""

    def __init__(self, capacity: int):
        self.capacity, self.free, self.by_room = capacity, 0, [[] for _ in range(capacity + 1)]
        self.bins: list[list] = []
        self.room: list[int] = []

    def add(self, size: int, item) -> None:
        fits = self.free >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            at = self.by_room[room].pop()
            if not self.by_room[room]:
                self.free &= ~(1 << room)
        else:
            at, room = len(self.bins), self.capacity
            self.bins.append([])
        self.bins[at].append((self.capacity - room, item))
        room -= size
        if at == len(self.room):
            self.room.append(room)
        else:
            self.room[at] = room
        if room:
            self.by_room[room].append(at)
            self.free |= 1 << room


def pack_locally(pieces, capacity: int, nearly_full: float, chunk: int):
    """Yield ``(bin, offset, open, piece)`` for the pieces of one task, largest first within a chunk.

    Nearly full bins are emitted; the pieces of the others go into the next chunk as one item each. What is still
    underfull at the end of the task comes out as open.
    """
    counter, waiting, kept = 0, [], []

    def fill(last: bool):
        nonlocal counter, kept
        best = BestFit(capacity)
        items = kept + [[p] for p in waiting]
        for item in sorted(items, key=lambda group: -sum(p[3] for p in group)):
            best.add(sum(p[3] for p in item), item)
        kept = []
        for content, room in zip(best.bins, best.room):
            group = [p for _, item in content for p in item]
            is_open = capacity - room < nearly_full * capacity
            if is_open and not last:
                kept.append(group)
                continue
            offset = 0
            for piece in group:
                yield counter, offset, is_open, piece
                offset += piece[3]
            counter += 1
        waiting.clear()

    for piece in pieces:
        if piece[3] == capacity:
            yield counter, 0, False, piece
            counter += 1
            continue
        waiting.append(piece)
        if len(waiting) >= chunk:
            yield from fill(False)
    yield from fill(True)


def _pieces(docs: DataFrame, path: str, end_id: int, capacity: int, spaces: bool, nearly_full: float, chunk: int) -> DataFrame:
    schema = schema_of(
        docs, "piece INT", "start BIGINT", "length BIGINT", "ids_crc32 BIGINT", "node BIGINT", "bin BIGINT", "off BIGINT", "open BOOLEAN"
    )
    end = end_id.to_bytes(4, "little")

    def run(batches):
        encode, task = encoder(path, spaces).encode, TaskContext.get().partitionId()
        names = [f.name for f in schema.fields]
        arrow = None

        def cut():
            nonlocal arrow
            for part in slices(batches):
                if arrow is None:
                    arrow = part.schema.field("doc_id").type
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = encode(text) + end
                    for i, at in enumerate(range(0, len(ids), 4 * capacity)):
                        raw = ids[at : at + 4 * capacity]
                        yield doc, i, at // 4, len(raw) // 4, zlib.crc32(raw)

        rows = []
        for number, offset, is_open, piece in pack_locally(cut(), capacity, nearly_full, chunk):
            rows.append((*piece, task, (task << 36) + number, offset, is_open))
            if len(rows) >= 20_000:
                yield _batch(rows, names, arrow)
                rows = []
        if rows:
            yield _batch(rows, names, arrow)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _batch(rows, names, id_type) -> pa.RecordBatch:
    kinds = [id_type, pa.int32(), *[pa.int64()] * 6, pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)], names=names)


def _merge_open(open_bins: DataFrame, capacity: int, nearly_full: float, fan_in: int, carry: int) -> DataFrame:
    """``(bin, host, base)``: where each open bin of the tasks ends up.

    Level by level, ``fan_in`` nodes meet in one task that best-fits their open bins as items. After best-fit, a node
    has at most one bin that is not over half full, and bins over half full cannot join each other. A parent thus has
    at most ``fan_in`` bins to place, and ``carry`` of the emptiest others from each node are more than they can use
    on any number of levels; the rest is emitted. That bounds a task without losing a piece or a fit.
    """
    state = open_bins.select("node", F.col("bin").alias("host"), F.col("fill"), "bin", F.lit(0).cast("long").alias("base"))
    done, level = [], 0
    out = "node long, host long, fill long, bin long, base long, open boolean"

    def merge(frame: pd.DataFrame, *, final: bool) -> pd.DataFrame:
        hosts = {h: (int(g["fill"].iloc[0]), g) for h, g in frame.groupby("host", sort=True)}
        best = BestFit(capacity)
        for host in sorted(hosts, key=lambda h: (-hosts[h][0], h)):
            best.add(hosts[host][0], host)
        order = sorted(range(len(best.bins)), key=lambda b: -best.room[b])
        stay = {b for b in order[:carry] if best.room[b] > (1 - nearly_full) * capacity} if not final else set()
        rows = []
        for b, content in enumerate(best.bins):
            first = content[0][1]
            for offset, host in content:
                for r in hosts[host][1].itertuples():
                    rows.append((r.node, first, capacity - best.room[b], r.bin, r.base + offset, b in stay))
        return pd.DataFrame(rows, columns=["node", "host", "fill", "bin", "base", "open"])

    while True:
        state = state.withColumn("node", F.expr(f"node div {fan_in}"))
        last = state.agg(F.max("node")).first()[0]
        if last is None:
            break
        final = last == 0
        merged = state.groupBy("node").applyInPandas(partial(merge, final=final), out)
        merged = staged(merged, f"pack-level-{level}")
        done.append(merged.where("not open").select("bin", "host", "base"))
        if final:
            break
        state, level = merged.where("open").drop("open"), level + 1
    if not done:
        return state.select("bin", "host", "base")
    placed = done[0]
    for more in done[1:]:
        placed = placed.unionAll(more)
    return placed


def pack(
    docs: DataFrame,
    path: str,
    end_id: int,
    capacity: int = 4096,
    spaces: bool = False,
    nearly_full: float = 0.99,
    chunk: int = 50_000,
    fan_in: int = 16,
    carry: int = 256,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of at most ``capacity`` tokens and their places ``(sequence_id, offset)``, gapless from 0.

    Only documents over ``capacity`` tokens are cut, at whole multiples. A NULL or empty text is the end id alone.
    Rows are packed one by one, so repeated rows and NULL ids are packed as often as they occur. An empty table
    gives no rows; other columns are ignored. Only lengths travel: texts and ids stay in the task that read them.
    """
    pieces = staged(
        _pieces(texts(docs, id_col, text_col), path, end_id, capacity, spaces, nearly_full, chunk), "pieces"
    )
    opened = pieces.where("open")
    fills = opened.groupBy("node", "bin").agg(F.sum("length").alias("fill"))
    places = _merge_open(fills, capacity, nearly_full, fan_in, carry)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    closed = pieces.where("not open").select(*columns, F.col("bin").alias("sequence_id"), F.col("off").alias("offset"))
    moved = opened.join(places, "bin").select(
        *columns, F.col("host").alias("sequence_id"), (F.col("off") + F.col("base")).alias("offset")
    )
    return closed.unionAll(moved)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=1, capacity=4096)
