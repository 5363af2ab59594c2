"""Token files compressed with Re-Pair grammars, with random access, as one binary shard per row."""

from __future__ import annotations

import json
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from railfeed.llm.common import schema_of, slices, table, texts
from railfeed.llm.packing import tokenizer_path
from railfeed.llm.tokens import encoder
from railfeed.session import work_dir

MAGIC = b"RPSHARD1"
SHARD_TOKENS = 1 << 21
#: Words whose ids a Python worker remembers, some 200 bytes each.
KNOWN_WORDS = 1_000_000
PAIRS_PER_ROUND = 4096
MIN_COUNT = 8
MIN_GAIN = 0.05
_BUCKETS = 19


def _floor(counts: np.ndarray, most: int) -> int:
    """The smallest count that at most ``most`` of the counts reach, give or take ties beyond 65,535."""
    reach = np.cumsum(np.bincount(np.minimum(counts, 1 << 16))[::-1])[::-1]
    return int(np.searchsorted(-reach, -most))


def compress(tokens: np.ndarray, ends: np.ndarray, most: int = PAIRS_PER_ROUND, least: int = MIN_COUNT, gain: float = MIN_GAIN):
    """``(symbols, symbol_ends, first, rules)``: rounds of Re-Pair over one shard.

    Each round replaces up to ``most`` of the most frequent pairs by new symbols, from left to right without overlap,
    until a round shortens the sequence by less than ``gain``. Frequent pairs are found by the counts of hash buckets;
    a full bucket stands for the pair with most places in it, which must then be seen ``least`` times itself. Symbols from ``first``
    on are rules, which only use smaller symbols. No pair spans two documents; ``ends`` and ``symbol_ends`` are where
    each document ends.
    """
    symbols = tokens.astype(np.uint32)
    first = next_symbol = int(symbols.max(initial=0)) + 1
    closing = np.zeros(len(symbols), bool)
    closing[ends[ends > 0] - 1] = True
    rules: list[np.ndarray] = []
    while len(symbols) > 1:
        key = (symbols[:-1].astype(np.uint64) << np.uint64(32)) | symbols[1:]
        bucket = ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _BUCKETS)).astype(np.int32)
        bucket[closing[:-1]] = 1 << _BUCKETS  # a bucket of no use
        counts = np.bincount(bucket, minlength=(1 << _BUCKETS) + 1)
        counts[-1] = 0
        floor = max(least, _floor(counts, most))
        where = np.flatnonzero((counts >= floor)[bucket])
        if not len(where):
            break
        stands = np.zeros(1 << _BUCKETS, np.uint64)
        stands[bucket[where]] = key[where]
        # Where a bucket holds several pairs, the one with most places stands for it.
        mixed = np.zeros(1 << _BUCKETS, bool)
        mixed[bucket[where[stands[bucket[where]] != key[where]]]] = True
        pairs, at, seen = np.unique(key[where[mixed[bucket[where]]]], return_index=True, return_counts=True)
        at = bucket[where[mixed[bucket[where]]]][at]
        rising = np.argsort(seen, kind="stable")
        stands[at[rising]] = pairs[rising]
        where = where[stands[bucket[where]] == key[where]]
        # In a run of neighbouring places every other one is taken.
        run = np.ones(len(where), bool)
        run[1:] = np.diff(where) > 1
        started = np.maximum.accumulate(np.where(run, np.arange(len(where)), 0))
        where = where[(np.arange(len(where)) - started) % 2 == 0]
        taken = np.bincount(bucket[where], minlength=1 << _BUCKETS)
        where = where[taken[bucket[where]] >= least]
        if len(where) < gain * len(symbols):
            break
        used = np.flatnonzero(taken >= least)
        rank = np.zeros(1 << _BUCKETS, np.uint32)
        rank[used] = np.arange(len(used))
        symbols[where] = next_symbol + rank[bucket[where]]
        closing[where] = closing[where + 1]
        keep = np.ones(len(symbols), bool)
        keep[where + 1] = False
        symbols, closing = symbols[keep], closing[keep]
        rules.append(stands[used])
        next_symbol += len(used)
    flat = np.concatenate(rules) if rules else np.empty(0, np.uint64)
    both = np.stack([(flat >> np.uint64(32)).astype(np.uint32), flat.astype(np.uint32)], axis=1)
    symbol_ends = np.zeros(len(ends), np.int64)
    symbol_ends[np.diff(ends, prepend=0) > 0] = np.flatnonzero(closing) + 1
    return symbols, np.maximum.accumulate(symbol_ends) if len(ends) else symbol_ends, first, both


def expansion_lengths(first: int, rules: np.ndarray) -> np.ndarray:
    """Tokens that each rule stands for; rules come in rounds that only use earlier symbols."""
    sizes = np.ones(first + len(rules), np.int64)
    done = first
    while done < len(sizes):
        rest = rules[done - first :]
        ready = int(np.argmax(np.append(rest.max(axis=1) >= done, True)))
        sizes[done : done + ready] = sizes[rest[:ready, 0]] + sizes[rest[:ready, 1]]
        done += ready
    return sizes


def _ints(values: np.ndarray) -> tuple[str, bytes]:
    kind = "<u2" if len(values) == 0 or int(values.max()) < 1 << 16 else "<u4"
    return kind, values.astype(kind).tobytes()


def dump_shard(ids: list, tokens: np.ndarray, ends: np.ndarray, **options) -> bytes:
    """A shard file: magic, length of a JSON head, the head, and the arrays it names.

    The arrays are the rules, their expansion lengths, the symbols, and the ends of each document in tokens and in
    symbols; so a range of tokens is found by sums of expansion lengths without reading what lies before it.
    """
    symbols, symbol_ends, first, rules = compress(tokens, ends, **options)
    parts = {
        "rules": rules.ravel(),
        "lengths": expansion_lengths(first, rules)[first:],
        "symbols": symbols,
        "ends": ends,
        "symbol_ends": symbol_ends,
    }
    head, body = {"first": first, "ids": ids, "tokens": len(tokens), "parts": {}}, []
    for name, values in parts.items():
        kind, raw = _ints(values)
        head["parts"][name] = [kind, len(values)]
        body.append(raw)
    text = json.dumps(head).encode()
    return b"".join([MAGIC, struct.pack("<I", len(text)), text, *body])


class Shard:
    """A shard file as read back; ``document`` and ``tokens`` expand only the symbols they need."""

    def __init__(self, raw: bytes):
        if raw[:8] != MAGIC:
            raise ValueError("not a shard file")
        (size,) = struct.unpack_from("<I", raw, 8)
        head, at = json.loads(raw[12 : 12 + size]), 12 + size
        self.ids, self.first, self.size, part = head["ids"], head["first"], head["tokens"], {}
        for name, (kind, n) in head["parts"].items():
            part[name] = np.frombuffer(raw, kind, n, at).astype(np.int64)
            at += n * int(kind[-1])
        self.rules, self.symbols = part["rules"].reshape(-1, 2), part["symbols"]
        self.ends, self.symbol_ends = part["ends"], part["symbol_ends"]
        self.sizes = np.concatenate([np.ones(self.first, np.int64), part["lengths"]])
        self._flat = self._offset = None

    def _expand_rules(self) -> None:
        """The tokens of every symbol in one array, round by round, terminals first."""
        self._offset = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self._flat = np.empty(int(self.sizes.sum()), "<u4")
        self._flat[: self.first] = np.arange(self.first)
        done = self.first
        while done < len(self.sizes):
            rest = self.rules[done - self.first :]
            ready = int(np.argmax(np.append(rest.max(axis=1) >= done, True)))
            a, b = self._offset[done], self._offset[done] + int(self.sizes[done : done + ready].sum())
            self._flat[a:b] = self._gather(rest[:ready].ravel())
            done += ready

    def _gather(self, symbols: np.ndarray) -> np.ndarray:
        sizes = self.sizes[symbols]
        before = np.cumsum(sizes) - sizes
        return self._flat[np.repeat(self._offset[symbols] - before, sizes) + np.arange(int(sizes.sum()))]

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        if self._flat is None:
            self._expand_rules()
        return self._gather(symbols)

    def document(self, i: int) -> np.ndarray:
        return self.expand(self.symbols[self.symbol_ends[i - 1] if i else 0 : self.symbol_ends[i]])

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """Token ids ``[start, stop)`` of the shard."""
        reach = np.cumsum(self.sizes[self.symbols])
        a, b = np.searchsorted(reach, start, "right"), np.searchsorted(reach, stop, "left") + 1
        skip = start - (int(reach[a - 1]) if a else 0)
        return self.expand(self.symbols[a:b])[skip : skip + stop - start]


def write_tokens(
    docs: DataFrame, path: str, vocabulary: str, end_id: int, shard_tokens: int = SHARD_TOKENS, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Write shards ``(part, shard, tokens, payload)`` in ascending id order as Parquet under ``path``.

    A NULL or empty text is the end id alone. NULL ids come first; rows that repeat an id follow each other in the
    order of their texts. Documents are not split over shards, so a very long text makes a shard of its own length. An
    empty table gives no shards. Other columns are ignored.
    """
    frame = texts(docs, id_col, text_col)
    ordered = frame.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    schema = StructType.fromDDL("part INT, shard INT, tokens BIGINT, payload BINARY")
    end = end_id.to_bytes(4, "little")

    def run(batches):
        encode, part_no, number = encoder(vocabulary, True, KNOWN_WORDS).encode, TaskContext.get().partitionId(), 0
        ids, held, ends, size = [], [], [], 0

        def close():
            nonlocal number, ids, held, ends, size
            raw = dump_shard(ids, np.frombuffer(b"".join(held), "<u4"), np.array(ends, np.int64))
            row = [pa.array([part_no], pa.int32()), pa.array([number], pa.int32()), pa.array([size]), pa.array([raw], pa.binary())]
            ids, held, ends, size, number = [], [], [], 0, number + 1
            return pa.RecordBatch.from_arrays(row, names=schema.names)

        for part in slices(batches, 256):
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                raw = encode(text) + end
                ids.append(doc)
                held.append(raw)
                size += len(raw) // 4
                ends.append(size)
                if size >= shard_tokens:
                    yield close()
        if ids:
            yield close()

    ordered.mapInArrow(run, schema).write.parquet(path)


def read_tokens(spark: SparkSession, path: str, id_type: str = "BIGINT") -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` from the shards alone; ``start`` counts all ids of documents before."""
    shards = spark.read.parquet(path)
    schema = StructType.fromDDL(f"part INT, shard INT, doc_id {id_type}, at BIGINT, n_tokens BIGINT, ids_crc32 BIGINT")

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            for part, shard, raw in zip(*(batch.column(i) for i in range(3))):
                held = Shard(raw.as_py())
                n, ends = len(held.ids), held.ends
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                ids = memoryview(held.expand(held.symbols).astype("<u4").tobytes())
                crcs = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                columns = [[part.as_py()] * n, [shard.as_py()] * n, held.ids, starts, ends - starts, crcs]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, arrow.types)], names=schema.names)

    found = shards.select("part", "shard", "payload").mapInArrow(run, schema)
    # Sums within a part, then over the totals of the parts, of which there are as many as tasks that wrote.
    sizes = shards.select("part", "shard", "tokens")
    inner = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = sizes.groupBy("part").agg(F.sum("tokens").alias("all")).select("part", F.coalesce(F.sum("all").over(outer), F.lit(0)).alias("base"))
    within = sizes.select("part", "shard", F.coalesce(F.sum("tokens").over(inner), F.lit(0)).alias("before"))
    offsets = within.join(totals, "part").select("part", "shard", (F.col("base") + F.col("before")).alias("offset"))
    return found.join(offsets, ["part", "shard"]).select("doc_id", (F.col("offset") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), work_dir(spark, "tokens")
    write_tokens(docs, path, tokenizer_path("byte_bpe_50k.json"), end_id=2)
    return read_tokens(spark, path, schema_of(docs).fields[0].dataType.simpleString())
