"""Benchmark decontamination by template windows with slot checks."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railfeed.llm.common import hash_bitmap, in_bitmap, release, schema_of, slices, staged, table, texts

#: Words per template window, fewest of them that must not be slots, share of an item's windows to find.
WINDOW, LITERALS, COVERAGE = 5, 2, 0.5
#: Bits of the bitmap of window hashes that documents are tested against: 8 MB, whatever the benchmark's size.
BITMAP_BITS = 1 << 26
#: Units and number words that stand for slots.
UNITS = frozenset(
    "mm cm m km in ft yd mi mg g kg t lb lbs oz ml cl l s sec min h hr hrs hour hours minute minutes second seconds day days "
    "week weeks month months year years meter meters metre metres kilometer kilometers kilometre kilometres mile miles gram "
    "grams kilogram kilograms liter liters litre litres dollar dollars cent cents euro euros pound pounds percent kmh mph".split()
)
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen "
    "nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)
_EDGES = re.compile(r"^[^\w$€£%]+|[^\w$€£%]+$")
_NUMBER = re.compile(r"([$€£]?)([+-]?\d[\d.,:/]*)([$€£%]?|[a-zA-Zµ]{1,3})")
_SLOTS = {1: "num", 2: "name", 3: "unit"}


def canonical(word: str) -> list[tuple[int, str]]:
    """``(kind, value)`` pairs of a word: kind 0 is the lower-case word itself, others are typed slots.

    Numbers (digits or number words), currency signs and units, and capitalised words as names become slots. The rule
    looks at the word alone, so a passage gives the same template wherever it stands. Signs around a word are
    dropped, a word of signs only gives nothing.
    """
    if not word.isalpha():
        word = _EDGES.sub("", word)
        if not word:
            return []
    if word[0].isdigit() or word[0] in "$€£+-" or word[-1].isdigit():
        if hit := _NUMBER.fullmatch(word):
            sign, value, tail = hit.groups()
            out = [(3, sign)] if sign else []
            out.append((1, value.rstrip(".,:/")))
            return [*out, (3, tail.lower())] if tail else out
    low = word.lower()
    if low in NUMBER_WORDS:
        return [(1, low)]
    if low in UNITS or word in "$€£%":
        return [(3, low)]
    if len(word) > 1 and word.istitle():
        return [(2, low)]
    return [(0, low)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_CORE = re.compile(r"[\w$€£%](?:\S*[\w$€£%])?")
_SLOT_HASH = _mix(np.arange(4, dtype=np.uint64) + np.uint64(1 << 40))
_FIXED = np.sort(np.array([zlib.crc32(w.encode()) for w in UNITS | NUMBER_WORDS], np.uint32))


class Tokens:
    """Canonical tokens of a text: a hash and a kind each, and the word that gave it."""

    def __init__(self, text: str, known: dict[str, list]):
        self.words = _CORE.findall(text)
        low = list(map(str.lower, self.words))
        raw = " ".join(low).encode("utf-8", "surrogatepass").split(b" ") if low else []
        crc = np.array(list(map(zlib.crc32, raw)), np.uint32)
        self.hashes, self.kinds = crc.astype(np.uint64), np.zeros(len(low), np.int8)
        self.word, self.part = np.arange(len(low)), np.zeros(len(low), np.int64)
        self.known = known
        self.kinds[np.array(list(map(str.istitle, self.words)), bool) & (np.array(list(map(len, low)), np.int64) > 1)] = 2
        near = _FIXED[np.minimum(np.searchsorted(_FIXED, crc), len(_FIXED) - 1)]
        for i in np.flatnonzero(near == crc).tolist():
            if low[i] in UNITS or low[i] in NUMBER_WORDS:
                self.kinds[i] = canonical(low[i])[0][0]
        odd = np.flatnonzero(~np.array(list(map(str.isalpha, self.words)), bool)).tolist()
        if odd:
            self._expand(odd)
        slot = self.kinds > 0
        self.hashes[slot] = _SLOT_HASH[self.kinds[slot]]

    def _parts(self, i: int) -> list[tuple[int, str]]:
        word = self.words[i]
        if word not in self.known:
            self.known[word] = canonical(word)
        return self.known[word]

    def _expand(self, odd: list[int]) -> None:
        """Words that are not letters alone can be several tokens, or none."""
        parts = [self._parts(i) for i in odd]
        counts = np.ones(len(self.words), np.int64)
        counts[odd] = [len(p) for p in parts]
        self.word = np.repeat(self.word, counts)
        first = np.cumsum(counts) - counts
        self.part = np.arange(len(self.word)) - first[self.word]
        self.hashes, self.kinds = self.hashes[self.word], self.kinds[self.word]
        for i, found in zip(odd, parts):
            for j, (kind, value) in enumerate(found):
                self.kinds[first[i] + j] = kind
                self.hashes[first[i] + j] = zlib.crc32(value.encode("utf-8", "surrogatepass"))

    def slots(self, start: int, stop: int) -> list[str]:
        """Type and value of the slots in a range of tokens."""
        out = []
        for i in range(start, stop):
            if self.kinds[i]:
                kind, value = canonical(self.words[self.word[i]])[self.part[i]]
                out.append(f"{_SLOTS[kind]}={value}")
        return out

    def windows(self, window: int, literals: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes of the windows with enough words that are no slots."""
        n = len(self.hashes) - window + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        total, plain, literal = np.zeros(n, np.uint64), np.zeros(n, np.int8), self.kinds == 0
        for i in range(window):
            total = _mix(total + np.uint64(0x9E3779B97F4A7C15)) + self.hashes[i : i + n]
            plain += literal[i : i + n]
        at = np.flatnonzero(plain >= literals)
        return at, _mix(total[at])


def _windows(frame: DataFrame, bitmap=None, lengths: list[int] | None = None, window: int = WINDOW, literals: int = LITERALS) -> DataFrame:
    """``(doc_id, pos, hash, slots, length, windows)`` per template window, only those in the bitmap where one is given.

    ``slots`` holds kind and value of each slot in the window in order, ``windows`` the text's number of windows.
    Windows have ``lengths`` tokens; where none are given they have ``window``, or all tokens of a shorter text.
    """
    schema = schema_of(frame, "pos INT", "hash BIGINT", "slots ARRAY<STRING>", "length INT", "windows INT")

    def run(batches):
        known: dict[str, list] = {}
        bits = None if bitmap is None else np.frombuffer(bitmap.value, np.uint8)
        for part in slices(batches, 256):
            rows, at_row = [], []
            if len(known) > 100_000:
                known.clear()
            for row, text in enumerate(part.column(1).to_pylist()):
                tokens = Tokens(text, known)
                for length in lengths or [max(1, min(window, len(tokens.hashes)))]:
                    at, found = tokens.windows(length, literals)
                    count = len(at)
                    if bits is not None and count:
                        hit = in_bitmap(bits, found)
                        at, found = at[hit], found[hit]
                    for pos, h in zip(at.tolist(), found.view(np.int64).tolist()):
                        rows.append((pos, h, tokens.slots(pos, pos + length), length, count))
                        at_row.append(row)
            columns = list(zip(*rows)) if rows else [[]] * 5
            kinds_ = [pa.int32(), pa.int64(), pa.list_(pa.string()), pa.int32(), pa.int32()]
            ids = part.column(0).take(pa.array(at_row, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, type=t) for c, t in zip(columns, kinds_))], names=schema.names)

    return frame.mapInArrow(run, schema)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    coverage: float = COVERAGE,
    window: int = WINDOW,
    literals: int = LITERALS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``(doc_id, item_id, coverage, reworded)`` for each document that holds a benchmark item, plain or re-parameterised.

    Windows of canonical tokens are joined by hash. A slot value of the item stands for one value of the document at one
    shift: the one that most windows there have, of equally frequent ones the same value. Windows with another one do
    not count, the others do. ``coverage`` is the share of the item's windows found that way at any shift, ``reworded``
    says that some slot value differs. An item shorter than a window is a window of its own, and found only with its own
    slot values. An item needs a window with ``literals`` words that are no slots; without one it matches nothing, nor do
    NULL and empty texts. Rows that repeat an id are taken together, NULL ids too, as one document; repeated items
    likewise. Texts of any length are read whole. Empty tables give no rows; other columns are ignored.

    A document that has the share asked for of an item's windows has one of its rarest ones, however many the others
    are. So only these are joined first, and a phrase that many items share brings no pairs of its own.
    """
    windows_ = staged(_windows(texts(benchmark, item_col, item_text_col), None, None, window, literals), "template-items")
    lengths = sorted(r.length for r in windows_.select("length").distinct().collect())  # up to ``window`` of them
    bitmap = hash_bitmap(windows_, "hash", BITMAP_BITS)
    found = staged(_windows(texts(docs, id_col, text_col), bitmap, lengths or [window], window, literals), "template-windows")
    found = found.select("doc_id", "pos", "hash", "slots")
    items = staged(
        windows_.select(
            F.col("doc_id").alias("item_id"), F.col("pos").alias("ipos"), "hash", F.col("slots").alias("islots"),
            (F.col("length") < window).alias("short"), F.col("windows").alias("iw"),
        ).distinct(),
        "template-windows-of-items",
    )
    # a document with c of an item's w windows has one of any w - c + 1
    asked = _rarest(items, coverage).join(found.select("doc_id", "hash").distinct(), "hash").select("doc_id", "item_id").distinct()
    asked = staged(asked, "template-pairs").select(F.col("doc_id").alias("asked_doc"), F.col("item_id").alias("asked_item"))
    hits = found.join(asked, F.col("doc_id").eqNullSafe(F.col("asked_doc"))).withColumnRenamed("hash", "dhash")
    hits = hits.join(items, F.col("item_id").eqNullSafe(F.col("asked_item")) & (F.col("hash") == F.col("dhash")))
    # Equal templates have equal slot kinds, so pairs of values line up.
    pairs = F.transform(F.arrays_zip("islots", "slots"), lambda p: F.struct(p["islots"].alias("i"), p["slots"].alias("s")))
    hits = hits.select("doc_id", "item_id", (F.col("pos") - F.col("ipos")).alias("shift"), "ipos", "iw", "short", pairs.alias("pairs"))
    lined = hits.groupBy("doc_id", "item_id", "shift").agg(
        F.collect_set(F.struct("ipos", "pairs")).alias("hits"), F.max("iw").alias("iw"), F.max("short").alias("short")
    )
    pairs = F.flatten("hits.pairs")
    one_each = F.size(F.array_distinct(F.transform(pairs, lambda p: p["i"]))) == F.size(F.array_distinct(pairs))
    lined = lined.withColumn("hits", F.when(one_each, F.col("hits")).otherwise(F.expr(_AGREEING))).where("size(hits) > 0")
    differs = F.exists(F.flatten("hits.pairs"), lambda p: p["i"] != p["s"])
    lined = lined.select("doc_id", "item_id", F.col("hits.ipos").alias("at"), "iw", "short", differs.alias("differs")).where("NOT (short AND differs)")
    per_item = lined.groupBy("doc_id", "item_id").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("at")))).alias("n"), F.max("iw").alias("iw"), F.max("differs").alias("reworded")
    )
    share = F.col("n") / F.col("iw")
    out = per_item.where(share >= coverage).select("doc_id", "item_id", F.least(share, F.lit(1.0)).alias("coverage"), "reworded")
    out = staged(out, "contaminated")
    release(windows_)
    return out


# Windows whose slot values are those taken: per value of the item, the value of the document that most windows have.
# Every step is bound to a name by a one-element array, so that it is worked out once and not for each window.
_AGREEING = """element_at(transform(array(flatten(hits.pairs)), flat -> element_at(
  transform(array(transform(array_distinct(flat), p -> struct(p.i AS i, size(filter(flat, q -> q = p)) AS n, p.i = p.s AS same, p.s AS s))),
  known -> element_at(transform(array(transform(
    filter(known, a -> NOT exists(known, b -> b.i = a.i AND struct(b.n, b.same, b.s) > struct(a.n, a.same, a.s))),
    a -> struct(a.i AS i, a.s AS s))),
  taken -> filter(hits, h -> forall(h.pairs, p -> array_contains(taken, p)))), 1)), 1)), 1)"""


def _rarest(items: DataFrame, coverage: float) -> DataFrame:
    """``(item_id, hash)``: so many of an item's windows, those in fewest items first, that the rest is less than the share asked for."""
    common = items.select("item_id", "hash").distinct().groupBy("hash").agg(F.count("*").alias("items"))
    own = items.join(common, "hash").groupBy("item_id").agg(
        F.array_sort(F.collect_set(F.struct("items", "ipos", "hash"))).alias("windows"), F.max("iw").alias("iw")
    )
    enough = F.greatest(F.lit(1), F.size("windows") - F.ceil(F.lit(coverage) * F.col("iw")).cast("int") + 1)
    return own.select("item_id", F.explode(F.slice("windows", F.lit(1), enough)).alias("w")).select("item_id", "w.hash").distinct()


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose document holds no benchmark item; ids compare NULL-safely."""
    bad = contaminated(docs, benchmark).select("doc_id").distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["doc_id"]), "left_anti")


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
