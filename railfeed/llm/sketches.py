"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests."""

from __future__ import annotations

import base64
import bisect
import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railfeed.llm.common import schema_of, slices, table, texts

#: Cells of the first level of a fingerprint, cells per digest, and fold of long paragraphs.
CELLS, HASHES, FOLD = 16, 3, 16


def paragraph_digests(text: str, fold: int = FOLD) -> np.ndarray:
    """A 64-bit digest of each paragraph, told apart by how often it occurred before, so copies count.

    A paragraph ends at a line break; long ones are folded after each word whose hash is a multiple of ``fold``, so
    that a change in a paragraph leaves the digests of its other parts.
    """
    from xxhash import xxh64_intdigest

    seen: dict[bytes, int] = {}
    out = []
    for line in text.encode("utf-8", "surrogatepass").split(b"\n"):
        words = line.split()
        cuts = [i for i, c in enumerate(map(zlib.crc32, words), 1) if not c % fold]
        for a, b in zip([0, *cuts], [*cuts, len(words)]):
            if a < b:
                part = b" ".join(words[a:b])
                again = seen[part] = seen.get(part, 0) + 1
                out.append(xxh64_intdigest(part, again))
    return np.array(out, np.uint64)


def _mix(x: np.ndarray, salt) -> np.ndarray:
    x = x + np.asarray(salt, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_CHECK, _LOW = 1 << 20, np.uint64(0xFFFFFFFF)


class Sketches:
    """Many sketches side by side, each with its own number of cells and hashes.

    A cell has a count, the sum of its digests modulo 2^64 and the sum of their checks modulo 2^32. Sketches of equal shape
    subtract cell by cell; that gives the same as taking the digests of one out of the other, which is what
    ``update`` with a sign of -1 does.
    """

    def __init__(self, cells: np.ndarray, salts: np.ndarray):
        self.third = np.maximum(np.asarray(cells, np.int64) // HASHES, 1)
        self.salts = np.asarray(salts, np.uint64)
        sizes = HASHES * self.third
        self.base = np.cumsum(sizes) - sizes
        self.owner = np.repeat(np.arange(len(sizes)), sizes)
        self.count = np.zeros(len(self.owner), np.int64)
        self.keys, self.checks = np.zeros(len(self.owner), np.uint64), np.zeros(len(self.owner), np.uint64)

    def update(self, which: np.ndarray, digests: np.ndarray, sign: np.ndarray) -> None:
        """Add (1) or take out (-1) digests, each of the sketch ``which`` names."""
        factor = sign.astype(np.int64).view(np.uint64)
        third, base, salt = self.third[which], self.base[which], self.salts[which] * np.uint64(HASHES)
        keys, checks = digests * factor, _mix(digests, _CHECK) * factor
        for i in range(HASHES):  # each hash has a third of the cells, so a digest never meets itself
            at = base + i * third + (_mix(digests, salt + np.uint64(i)) % third.astype(np.uint64)).astype(np.int64)
            np.add.at(self.count, at, sign)
            np.add.at(self.keys, at, keys)
            np.add.at(self.checks, at, checks)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(which, digests, signs, failed)``: what the cells give up, and the sketches that are not empty then."""
        found = [(np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64))]
        look = np.arange(len(self.owner))
        while len(look):
            look = look[np.abs(self.count[look]) == 1]
            sign = self.count[look]
            digests = self.keys[look] * sign.view(np.uint64)
            pure = (_mix(digests, _CHECK) ^ (self.checks[look] * sign.view(np.uint64))) & _LOW == 0
            which, digests, sign = self.owner[look[pure]], digests[pure], sign[pure]
            _, first = np.unique(_mix(digests, which.astype(np.uint64)), return_index=True)
            if not len(first):
                break
            which, digests, sign = which[first], digests[first], sign[first]
            found.append((which, digests, sign))
            self.update(which, digests, -sign)
            look = np.flatnonzero(self.count)
        left = np.zeros(len(self.third), bool)
        left[self.owner[(self.count != 0) | (self.keys != 0)]] = True
        return (*(np.concatenate(x) for x in zip(*found)), left)

    def cells(self, which: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts, sums and checks of one sketch."""
        at = slice(self.base[which], self.base[which] + HASHES * self.third[which])
        return self.count[at], self.keys[at], self.checks[at]

    def put(self, which: int, cells) -> None:
        at = slice(self.base[which], self.base[which] + HASHES * self.third[which])
        self.count[at], self.keys[at], self.checks[at] = cells


def _flat(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    which = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    return which, np.concatenate(lists) if lists else np.empty(0, np.uint64)


def _filled(lists: list[np.ndarray], cells, salts) -> Sketches:
    out = Sketches(cells, salts)
    which, flat = _flat(lists)
    out.update(which, flat, np.ones(len(flat), np.int64))
    return out


def _dealt(cells: int, n: int) -> list[int]:
    """Cells of the levels that a fingerprint of ``n`` digests shares with others: four times as many each."""
    out = [cells]
    while out[-1] * 16 <= n:
        out.append(out[-1] * 4)
    return out


class Fingerprints:
    """Fingerprints of many lists of digests: sketches in levels, from small ones for small differences to one that
    gives up all digests.

    Sketches of the shared levels have the same cells in all fingerprints, so two of them subtract. The last one has
    cells for its own list alone; it is made larger until it peels. What a fingerprint holds depends on its own list
    only, and any two of them give their exact difference without the texts.
    """

    def __init__(self, lists: list[np.ndarray], cells: int = CELLS):
        self.first, self.sizes = cells, np.array([len(x) for x in lists], np.int64)
        self.levels: list[tuple[np.ndarray, Sketches]] = []
        deep = np.array([len(_dealt(cells, n)) for n in self.sizes.tolist()], np.int64)
        for level in range(int(deep.max(initial=0))):
            rows = np.flatnonzero(deep > level)
            size = cells * 4**level
            self.levels.append((rows, _filled([lists[i] for i in rows], np.full(len(rows), size), np.full(len(rows), level + 1))))
        self.whole = np.maximum(cells, self.sizes * 27 // 20 + 12)
        self.salts = np.full(len(lists), 100)
        self.last: list = [None] * len(lists)
        open_ = np.arange(len(lists))
        while len(open_):
            made = _filled([lists[i] for i in open_], self.whole[open_], self.salts[open_])
            for j, i in enumerate(open_.tolist()):
                self.last[i] = tuple(x.copy() for x in made.cells(j))
            which, digests, sign, failed = made.peel()
            peeled = np.bincount(which, sign, minlength=len(open_)).astype(np.int64)
            failed |= peeled != self.sizes[open_]
            open_ = open_[failed]
            self.whole[open_] += self.whole[open_] // 4
            self.salts[open_] += 1

    def dumps(self) -> list[str]:
        """Each fingerprint in base64: digests, cells and hash number of the last level, then counts, sums and checks of all levels."""
        own: list[list] = [[] for _ in self.last]
        for rows, sketches in self.levels:
            for j, i in enumerate(rows.tolist()):
                own[i].append(sketches.cells(j))
        out = []
        for i, levels in enumerate(own):
            head = np.array([self.sizes[i], self.whole[i], self.salts[i]], "<u4").tobytes()
            parts = [x for c, k, h in [*levels, self.last[i]] for x in (c.astype("<i4"), k.astype("<u8"), (h & _LOW).astype("<u4"))]
            out.append(base64.b64encode(b"".join([head, *(x.tobytes() for x in parts)])).decode())
        return out

    @classmethod
    def loads(cls, prints: list[str], cells: int = CELLS) -> Fingerprints:
        """The fingerprints that ``dumps`` wrote, of the same cells in the first level."""
        raws = [base64.b64decode(p) for p in prints]
        out = cls([], cells)
        heads = np.array([np.frombuffer(r, "<u4", 3) for r in raws], np.int64).reshape(-1, 3)
        out.sizes, out.whole, out.salts = heads[:, 0].copy(), heads[:, 1].copy(), heads[:, 2].copy()
        deep = np.array([len(_dealt(cells, n)) for n in out.sizes.tolist()], np.int64)
        at = np.full(len(raws), 12)

        def read(i: int, n: int):
            n, parts = HASHES * max(n // HASHES, 1), []
            for kind in ("<i4", "<u8", "<u4"):
                parts.append(np.frombuffer(raws[i], kind, n, at[i]).astype(np.int64 if kind == "<i4" else np.uint64))
                at[i] += parts[-1].size * int(kind[2])
            return tuple(parts)

        for level in range(int(deep.max(initial=0))):
            rows = np.flatnonzero(deep > level)
            sketches = Sketches(np.full(len(rows), cells * 4**level), np.full(len(rows), level + 1))
            for j, i in enumerate(rows.tolist()):
                sketches.put(j, read(i, cells * 4**level))
            out.levels.append((rows, sketches))
        out.last = [read(i, int(n)) for i, n in enumerate(out.whole.tolist())]
        return out

    def _listed(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(position in which, digest)`` of all digests, peeled from the last levels."""
        made = Sketches(self.whole[which], self.salts[which])
        if len(which):
            made.count, made.keys, made.checks = (np.concatenate(x) for x in zip(*(self.last[i] for i in which.tolist())))
        return made.peel()[:2]

    def differences(self, left, right) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(pair, digest, side)`` of all digests that only one of ``left[pair]`` and ``right[pair]`` has; side 1 is the left.

        The smallest level is subtracted and peeled first. Where it is too small for the difference the next one is
        tried, and after the last shared one both lists are peeled whole.
        """
        left, right = np.asarray(left, np.int64), np.asarray(right, np.int64)
        apart = self.sizes[left] - self.sizes[right]
        found = [(np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64))]
        open_ = np.ones(len(left), bool)
        for level, (rows, sketches) in enumerate(self.levels):
            size, place = self.first * 4**level, np.full(len(self.sizes), -1)
            place[rows] = np.arange(len(rows))
            a, b = place[left], place[right]
            tried = np.flatnonzero(open_ & (a >= 0) & (b >= 0) & (np.abs(apart) <= size))
            both = Sketches(np.full(len(tried), size), np.full(len(tried), level + 1))
            for name in ("count", "keys", "checks"):
                cells = getattr(sketches, name).reshape(len(rows), -1)
                setattr(both, name, (cells[a[tried]] - cells[b[tried]]).ravel())
            which, digests, sign, failed = both.peel()
            failed |= np.bincount(which, sign, minlength=len(tried)).astype(np.int64) != apart[tried]
            done = ~failed[which]
            found.append((tried[which[done]], digests[done], sign[done]))
            open_[tried[~failed]] = False
        rest = np.flatnonzero(open_)
        sides = [self._listed(x[rest]) for x in (left, right)]
        pair = np.concatenate([p for p, _ in sides])
        digests = np.concatenate([d for _, d in sides])
        sign = np.repeat([1, -1], [len(p) for p, _ in sides])
        order = np.lexsort((digests, pair))
        pair, digests, sign = pair[order], digests[order], sign[order]
        same = np.zeros(len(pair) + 1, bool)
        same[1:-1] = (pair[1:] == pair[:-1]) & (digests[1:] == digests[:-1])
        alone = ~(same[1:] | same[:-1])
        found.append((rest[pair[alone]], digests[alone], sign[alone]))
        return tuple(np.concatenate(x) for x in zip(*found))

    def likeness(self, left, right) -> list[float]:
        """Shared digests over all distinct ones of each pair, from the peeled difference; 1 for two without any."""
        differ = np.bincount(self.differences(left, right)[0], minlength=len(left)).tolist()
        both = (self.sizes[left] + self.sizes[right]).tolist()
        return [(n - d) / (n + d) if n else 1.0 for n, d in zip(both, differ)]


def with_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Rows sorted by ``(bucket, doc_id, text)`` within each task, led by the row before each bucket's first.

    Buckets are ranges of ids between approximate quantiles. The last row of a bucket is also sent to the next bucket
    that has rows, marked as ``lead``, so that neighbours meet in one task and each text is shuffled once. The driver
    holds a few numbers per bucket.
    """
    spark = docs.sparkSession
    parts = parts or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = docs.select("doc_id").approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.1 / parts) if parts > 1 else []
    cuts = sorted({int(c) for c in cuts})
    bucket = F.lit(0)
    if cuts:
        edges = F.array(*[F.lit(c).cast("long") for c in cuts])
        bucket = F.size(F.filter(edges, lambda e: e <= F.col("doc_id"))) if len(cuts) < 8 else _bucket_udf(cuts)(F.col("doc_id"))
    bucket = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(bucket)
    placed = docs.select(bucket.cast("int").alias("bucket"), "doc_id", "text")
    last = placed.groupBy("bucket").agg(F.max("doc_id").alias("top")).orderBy("bucket").collect()
    follow = {row.bucket: after.bucket for row, after in zip(last, last[1:] + last[:1])}
    tops = {row.bucket: row.top for row in last}
    if not follow:
        return placed.withColumn("lead", F.lit(False))
    rows = [(b, tops[b], follow[b]) for b in follow]
    ends = spark.createDataFrame(rows, "bucket INT, top BIGINT, follow INT")
    marked = placed.join(F.broadcast(ends), "bucket")  # one row per bucket
    where = F.array(F.struct(F.col("bucket"), F.lit(False).alias("lead")))
    at_end = F.col("doc_id").eqNullSafe(F.col("top"))
    both = F.when(at_end, F.concat(where, F.array(F.struct(F.col("follow").alias("bucket"), F.lit(True).alias("lead"))))).otherwise(where)
    sent = marked.select(F.explode(both).alias("to"), "doc_id", "text").select("to.bucket", "to.lead", "doc_id", "text")
    return sent.repartitionById(parts, "bucket").sortWithinPartitions("bucket", F.desc("lead"), "doc_id", "text")


def _bucket_udf(cuts: list[int]):
    @F.arrow_udf("int")
    def place(column: pa.Array) -> pa.Array:
        return pa.array([0 if v is None else bisect.bisect_right(cuts, v) for v in column.to_pylist()], pa.int32())

    return place


def edited(text: str, other: str) -> str:
    """The last third of the code points replaced by as many of the first of ``other``, or all of them."""
    third = len(text) // 3
    return text[: len(text) - third] + other[:third]


def fingerprint_edits(docs: DataFrame, cells: int = CELLS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: sketches of its text and of its edited text, and their likeness to each other and to the next row's.

    The next row is the one before it in ascending order of id, text, and the last one for the first. NULL texts are
    empty; NULL ids come first; repeated rows follow each other and repeat in the result. A single row is its own
    next one. An empty table gives no rows, other columns are ignored. Ids are integers.
    """
    frame = with_next(texts(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long")))
    schema = schema_of(
        frame, "n_chars BIGINT", "edited_sha256 STRING", "fingerprint STRING", "edited_fingerprint STRING", "near_edited DOUBLE", "near_next DOUBLE"
    )
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]

    def run(batches):
        before = None
        for part in slices(batches, 128):
            rows, changed, own, after = [], [], [], []
            every = [] if before is None else [before[1]]
            for lead, doc, text in zip(*(part.column(part.schema.get_field_index(c)).to_pylist() for c in ("lead", "doc_id", "text"))):
                digests = paragraph_digests(text)
                if not lead:
                    new = edited(text, before[0])
                    changed.append(paragraph_digests(new))
                    own.append(len(every))
                    after.append(len(every) - 1)
                    rows.append((doc, len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest()))
                every.append(digests)
                before = text, digests
            prints = Fingerprints(every + changed, cells)
            new = list(range(len(every), len(every) + len(changed)))
            texts_ = prints.dumps()
            columns = list(zip(*rows)) if rows else [[]] * 3
            columns += [[texts_[i] for i in own], [texts_[i] for i in new]]
            columns += [prints.likeness(own, new), prints.likeness(own, after)]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], names=schema.names)

    return frame.mapInArrow(run, schema)


def op10_iblt_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))
