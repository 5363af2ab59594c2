"""Line dedup: winnowed line fingerprints, matches extended both ways, later repeated runs deleted."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from railfeed.llm.common import free_name, hash_bitmap, in_bitmap, maybe_in, release, schema_of, slices, small_batches, staged, table, texts

#: A fingerprint covers whole lines of at least GRAM words; every SPAN words of line starts select one.
GRAM, SPAN, MIN_RUN = 22, 14, 50
#: Of as many neighbouring words one ends a line. Runs of 4 * FOLD + GRAM + SPAN - 4 words or more share a fingerprint.
FOLD = 4
SHORTEST = 4 * FOLD + GRAM + SPAN - 4
#: Rows of as many of the most frequent fingerprints are dealt to all partitions where they are joined.
HOT = 500
#: Bits of the bitmap of repeated fingerprints: 16 MB, whatever the number of documents.
BITMAP_BITS = 1 << 27
#: Bits of the bitmaps of document keys: 8 MB.
KEY_BITS = 1 << 26
#: Words of more bytes are hashed one by one.
LONG = 64
_SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
#: The first 0 to 8 bytes of a number.
_HEAD = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_BASES = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def folds(hashes: np.ndarray, first: np.ndarray | None = None) -> np.ndarray:
    """Where lines start: at the first word, and after the smallest hash of each FOLD neighbours, the first of equal ones.

    With ``first``, the first word of each text and the end of the last, lines and neighbours stay within their text.
    """
    first = np.array([0, len(hashes)]) if first is None else first
    start = np.zeros(len(hashes) + 1, bool)
    if len(hashes) >= FOLD:
        keys = (_mix(hashes.astype(np.uint64)) << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64)
        least = keys[: len(hashes) - FOLD + 1]
        for i in range(1, FOLD):
            least = np.minimum(least, keys[i : i + len(least)])
        whole = np.ones(len(least), bool)
        for i in range(1, FOLD):  # neighbours over the end of a text are none
            ends = first[1:-1] - i
            whole[ends[(ends >= 0) & (ends < len(whole))]] = False
        start[(least[whole] & np.uint64(0xFFFFFFFF)).astype(np.int64) + 1] = True
    start[first] = True
    return start[:-1]


def word_edges(raw: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word in the bytes of several texts, which begin and end at ``cuts``."""
    if not len(raw):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    space = _SPACE[raw]
    before, after = np.ones(len(raw), bool), np.ones(len(raw), bool)
    before[1:], after[:-1] = space[:-1], space[1:]
    before[cuts[cuts < len(raw)]] = True
    after[cuts[cuts > 0] - 1] = True
    return np.flatnonzero(before & ~space), np.flatnonzero(after & ~space) + 1


def _hash_bytes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each range of bytes: eight at a time are mixed in, long ones take XXH64."""
    from xxhash import xxh64_intdigest

    eights = np.ndarray(len(raw) + 1, "<u8", np.concatenate([raw, np.zeros(8, np.uint8)]), strides=(1,))
    sizes = ends - starts
    out = _mix(sizes.astype(np.uint64) + np.uint64(_BASES[0]))
    which, at = np.arange(len(starts)), starts
    for done in range(0, LONG, 8):
        out[which] = _mix((out[which] ^ (eights[at] & _HEAD[np.minimum(sizes[which] - done, 8)])) + np.uint64(_BASES[1]))
        more = sizes[which] > done + 8
        which, at = which[more], at[more] + 8
        if not len(which):
            break
    for i in which.tolist():
        out[i] = xxh64_intdigest(raw[starts[i] : ends[i]])
    return out


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column without NULLs, one after the other, and where each begins and the last ends."""
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    cuts = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[cuts[0] : cuts[-1]] if data else np.empty(0, np.uint8)
    return raw, cuts - cuts[0]


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, which stands for it from here on, whether a line starts with it, and the first word
    of each text and the end of the last.

    Lines are folded by their words alone, whatever the line breaks, so a passage set between other words falls into
    the same lines as elsewhere, but for those at its two ends.
    """
    raw, cuts = _bytes_of(column)
    starts, ends = word_edges(raw, cuts)
    hashes, first = _hash_bytes(raw, starts, ends), np.searchsorted(starts, cuts)
    return hashes, folds(hashes, first), first


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, list[np.ndarray]] = {}


def _powers(which: int, n: int) -> list[np.ndarray]:
    """Powers of a base and of its inverse from 0 to ``n`` at least, modulo 2^64."""
    known = _POWERS.get(which)
    if known is None or len(known[0]) <= n:
        known = _POWERS[which] = []
        for base in (_BASES[which], pow(_BASES[which], -1, 1 << 64)):
            out = np.full(2 * n + 1, base, np.uint64)
            out[0] = 1
            known.append(np.multiply.accumulate(out))
    return known


def _run_hashes(hashes: np.ndarray, which: int = 0):
    """A function that hashes the runs ``[a, b)`` of the words, equal runs alike wherever they are; there are two of them."""
    up, down = _powers(which, len(hashes))
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(_mix(hashes.astype(np.uint64) + np.uint64(1 + which)) * up[: len(hashes)], out=total[1:])
    return lambda a, b: _mix((total[b] - total[a]) * down[a])


def winnow(parts: list[tuple[np.ndarray, np.ndarray]], gram: int = GRAM, span: int = SPAN):
    """``selected`` for several texts, given one by one as word hashes and starts."""
    first = np.cumsum([0, *(len(h) for h, _ in parts)])
    return selected(*(np.concatenate([p[i] for p in parts]) for i in (0, 1)), first, gram, span)


def selected(hashes: np.ndarray, start: np.ndarray, first: np.ndarray, gram: int = GRAM, span: int = SPAN):
    """``(text, position, gram)`` of the selected lines of several texts, given as ``word_hashes`` does.

    The gram of a line is a hash of the fewest lines from it on that hold ``gram`` words. Among the lines that start
    within ``span`` words of a line, the one with the smallest gram is selected, the first of equal ones. So any two
    runs of equal lines with ``gram + span`` words share a selected gram.
    """
    none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    at = np.flatnonzero(start)
    if not len(at):
        return none
    ends = np.append(at[1:], len(hashes))
    text = np.searchsorted(first, at, "right") - 1
    last = np.minimum(np.searchsorted(ends, at + gram), len(ends) - 1)
    full = (ends[last] >= at + gram) & (ends[last] <= first[text + 1])
    at, stop, text = at[full], ends[last][full], text[full]
    if not len(at):
        return none
    grams = _run_hashes(hashes)(at, stop)
    best, least = np.arange(len(at)), grams.copy()
    for step in range(1, min(span, len(at))):
        near = (at[step:] < at[:-step] + span) & (text[step:] == text[:-step])
        where = np.flatnonzero(near & (grams[step:] < least[:-step]))
        if not near.any():
            break
        least[where], best[where] = grams[where + step], where + step
    chosen = np.zeros(len(at), bool)
    chosen[best] = True
    return text[chosen], at[chosen] - first[text[chosen]], grams[chosen]


def merged(spans) -> list[list[int]]:
    """Overlapping and touching ranges made one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _same(a: np.ndarray, b: np.ndarray) -> int:
    """How many elements from the first on are equal."""
    n, done, step = min(len(a), len(b)), 0, 64
    while done < n:
        differ = a[done : done + step][: n - done] != b[done : done + step][: n - done]
        if differ.any():
            return done + int(differ.argmax())
        done, step = done + len(differ), step * 4
    return n


def extend(mine: np.ndarray, other: np.ndarray, pos: int, at: int) -> tuple[int, int]:
    """The run ``[a, b)`` of ``mine`` around ``pos`` that equals ``other`` around ``at``."""
    return pos - _same(mine[:pos][::-1], other[:at][::-1]), pos + _same(mine[pos:], other[at:])


def longest_runs(mine: np.ndarray, other: np.ndarray, places, min_run: int) -> list[tuple[int, int]]:
    """Runs of at least ``min_run`` words around the places ``(pos, at)``; those in a run of the same shift are left out."""
    out, reach = [], {}
    for pos, at in sorted(places):
        if pos >= reach.get(pos - at, 0):
            a, b = extend(mine, other, pos, at)
            reach[pos - at] = b
            if b - a >= min_run:
                out.append((a, b))
    return out


def _around(pos: np.ndarray, n: int, min_run: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last start of the windows of ``min_run`` words, in a text of ``n``, that hold the gram at each place."""
    return np.maximum(pos - max(min_run - GRAM, 0), 0), np.minimum(pos, n - min_run)


def window_starts(pos: np.ndarray, n: int, min_run: int) -> np.ndarray:
    """Starts of all windows that hold one of the grams."""
    lo, hi = _around(pos, n, min_run)
    edge = np.zeros(n + 2, np.int64)
    np.add.at(edge, lo[lo <= hi], 1)
    np.add.at(edge, hi[lo <= hi] + 1, -1)
    return np.flatnonzero(np.cumsum(edge) > 0)


def own_runs(hashes: np.ndarray, pos: np.ndarray, grams: np.ndarray, min_run: int) -> tuple[list[list[int]], np.ndarray]:
    """Runs that repeat an earlier one of the same text, and which places have only such windows around them.

    Such a place repeats one of its own document, which stands for it elsewhere.
    """
    if len(set(grams.tolist())) == len(grams):
        return [], np.zeros(len(pos), bool)
    _, which, n = np.unique(grams, return_inverse=True, return_counts=True)
    starts = window_starts(pos[n[which] > 1], len(hashes), min_run)
    if not len(starts):
        return [], np.zeros(len(pos), bool)
    _, first, which = np.unique(_run_hashes(hashes)(starts, starts + min_run), return_index=True, return_inverse=True)
    starts = starts[first[which] < np.arange(len(starts))]
    total = np.zeros(len(hashes) + 1, np.int64)
    total[starts + 1] = 1
    total = np.cumsum(total)
    lo, hi = _around(pos, len(hashes), min_run)
    return merged((a, a + min_run) for a in starts.tolist()), (lo <= hi) & (total[hi + 1] - total[lo] == hi + 1 - lo)


def _grams(docs: DataFrame) -> DataFrame:
    """The selected grams of all documents, one per row."""

    def run(batches):
        for part in slices(batches, 64):
            found = selected(*word_hashes(part.column(0)))
            yield pa.RecordBatch.from_arrays([pa.array(found[2].view(np.int64))], names=["gram"])

    return docs.where("doc_id IS NOT NULL").select("text").mapInArrow(run, "gram BIGINT")


def _marks(docs: DataFrame, repeated, min_run: int) -> DataFrame:
    """``(doc_id, k, size, words, marks, own)`` of documents with selected grams in the bitmap.

    ``words`` has all ``size`` word hashes, ``marks`` those grams, and ``own`` the runs that repeat within the document.
    """
    frame = docs.where("doc_id IS NOT NULL").select("doc_id", F.xxhash64("doc_id", "text").alias("k"), "text")
    schema = schema_of(
        frame, "size INT", "words BINARY", "marks ARRAY<STRUCT<pos: INT, gram: BIGINT>>",
        "own ARRAY<STRUCT<a: INT, b: INT>>", keep=("doc_id", "k"),
    )
    span = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
    mark = [pa.field("pos", pa.int32()), pa.field("gram", pa.int64())]

    def run(batches):
        bits = np.frombuffer(repeated.value, np.uint8)
        for part in slices(batches, 64):
            hashes, start, begin = word_hashes(part.column(2))
            found = selected(hashes, start, begin)
            hit = in_bitmap(bits, found[2])
            text, pos, grams = (x[hit] for x in found)
            rows, first = np.unique(text, return_index=True)
            words, own, inside = [], [], []
            for row, a, b in zip(rows.tolist(), first.tolist(), np.append(first[1:], len(text)).tolist()):
                mine = hashes[begin[row] : begin[row + 1]]
                words.append(mine.astype("<u8").tobytes())
                runs, again = own_runs(mine, pos[a:b], grams[a:b], min_run)
                own.append([{"a": x, "b": y} for x, y in runs])
                inside.append(again)
            stay = ~np.concatenate([np.empty(0, bool), *inside])
            edges = np.append(0, np.cumsum(np.bincount(np.searchsorted(rows, text[stay]), minlength=len(rows))))
            arrays = [pa.array(pos[stay].astype(np.int32)), pa.array(grams[stay].view(np.int64))]
            lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.StructArray.from_arrays(arrays, fields=mark))
            ids = [part.column(i).take(pa.array(rows, pa.int64())) for i in range(2)]
            sizes = pa.array(np.diff(begin)[rows].astype(np.int32))
            yield pa.RecordBatch.from_arrays([*ids, sizes, pa.array(words, pa.binary()), lists, pa.array(own, span)], names=schema.names)

    return frame.mapInArrow(run, schema)


def _hot(rows: DataFrame, key: str) -> Column:
    """Whether ``key`` is among the HOT most frequent ones of ``rows``, by a sketch of bounded size."""
    top = rows.agg(F.call_function("approx_top_k", F.col(key), F.lit(HOT), F.lit(8 * HOT)).alias("top")).first().top or []
    return F.col(key).isin([x.item for x in top]) if top else F.lit(False)


def _with_first(rows: DataFrame, keys: list[str], first: DataFrame) -> DataFrame:
    """``rows`` joined with their ``first`` by ``keys``; rows of the most frequent keys are dealt to all partitions."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = _hot(rows, keys[0])
    rows = rows.withColumn("salt", F.when(hot, F.pmod(F.xxhash64("k"), F.lit(parts))).otherwise(0))
    first = first.withColumn("salt", F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))))
    return rows.join(first.withColumn("salt", F.col("salt").cast("long")), [*keys, "salt"]).drop("salt")


def _extended(places: DataFrame, words: DataFrame, min_run: int) -> DataFrame:
    """``(k, a, b)`` of the equal runs around ``(k, pos)`` and the earlier ``(ck, at)``.

    The word hashes travel once per pair of documents, with all places of the pair, and only those of documents that
    are in one.
    """
    pairs = staged(places.groupBy("k", "ck").agg(F.collect_set(F.struct("pos", "at")).alias("places")), "line-pairs")
    earlier, later = (hash_bitmap(pairs.select(F.col(c).alias("k")).distinct(), "k", KEY_BITS) for c in ("ck", "k"))
    others = words.where(maybe_in(earlier, F.col("k"))).select(F.col("k").alias("ck"), F.col("words").alias("other"))
    mine = words.where(maybe_in(later, F.col("k"))).select("k", F.col("words").alias("mine"))
    both = pairs.join(others, "ck").join(mine, "k")
    kinds = [pa.int64(), pa.int32(), pa.int32()]

    def run(batches):
        # Rows of a document come together where the join sorts, so most of their overlaps are merged here.
        doc, spans, rows = None, set(), []
        for part in slices(batches, 16):
            near = part.column(3)
            pos, at = (near.flatten().field(i).to_numpy(zero_copy_only=False).tolist() for i in range(2))
            edges = np.cumsum([0, *near.value_lengths().to_pylist()]).tolist()
            for k, mine, other, i, j in zip(*(part.column(i).to_pylist() for i in range(3)), edges, edges[1:]):
                if k != doc:
                    rows += [(doc, a, b) for a, b in merged(spans)]
                    doc, spans = k, set()
                mine, other = np.frombuffer(mine, "<u8"), np.frombuffer(other, "<u8")
                spans.update(longest_runs(mine, other, zip(pos[i:j], at[i:j]), min_run))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), kinds)], names=["k", "a", "b"])
                rows = []
        if spans:
            rows = [(doc, a, b) for a, b in merged(spans)]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), kinds)], names=["k", "a", "b"])

    return both.select("k", "mine", "other", "places").mapInArrow(run, "k BIGINT, a INT, b INT")


def _windows(places: DataFrame, words: DataFrame, min_run: int, covered: DataFrame | None = None, asked=None) -> DataFrame:
    """``(doc_id, k, s, window, proof)``: start and two hashes of the windows around the places ``(k, pos)``.

    With ``covered`` only windows that reach out of the ``spans`` of their document, with a bitmap only those in it.
    """
    near = places.groupBy("k").agg(F.collect_set("pos").alias("places"))
    near = near.join(covered, "k", "left") if covered else near.withColumn("spans", F.lit(None).cast("array<struct<a: int, b: int>>"))
    both = words.join(near, "k").select("doc_id", "k", "words", "places", "spans")
    schema = schema_of(both, "s INT", "window BIGINT", "proof BIGINT", keep=("doc_id", "k"))

    def run(batches):
        bits = None if asked is None else np.frombuffer(asked.value, np.uint8)
        for part in slices(batches, 64):
            at, found, proofs = [], [], []
            for raw, places_, spans in zip(*(part.column(i).to_pylist() for i in (2, 3, 4))):
                hashes = np.frombuffer(raw, "<u8")
                starts = window_starts(np.array(places_, np.int64), len(hashes), min_run)
                if spans:
                    a, b = np.array(merged((x["a"], x["b"]) for x in spans)).T
                    i = np.searchsorted(a, starts, "right") - 1
                    starts = starts[(i < 0) | (b[i] < starts + min_run)]
                windows = _run_hashes(hashes)(starts, starts + min_run)
                if bits is not None:
                    hit = in_bitmap(bits, windows)
                    starts, windows = starts[hit], windows[hit]
                at.append(starts)
                found.append(windows)
                proofs.append(_run_hashes(hashes, 1)(starts, starts + min_run))
            rows = pa.array(np.repeat(np.arange(len(at)), [len(x) for x in at]))
            columns = [pa.array(np.concatenate(at).astype(np.int32)), *(pa.array(np.concatenate(x).view(np.int64)) for x in (found, proofs))]
            yield pa.RecordBatch.from_arrays([*(part.column(i).take(rows) for i in range(2)), *columns], names=schema.names)

    return both.mapInArrow(run, schema)


def repeated_runs(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """``(k, a, b)``: word ranges of documents that repeat an earlier run of ``min_run`` words or more.

    Earlier means a smaller ``doc_id``, or a place before it in the same document. The grams selected anywhere are
    counted first, and a bitmap of fixed size keeps those seen once out of the rest. Runs within a document are found
    where it is read. Each place of a repeated gram is joined with the first document that has it, and extended over
    all equal words. Where its gram occurs a third time and a window of ``min_run`` words around it reaches out of the
    runs found so far, those windows are joined by hash with the first equal ones around any place of the gram. So
    all runs are found, and a group of any size gives rows in proportion to its places. Ranges may overlap.

    Words are compared by 64-bit hashes, windows by two of them made of these. A ``min_run`` under the length that any
    two equal runs need to share a fingerprint is refused.
    """
    if min_run < SHORTEST:
        raise ValueError(f"min_run must be {SHORTEST} or more")
    spark = docs.sparkSession
    seen = _grams(docs).groupBy("gram").agg(F.count("*").alias("n")).where("n > 1")
    with small_batches(spark):
        repeated = hash_bitmap(seen, "gram", BITMAP_BITS)
        marked = staged(_marks(docs, repeated, min_run), "line-marks")
    words = marked.select("k", "words")
    own = marked.select("k", F.explode("own").alias("s")).select("k", "s.a", "s.b")
    marks = marked.select("doc_id", "k", "size", F.explode("marks").alias("m")).select("doc_id", "k", "size", "m.*")
    place = F.min(F.struct("doc_id", "k", "pos")).alias("first")
    first = marks.groupBy("gram").agg(place, F.count("*").alias("n")).where("n > 1")
    shared = staged(_with_first(marks, ["gram"], first), "line-shared")
    pair = ["k", "pos", F.col("first.k").alias("ck"), F.col("first.pos").alias("at")]
    with small_batches(spark):
        spans = staged(own.unionAll(_extended(shared.where("k <> first.k").select(*pair), words, min_run)), "line-spans")
    covered = spans.groupBy("k").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    left = shared.where("n > 2 AND k <> first.k").join(covered, "k", "left")
    inside = f"s -> s.a <= greatest(0, pos - {max(min_run - GRAM, 0)}) AND s.b >= least(size, pos + {min_run})"
    left = staged(left.where(f"spans IS NULL OR NOT exists(spans, {inside})").select("k", "pos", "gram"), "line-left")
    texts_ = marked.select("doc_id", "k", "words")
    used = hash_bitmap(left.select("k").distinct(), "k", KEY_BITS)
    grams = hash_bitmap(left.select("gram").distinct(), "gram", KEY_BITS)  # a few others pass it and join nothing
    with small_batches(spark):
        asked = hash_bitmap(_windows(left, texts_.where(maybe_in(used, F.col("k"))), min_run, covered), "window", BITMAP_BITS)
        near = staged(shared.where("n > 2").where(maybe_in(grams, F.col("gram"))).select("k", "pos"), "line-near")
        used = hash_bitmap(near.select("k").distinct(), "k", KEY_BITS)
        windows = staged(_windows(near, texts_.where(maybe_in(used, F.col("k"))), min_run, asked=asked), "line-windows")
    first = windows.groupBy("window", "proof").agg(F.min(F.struct("doc_id", "k", "s")).alias("first"), F.count("*").alias("n")).where("n > 1")
    more = _with_first(windows, ["window", "proof"], first).where("k <> first.k OR s <> first.s")
    out = staged(spans.unionAll(more.select("k", F.col("s").alias("a"), (F.col("s") + min_run).alias("b"))), "line-spans")
    release(marked, shared, spans, left, near, windows)
    return out


def cut_words(text: str, spans: list[tuple[int, int]]) -> tuple[str, int]:
    """The text without the words in the ranges, which may overlap, and how many words went."""
    raw = text.encode("utf-8", "surrogatepass")
    starts, ends = word_edges(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    out, done, gone = [], 0, 0
    for a, b in merged(spans):
        gone += b - a
        if b < len(starts):
            out.append(raw[done : starts[a]])
            done = starts[b]
        else:  # to the end, with the space before it
            out.append(raw[done : max(done, ends[a - 1] if a else 0)])
            done = len(raw)
    return b"".join([*out, raw[done:]]).decode("utf-8", "surrogatepass"), gone


def drop_repeated_runs(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """All rows and columns of ``docs``, with later repeated runs cut out of ``text`` and ``n_chars`` brought up to date.

    The first place of a run keeps it. A text that is wholly repeated becomes empty, its row stays. Rows whose id or
    text is NULL stay as they are; rows that repeat id and text are one document and change alike. Where there is no
    ``n_chars`` of whole numbers none is added or changed; columns of any other name are kept. An empty table stays
    empty, texts of any length are read whole.
    """
    found = repeated_runs(texts(docs), min_run)
    touched = hash_bitmap(found.select("k").distinct(), "k", KEY_BITS)
    key, hit, ranges = (free_name(docs, n) for n in ("key", "hit", "ranges"))
    spans = found.groupBy(F.col("k").alias(key)).agg(F.collect_list(F.struct("a", "b")).alias(ranges))
    columns_ = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.withColumn(key, F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", F.coalesce("text", F.lit("")))))
    marked = marked.withColumn(hit, maybe_in(touched, F.col(key)))
    rest = marked.where(~F.col(hit)).select(*columns_)  # most documents; these are not shuffled
    marked = marked.where(F.col(hit)).join(spans, key, "left").select(*columns_, ranges)
    where = docs.columns.index("text")
    counted = "n_chars" in docs.columns and isinstance(docs.schema["n_chars"].dataType, IntegralType)

    def run(batches):
        for part in slices(batches):
            found = part.column(part.num_columns - 1).to_pylist()
            columns = [part.column(i) for i in range(part.num_columns - 1)]
            names = part.schema.names[:-1]
            if any(found):
                new = columns[where].to_pylist()
                for i, spans in enumerate(found):
                    if spans and new[i] is not None:
                        new[i] = cut_words(new[i], [(s["a"], s["b"]) for s in spans])[0]
                columns[where] = pa.array(new, type=columns[where].type)
                if counted:
                    i = names.index("n_chars")
                    sizes = [len(t) if s and t is not None else old for t, s, old in zip(new, found, columns[i].to_pylist())]
                    columns[i] = pa.array(sizes, type=columns[i].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rest.unionAll(marked.mapInArrow(run, docs.schema))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cleaned = drop_repeated_runs(docs.withColumn("n_chars", F.char_length(F.coalesce("text", F.lit("")))))
    return cleaned.select("doc_id", F.col("text").alias("clean_text"), F.col("n_chars").alias("clean_chars"))
