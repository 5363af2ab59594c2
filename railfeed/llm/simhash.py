"""SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from railfeed.llm.common import components, each_text, free_name, staged, table, texts

BITS = 64


def shingle_hashes(text: str, shingle: int = 3) -> np.ndarray:
    """XXH64 (seed 42) of every run of words, repeats included; one hash of all words where there are fewer."""
    from xxhash import xxh64_intdigest

    joined = b" ".join(text.encode("utf-8", "surrogatepass").lower().split())
    if not joined:
        return np.empty(0, np.uint64)
    space = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32).tolist()
    starts, ends = [0, *(s + 1 for s in space)], [*space, len(joined)]
    if len(starts) < shingle:
        return np.array([xxh64_intdigest(joined, 42)], np.uint64)
    return np.array([xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts, ends[shingle - 1 :])], np.uint64)


def fingerprint(text: str, shingle: int = 3, block: int = 1 << 16) -> int:
    """64 majority bits as a signed integer; a text without words has 0."""
    hashes = shingle_hashes(text, shingle)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), block):
        part = hashes[at : at + block].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def covering_masks(radius: int) -> list[int]:
    """2^(radius+1) - 1 masks; any ``radius`` bits are all outside at least one of them.

    Bit i carries a non-zero vector m(i) of radius + 1 binary digits and mask v keeps the bits with an odd product
    of m(i) and v. The vectors of ``radius`` bits span at most ``radius`` dimensions, so some v is orthogonal to all.
    """
    count = 2 ** (radius + 1) - 1
    return [
        sum(1 << i for i in range(BITS) if ((i % count + 1) & v).bit_count() % 2) for v in range(1, count + 1)
    ]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, k1, k2, fp)``; k1 and k2 hash id and text, so that equal pairs mean repeated rows."""
    keyed = texts(docs, id_col, text_col).withColumns(row_keys("doc_id", "text"))
    return each_text(keyed, ["fp BIGINT"], lambda t: (fingerprint(t, shingle),), keep=("doc_id", "k1", "k2"))


def row_keys(id_col: str, text_col: str) -> dict[str, Column]:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return {"k1": F.xxhash64(id_col, text), "k2": F.xxhash64(text, F.lit(1), id_col)}


def linked(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """Edges ``(u, v)`` that connect exactly the fingerprints ``fp`` within ``radius`` (0 to 2) bits, by chains.

    Table t files a fingerprint under its bits inside mask t. Two fingerprints within the radius collide in the table
    whose mask has none of the bits they differ in, and there each is sent to itself with one of the bits outside the
    mask flipped, or none: they differ in at most two such bits if and only if they meet at one of these. At a meeting
    place all are within two bits of each other, so each is linked to the smallest one met: all links are kept through
    chains, no bucket is compared pair by pair, however many fingerprints it holds.
    """
    if radius not in (0, 1, 2):
        raise ValueError("radius must be 0, 1 or 2")
    if radius == 0:
        return distinct.select(F.col("fp").alias("u"), F.col("fp").alias("v")).where("false")
    masks = covering_masks(radius)
    filed = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("t", "k"))
    shared = filed.groupBy("t", "k").agg(F.count("*").alias("n")).where("n > 1").select("t", "k")
    collided = staged(filed.join(shared, ["t", "k"], "left_semi"), "collided")
    outside = F.array(*[F.array(*[F.lit(_signed(1 << i)) for i in range(BITS) if not m >> i & 1]) for m in masks])
    flips = F.element_at(outside, F.col("t") + 1)
    if radius == 2:
        places = F.transform(F.concat(F.array(F.lit(0).cast("long")), flips), lambda f: F.struct(F.lit(0).cast("long").alias("b"), F.col("fp").bitwiseXOR(f).alias("at")))
    else:
        places = F.transform(flips, lambda f: F.struct(f.alias("b"), F.col("fp").bitwiseOR(f).alias("at")))
    near = collided.select("fp", "t", "k", F.explode(places).alias("p")).select("fp", "t", "k", "p.b", "p.at")
    meet = near.withColumn("least", F.min("fp").over(Window.partitionBy("t", "k", "b", "at")))
    return meet.where("least < fp").select(F.col("fp").alias("u"), F.col("least").alias("v")).distinct()


def _groups(docs: DataFrame, shingle: int, radius: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Fingerprints per row, and ``(fp, root, first)`` per fingerprint with the first row of its group."""
    prints = staged(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2")
    nodes = prints.groupBy("fp").agg(F.min(order).alias("first"))
    roots = components(linked(nodes.select("fp"), radius))
    named = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = staged(named, "nodes")
    return prints, named


def simhash_groups(
    docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, fp, component_id)`` per row: the fingerprint and the smallest id linked to it by any chain.

    Equal fingerprints are one node, so copies cost one row each and no pair. A NULL or empty text, or one without
    words, has fingerprint 0 and links like any other. Rows with a NULL id get the smallest id of their group, NULL
    if there is none. Repeated rows give repeated results, an empty table gives none, extra columns are ignored.
    """
    prints, named = _groups(docs, shingle, radius, id_col, text_col)
    least = named.groupBy("root").agg(F.min("first").alias("first"))
    labels = named.select("fp", "root").join(least, "root").select("fp", F.col("first.doc_id").alias("component_id"))
    return prints.join(labels, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One document of each group stays, the one with the smallest ``doc_id``; all columns stay.

    Rows that repeat id and text are copies too, so one of them stays. A NULL id sorts last, so such a row stays
    only where no row of its group has an id.
    """
    _, named = _groups(docs, shingle, radius, "doc_id", "text")
    first = named.groupBy("root").agg(F.min("first").alias("first"))
    one, two = free_name(docs, "k1"), free_name(docs, "k2")
    keep = first.select(F.col("first.k1").alias(one), F.col("first.k2").alias(two))
    keys = row_keys("doc_id", "text")
    marked = docs.withColumns({one: keys["k1"], two: keys["k2"]})
    kept = marked.join(keep, [one, two], "left_semi").dropDuplicates([one, two])
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
