from __future__ import annotations

import itertools
import random

import pytest
from railfeed.llm import simhash as S


def _union(ids):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    def join(a, b):
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)

    return find, join


def _plain_fingerprint(text):
    import xxhash

    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
    runs = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_is_the_majority_of_the_shingle_hashes(text_rows):
    for text in [*list(text_rows.values())[:40], "", "one", "Two Words", "ÉTÉ À LA", "a b c\x1cd e f"]:
        assert S.fingerprint(text) & (1 << 64) - 1 == _plain_fingerprint(text)


@pytest.mark.parametrize("radius", [0, 1, 2])
def test_masks_cover_every_set_of_bits(radius):
    masks = S.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for bits in itertools.combinations(range(64), radius):
        assert any(not any(m >> b & 1 for b in bits) for m in masks)


@pytest.mark.parametrize("radius", [0, 1, 2])
def test_components_equal_comparing_all_pairs(spark, radius):
    rng = random.Random(radius)
    values = {rng.getrandbits(64) for _ in range(60)}
    for v in list(values)[:30]:
        for _ in range(6):  # chains and dense clusters
            for _ in range(rng.randint(1, 3)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    values = [S._signed(v) for v in values]
    edges = S.linked(spark.createDataFrame([(v,) for v in values], "fp BIGINT"), radius)
    roots = {r.node: r.root for r in S.components(edges).collect()}
    find, join = _union(values)
    for a, b in itertools.combinations(values, 2):
        if ((a ^ b) & (1 << 64) - 1).bit_count() <= radius:
            join(a, b)
    assert {v: roots.get(v, v) for v in values} == {v: find(v) for v in values}


def test_query_equals_comparing_all_pairs(spark, sf_dir, text_rows):
    prints = {i: _plain_fingerprint(t) for i, t in text_rows.items()}
    find, join = _union(prints)
    for a, b in itertools.combinations(prints, 2):
        if (prints[a] ^ prints[b]).bit_count() <= 2:
            join(a, b)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in S.op2_simhash_dedup(spark, sf_dir).collect()}
    assert got == {i: (f"{prints[i]:016x}", find(i)) for i in prints}


def test_odd_rows(odd, empty):
    groups = {(r.doc_id, r.fp, r.component_id) for r in S.simhash_groups(odd).collect()}
    assert {(1, 0, 1), (2, 0, 1), (3, 0, 1), (None, 0, 1)} <= groups
    assert S.simhash_groups(odd).count() == odd.count()
    assert any(d is None and c is None for d, _, c in groups)
    kept = S.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "4", "5", "6", "7", "None"]
    assert S.simhash_groups(empty).count() == S.drop_near_duplicates(empty).count() == 0


def test_a_large_group_of_copies_is_one_class(spark):
    rows = [(i, "the same text in every row of this group") for i in range(3000)] + [(9000, "another text altogether is here")]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(6)
    assert {r.component_id: r["count"] for r in S.simhash_groups(df).groupBy("component_id").count().collect()} == {0: 3000, 9000: 1}
    assert sorted(r.doc_id for r in S.drop_near_duplicates(df).collect()) == [0, 9000]
