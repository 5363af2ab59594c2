from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
from railfeed.llm import sketches as K


def _exact(a, b):
    x, y = Counter(K.paragraph_digests(a).tolist()), Counter(K.paragraph_digests(b).tolist())
    both, every = sum((x & y).values()), sum((x | y).values())
    return both / every if every else 1.0


def test_peeling_recovers_the_difference():
    rng = np.random.default_rng(0)
    pairs = []
    for n in (0, 1, 3, 20, 300, 3000):
        common = rng.integers(0, 2**63, 500).astype(np.uint64)
        pairs.append(tuple(np.concatenate([common, rng.integers(0, 2**63, n).astype(np.uint64)]) for _ in range(2)))
    pairs.append((pairs[3][0], np.empty(0, np.uint64)))
    prints = K.Fingerprints([x for pair in pairs for x in pair])
    left, right = np.arange(len(pairs)) * 2, np.arange(len(pairs)) * 2 + 1
    which, digests, sides = prints.differences(left, right)
    again = K.Fingerprints.loads(prints.dumps())  # without the digests
    assert again.dumps() == prints.dumps() and again.likeness(left, right) == prints.likeness(left, right)
    for i, (a, b) in enumerate(pairs):
        left, right = (set(digests[(which == i) & (sides == s)].tolist()) for s in (1, -1))
        assert left == set(a.tolist()) - set(b.tolist()) and right == set(b.tolist()) - set(a.tolist())


def test_a_sketch_that_is_too_small_says_so():
    digests = np.arange(1, 200, dtype=np.uint64)
    sketch = K.Sketches([15, 900], [1, 1])
    for i in (0, 1):
        sketch.update(np.full(199, i), digests, np.ones(199, np.int64))
    which, found, signs, failed = sketch.peel()
    assert failed.tolist() == [True, False] and set(found[which == 1].tolist()) == set(digests.tolist()) and (signs == 1).all()


def test_query_equals_brute_force(spark, sf_dir, text_rows):
    ids = sorted(text_rows, reverse=True)
    rows = {r.doc_id: r for r in K.op10_iblt_fingerprints(spark, sf_dir).collect()}
    assert sorted(rows) == sorted(ids)
    for i, after in zip(ids, ids[1:] + ids[:1]):
        text, other, r = text_rows[i], text_rows[after], rows[i]
        new = text[: len(text) - len(text) // 3] + other[: len(text) // 3]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        assert abs(r.near_edited - _exact(text, new)) < 1e-12 and abs(r.near_next - _exact(text, other)) < 1e-12
        prints = K.Fingerprints.loads([r.fingerprint, r.edited_fingerprint, rows[after].fingerprint])
        assert prints.likeness([0, 0], [1, 2]) == [r.near_edited, r.near_next]  # whoever has the fingerprints gets the same
        assert (r.fingerprint == r.edited_fingerprint) == (Counter(K.paragraph_digests(text)) == Counter(K.paragraph_digests(new)))
    assert np.mean([r.near_edited for r in rows.values()]) > 0.3 > np.mean([r.near_next for r in rows.values()])


def test_many_buckets_with_gaps(spark):
    docs = [(i * i, f"text {i}\n" * (i % 4)) for i in range(100)]
    frame = spark.createDataFrame(docs, "doc_id BIGINT, text STRING").repartition(7)
    spark.conf.set("spark.sql.shuffle.partitions", "30")
    try:
        rows = {r.doc_id: r for r in K.fingerprint_edits(frame).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    for (i, text), (_, other) in zip(docs, docs[-1:] + docs[:-1]):
        assert rows[i].edited_sha256 == hashlib.sha256(K.edited(text, other).encode()).hexdigest()


def test_odd_rows(spark, odd, empty):
    rows = K.fingerprint_edits(odd).collect()
    assert len(rows) == odd.count() and K.fingerprint_edits(empty).count() == 0
    by_id = {r.doc_id: r for r in rows if r.doc_id}
    assert by_id[1].n_chars == 0 and by_id[1].fingerprint == by_id[2].fingerprint == by_id[3].fingerprint
    assert by_id[2].near_next == 1.0 and by_id[6].n_chars == 5 * 40_000 + 3
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    alone = K.fingerprint_edits(spark.createDataFrame([(3, "a b c d e f")], "doc_id BIGINT, text STRING")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0
