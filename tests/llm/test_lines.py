from __future__ import annotations

import random

import numpy as np
import pytest
from railfeed.llm import lines as L


def _prose(rng, n, words):
    return " ".join(rng.choice(words) + ("." if rng.random() < 0.1 else "") + ("\n" if rng.random() < 0.03 else "") for _ in range(n))


def _planted(seed, many=250):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(600)]
    passages = [_prose(rng, rng.randint(51, 70), words) for _ in range(20)]
    docs, planted = [], []
    for i in range(many):
        body = _prose(rng, rng.randint(80, 300), words).split(" ")
        for p in rng.sample(range(20), rng.choice([0, 0, 1, 2])):
            at = rng.randint(0, len(body))
            body[at:at] = [passages[p]]
            planted.append((i, p))
        docs.append((i, " ".join(body)))
    return docs, planted, passages


def test_passages_between_other_words_stay_once(spark):
    docs, planted, passages = _planted(3)
    out = {r.doc_id: r.text for r in L.drop_repeated_runs(spark.createDataFrame(docs, "doc_id BIGINT, text STRING").repartition(5)).collect()}
    plain = lambda t: " ".join(t.split())
    first = {}
    for i, p in planted:
        assert (plain(passages[p]) in plain(out[i])) == (first.setdefault(p, i) == i)
    touched = {i for i, _ in planted}
    assert all(out[i] == t for i, t in docs if i not in touched)


def test_kept_words_equal_brute_force(spark):
    """Every word that stays is not covered by an earlier equal run of 50 words, every cut one is."""
    docs, _, _ = _planted(4, 60)
    docs.append((60, docs[3][1]))
    docs.append((61, docs[5][1] + " " + docs[5][1]))
    out = {r.doc_id: r.text.split() for r in L.drop_repeated_runs(spark.createDataFrame(docs, "doc_id BIGINT, text STRING")).collect()}
    seen: set = set()
    for i, text in docs:
        words = text.split()
        gone = np.zeros(len(words), bool)
        runs = [tuple(words[a : a + 50]) for a in range(len(words) - 49)]
        for a, run in enumerate(runs):
            if run in seen:
                gone[a : a + 50] = True
            seen.add(run)
        assert out[i] == [w for w, g in zip(words, gone) if not g]


def test_winnowing_shares_a_fingerprint():
    rng = np.random.default_rng(0)
    for _ in range(200):
        run = rng.integers(0, 2**32, 60).astype(np.uint32)
        found = []
        for _ in range(2):
            left, right = (rng.integers(0, 2**32, rng.integers(0, 40)).astype(np.uint32) for _ in range(2))
            hashes = np.concatenate([left, run, right])
            start = np.ones(len(hashes), bool)
            alone = [x.tolist() for x in L.winnow([(hashes, start)])]
            text, *rest = (x[y] for x, y in zip(L.winnow([(run, run > 0), (hashes, start), (right, right > 0)]), [slice(None)] * 5))
            assert alone[1:] == [x[text == 1].tolist() for x in rest]  # texts beside it change nothing
            found.append(set(alone[2]))
        assert found[0] & found[1]


def test_cut_words():
    assert L.cut_words("a b c d e", [(1, 3)]) == ("a d e", 2)
    assert L.cut_words("a b\nc d e", [(2, 5)]) == ("a b", 3)
    assert L.cut_words("a b c", [(0, 2), (1, 3)]) == ("", 3)
    assert L.cut_words("a  b c d", [(0, 1), (2, 3)]) == ("b d", 2)


def test_odd_rows(odd, empty, spark):
    out = L.drop_repeated_runs(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    got = {(r.doc_id, r.source): r.text for r in out.where("doc_id <> 6 OR doc_id IS NULL").collect()}
    assert got == {(r.doc_id, r.source): r.text for r in odd.where("doc_id <> 6 OR doc_id IS NULL").collect()}
    long = out.where("doc_id = 6").first()
    assert long.text.split() == ["long", "end"] and long.n_chars == len(long.text)  # each run equals the one a word before
    assert L.drop_repeated_runs(empty).count() == 0


def test_copies_become_empty_and_the_first_stays(spark):
    text = " ".join(f"word{i}" for i in range(80))
    rows = [(i, text, 0) for i in range(500)]
    out = L.drop_repeated_runs(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, n_chars BIGINT").repartition(4)).collect()
    assert {r.doc_id for r in out if r.text} == {0} and len(out) == 500
    assert all(r.n_chars == 0 for r in out)


def _kept(docs):
    seen, out = set(), {}
    for i, text in docs:
        words = text.split()
        gone = np.zeros(len(words), bool)
        for a in range(len(words) - 49):
            run = tuple(words[a : a + 50])
            if run in seen:
                gone[a : a + 50] = True
            seen.add(run)
        out[i] = [w for w, g in zip(words, gone) if not g]
    return out


def _cleaned(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id BIGINT, text STRING")
    return {r.doc_id: r.text.split() for r in L.drop_repeated_runs(frame).collect()}


def test_repeated_words_and_small_vocabularies(spark):
    """No word of these ends a line by its own hash: crc32 is no multiple of three for any of them."""
    rng = random.Random(8)
    few = ["with", "of", "|", "0", "1", "de"]
    table_ = " ".join(rng.choice(few) for _ in range(150))
    docs = [(1, "with " * 308 + "end"), (2, "start " + "with " * 120), (3, table_), (4, f"some words before {table_} and after")]
    docs += [(5, "0 1 " * 90), (6, "a row | 0 | " * 40), (7, " ".join(rng.choice(few[:2]) for _ in range(400)))]
    docs += [(8, docs[6][1].replace(" ", "\n")), (9, "x " + " ".join(docs[6][1].split()[100:151]) + " y")]
    assert _cleaned(spark, docs) == _kept(docs)


def test_runs_that_the_first_documents_hold_in_part(spark):
    rng = random.Random(9)
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    docs = []
    for _ in range(12):
        p = fresh(rng.randint(60, 75))
        parts = [p[:49], p[12:60], p, p, p[5:58], p[:30] + fresh(1) + p[31:]]
        for part in parts:
            docs.append((len(docs), " ".join(fresh(20) + part + fresh(20))))
        docs.append((len(docs), " ".join(p[:49] + fresh(9) + p[12:60] + fresh(9) + p + fresh(9) + p)))
    assert _cleaned(spark, docs) == _kept(docs)


def test_folds_share_a_fingerprint_in_any_run_of_fifty():
    rng = np.random.default_rng(1)
    for i in range(600):
        run = rng.integers(0, (2**32, 3, 2)[i % 3], 50).astype(np.uint32)
        found = []
        for _ in range(2):
            sides = [rng.integers(0, 2**32, rng.integers(0, 40)).astype(np.uint32) for _ in range(2)]
            hashes = np.concatenate([sides[0], run, sides[1]])
            _, pos, grams = L.winnow([(hashes, L.folds(hashes))])
            found.append(set(zip((pos - len(sides[0])).tolist(), grams.tolist())))
        assert found[0] & found[1]


def test_words_with_equal_checksums_are_other_words(spark):
    """crc32 of the middle words is equal; no 50 words in a row are."""
    import zlib

    one, other = b"yhcbdjwhj", b"cfmwjcitz"
    assert zlib.crc32(one) == zlib.crc32(other)
    left, right = ([f"{side}{i}" for i in range(30)] for side in "lr")
    docs = [(1, " ".join([*left, one.decode(), *right])), (2, " ".join([*left, other.decode(), *right]))]
    docs += [(10 + i, t) for i, (_, t) in enumerate(docs * 3)]
    assert _cleaned(spark, docs) == _kept(docs)


def test_runs_too_short_for_the_fingerprints_are_refused(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id BIGINT, text STRING")
    with pytest.raises(ValueError):
        L.drop_repeated_runs(docs, min_run=L.SHORTEST - 1)


def test_columns_of_clashing_names_and_kinds(spark):
    text = " ".join(f"word{i}" for i in range(80))
    rows = [(i, text, "many", 1.5, "a", "b") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, n_chars STRING, key DOUBLE, Hit STRING, ranges STRING")
    out = L.drop_repeated_runs(df)
    assert out.columns == df.columns
    assert sorted(tuple(r) for r in out.collect()) == [(0, text, "many", 1.5, "a", "b"), (1, "", "many", 1.5, "a", "b"), (2, "", "many", 1.5, "a", "b")]


def test_query_equals_all_windows(spark, sf_dir, text_rows):
    got = {r.doc_id: (r.clean_text.split(), r.clean_chars == len(r.clean_text)) for r in L.op8_line_dedup(spark, sf_dir).collect()}
    assert got == {i: (words, True) for i, words in _kept(sorted(text_rows.items())).items()}
