from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from railfeed.llm import resampling as R

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def _lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def _features(text, longest=2):
    words = WORD.findall(_lower(text))
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def _brute(docs, target, longest=2, buckets=10_000, seed=7, percent=25, least=20):
    """The draw by dictionaries, one text after the other."""
    count = lambda texts: Counter(crc32(f.encode()) % buckets for t in texts for f in _features(t, longest)[1])
    raw, want = count(t for _, t in docs), count(target)
    s_all, t_all = sum(raw.values()), sum(want.values())
    out, order = [], []
    for at, (i, text) in enumerate(docs):
        words, features = _features(text, longest)
        total = 0
        for f in features:
            b = crc32(f.encode()) % buckets
            total += math.floor(1000 * math.log((want[b] + 1) * (s_all + buckets) / ((raw[b] + 1) * (t_all + buckets))))
        weight = total // len(features) if features else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(features), weight, score, None])
        if len(words) >= least:
            order.append((-score, i is None, i or 0, at))
    for rank, (*_, at) in enumerate(sorted(order)[: percent * len(order) // 100], 1):
        out[at][4] = rank
    return Counter(map(tuple, out))


def _rows(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect())


def test_query_equals_brute_force(spark, sf_dir, text_rows):
    target = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert _rows(R.op13_importance_resampling(spark, sf_dir)) == _brute(list(text_rows.items()), target)


@pytest.mark.parametrize("longest", [1, 2, 3, 4])
def test_runs_have_the_crc_of_their_text(text_rows, longest):
    texts = [*list(text_rows.values())[:30], "", "one", "A-b_c", "ÉTÉ à 中文 x\x00y\x7fz", "  two words ", "the the the the"]
    grams = R.Grams(pa.array(texts), longest)
    assert [len(c) for _, c in grams.by_length] == [sum(max(0, len(WORD.findall(_lower(t))) - n) for t in texts) for n in range(longest)]
    for at, text in enumerate(texts):
        got = Counter(c for owner, crcs in grams.by_length for c in crcs.to_numpy()[owner == at].tolist())
        assert got == Counter(crc32(f.encode()) for f in _features(text, longest)[1])
    values = np.random.default_rng(0).integers(-500, 500, 97)
    want = [sum(int(values[crc32(f.encode()) % 97]) for f in _features(t, longest)[1]) for t in texts]
    assert grams.sums(pa.array(values), 97).tolist() == want


def test_ties_and_repeated_rows(spark):
    rows = [(i % 40, "same words " * 15) for i in range(120)] + [(500, "too few words")]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(7)
    got, want = _rows(R.resample(df, df.limit(3))), _brute(rows, [t for _, t in df.limit(3).collect()])
    assert got == want and sorted(r[4] for r in got if r[4]) == list(range(1, 31))


def test_odd_rows(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    clash = odd.withColumns({c: F.lit("x") for c in ("weight", "order", "at", "place", "rank", "n_words")})
    target = spark.createDataFrame([("two words",), (None,), ("",)], "text STRING")
    assert _rows(R.resample(clash, target, percent=100, min_words=1)) == _brute(rows, ["two words"], percent=100, least=1)
    assert R.resample(empty, target).count() == 0
    assert _rows(R.resample(odd, target.where("false"))) == _brute(rows, [])


def test_the_draw_moves_towards_the_target(spark):
    near = [(i, f"alpha beta gamma delta {i} " * 6) for i in range(200)]
    far = [(1000 + i, f"red green blue white {i} " * 6) for i in range(600)]
    df = spark.createDataFrame(near + far, "doc_id BIGINT, text STRING")
    target = spark.createDataFrame([("alpha beta gamma delta " * 50,)], "text STRING")
    drawn = [r.doc_id for r in R.resample(df, target).where("rank IS NOT NULL").collect()]
    assert len(drawn) == 200 and sum(i < 1000 for i in drawn) > 150  # 50 by chance
