from __future__ import annotations

import zlib

import numpy as np
from railfeed.llm import repair as R
from railfeed.llm.packing import tokenizer_path
from railfeed.llm.tokens import WordEncoder


def _stream(seed=0, docs=50, words=300):
    rng = np.random.default_rng(seed)
    pieces = [rng.integers(0, 900, rng.integers(2, 6)) for _ in range(words)]
    out = [np.concatenate([pieces[i] for i in rng.zipf(1.3, rng.integers(0, 200)) % words] + [[2]]) for _ in range(docs)]
    return np.concatenate(out).astype(np.uint32), np.cumsum([len(x) for x in out])


def test_round_trip_and_random_access():
    tokens, ends = _stream()
    shard = R.Shard(R.dump_shard(list(range(len(ends))), tokens, ends))
    assert len(shard.rules) > 50 and len(shard.symbols) < 0.6 * len(tokens)
    starts = [0, *ends[:-1]]
    for i, (a, b) in enumerate(zip(starts, ends)):
        assert (shard.document(i) == tokens[a:b]).all()
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = sorted(rng.integers(0, len(tokens) + 1, 2))
        if a < b:
            assert (shard.tokens(a, b) == tokens[a:b]).all()


def test_rules_only_use_earlier_symbols_and_lengths_add_up():
    tokens, ends = _stream(2)
    symbols, symbol_ends, first, rules = R.compress(tokens, ends)
    assert (rules.max(axis=1) < first + np.arange(len(rules))).all()
    sizes = R.expansion_lengths(first, rules)
    assert sizes[symbols].sum() == len(tokens) and symbol_ends[-1] == len(symbols)
    assert (sizes[first:] == sizes[rules[:, 0]] + sizes[rules[:, 1]]).all()


def test_repetition_of_one_symbol():
    tokens = np.full(1000, 5, np.uint32)
    shard = R.Shard(R.dump_shard([1, 2], tokens, np.array([400, 1000])))
    assert (shard.document(0) == 5).all() and len(shard.document(1)) == 600 and len(shard.symbols) < 100


def test_query_equals_encoding_each_text(spark, sf_dir, text_rows):
    words, at, expected = WordEncoder(tokenizer_path("byte_bpe_50k.json"), True), 0, {}
    for i in sorted(text_rows):
        raw = words.whole(text_rows[i]) + (2).to_bytes(4, "little")
        expected[i] = (at, len(raw) // 4, zlib.crc32(raw))
        at += len(raw) // 4
    rows = R.op3_token_output(spark, sf_dir).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows} == expected and len(rows) == len(expected)


def test_many_small_shards_and_odd_rows(spark, odd, empty, tmp_path):
    for name, frame in (("odd", odd.repartition(3)), ("empty", empty)):
        R.write_tokens(frame, str(tmp_path / name), tokenizer_path("byte_bpe_50k.json"), 2, shard_tokens=3)
    rows = R.read_tokens(spark, str(tmp_path / "odd")).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, None, 1, 2, 3, 4, 4, 5, 6, 7]
    assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows[:-1])]).tolist()
    words = WordEncoder(tokenizer_path("byte_bpe_50k.json"), True)
    texts = {r.doc_id: r.text or "" for r in odd.collect() if r.doc_id}
    assert all(r.ids_crc32 == zlib.crc32(words.whole(texts[r.doc_id]) + b"\2\0\0\0") for r in rows if r.doc_id)
    assert R.read_tokens(spark, str(tmp_path / "empty")).count() == 0


def test_the_most_frequent_pair_of_a_bucket_is_replaced():
    bucket = lambda a, b: ((a << 32 | b) * 0x9E3779B97F4A7C15 % 2**64) >> (64 - R._BUCKETS)
    rare = next((a, b) for a in range(3000, 9000) for b in range(3000, 9000) if bucket(a, b) == bucket(1, 2))
    tokens = np.array([x for i in range(500) for x in (1, 2, 10 + i)] + list(rare), np.uint32)
    symbols, _, _, rules = R.compress(tokens, np.array([len(tokens)]))
    assert [1, 2] in rules.tolist() and len(symbols) <= 1002
