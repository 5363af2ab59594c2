from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from railfeed.llm import packing as P
from railfeed.llm.tokens import WordEncoder

ALPHABET = [" ", "  ", "\n", "a", "B", "é", "é", "'s", "1", "23", ".", "!!", "\t", " ", "İ", "中", "\U0001f44d", "\x1c", "the", " the", "_", "<|endoftext|>", "Σ", "|"]


@pytest.fixture(scope="module", params=[("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def words(request):
    return WordEncoder(P.tokenizer_path(request.param[0]), request.param[1])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(ALPHABET), max_size=14).map("".join) | st.text(max_size=20))
def test_words_encode_as_the_whole_text(words, text):
    assert words.encode(text) == words.whole(text)


def test_documents_encode_as_the_whole_text(words, text_rows):
    for text in list(text_rows.values())[:80]:
        assert words.encode(text) == words.whole(text)


def _check(rows, docs, capacity, path=None):
    words = WordEncoder(path or P.tokenizer_path("word_bpe_49k.json"), False)
    bins: dict = {}
    for r in rows:
        assert 0 < r.length <= capacity
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for content in bins.values():
        at = 0
        for offset, length in sorted(content):
            assert offset == at
            at += length
        assert at <= capacity
    expected = []
    for doc, text in docs:
        raw = words.whole(text or "") + (1).to_bytes(4, "little")
        for i, at in enumerate(range(0, len(raw), 4 * capacity)):
            part = raw[at : at + 4 * capacity]
            expected.append((str(doc), i, at // 4, len(part) // 4, zlib.crc32(part)))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(expected)
    return len(bins), sum(r.length for r in rows)


def test_query_packs_everything_tightly(spark, sf_dir, text_rows):
    rows = P.op7_best_fit_packing(spark, sf_dir).collect()
    bins, total = _check(rows, text_rows.items(), 4096)
    assert bins <= -(-total // 4096) + 1


def test_many_tasks_are_merged(spark, text_rows):
    docs = list(text_rows.items())
    df = spark.createDataFrame(docs, "doc_id BIGINT, text STRING").repartition(40)
    rows = P.pack(df, P.tokenizer_path("word_bpe_49k.json"), 1, capacity=700, fan_in=3, carry=8).collect()
    bins, total = _check(rows, docs, 700)
    assert bins <= 1.06 * total / 700 + 2  # forty tasks of five documents each


def test_odd_rows(odd, empty):
    path = P.tokenizer_path("word_bpe_49k.json")
    _check(P.pack(odd, path, 1).collect(), [(r.doc_id, r.text) for r in odd.collect()], 4096)
    assert P.pack(empty, path, 1).count() == 0


def test_best_fit_uses_the_fullest_bin_with_room():
    best = P.BestFit(10)
    for size, name in ((7, "a"), (6, "b"), (3, "c"), (4, "d"), (10, "e")):
        best.add(size, name)
    assert [[n for _, n in b] for b in best.bins] == [["a", "c"], ["b", "d"], ["e"]]
    assert best.room == [0, 0, 0]


def test_local_packing_keeps_every_piece():
    rng = random.Random(5)
    pieces = [(i, 0, 0, rng.randint(1, 100), 0) for i in range(2000)]
    out = list(P.pack_locally(iter(pieces), 100, 0.99, 300))
    assert sorted(p[0] for *_, p in out) == list(range(2000))
    sizes = np.bincount([b for b, *_ in out], weights=[p[3] for *_, p in out])
    assert sizes.max() <= 100 and len(sizes[sizes > 0]) <= 1.03 * sizes.sum() / 100 + 1


def test_special_tokens_in_a_text_as_the_library_encodes_them(words, request):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(P.tokenizer_path(request.node.callspec.params["words"][0]))
    added = [t.content for t in plain.get_added_tokens_decoder().values()]
    assert added
    for token in [*added, "<|endoftext|>", "<|EndOfText|>", "<|other|>"]:
        for text in (token, f"some words {token} and more", f"glued{token}words, {token}{token}\nEnd"):
            expected = np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            assert words.encode(text) == words.whole(text) == expected
