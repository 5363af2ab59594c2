"""Every stage of the pipeline against a plain version on what the stage before it kept, and the contract of the queries."""

from __future__ import annotations

import importlib
import itertools
import pathlib
import re

import corpus_pipeline
import numpy as np
import pytest
from railfeed.llm import queries
from railfeed.llm import quality as Q
from railfeed.llm.common import staged, table
from railfeed.llm.packing import tokenizer_path
from railfeed.llm.tokens import encoder

#: Tests that hold a query without SQL against a plain version of its own.
BRUTE_FORCE = {
    "op1_secret_scan": ("test_secrets", "test_every_planted_key_is_a_secret"),
    "op2_simhash_dedup": ("test_simhash", "test_query_equals_comparing_all_pairs"),
    "op3_token_output": ("test_repair", None),
    "op4_quality_classifier": ("test_quality", "test_held_out_accuracy"),
    "op7_best_fit_packing": ("test_packing", "test_query_packs_everything_tightly"),
    "op8_line_dedup": ("test_lines", "test_query_equals_all_windows"),
    "op9_benchmark_decontamination": ("test_decontaminate", "test_query_equals_comparing_all"),
    "op10_iblt_fingerprints": ("test_sketches", "test_query_equals_brute_force"),
    "op12_embedding_whitening": ("test_whitening", "test_query_equals_exact_fractions"),
    "op13_importance_resampling": ("test_resampling", "test_query_equals_brute_force"),
}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_every_query_has_sql_or_a_plain_version(name):
    if name in queries.EXPECTED:
        return
    module, test = BRUTE_FORCE[name]
    text = (pathlib.Path(__file__).parent / f"{module}.py").read_text()
    assert name in text and (test is None or f"def {test}(" in text)
    importlib.import_module(f"railfeed.llm.{ {'test_decontaminate': 'decontaminate'}.get(module, module.removeprefix('test_')) }")


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """What each stage gives, by name, with what went in."""
    docs, out = table(spark, sf_dir, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        made = staged(stage(spark, docs, sf_dir), f"test-{name}")
        out[name] = ({r.doc_id: r.text for r in docs.collect()}, made)
        docs = made
    return out


def _texts(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_rejected_documents_go(spark, sf_dir, stages):
    before, after = stages["quality_classifier"]
    docs = table(spark, sf_dir, "documents")
    model = Q.train(docs, table(spark, sf_dir, "labels"))
    scores = dict(zip(before, model.scores([Q.passage_features(t) for t in before.values()])))
    assert _texts(after) == {i: t for i, t in before.items() if scores[i] >= 0.7}
    assert after.columns == docs.columns


def test_repeated_runs_are_cut(stages):
    before, after = stages["line_dedup"]
    seen, kept = set(), {}
    for i, text in sorted(before.items()):
        words = re.findall(r"[^ \t\n\r\x0b\x0c]+", text)
        gone = np.zeros(len(words), bool)
        for a in range(len(words) - 49):
            run = tuple(words[a : a + 50])
            gone[a : a + 50] |= run in seen
            seen.add(run)
        kept[i] = [w for w, g in zip(words, gone) if not g]
    assert {i: re.findall(r"[^ \t\n\r\x0b\x0c]+", t) for i, t in _texts(after).items()} == kept


def test_one_of_each_group_stays(stages):
    from railfeed.llm.simhash import fingerprint

    before, after = stages["simhash_dedup"]
    prints = {i: fingerprint(t) for i, t in before.items()}
    root = {i: i for i in before}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(before), 2):
        if ((prints[a] ^ prints[b]) & (1 << 64) - 1).bit_count() <= 2:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    assert _texts(after) == {i: before[i] for i in before if find(i) == i}


def test_contaminated_documents_go(spark, sf_dir, stages):
    from test_decontaminate import _plain

    before, after = stages["benchmark_decontamination"]
    items = [(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    bad = {i for i, _ in _plain(list(before.items()), items)}
    assert _texts(after) == {i: t for i, t in before.items() if i not in bad}


def test_everything_left_is_packed(stages):
    before, after = stages["best_fit_packing"]
    words = encoder(tokenizer_path("word_bpe_49k.json"), False)
    size = {i: len(words.encode(t)) // 4 + 1 for i, t in before.items()}
    pieces, bins = {}, {}
    for r in after.collect():
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, n in size.items():
        assert sorted(pieces[i]) == [(k, k * 4096, min(4096, n - k * 4096)) for k in range(-(-n // 4096))]
    assert pieces.keys() == size.keys()
    for parts in bins.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [at for at, _ in sorted(parts)] == [0, *ends[:-1].tolist()] and ends[-1] <= 4096
    assert len(bins) <= -(-sum(size.values()) // 4096) + 2


def test_the_run_is_the_stages_one_after_the_other(spark, sf_dir, stages):
    rows = corpus_pipeline.run(spark, sf_dir)
    _, after = stages["best_fit_packing"]
    pick = lambda df: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert pick(rows) == pick(after)


def test_stages_take_nulls_and_empty_tables(spark, sf_dir, tmp_path):
    docs = table(spark, sf_dir, "documents")
    columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in docs.schema)
    odd = docs.limit(5).unionByName(spark.sql(f"SELECT {columns}")).unionByName(docs.limit(1).selectExpr("doc_id + 10000000 AS doc_id", "'' AS text", "lang", "source", "n_chars"))
    for start in (odd, docs.where("false")):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs = staged(stage(spark, docs, sf_dir), f"odd-{name}")
        assert docs.count() >= 0
