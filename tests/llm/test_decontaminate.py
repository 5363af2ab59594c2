from __future__ import annotations

import random

import pytest
from railfeed.llm import decontaminate as D

ITEM = "On Monday the farmer Alice sold 12 baskets of apples for 3 dollars and Alice bought 5 kg of fresh bread with what was left."


def _hits(spark, texts, item=ITEM):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    return {r.doc_id: r for r in D.contaminated(docs, spark.createDataFrame([(7, item)], "item_id BIGINT, text STRING")).collect()}


def test_query_finds_the_planted_items(spark, text_rows, sf_dir):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    planted = {(i, k) for i, t in text_rows.items() for k, x in items.items() if x in t}
    rows = D.op9_benchmark_decontamination(spark, sf_dir).collect()
    assert planted <= {(r.doc_id, r.item_id) for r in rows}
    plain = {i: [w.lower().strip(".,") for w in t.split()] for i, t in text_rows.items()}
    for r in rows:  # everything found shares most runs of five words with the item
        words = [w.lower().strip(".,") for w in items[r.item_id].split()]
        runs = {tuple(words[a : a + 5]) for a in range(len(words) - 4)}
        have = {tuple(plain[r.doc_id][a : a + 5]) for a in range(len(plain[r.doc_id]) - 4)}
        assert len(runs & have) >= 0.3 * len(runs)


def test_other_slots_are_found_and_must_be_consistent(spark):
    other = ITEM.replace("Alice", "Berta").replace("12", "40").replace("Monday", "Friday").replace("kg", "lb")
    mixed = ITEM.replace("Alice sold", "Berta sold")
    hits = _hits(spark, [f"before {ITEM} after", f"some words {other} more", "nothing of that kind is in here at all", mixed])
    assert set(hits) == {0, 1, 3}  # of the fourth only the windows with the other name do not count
    assert 0.5 < hits[3].coverage < 1.0
    assert not hits[0].reworded and hits[1].reworded and hits[0].coverage == hits[1].coverage == 1.0


@pytest.mark.parametrize(
    "word, parts",
    [
        ("Alice,", [(2, "alice")]),
        ("12", [(1, "12")]),
        ("5kg", [(1, "5"), (3, "kg")]),
        ("$3.50", [(3, "$"), (1, "3.50")]),
        ("seven", [(1, "seven")]),
        ("miles", [(3, "miles")]),
        ("house.", [(0, "house")]),
        ("--", []),
    ],
)
def test_canonical(word, parts):
    assert D.canonical(word) == parts


def test_odd_rows(spark, odd, empty):
    bench = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "too short", 0), (None, ITEM, 0), (None, ITEM, 0)], "item_id BIGINT, text STRING, hash INT")
    assert D.contaminated(odd, bench).count() == 0
    assert D.contaminated(empty, bench).count() == D.contaminated(odd, bench.where("false")).count() == 0
    kept = D.drop_contaminated(odd, bench)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    bad = odd.unionByName(odd.limit(1).selectExpr("CAST(NULL AS BIGINT) AS doc_id", f"'{ITEM}' AS text", "source", "fp", "score", "n_chars"))
    rows = D.contaminated(bad, bench).collect()
    assert [(r.doc_id, r.item_id, r.coverage) for r in rows] == [(None, None, 1.0)]


def test_a_common_item_in_many_documents(spark):
    hits = _hits(spark, [f"lead {i} {ITEM} tail" for i in range(400)])
    assert len(hits) == 400


def _plain(docs, items, share=0.5):
    """Pairs found by comparing every document with every item, window by window."""

    def windows(text, length):
        tokens = [t for w in text.split() for t in D.canonical(w)]
        out = []
        for at in range(len(tokens) - length + 1):
            part = tokens[at : at + length]
            if sum(k == 0 for k, _ in part) >= D.LITERALS:
                out.append((at, tuple((k, v if k == 0 else "") for k, v in part), [(k, v) for k, v in part if k]))
        return out, len(tokens)

    found = {}
    for k, item in items:
        n = windows(item, 1)[1]
        length = min(D.WINDOW, n)
        mine = windows(item, length)[0] if n else []
        for i, text in docs:
            by_shift = {}
            for at, template, slots in windows(text, length)[0] if mine else []:
                for iat, itemplate, islots in mine:
                    if template == itemplate:
                        by_shift.setdefault(at - iat, []).append((iat, list(zip(islots, slots))))
            good, differs = set(), False
            for hits in by_shift.values():
                flat = [p for _, pairs in hits for p in pairs]
                taken = {v: max((flat.count(p), p[0] == p[1], p[1][1], p) for p in flat if p[0] == v)[3] for v, _ in flat}
                agree = [(iat, pairs) for iat, pairs in hits if all(taken[p[0]] == p for p in pairs)]
                other = any(p[0] != p[1] for _, pairs in agree for p in pairs)
                if not (other and length < D.WINDOW):
                    good |= {iat for iat, _ in agree}
                    differs |= other and bool(agree)
            if good and len(good) >= share * len(mine):
                found[i, k] = (len(good) / len(mine), differs)
    return found


def _found(spark, docs, items):
    rows = D.contaminated(spark.createDataFrame(docs, "doc_id BIGINT, text STRING"), spark.createDataFrame(items, "item_id BIGINT, text STRING")).collect()
    return {(r.doc_id, r.item_id): (r.coverage, r.reworded) for r in rows}


def test_pairs_equal_comparing_all(spark):
    """Items that share phrases, repeat names and numbers, or are short, in documents that hold them whole, in part and changed."""
    rng = random.Random(5)
    names, plain = ["Alice", "Berta", "Carl", "Dora"], "apples bread farmer sold bought fresh was left house river under above many some".split()
    phrase = "which of the following is true about the"
    items = []
    for k in range(25):
        words = [rng.choice(names) if rng.random() < 0.15 else str(rng.randint(1, 9)) if rng.random() < 0.1 else rng.choice(plain) for _ in range(rng.randint(3, 25))]
        items.append((k, (phrase + " " if k % 3 == 0 else "") + " ".join(words)))
    items += [(90, "the capital of France"), (91, "France"), (92, "")]
    docs = []
    for i in range(120):
        text = rng.choice(items)[1].split()
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            if text:
                at = rng.randrange(len(text))
                text[at] = rng.choice(names + plain + ["7"])
        docs.append((i, " ".join([*rng.choices(plain, k=5), *text, *rng.choices(names + plain, k=5)])))
    docs += [(500, "we saw the capital of France again"), (501, "we saw the capital of Germany again")]
    got = _found(spark, docs, items)
    assert got == _plain(docs, items)
    assert (500, 90) in got and (501, 90) not in got and not {k for _, k in got} & {91, 92}


def test_a_shared_phrase_brings_no_pairs(spark):
    """300 documents and 200 items have one phrase in common: the windows joined grow with the documents, not with the pairs."""
    phrase = "which of the following is true about"
    items = [(k, phrase + " " + " ".join(f"w{k}x{j}" for j in range(14))) for k in range(200)]
    docs = [(i, f"{phrase} " + " ".join(f"d{i}x{j}" for j in range(14))) for i in range(300)] + [(999, items[3][1])]
    found = D._windows(D.texts(spark.createDataFrame(items, "item_id BIGINT, text STRING"), "item_id"))
    windows = found.selectExpr("doc_id AS item_id", "pos AS ipos", "hash", "windows AS iw")
    rare = D._rarest(windows, 0.5)
    theirs = D._windows(D.texts(spark.createDataFrame(docs, "doc_id BIGINT, text STRING")), None, [5]).select("doc_id", "hash")
    assert rare.join(theirs, "hash").select("doc_id").distinct().count() == 1
    assert _found(spark, docs, items) == {(999, 3): (1.0, False)}


def test_query_equals_comparing_all(spark, sf_dir, text_rows):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id): (r.coverage, r.reworded) for r in D.op9_benchmark_decontamination(spark, sf_dir).collect()}
    assert got == _plain(list(text_rows.items()), items)
