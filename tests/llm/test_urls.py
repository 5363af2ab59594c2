from __future__ import annotations

import re

import compare
from railfeed.llm import urls as U


def test_query_equals_its_sql(spark, sf_dir, duck):
    assert not compare.differences(U.op6_url_filters(spark, sf_dir), duck, U.OP6_SQL)


def _plain(url):
    text = (url or "").lower()
    has = lambda t: re.search(rf"(?<![a-z0-9]){t}(?![a-z0-9])", text, re.A)
    return any(map(has, U.STRICT)) or sum(bool(has(t)) for t in U.SOFT) >= U.SOFT_HITS


def test_vocabulary_equals_patterns():
    urls = ["http://a.com/porn", "http://pornography.com", "x://bet.com/poker", "x://bet.com/bet", "x://betting.com/free-live", "x://SEX.adult.com"]
    urls += ["http://a/xxx1", "http://a/1xxx", "http://a/éxxxé", "bet poker", "sexadult sex", None, "", "escorts", "escort-escorts", "free%20bet"]
    assert U.vocabulary_verdicts(urls, U.build_automaton()) == [bool(_plain(u)) for u in urls]


def test_parts_rules_and_odd_rows(spark):
    rows = [
        ("http://Www.EXAMPLE.net/en/x?q", "www.example.net", "/en/x", "example.net/en/", "allow"),
        ("http://example.net/EN/", "example.net", "/EN/", "net/", "block"),
        ("http://a.net", "a.net", "", None, "allow"),
        ("http://planet/", "planet", "/", None, "allow"),
        ("http://net/", "net", "/", "net/", "block"),
        ("http://x.example.com/de/1", "x.example.com", "/de/1", "example.com/de/", "block"),
        ("http://a.org/fr/porn", "a.org", "/fr/porn", "org/fr/", "allow"),
        ("http://a.org/porn", "a.org", "/porn", None, "block"),
        ("http://a.org?x/fr/", "a.org", "", None, "allow"),
        ("a.net/b://C/d#e", "c", "/d", None, "allow"),
        ("no scheme", "", "", None, "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("http://É.net/" + "a" * 100_000, "É.net", "/" + "a" * 100_000, "net/", "block"),
    ]
    frame = spark.createDataFrame([(i, r[0], "own", None) for i, r in enumerate(rows)] * 2, "page_id INT, url STRING, host STRING, path STRING")
    got = U.judge(frame).orderBy("page_id").collect()
    assert [(r.url, r.host, r.path, r.rule, r.verdict) for r in got] == [x for r in rows for x in (r, r)]
    assert U.judge(frame.where("false")).count() == 0
    assert {r.rule for r in U.judge(frame, rules=()).collect()} == {None}
