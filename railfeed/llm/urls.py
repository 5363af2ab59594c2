"""URL filter: a weighted vocabulary matched by Aho-Corasick, below explicit host and path rules."""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from railfeed.llm.common import table

#: Terms that reject on their own, and terms of which SOFT_HITS distinct ones reject.
STRICT = ("porn", "xxx", "hentai", "casino", "viagra", "cialis", "escorts", "camgirls", "jackpot", "bestiality")
SOFT = (
    "sex", "adult", "nude", "naked", "erotic", "escort", "dating", "bet", "betting", "poker", "slots", "roulette", "gamble",
    "lottery", "bonus", "pills", "pharmacy", "torrent", "warez", "crack", "keygen", "replica", "payday", "loan", "free",
    "cheap", "download", "hack", "cheat", "live",
)
SOFT_HITS = 2
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def vocabulary_verdicts(urls: list[str | None], automaton, soft_hits: int = SOFT_HITS) -> list[bool]:
    """True where a URL has one strict term, or ``soft_hits`` distinct soft ones.

    A term counts where no ASCII letter or digit stands before or after it; ASCII capitals equal small letters. A
    NULL URL has no terms.
    """
    out = []
    for url in urls:
        soft, reject = set(), False
        raw = (url or "").encode("utf-8", "surrogatepass").lower().decode("latin-1")
        for end, (term, strict) in automaton.iter(raw):
            before, after = raw[end - len(term) : end - len(term) + 1] if end >= len(term) else "", raw[end + 1 : end + 2]
            if any(c.isascii() and c.isalnum() for c in (before, after)):
                continue
            if strict:
                reject = True
                break
            soft.add(term)
        out.append(reject or len(soft) >= soft_hits)
    return out


@lru_cache(maxsize=8)
def build_automaton(strict: tuple[str, ...] = STRICT, soft: tuple[str, ...] = SOFT):
    """One per worker and vocabulary."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for term in soft:
        found.add_word(term, (term, False))
    for term in strict:
        found.add_word(term, (term, True))
    found.make_automaton()
    return found


def vocabulary_rejects(url: Column, strict=STRICT, soft=SOFT, soft_hits: int = SOFT_HITS) -> Column:
    @F.arrow_udf(BooleanType())
    def rejects(column: pa.Array) -> pa.Array:
        return pa.array(vocabulary_verdicts(column.to_pylist(), build_automaton(tuple(strict), tuple(soft)), soft_hits), pa.bool_())

    return rejects(url)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` with ASCII capitals lowered, and path; both empty without ``://``."""
    pattern = r"(?s)://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(text, pattern, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(text, pattern, 2)


def judge(pages: DataFrame, rules=RULES, strict=STRICT, soft=SOFT, soft_hits: int = SOFT_HITS, url_col: str = "url") -> DataFrame:
    """All columns of ``pages`` with ``host, path, rule, verdict`` (replacing columns of those names).

    A rule fits its host and all subdomains where the path starts with the rule's; the longest fitting rule decides,
    the first listed of equally long ones. Without one the vocabulary does. A NULL or empty URL is allowed. Rows are
    judged one by one, so repeated rows repeat and an empty table stays empty.
    """
    host, path = url_parts(F.col(url_col))
    out = pages.withColumns({"__reject": vocabulary_rejects(F.col(url_col), strict, soft, soft_hits), "host": host, "path": path})
    rule, action = F, F
    for verdict, domain, start in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((F.col("host") == domain) | F.endswith(F.col("host"), F.lit(f".{domain}"))) & F.startswith(F.col("path"), F.lit(start))
        rule, action = rule.when(fits, F.lit(domain + start)), action.when(fits, F.lit(verdict))
    if rule is F:
        rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    out = out.withColumns({"rule": rule, "__rule_verdict": action})
    learned = F.when(F.col("__reject"), "block").otherwise("allow")
    return out.withColumn("verdict", F.coalesce("__rule_verdict", learned)).drop("__reject", "__rule_verdict")


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def _has(term: str) -> str:
    return f"regexp_matches(u, '(^|[^a-z0-9]){term}([^a-z0-9]|$)')"


def _fits(domain: str, start: str) -> str:
    return f"(host = '{domain}' OR ends_with(host, '.{domain}')) AND starts_with(path, '{start}')"


_LONGEST_FIRST = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
OP6_SQL = f"""
WITH p AS (
  SELECT page_id, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS u,
         translate(regexp_extract(coalesce(url, ''), '(?s)://([^/?#]*)([^?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
m AS (
  SELECT *, ({" OR ".join(map(_has, STRICT))}) OR ({" + ".join(f"CAST({_has(t)} AS INTEGER)" for t in SOFT)}) >= {SOFT_HITS} AS reject,
         CASE {" ".join(f"WHEN {_fits(d, s)} THEN '{d}{s}'" for _, d, s in _LONGEST_FIRST)} END AS rule,
         CASE {" ".join(f"WHEN {_fits(d, s)} THEN '{v}'" for v, d, s in _LONGEST_FIRST)} END AS rule_verdict
  FROM p)
SELECT page_id, host, path, rule, coalesce(rule_verdict, CASE WHEN reject THEN 'block' ELSE 'allow' END) AS verdict
FROM m
"""
