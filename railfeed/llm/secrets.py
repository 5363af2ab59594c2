"""Secret scan: candidates from whole texts, and a random forest that removes false positives.

Columns and SQL functions only, with Spark's own forest; nothing runs in Python on the executors.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railfeed.llm.common import staged, table

_RUN = "A-Za-z0-9+/_-"
#: A candidate: 16 or more such characters, with up to two equals signs behind.
CANDIDATE = rf"(?<![{_RUN}])[{_RUN}]{{16,}}={{0,2}}"
_KEYWORDS = "passw|pwd|secret|token|api|key|auth|bearer|credential|private|access"
#: Another candidate: 8 or more characters assigned to a keyword, without the signs of a sentence behind them.
ASSIGNED = (
    rf"(?i:{_KEYWORDS})[A-Za-z0-9_.-]*[\"'`\])]*\s*(?:[:=]{{1,2}}|=>)\s*[\"'`]*"
    r"([^\s\"'`]{7,}[^\s\"'`.,;:!?)\]}|#*&]|[^\s\"'`]{8,})"
)
#: Forms of labelled findings. A finding of a strict form is a secret, one of a plain form is not, others have no label.
STRICT_FORMS = (
    r"^AKIA[A-Z2-7]{16}$",
    r"^gh[pousr]_[A-Za-z0-9]{36}$",
    r"^xox[abpr]-[0-9A-Za-z-]{20,}$",
)
#: Hex digits are keys as often as commit ids and checksums, so what stands before them decides.
HEX_FORM = r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]{16,128}$"
DIGEST_WORDS = r"^(commits?|sha|md|crc|checksums?|digests?|hash|hashes|revisions?|rev|blob|tree|etag|fingerprints?|sums?|uuid|merge|parent)$"
PLAIN_WORD = r"^[A-Za-z][a-z]+$"
PLAIN_FORMS = (r"^[0-9_/+-]+$", r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$", r"^/?[a-z]+(/[a-z0-9_-]*[a-z])+$")
LABELLED = 20_000
MIN_DOCS = 5
_CLASSES = {"l": "[a-z]", "u": "[A-Z]", "d": "[0-9]", "s": "[+/_=-]"}
TRANSITIONS = {f"{x}{y}": f"{_CLASSES[x]}(?={_CLASSES[y]})" for x in _CLASSES for y in _CLASSES}


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """``(doc_id, path, pos, value, left, right)`` of each candidate in the whole texts.

    ``pos`` numbers the words of the text from 0; ``left`` and ``right`` are three words on either side, with what is
    glued to the candidate in its own word. NULL and empty texts have none; a NULL path is empty.
    """
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")
    found = docs.select(F.col(id_col).alias("doc_id"), path.alias("path"), F.col(text_col).alias("text"))
    found = found.where(F.col("text").rlike(CANDIDATE) | F.col("text").rlike(ASSIGNED))
    found = found.select("doc_id", "path", F.split("text", r"\s+").alias("words"))
    # A keyword and its sign may be words of their own. The start of a next assignment ends a value like a quote.
    near = lambda a, n: F.array_join(F.slice("words", F.greatest(F.lit(1), a), n), " ")
    parted = lambda text: F.regexp_replace(text, r"[&;,](?=\w+[:=])", '"')
    led = lambda i: parted(near(i - 1, F.least(F.lit(3), i + 1)))
    here = ASSIGNED + r"(?=\S*$)"
    at = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.get("words", i).rlike(CANDIDATE) | led(i).rlike(here))
    found = found.select("doc_id", "path", "words", F.explode(at).alias("pos"))
    word = F.get("words", F.col("pos"))
    found = found.select(
        "doc_id", "path", "pos", word.alias("word"), led(F.col("pos")).alias("led"),
        F.when(F.col("pos") > 0, near(F.col("pos") - 2, F.least(F.lit(3), F.col("pos")))).otherwise("").alias("before"),
        near(F.col("pos") + 2, F.lit(3)).alias("after"),
    )
    values = F.concat(
        F.regexp_extract_all("word", F.lit(f"({CANDIDATE})"), 1),
        F.regexp_extract_all("led", F.lit(here), 1),
        F.regexp_extract_all(parted("word"), F.lit(ASSIGNED), 1),
    )
    found = found.withColumn("value", F.explode(F.array_distinct(values)))
    here = F.instr("word", F.col("value"))
    return found.select(
        "doc_id", "path", "pos", "value",
        F.concat_ws(" ", "before", F.substr(F.col("word"), F.lit(1), here - 1)).alias("left"),
        F.concat_ws(" ", F.substr(F.col("word"), here + F.length("value")), "after").alias("right"),
    )


def dictionary(docs: DataFrame, min_docs: int = MIN_DOCS, text_col: str = "text") -> DataFrame:
    """Words of 3 to 20 ASCII letters, in lower case, that stand in ``min_docs`` documents of the whole corpus."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(text_col), F.lit(r"(?<![a-z0-9])([a-z]{3,20})(?![a-z0-9])"), 1))
    return docs.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs).select("word")


def _coverage(found: DataFrame, words: DataFrame) -> DataFrame:
    """``(value, coverage)``: the share of a value's characters that lie in letter runs found in the dictionary."""
    values = found.select("value").distinct()
    runs = values.select("value", F.explode(F.regexp_extract_all(F.lower("value"), F.lit("([a-z]{3,})"), 1)).alias("word"))
    known = runs.join(words, "word", "left_semi")
    return known.groupBy("value").agg((F.sum(F.length("word")) / F.max(F.length("value"))).alias("coverage"))


def _last_word(text: str) -> Column:
    return F.coalesce(F.try_element_at(F.regexp_extract_all(F.lower(F.col(text)), F.lit("([a-z]+)"), 1), F.lit(-1)), F.lit(""))


def _first_word(text: str) -> Column:
    return F.regexp_extract(F.lower(F.col(text)), "([a-z]+)", 1)


def _features(found: DataFrame, words: DataFrame) -> DataFrame:
    size = F.length("value").cast("double")
    path = F.lower("path")
    flag = lambda c: c.cast("double")
    out = found.join(_coverage(found, words), "value", "left")
    shares = {f"t_{k}": F.regexp_count("value", F.lit(p)) / size for k, p in TRANSITIONS.items()}
    return out.select(
        *found.columns,
        size.alias("size"),
        (F.size(F.array_distinct(F.split("value", ""))) / size).alias("varied"),
        *[c.alias(k) for k, c in shares.items()],
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
        F.regexp_count(path, F.lit("/")).cast("double").alias("depth"),
        flag(path.rlike("test|example|sample|mock|fixture|doc|readme")).alias("path_test"),
        flag(path.rlike(r"\.(env|ya?ml|json|ini|conf|cfg|properties|toml|tf)$")).alias("path_config"),
        flag(F.lower("left").rlike(_KEYWORDS)).alias("keyword"),
        flag(F.col("left").rlike("[=:]\\W*$")).alias("assigned"),
        flag(F.col("left").rlike("[\"'`]$")).alias("quoted"),
        _last_word("left").alias("left_word"),
        _first_word("right").alias("right_word"),
    )


FEATURES = [
    "size", "varied", *(f"t_{k}" for k in TRANSITIONS), "coverage", "depth", "path_test", "path_config", "keyword", "assigned",
    "quoted", "left_odds", "right_odds",
]


def _odds(labelled: DataFrame, word: str) -> DataFrame:
    ones = F.sum("label")
    return labelled.groupBy(word).agg(F.log((ones + 0.5) / (F.count("*") - ones + 0.5)).alias(word.replace("word", "odds")))


def _with_odds(rows: DataFrame, odds: list[DataFrame]) -> DataFrame:
    for word, table_ in zip(("left_word", "right_word"), odds):
        rows = rows.join(table_, word, "left").fillna(0.0, [word.replace("word", "odds")])
    return rows


def form_labels(found: DataFrame) -> DataFrame:
    """Labelled findings where no table of them is given: by form, 1 for strict ones and 0 for plain ones.

    Lower-case words are plain where no keyword or sign of assignment stands before them. Hex digits are a secret where
    they are assigned to a keyword, and plain after a word for a digest or a revision; elsewhere they have no label.
    """
    digits, digest = F.col("value").rlike(HEX_FORM), F.col("left_word").rlike(DIGEST_WORDS)
    strict = F.greatest(*[F.col("value").rlike(p) for p in STRICT_FORMS])
    strict |= digits & ~digest & (F.col("keyword") == 1) & (F.col("assigned") == 1)
    plain = F.greatest(*[F.col("value").rlike(p) for p in PLAIN_FORMS]) | (digits & digest)
    plain |= F.col("value").rlike(PLAIN_WORD) & (F.col("keyword") + F.col("assigned") == 0)
    return found.withColumn("label", F.when(plain, 0).when(strict, 1)).where("label IS NOT NULL")


def scan(docs: DataFrame, findings: DataFrame | None = None, labelled: int = LABELLED, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(doc_id, path, pos, value, score, secret)`` per candidate; ``secret`` is a score of 0.5 or more.

    ``findings`` has ``value`` and ``label`` (0 or 1) of findings judged before; without it, findings of well-known
    forms give the labels. At most ``labelled`` of them, chosen by a hash, are used: one half teaches which words stand
    next to secrets, the other trains the forest. With one kind of label only, or none, nothing is removed.
    NULL and empty texts have no candidates, an empty table gives no rows, repeated rows repeat their findings. Texts of
    any length are scanned whole. A value that ``findings`` judges both ways counts as 0; equal hashes are taken in the
    order of their values. Only ``doc_id``, ``text`` and ``source`` are read.
    """
    found = staged(candidates(docs), "secret-candidates")
    rows = staged(_features(found, dictionary(docs, min_docs)), "secret-features")
    if findings is None:
        known = form_labels(rows)
    else:
        judged = findings.where("label IS NOT NULL").groupBy("value").agg(F.min("label").alias("label"))
        known = rows.join(judged, "value")
    picked = known.withColumn("draw", F.xxhash64("value", "doc_id", "pos"))
    known = staged(picked.orderBy("draw", "value").limit(labelled), "secret-labels")
    teach, fit = known.where("pmod(draw, 2) = 0"), known.where("pmod(draw, 2) = 1")
    kinds = fit.agg(F.min("label"), F.max("label")).first()
    if kinds[0] == kinds[1]:
        return rows.select("doc_id", "path", "pos", "value", F.lit(1.0).alias("score"), F.lit(True).alias("secret"))
    odds = [staged(_odds(teach, w), f"secret-{w}") for w in ("left_word", "right_word")]
    assemble = VectorAssembler(inputCols=FEATURES, outputCol="features")
    forest = RandomForestClassifier(labelCol="label", numTrees=20, maxDepth=6, seed=7, maxMemoryInMB=64)
    model: RandomForestClassificationModel = forest.fit(assemble.transform(_with_odds(fit, odds)).select("features", F.col("label").cast("double")))
    scored = model.transform(assemble.transform(_with_odds(rows, odds)))
    score = vector_to_array("probability")[1]
    return scored.select("doc_id", "path", "pos", "value", score.alias("score"), (score >= 0.5).alias("secret"))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
