from __future__ import annotations

import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").cache()


@pytest.fixture(scope="session")
def text_rows(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


ODD = [
    (1, None, "src0", "x", 0.5),
    (2, "", None, "x", 0.5),
    (3, " \n\t ", "src0", None, None),
    (4, "one", "src0", "x", 0.5),
    (4, "one", "src0", "x", 0.5),
    (5, "two words", "src1", "x", 0.5),
    (None, "a text without an id", "src0", "x", 0.5),
    (None, None, None, None, None),
    (6, "long " * 40_000 + "end", "src0", "x", 0.5),
    (7, "é中\U0001f44d <|endoftext|> tail  \x1c", "src0", "x", 0.5),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, and extra columns whose names the operators use inside."""
    schema = "doc_id BIGINT, text STRING, source STRING, fp STRING, score DOUBLE"
    return spark.createDataFrame(ODD, schema).withColumn("n_chars", F.length("text").cast("long"))


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")
