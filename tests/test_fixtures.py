"""How the payload text is made."""

from __future__ import annotations

from pyspark.sql import functions as F
from railfeed.checks import fixtures as fx


def test_a_value_is_worked_out_once(spark):
    value = fx._attr("n", F.col("marker"))
    assert str(value).count("marker") == 1
    assert str(fx._pick(F.col("marker") % 3, None, "a", "b")).count("marker") == 1
    rows = spark.createDataFrame([("x",), ("",), (None,)], "marker STRING").select(value.alias("text")).collect()
    assert [r.text for r in rows] == [' n="x"', ' n=""', ""]
    picked = spark.range(5).select(fx._pick(F.col("id"), None, "a", "b").alias("p")).collect()
    assert [r.p for r in picked] == [None, "a", "b", None, None]
