"""Captured responses to raw rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import json_array, json_map, parse_json
from ..schemas import PAGE_ITEM_KEYS


def stamp_batch(df: DataFrame, batch_id: str) -> DataFrame:
    return df.withColumn("batch_id", F.lit(batch_id))


def read_responses(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """Captured responses from files: one per file, or one per line."""
    files = spark.read.text(path, wholetext=whole_files)
    return files.select(F.col("value").alias("payload"), F.input_file_name().alias("source_file"))


def answered(calls: DataFrame) -> DataFrame:
    """Calls whose text is stored: all that returned one, whatever their status; a raised call has none."""
    return calls.filter(~F.col("raised"))


def land_json(responses: DataFrame) -> DataFrame:
    """One row per element of a list payload, one row for any other payload.

    A payload that is no list (or no JSON at all) keeps its text byte for byte.
    """
    elements = F.transform(json_array(parse_json(F.col("payload"))), lambda e: F.to_json(e))
    others = [c for c in responses.columns if c != "payload"]
    # outer with a later filter: the inner form adds a size check that parses every payload again
    rows = responses.select(*others, F.posexplode_outer(F.coalesce(elements, F.array("payload"))).alias("pos", "payload"))
    return rows.filter("pos IS NOT NULL")


def land_text(responses: DataFrame) -> DataFrame:
    """One row per response, text untouched."""
    return responses.select(*[c for c in responses.columns if c != "payload"], F.col("payload").cast("string"))


def page_envelope(pages: DataFrame) -> DataFrame:
    """Item list and announced total of each page response, whatever its envelope.

    A preferred key wins if it holds a list with entries. Otherwise the first key in document order
    that holds a list is taken; VARIANT sorts its keys, so the order is read from the text. A bare list
    announces its own length. No list at all gives NULL.
    """
    doc = F.col("doc")
    parsed = pages.withColumn("doc", parse_json(F.col("payload"))).withColumns(
        {
            "bare": json_array(doc),
            "lists": F.map_filter(
                F.transform_values(json_map(doc), lambda _, v: json_array(v)), lambda _, v: v.isNotNull()
            ),
        }
    )
    preferred = F.coalesce(*[F.col("lists")[key] for key in PAGE_ITEM_KEYS])
    list_keys = F.filter(F.json_object_keys("payload"), lambda k: F.map_contains_key("lists", k))
    first_list = F.col("lists")[F.get(list_keys, F.lit(0))]
    items = F.coalesce("bare", F.when(F.size(preferred) > 0, preferred), first_list)
    total = F.coalesce(F.array_size("bare").cast("bigint"), F.try_variant_get(doc, "$.total", "bigint"))
    return parsed.withColumns({"items": items, "total": total}).drop("doc", "bare", "lists")


def _page_run(pages: DataFrame, limit: int) -> DataFrame:
    """Per batch: where the page run ends and what it reports.

    Plain aggregates instead of an ordered window, so a batch with very many pages stays parallel.
    """
    offset = F.col("offset")
    bad = (F.col("status_code") != 200) | F.coalesce(F.size("items") == 0, F.lit(True))
    per_batch = pages.groupBy("batch_id").agg(
        F.min(F.when(bad, offset)).alias("bad_offset"),
        F.min_by(F.when(bad, F.col("status_code")), F.when(bad, offset)).alias("bad_status"),
        F.min(F.when(F.col("total").isNotNull(), offset)).alias("total_offset"),
        F.min_by("total", F.when(F.col("total").isNotNull(), offset)).alias("total"),
    )
    seen = F.coalesce(F.col("total_offset") <= F.col("bad_offset"), F.col("total_offset").isNotNull())
    full = (F.ceil(F.col("total") / limit) - 1) * limit
    return per_batch.select(
        "batch_id",
        "bad_offset",
        "bad_status",
        F.when(seen, F.col("total")).alias("total"),
        F.when(seen, F.greatest(F.col("total_offset"), full)).alias("last_offset"),
    )


def _kept() -> Column:
    offset = F.col("offset")
    return F.coalesce(offset < F.col("bad_offset"), F.lit(True)) & F.coalesce(
        offset <= F.col("last_offset"), F.lit(True)
    )


def page_concat(pages: DataFrame, limit: int) -> DataFrame:
    """Items of every batch in page order, up to the point where paging stops.

    Expects the pages a paging client fetched: offsets 0, limit, 2 * limit, ...
    """
    parsed = page_envelope(pages)
    run = _page_run(parsed, limit)
    kept = parsed.join(run.drop("total"), "batch_id").filter(_kept())
    return kept.select("batch_id", "offset", F.posexplode("items").alias("pos", "item")).select(
        "batch_id", "offset", "pos", F.to_json("item").alias("payload")
    )


def page_report(pages: DataFrame, limit: int) -> DataFrame:
    """One row per batch: announced total, pages used, page size and last status."""
    parsed = page_envelope(pages)
    run = _page_run(parsed, limit)
    counts = (
        parsed.drop("total", "items", "payload")
        .join(run, "batch_id")
        .groupBy("batch_id", "total", "bad_offset", "bad_status", "last_offset")
        .agg(F.count_if(_kept()).alias("page_count"))
    )
    hit_bad = F.coalesce(F.col("bad_offset") <= F.col("last_offset"), F.col("bad_offset").isNotNull())
    return counts.select(
        "batch_id",
        "total",
        "page_count",
        F.lit(limit).alias("limit"),
        F.when(hit_bad, F.col("bad_status")).otherwise(F.lit(200)).alias("status_code"),
    )


def result_count(payload: Column) -> Column:
    """Number of results in a response: list length, length of ``results``, else one."""
    doc = parse_json(payload)
    return F.coalesce(F.array_size(json_array(doc)), F.array_size(json_array(doc, "$.results")), F.lit(1))


def forecast_result_count(payload: Column) -> Column:
    """A forecast call counts as one result however many places it covers; an empty answer counts as none."""
    doc = parse_json(payload)
    empty = F.coalesce(F.array_size(json_array(doc)) == 0, F.size(json_map(doc)) == 0, F.lit(False))
    return F.when(empty | F.coalesce(F.is_variant_null(doc), F.lit(False)), 0).otherwise(1)
