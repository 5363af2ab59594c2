"""WARC archives: write page captures as records, read them back, and assemble transactions."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from railfeed.llm.common import staged, table
from railfeed.session import work_dir

#: Protocol version, date of the captures, profile of a revisit by payload digest.
VERSION = "WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
#: Records of a file: so many, or fewer where pages are long, so that files stay near these plain bytes.
RECORDS_PER_FILE, FILE_BYTES = 30_000, 256 << 20


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a binary column: five hex digits become four base32 digits."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record_id(kind: str, *of: Column) -> Column:
    h = F.md5(F.concat_ws("\x1f", F.lit(kind), *of))
    cuts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _lines(*pairs: tuple[str, Column]) -> Column:
    """Header lines; one whose value is NULL is left out."""
    return F.concat(*[F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit("")) for name, value in pairs])


def _record(kind: Column, record_id: Column, block: Column, *more: tuple[str, Column]) -> Column:
    head = _lines(
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id),
        ("WARC-Date", F.lit(DATE)),
        *more,
        ("Content-Length", F.octet_length(block).cast("string")),
    )
    return F.concat(F.lit(f"{VERSION}\r\n"), head, F.lit("\r\n"), block)


def captures(pages: DataFrame, min_bytes: int, id_col: str, url_col: str, body_col: str) -> DataFrame:
    """Pages with payload digest, record type and the record id of the response.

    Rows that repeat another one are captures of their own, told apart by their place in the table. ``pages`` is read
    twice and must give the same rows in the same partitions, as a stored table does.
    """
    page = pages.select(
        F.col(id_col).alias("page_id"),
        F.regexp_replace(F.col(url_col), "[\\r\\n]", "%0A").alias("url"),
        F.coalesce(F.col(body_col), F.lit("")).alias("body"),
        F.monotonically_increasing_id().alias("place"),
    )
    page = page.withColumn("payload_bytes", F.octet_length("body").cast("long"))
    page = page.withColumn("digest", base32_sha1(F.encode("body", "UTF-8"))).withColumn("response_id", _record_id("response", *_ident()))
    key = ["digest", "payload_bytes"]
    # All rows with the largest id of equal payloads answer; the others refer to the first of them.
    named = page.where((F.col("payload_bytes") >= min_bytes) & F.col("page_id").isNotNull())
    order = F.struct("page_id", -F.col("place"))
    first = named.groupBy(*key).agg(F.max("page_id").alias("top"), F.max_by("response_id", order).alias("first_id"))
    page = page.join(first, key, "left")
    revisit = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    return page.withColumn("refers", F.when(revisit, F.col("first_id")))


def _ident() -> list[Column]:
    return [F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.coalesce("url", F.lit("")), F.col("digest"), F.col("place").cast("string")]


def write_archive(
    pages: DataFrame, path: str, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", body_col: str = "html"
) -> None:
    """Write three records per page (request, response or revisit, metadata) as gzipped WARC files under ``path``.

    A record is a row of text; the blank lines that end it are the writer's line separator. Of equal payloads of at
    least ``min_bytes`` bytes, that with the largest id is the response (all rows that have it, where it repeats) and
    the others are revisits of it. A NULL html is empty, an empty table gives no records, other columns are ignored.
    """
    size = pages.select(F.avg(F.octet_length(body_col))).first()[0] or 0
    records_per_file = max(3, min(RECORDS_PER_FILE, int(3 * FILE_BYTES / (size + 1))))
    page = captures(pages, min_bytes, id_col, url_col, body_col)
    rid, url, ident = F.col("response_id"), F.col("url"), _ident()
    host = F.regexp_extract(url, "://([^/?#]*)", 1)
    target = F.when(F.regexp_extract(url, "://[^/?#]*(.*)$", 1) != "", F.regexp_extract(url, "://[^/?#]*(.*)$", 1)).otherwise(F.lit("/"))
    asked = F.concat(F.lit("GET "), F.coalesce(target, F.lit("/")), F.lit(" HTTP/1.1\r\n"), _lines(("Host", host)), F.lit("\r\n"))
    answer_head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        _lines(("Content-Length", F.col("payload_bytes").cast("string"))),
        F.lit("\r\n"),
    )
    revisit = F.col("refers").isNotNull()
    answer = F.when(revisit, answer_head).otherwise(F.concat(answer_head, F.col("body")))
    payload = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    uri = ("WARC-Target-URI", url)
    records = F.array(
        _record(
            F.lit("request"), _record_id("request", *ident), asked, uri, ("WARC-Concurrent-To", rid),
            ("Content-Type", F.lit("application/http; msgtype=request")),
        ),
        _record(
            F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")), rid, answer, uri, payload,
            ("WARC-Refers-To", F.col("refers")), ("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ),
        _record(
            F.lit("metadata"), _record_id("metadata", *ident), _lines(("page-id", F.col("page_id").cast("string"))), uri,
            ("WARC-Concurrent-To", rid), ("Content-Type", F.lit("application/warc-fields")),
        ),
    )
    rows = page.select(F.explode(records).alias("value"))
    rows.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def _inflate(raw: bytes) -> Iterator[bytes]:
    """Plain bytes of a gzip file of any number of members, or of a file that is not compressed."""
    if raw[:2] != b"\x1f\x8b":
        yield raw
        return
    view = memoryview(raw)
    while len(view):
        unzip, used = zlib.decompressobj(31), 0
        while used < len(view) and not unzip.eof:
            step = view[used : used + (1 << 18)]
            used += len(step)
            yield unzip.decompress(step)
        view = view[used - len(unzip.unused_data) :]


def parse_records(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(headers, block)`` of each record, by its length and not by what the block looks like."""
    source, buffer = _inflate(raw), bytearray()

    def need(ready) -> bool:
        while not ready():
            more = next(source, None)
            if more is None:
                return False
            buffer.extend(more)
        return True

    at = 0
    while True:
        if at > (1 << 22):
            del buffer[:at]
            at = 0
        while need(lambda: len(buffer) >= at + 2) and buffer[at : at + 2] == b"\r\n":
            at += 2
        if not need(lambda: buffer.find(b"\r\n\r\n", at) >= 0):
            if bytes(buffer[at:]).strip():
                raise ValueError("archive ends within a record's header")
            return
        stop = buffer.index(b"\r\n\r\n", at)
        first, *lines = bytes(buffer[at:stop]).decode("utf-8", "replace").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record starts with {first[:40]!r}")
        headers: dict[str, str] = {}
        for name, _, value in (line.partition(":") for line in lines):
            name, value = name.strip().lower(), value.strip()
            # a capture may be concurrent to several records
            headers[name] = f"{headers[name]}\n{value}" if name == "warc-concurrent-to" and name in headers else value
        size, at = int(headers["content-length"]), stop + 4
        if not need(lambda: len(buffer) >= at + size):
            raise ValueError("archive ends within a record's block")
        yield headers, bytes(buffer[at : at + size])
        at += size


RECORD = (
    "kind STRING, record_id STRING, concurrent_to ARRAY<STRING>, refers_to STRING, uri STRING, payload_bytes BIGINT, "
    "payload_digest STRING, status INT, fields MAP<STRING, STRING>, payload BINARY"
)


def _row(headers: dict[str, str], block: bytes, payloads: bool) -> tuple:
    kind, status, fields, payload, size, digest = headers.get("warc-type"), None, {}, None, None, None
    if kind in ("request", "response", "revisit"):
        head, _, body = block.partition(b"\r\n\r\n")
        first, *lines = head.decode("utf-8", "replace").split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        if kind == "request":
            fields["request-line"] = first
        else:
            status = int(m[1]) if (m := re.match(r"HTTP/\S+ (\d+)", first)) else None
        if kind == "response":
            payload, size = body, len(body)
            digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        elif kind == "revisit":
            size = int(fields["content-length"]) if "content-length" in fields else None
            digest = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    elif kind == "metadata":
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in block.decode("utf-8", "replace").split("\r\n") if x)}
    stated = headers.get("warc-payload-digest")
    if kind == "response" and stated and stated != f"sha1:{digest}":
        raise ValueError(f"payload of {headers.get('warc-record-id')} differs from its digest")
    with_ = headers["warc-concurrent-to"].split("\n") if "warc-concurrent-to" in headers else []
    ids = (headers.get("warc-record-id"), with_, headers.get("warc-refers-to"))
    return (kind, *ids, headers.get("warc-target-uri"), size, digest, status, list(fields.items()), payload if payloads else None)


def read_archive(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record; a response's size and digest are taken from the payload as read, and checked."""
    schema = StructType.fromDDL(RECORD)
    kinds = [*[pa.string()] * 2, pa.list_(pa.string()), *[pa.string()] * 2, pa.int64(), pa.string(), pa.int32(), pa.map_(pa.string(), pa.string()), pa.binary()]

    def flush(rows):
        columns = zip(*rows) if rows else [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], names=schema.names)

    def run(batches):
        for batch in batches:
            for raw in batch.column(0):
                rows, held = [], 0
                for headers, block in parse_records(raw.as_py()):
                    rows.append(_row(headers, block, payloads))
                    held += len(block) if payloads else 200
                    if held > (1 << 23) or len(rows) >= 5000:
                        yield flush(rows)
                        rows, held = [], 0
                yield flush(rows)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, schema)


def transactions(records: DataFrame) -> DataFrame:
    """One nested row per capture: its response or revisit, and all request and metadata records concurrent to it.

    Records are concurrent whichever of the two names the other. ``request`` and ``metadata`` are the ones with the
    smallest record id, ``requests`` and ``metadata_records`` have all of them in that order; NULL and empty where there
    is none. ``refers`` is the metadata of the capture that a revisit refers to. Request or metadata records whose
    capture is missing are left out; records with an id seen twice are one record. No records give no rows. A payload
    of any length goes through as it is.
    """
    once = records.dropDuplicates(["record_id"])
    is_answer = F.col("kind").isin("response", "revisit")
    shown = F.struct("kind", "status", "payload_bytes", "payload_digest", "fields", "payload")
    answers = once.where(is_answer).select(
        F.col("record_id").alias("capture"), F.struct("refers_to", "uri", shown.alias("response")).alias("answer"), F.lit(None).cast(_PARTNER).alias("partner")
    )
    partners = once.where("kind IN ('request', 'metadata')").select(
        "record_id", "concurrent_to", F.struct("kind", F.col("record_id").alias("id"), "fields").alias("partner")
    )
    # captures that the record names, and those that name it
    named = once.where(is_answer).select(F.col("record_id").alias("capture"), F.explode("concurrent_to").alias("record_id"))
    pairs = partners.select(F.explode("concurrent_to").alias("capture"), "partner").unionAll(
        named.join(partners, "record_id").select("capture", "partner")
    )
    both = answers.unionByName(pairs.withColumn("answer", F.lit(None).cast(answers.schema["answer"].dataType)))
    whole = both.groupBy("capture").agg(F.max_by("answer", F.col("answer").isNotNull()).alias("answer"), F.collect_set(F.struct(
        F.col("partner.id"), F.col("partner.kind"), F.to_json("partner.fields").alias("fields"))).alias("partners"))
    some = lambda kind: F.transform(
        F.filter(F.array_sort("partners"), lambda p: p["kind"] == kind),
        lambda p: F.struct(p["id"].alias("id"), F.from_json(p["fields"], "MAP<STRING, STRING>").alias("fields")),
    )
    whole = whole.where("answer IS NOT NULL").select(
        F.col("capture").alias("record_id"), "answer.*", some("request").alias("requests"), some("metadata").alias("metadata_records")
    )
    first = {"request": F.get("requests", F.lit(0)), "metadata": F.get("metadata_records", F.lit(0))}
    whole = whole.withColumns(first)
    other = whole.select(F.col("record_id").alias("refers_to"), F.col("metadata").alias("refers"))
    # only revisits refer to anything, so responses do not meet under NULL
    found = whole.where("refers_to IS NOT NULL").join(other, "refers_to", "left")
    rest = whole.where("refers_to IS NULL").withColumn("refers", F.lit(None).cast(other.schema["refers"].dataType))
    return found.unionByName(rest)


_PARTNER = "STRUCT<kind: STRING, id: STRING, fields: MAP<STRING, STRING>>"


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per row of ``pages``. A NULL id is never the largest; where equal payloads have no other, all are responses."""
    path = work_dir(spark, "warc")
    write_archive(table(spark, sf_dir, "pages"), path, min_bytes=0)
    page_id = lambda c: F.element_at(F.col(f"{c}.fields"), "page-id").cast("long")
    records = staged(read_archive(spark, path, payloads=False), "records")  # the archive is parsed once
    return transactions(records).select(
        page_id("metadata").alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.kind").alias("record_type"),
        page_id("refers").alias("refers_to"),
    )


#: Base32 of a SHA-1 in SQL: a 20-bit number for every five hex digits, four letters for each number.
_DIGIT = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((n >> {shift}) & 31 AS INTEGER), 1)"
OP5_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (
  SELECT page_id, octet_length(body) AS payload_bytes,
         list_aggregate(list_transform(range(0, 8), lambda i: list_aggregate(list_transform(
           [CAST('0x' || substr(sha1(body), CAST(5 * i + 1 AS INTEGER), 5) AS BIGINT)],
           lambda n: {" || ".join(_DIGIT.format(shift=s) for s in (15, 10, 5, 0))}), 'string_agg', '')), 'string_agg', '') AS payload_digest
  FROM p),
t AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM t
"""
