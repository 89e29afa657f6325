"""A content-addressed WARC archive.

Payload bytes are stored once, under their SHA-256; record headers are stored exactly, one row
per record.  Reading joins the two, checks every payload against its digest, and puts the
original records together.  The first record of equal payloads is a ``response``; the others are
``revisit`` records that refer to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_CONV32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1, without a label: 20 bits (5 hex digits) give 4 letters."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*parts)), _CONV32, _BASE32)


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def _clean(value: Column) -> Column:
    """A header value cannot hold line ends or other control bytes: they are percent-encoded."""
    for code in (*range(32), 127):
        value = F.replace(value, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return value


def record_id(row: Column) -> Column:
    """A name-based identifier of the record, from its page, address, payload and place."""
    h = F.sha2(row, 256)
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def write_archive(pages: DataFrame, path: str, min_payload: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write ``path/payloads`` (digest, payload) and ``path/records`` (page_id, digest, header).

    The payload of a page is its html in UTF-8, empty for null.  Among records with equal
    payloads of at least ``min_payload`` bytes the smallest ``page_id`` is the response (null ids
    come last; the earlier stored row wins among repeated ids); shorter payloads are responses
    all.  A null address leaves its header line out.  Every row is a record, repeated or not.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    path = path.rstrip("/")
    # the row number becomes part of the written index, so that no later step depends on how pages are read
    index = pages.select(
        "page_id", "url", F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("n"),
        base32_sha1(payload).alias("sha1"), F.monotonically_increasing_id().alias("row"),
    )
    index.write.option("compression", "zstd").parquet(f"{path}/index")
    index = pages.sparkSession.read.schema(index.schema).parquet(f"{path}/index")
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row")
    first = index.where(F.col("n") >= min_payload).groupBy("digest").agg(F.min(order).alias("first"))
    facts = (
        index.join(first, "digest", "left")
        .withColumn("is_first", F.coalesce(F.col("first.row") == F.col("row"), F.lit(True)))
        .withColumn("kind", F.when(F.col("is_first"), "response").otherwise("revisit"))
    )
    name = lambda page, row: record_id(F.concat_ws("|", page.cast("string"), F.col("digest"), row.cast("string")))
    length = F.when(F.col("is_first"), F.col("n")).otherwise(F.lit(0)).cast("string")
    refers = F.concat(
        _line("WARC-Profile", F.lit(_PROFILE)),
        _line("WARC-Refers-To", name(F.col("first.page_id"), F.col("first.row"))),
        _line("X-Refers-To-Page", F.coalesce(F.col("first.page_id").cast("string"), F.lit(""))),
    )
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.col("kind")),
        _line("WARC-Record-ID", name(F.col("page_id"), F.col("row"))),
        _line("WARC-Date", F.lit(date)),
        F.coalesce(_line("WARC-Target-URI", _clean(F.col("url"))), F.lit("")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(F.col("is_first"), F.lit("")).otherwise(refers),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", length),
        F.lit("\r\n"),
    )
    records = facts.select("page_id", "digest", F.encode(header, "UTF-8").alias("header"))
    records.write.option("compression", "zstd").parquet(f"{path}/records")
    # one payload per digest; equal ones meet in each task before the shuffle, so copies hardly move
    content = pages.select(F.sha2(payload, 256).alias("digest"), payload.alias("payload"))
    stored = content.groupBy("digest").agg(F.first("payload").alias("payload"))
    stored.write.option("compression", "zstd").parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """``page_id``, ``header``, ``payload``, ``record``: the original records, reconstructed.

    ``record`` is header, block and the two closing line ends; a revisit has an empty block, and
    ``payload`` then is what it refers to.  A payload that does not match its digest or a record
    without one fails the read.
    """
    path = path.rstrip("/")
    payloads = spark.read.parquet(f"{path}/payloads")
    wrong = F.raise_error(F.concat(F.lit("payload does not match its digest "), F.col("digest")))
    checked = payloads.select(
        "digest", F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(wrong).alias("payload")
    )
    records = spark.read.parquet(f"{path}/records")
    lost = F.raise_error(F.concat(F.lit("no payload stored for "), F.col("digest")))
    joined = records.join(checked, "digest", "left").withColumn("payload", F.coalesce(F.col("payload"), lost))
    revisit = field(F.col("header"), "WARC-Type") == "revisit"
    block = F.when(revisit, F.lit(b"")).otherwise(F.col("payload"))
    return joined.select(
        "page_id", "header", "payload", F.concat(F.col("header"), block, F.lit(b"\r\n\r\n")).alias("record")
    )


def field(header: Column, name: str) -> Column:
    """A header line's value, null if there is no such line."""
    text = F.decode(header, "UTF-8")
    value = F.regexp_extract(text, rf"\r\n{name}: ([^\r]*)\r\n", 1)
    return F.when(text.contains(f"\r\n{name}: "), value)


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """Facts of each record of an archive, all derived from the bytes that were read back."""
    records = read_archive(spark, path)
    kind = field(F.col("header"), "WARC-Type")
    return records.select(
        "page_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
        kind.alias("record_type"),
        F.expr("try_cast(regexp_extract(decode(header, 'UTF-8'), '\r\nX-Refers-To-Page: ([^\r]*)\r\n', 1) AS BIGINT)").alias("refers_to"),
        (field(F.col("header"), "WARC-Payload-Digest") == F.concat(F.lit("sha1:"), base32_sha1(F.col("payload")))).alias("verified"),
    )
