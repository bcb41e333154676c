"""A content-addressed WARC archive as two tables.

``payloads`` holds the bytes of every different payload once, under its SHA-256; ``headers``
holds the exact header bytes of every record and the digest of its payload. A record is rebuilt
by joining the two. Equality of digests is verified when payloads are merged (equal length and
an independent second hash) and when they are read back (the digest of the bytes that came).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pumpguard.session import scratch_path

#: Payloads below this size are never replaced by a revisit.
MIN_REVISIT_BYTES = 100
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_DATE = "2020-01-01T00:00:00Z"
RECORD_ID = "urn:pumpguard:record:"


def _line(name: str, value: Column | str) -> Column:
    value = F.lit(value) if isinstance(value, str) else value.cast("string")
    # a line break inside a value would end the header: it is written as %0D or %0A
    return F.concat(F.lit(f"{name}: "),
                    F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")),
                    F.lit(CRLF))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", min_revisit: int = MIN_REVISIT_BYTES) -> None:
    """Write ``path/payloads`` and ``path/headers`` for one record per row of ``pages``.

    Of the records with one payload of at least ``min_revisit`` bytes, that with the smallest
    (page id, url, copy) is a response and the others revisit it; smaller payloads are always
    responses. Null payload: empty. Null id: ordered after all others. Repeated rows are
    numbered as copies, so each is a record of its own.
    """
    payload = F.encode(F.coalesce(F.col(payload_col).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"),
                        F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn(
        "length", F.octet_length("payload").cast("long"))
    # the bytes travel once for each payload and task at most
    stored = rows.groupBy("digest").agg(
        F.any_value("payload").alias("payload"), F.min("length").alias("length"),
        F.max("length").alias("_longest"), F.min(F.xxhash64("payload")).alias("_low"),
        F.max(F.xxhash64("payload")).alias("_high"))
    clash = (F.col("length") != F.col("_longest")) | (F.col("_low") != F.col("_high"))
    stored = stored.select("digest", F.when(clash, F.raise_error(F.lit("two payloads, one digest")))
                           .otherwise(F.col("payload")).alias("payload"), "length")
    stored.write.option("compression", "zstd").parquet(f"{path}/payloads")

    copies = rows.groupBy("page_id", "url", "digest", "length").agg(F.count(F.lit(1)).alias("n"))
    records = copies.select("page_id", "url", "digest", "length",
                            F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy"))
    order = F.struct(F.col("page_id").isNull().alias("no_id"), F.col("page_id").alias("id"),
                     F.col("url").isNull().alias("no_url"), F.col("url").alias("url"))
    firsts = copies.filter(F.col("length") >= min_revisit).groupBy("digest").agg(
        F.min(order).alias("first")).withColumnRenamed("digest", "first_digest")
    records = records.join(firsts, F.col("digest") == F.col("first_digest"), "left")
    is_first = (order == F.col("first")) & (F.col("copy") == 1)
    revisit = F.col("first").isNotNull() & ~is_first
    record_id = _record_id(F.col("page_id"), F.col("url"), F.col("digest"), F.col("copy"))
    refers = _record_id(F.col("first.id"), F.col("first.url"), F.col("digest"), F.lit(1))
    header = F.concat(
        F.lit("WARC/1.1" + CRLF),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", record_id),
        F.when(F.col("url").isNotNull(), _line("WARC-Target-URI", F.col("url"))).otherwise(F.lit("")),
        _line("WARC-Date", RECORD_DATE),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(_line("WARC-Profile", PROFILE), _line("WARC-Refers-To", refers),
                                 _line("Content-Length", "0")))
        .otherwise(_line("Content-Length", F.col("length"))),
        F.lit(CRLF))
    (records.select("page_id", F.encode(header, "UTF-8").alias("header"), "digest")
     .write.option("compression", "zstd").parquet(f"{path}/headers"))


def _record_id(page_id: Column, url: Column, digest: Column, copy: Column) -> Column:
    """``<urn:...:page id:hash:copy>``: the page id can be read back from it."""
    mark = F.sha1(F.concat(F.coalesce(url, F.lit("\x01")), F.lit("|"), digest))
    return F.concat(F.lit(f"<{RECORD_ID}"), F.coalesce(page_id.cast("string"), F.lit("null")),
                    F.lit(":"), mark, F.lit(":"), copy.cast("string"), F.lit(">"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, rebuilt: header and body (the exact bytes of the record, without its
    two closing line breaks), payload (a revisit's is that of the record it refers to), the
    header's fields, and the digest of the payload that came back, verified.
    """
    headers = spark.read.parquet(f"{path}/headers")
    payloads = spark.read.parquet(f"{path}/payloads").select(
        F.col("digest").alias("stored_digest"), "payload")
    text = F.decode("header", "UTF-8")

    def field(name: str) -> Column:
        value = F.regexp_extract(text, f"\\r\\n{name}: ([^\\r]*)\\r\\n", 1)
        return F.when(value != "", value)

    def page(name: str) -> Column:
        number = F.regexp_extract(field(name), f"^<{RECORD_ID}(-?[0-9]+):", 1)
        return F.nullif(number, F.lit("")).cast("long")

    # the digest of the bytes is taken once for each payload, before the join
    checked = payloads.withColumn("actual", F.sha2("payload", 256)).withColumn(
        "payload_bytes", F.octet_length("payload").cast("long"))
    records = headers.join(checked, F.col("digest") == F.col("stored_digest"), "left")
    declared = F.regexp_extract(field("WARC-Payload-Digest"), "^sha256:([0-9a-f]{64})$", 1)
    length = field("Content-Length").cast("long")
    kind = field("WARC-Type")
    whole = (F.col("actual").eqNullSafe(declared)
             & (length == F.when(kind == "revisit", F.lit(0)).otherwise(F.col("payload_bytes"))))
    return records.select(
        page("WARC-Record-ID").alias("page_id"), field("WARC-Record-ID").alias("record_id"),
        kind.alias("record_type"), field("WARC-Target-URI").alias("target_uri"),
        page("WARC-Refers-To").alias("refers_to"), field("WARC-Refers-To").alias("refers_to_record"),
        "header", F.when(kind == "revisit", F.lit(b"")).otherwise(F.col("payload")).alias("body"),
        "payload", "payload_bytes",
        F.when(whole, F.col("actual")).otherwise(
            F.raise_error(F.concat(F.lit("damaged record "), field("WARC-Record-ID")))).alias("payload_digest"))


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Archive ``pages`` in the shared checkpoint folder, read it back: page_id, payload_bytes,
    payload_digest, record_type, refers_to, one row per page (no pages: no rows)."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archive(pages, path)
    return read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest",
                                            "record_type", "refers_to")
