"""Content-addressed web archive.

Payload bytes are stored once per SHA-256 digest (``contents``); the exact header bytes of
every record are stored separately (``headers``).  Records are put together again by
a join on the digest, which also checks the digest of what was stored.  Copies of a payload are
grouped by digest and bytes, so a digest that stands for two payloads is an error.

Of records with equal payloads of at least ``min_revisit`` bytes the one with the smallest
page_id is a ``response``, the others are ``revisit`` records that refer to it and have no
payload of their own.  ``export_records`` gives whole records; written one after the other
they are a WARC 1.1 file.

Edge cases: null html is an empty payload; a null url has no target header, line breaks
in a url are percent-encoded; a null page_id ranks last and has an empty id; of rows that share
page_id and payload one is the response; an empty table gives an empty archive; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlake.llm.common import materialize

MIN_REVISIT = 100
#: every record gets this date unless the caller has one: the tables have none
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_EOL = "\r\n"


def _id(col):
    return F.concat(F.lit("<urn:page:"), F.coalesce(col.cast("string"), F.lit("")), F.lit(">"))


def write_archive(pages: DataFrame, path: str, min_revisit: int = MIN_REVISIT, date: str = DATE) -> str:
    """Write ``pages`` (page_id, url, html) to ``path``/contents and ``path``/headers; returns ``path``."""
    spark = pages.sparkSession
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    whole = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    rows = materialize(whole.select("page_id", "url", "digest", F.octet_length("payload").cast("long").alias("n"))
                       .withColumn("row", F.monotonically_increasing_id()), "warc-rows")
    # grouped by the bytes themselves: equal digests are verified
    (whole.groupBy("digest", "payload").agg(F.count("*").alias("copies"))
     .write.option("compression", "zstd").parquet(f"{path}/contents"))
    if spark.read.parquet(f"{path}/contents").groupBy("digest").count().filter("count > 1").head(1):
        raise ValueError("one digest stands for two payloads")

    order = F.struct(F.col("page_id").isNull(), "page_id", "row")
    firsts = (rows.filter(F.col("n") >= min_revisit).groupBy("digest")
              .agg(F.min_by(F.struct("page_id", "row"), order).alias("first")))
    kinds = (rows.join(firsts, "digest", "left")
             .withColumn("revisit", F.col("first").isNotNull() & (F.col("row") != F.col("first.row"))))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_EOL}Content-Type: text/html; charset=UTF-8{_EOL}Content-Length: "),
                    F.col("n").cast("string"), F.lit(_EOL + _EOL))
    body = F.octet_length(http) + F.when(F.col("revisit"), F.lit(0)).otherwise(F.col("n"))
    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    head = F.concat(
        F.lit(f"WARC/1.1{_EOL}WARC-Type: "), F.when(F.col("revisit"), "revisit").otherwise("response"),
        F.lit(f"{_EOL}WARC-Record-ID: "), _id(F.col("page_id")),
        F.lit(f"{_EOL}WARC-Date: {date}"),
        F.when(F.col("url").isNull(), "").otherwise(F.concat(F.lit(f"{_EOL}WARC-Target-URI: "), uri)),
        F.lit(f"{_EOL}WARC-Payload-Digest: sha256:"), F.col("digest"),
        F.when(F.col("revisit"), F.concat(F.lit(f"{_EOL}WARC-Profile: {PROFILE}{_EOL}WARC-Refers-To: "),
                                          _id(F.col("first.page_id")))).otherwise(""),
        F.lit(f"{_EOL}Content-Type: application/http; msgtype=response{_EOL}Content-Length: "),
        body.cast("string"), F.lit(_EOL + _EOL), http)
    kinds.select(F.encode(head, "UTF-8").alias("header"), "digest").write.parquet(f"{path}/headers")
    return path


def export_records(spark: SparkSession, path: str) -> DataFrame:
    """header, digest, payload (of the content the record stands for), record (the whole WARC record).

    The stored payload's digest is computed anew; a difference is an error.
    """
    contents = spark.read.parquet(f"{path}/contents").select("digest", "payload")
    checked = contents.withColumn("payload", F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload"))
                                  .otherwise(F.raise_error(F.lit("stored payload differs from its digest")).cast("binary")))
    is_response = F.col("header").cast("string").startswith(f"WARC/1.1{_EOL}WARC-Type: response")
    return (spark.read.parquet(f"{path}/headers").join(checked, "digest")
            .withColumn("record", F.concat("header", F.when(is_response, F.col("payload")).otherwise(F.lit(b"")),
                                           F.lit((_EOL * 2).encode()))))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, url, record_bytes of every record.

    All from the stored records: the type, ids and digest from the header, the payload's
    size from the payload itself, checked against the record's Content-Length.
    """
    head = F.substring_index(F.col("header").cast("string"), _EOL * 2, 1)

    def field(name: str):
        found = F.regexp_extract("_head", rf"(?:^|\n){name}: ([^\r\n]*)", 1)
        return F.when(found != "", found)

    records = export_records(spark, path).withColumn("_head", head).select(
        F.regexp_extract(field("WARC-Record-ID"), r"<urn:page:(-?\d+)>", 1).alias("_page"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        field("WARC-Type").alias("record_type"),
        F.regexp_extract(F.coalesce(field("WARC-Refers-To"), F.lit("")), r"<urn:page:(-?\d+)>", 1).alias("_refers"),
        field("WARC-Target-URI").alias("url"), field("Content-Length").cast("long").alias("_length"),
        F.octet_length("_head").alias("_at"), F.octet_length("record").cast("long").alias("record_bytes"),
        F.regexp_extract(field("WARC-Payload-Digest"), "^sha256:(.*)$", 1).alias("_digest"))
    sound = ((F.col("record_bytes") == F.col("_at") + 4 + F.col("_length") + 4)
             & (F.col("payload_digest") == F.col("_digest")))
    number = lambda c: F.when(F.col(c) != "", F.col(c).cast("long"))
    return records.select(
        number("_page").alias("page_id"), "payload_bytes",
        F.when(sound, F.col("payload_digest")).otherwise(F.raise_error(F.lit("damaged record"))).alias("payload_digest"),
        "record_type", number("_refers").alias("refers_to"), "url", "record_bytes")
