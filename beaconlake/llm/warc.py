"""Content-addressed web archive.

Each distinct payload is stored once under its SHA-256; the exact header block of every record is stored apart.
A record is put together again by joining both on the digest.

    store = write_archive(pages, folder)
    records = read_archive(spark, store)        # one row per record, with its bytes

Of records with equal payloads of at least `least_bytes` bytes, the one with the smallest page id is the response and
the others revisit it; records with smaller payloads are all responses. A page id may repeat: then one of the rows
with the smallest id is the response. A null id comes after all others; null html is an empty payload; a null url
leaves out the target header. Line breaks in a url are written as %0D and %0A. No pages give an empty archive.

Scale: digests and ids are aggregated before the shuffle, so many copies of one page cost one row per task; payload
bytes are shuffled once, already without copies in a task. Headers meet their response by a join on the digest that
Spark can split when one digest holds many rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.session import staged

REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADER_END = "\r\n\r\n"


@dataclass(frozen=True)
class Store:
    headers: str
    payloads: str


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def write_archive(
    pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", least_bytes: int = 100,
    id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> Store:
    """Write payloads and headers below `folder`."""
    store = Store(f"{folder}/headers", f"{folder}/payloads")
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    records = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    digested = records.withColumn("digest", F.sha2("payload", 256))
    digested.groupBy("digest").agg(F.first("payload").alias("payload")).write.parquet(store.payloads)

    thin = digested.select(
        "page_id", "url", "digest", F.octet_length("payload").cast("long").alias("bytes"),
        F.monotonically_increasing_id().alias("record"),
    )
    thin = staged(thin, "warc-records")  # the record number stays as it is from here on
    order = F.struct(F.col("page_id").isNull().alias("last"), F.col("page_id").alias("id"), "record")
    firsts = thin.where(F.col("bytes") >= least_bytes).groupBy("digest").agg(F.min(order).alias("response"))
    firsts = firsts.select("digest", "response.id", F.col("response.record").alias("response_record"))
    known = thin.join(firsts, "digest", "left")
    revisit = F.coalesce(F.col("response_record") != F.col("record"), F.lit(False))

    def name(of: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(of.cast("string"), F.lit("")), F.lit(">"))

    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:record:"), F.col("record").cast("string"), F.lit(">"))),
        _line("WARC-Date", F.lit(date)),
        F.when(F.col("url").isNull(), "").otherwise(_line("WARC-Target-URI", uri)),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        _line("WARC-Page-ID", name(F.col("page_id"))),
        F.when(revisit, F.concat(_line("WARC-Profile", F.lit(REVISIT_PROFILE)), _line("WARC-Refers-To-Page", name(F.col("id"))))).otherwise(""),
        F.lit("Content-Type: text/html; charset=utf-8\r\n"),
        _line("WARC-Payload-Length", F.col("bytes").cast("string")),
        _line("Content-Length", F.when(revisit, "0").otherwise(F.col("bytes").cast("string"))),
        F.lit("\r\n"),
    )
    known.select("record", "digest", header.alias("header")).write.parquet(store.headers)
    return store


def _field(name: str, value: str) -> Column:
    found = F.regexp_extract("header", f"\r\n{name}: {value}\r\n", 1)
    return F.when(found != "", found)


def read_archive(spark: SparkSession, store: Store) -> DataFrame:
    """Records with the fields of their headers, `bytes` as written to a WARC file, and the full payload.

    The digest and length are those of the stored payload, computed again. A record whose payload does not match the
    digest in its header, or is missing, has verified = false.
    """
    payloads = spark.read.schema("digest string, payload binary").parquet(store.payloads).select(
        F.col("digest").alias("stored"), "payload", F.sha2("payload", 256).alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
    )
    headers = spark.read.schema("record long, digest string, header string").parquet(store.headers).select(
        "record", "header",
        _field("WARC-Type", "(response|revisit)").alias("record_type"),
        _field("WARC-Page-ID", "<urn:page:(-?[0-9]+)>").cast("long").alias("page_id"),
        _field("WARC-Refers-To-Page", "<urn:page:(-?[0-9]+)>").cast("long").alias("refers_to"),
        _field("WARC-Target-URI", "([^\r\n]*)").alias("url"),
        _field("WARC-Payload-Digest", "sha256:([0-9a-f]+)").alias("digest"),
    )
    joined = headers.join(payloads, F.col("digest") == F.col("stored"), "left")
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return joined.withColumns(
        {
            "verified": F.coalesce(F.col("payload_digest") == F.col("digest"), F.lit(False)),
            "bytes": F.concat(F.col("header").cast("binary"), block, F.lit(HEADER_END.encode())),
        }
    ).drop("stored")
