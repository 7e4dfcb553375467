"""Content-addressed WARC archive.

An archive is two Parquet tables in a folder:

``payloads``  one row per distinct payload: ``sha256`` (the address), ``payload``.
``headers``   one row per record: the exact WARC header bytes and HTTP header bytes, and the address.

Payload bytes are stored once; a record is rebuilt by joining its header to the payload.
Reading verifies each stored payload against its address, once per payload.

Defined cases: null html is the empty payload; a null url is written as an empty target; a null
page_id keeps its record, which is a response only where no record of that payload has an id;
rows repeating the page_id that is the response are responses too; an empty table gives an empty
archive; columns other than page_id, url and html are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import Scratch

CRLF = "\r\n"
#: The digits of base 32 as conv() writes them, and as RFC 4648 does.
CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
RFC4648_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: WARC-Date of every record: an archive written twice from the same pages is the same.
FIXED_DATE = "2024-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: 40 hex digits, 5 at a time into 4 base-32 digits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), CONV_DIGITS, RFC4648_DIGITS)


def _uuid(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("\n", *parts).cast("binary"))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *(F.substring(h, a, n) for a, n in cuts))


def build_records(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Header, address and kind of each record; no payload bytes pass through a shuffle here.

    Of records with one address and at least ``min_revisit_bytes`` bytes, that with the largest
    page_id is the response. The winner of each address is a map-side combined max, so a payload
    that a third of all pages share is one row a task; the join back has plain keys, which
    adaptive execution splits where they are hot.
    """
    p = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    p = p.select(
        "page_id", "url", F.sha2("payload", 256).alias("sha256"), F.octet_length("payload").cast("long").alias("bytes"), base32_sha1(F.col("payload")).alias("digest")
    )
    keepers = p.groupBy(F.col("sha256").alias("k_sha")).agg(F.max("page_id").alias("keeper"))
    r = p.join(keepers.hint("merge"), F.col("sha256") == F.col("k_sha"), "left").drop("k_sha")
    revisit = (F.col("bytes") >= min_revisit_bytes) & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    r = r.withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
    r = r.withColumn("refers_to", F.when(revisit, F.col("keeper")))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("bytes").cast("string"), F.lit(CRLF * 2))
    length = F.octet_length(http.cast("binary")) + F.when(F.col("record_type") == "response", F.col("bytes")).otherwise(0)
    profile = f"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{CRLF}"

    def fields(page_id: Column) -> Column:
        return F.concat(F.lit("<urn:uuid:"), _uuid(F.lit("page"), F.coalesce(page_id.cast("string"), F.lit("")), F.col("sha256")), F.lit(">"))

    warc = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "),
        F.col("record_type"),
        F.lit(f"{CRLF}WARC-Record-ID: "),
        fields(F.col("page_id")),
        F.when(F.col("refers_to").isNotNull(), F.concat(F.lit(f"{CRLF}WARC-Refers-To: "), fields(F.col("refers_to")))).otherwise(F.lit("")),
        F.lit(f"{CRLF}WARC-Target-URI: "),
        F.regexp_replace("url", r"[\r\n]+", " "),
        F.lit(f"{CRLF}WARC-Date: {FIXED_DATE}{CRLF}WARC-Payload-Digest: sha1:"),
        F.col("digest"),
        F.lit(f"{CRLF}X-Page-ID: "),
        F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit(f"{CRLF}X-Refers-To-Page-ID: "),
        F.coalesce(F.col("refers_to").cast("string"), F.lit("")),
        F.lit(CRLF),
        F.when(F.col("record_type") == "revisit", F.lit(profile)).otherwise(F.lit("")),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}Content-Length: "),
        length.cast("string"),
        F.lit(CRLF * 2),
    )
    return r.select("page_id", "sha256", "record_type", warc.cast("binary").alias("warc_header"), http.cast("binary").alias("http_header"))


def _owner_key(sha256: Column, page_id: Column) -> Column:
    return F.concat_ws(":", sha256, F.coalesce(page_id.cast("string"), F.lit("-")))


def write_archive(pages: DataFrame, path: str, min_revisit_bytes: int = 0) -> None:
    """Write the two tables of an archive of ``pages`` (page_id, url, html) below ``path``."""
    spark = pages.sparkSession
    build_records(pages, min_revisit_bytes).write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/headers")
    owners = spark.read.parquet(f"{path}/headers").where("record_type = 'response'").groupBy("sha256").agg(F.max("page_id").alias("owner"))
    owners = owners.select(_owner_key(F.col("sha256"), F.col("owner")).alias("o_key"))
    full = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    full = full.withColumn("sha256", F.sha2("payload", 256)).select(_owner_key(F.col("sha256"), F.col("page_id")).alias("key"), "sha256", "payload")
    # keyed by page_id too: the copies of one payload spread over the partitions, and rows that
    # repeat a page_id merge there, so payloads are shuffled once; merge joins at every size
    owned = full.join(owners.hint("merge"), F.col("key") == F.col("o_key"), "left_semi")
    stored = owned.groupBy("key").agg(F.first("sha256").alias("sha256"), F.first("payload").alias("payload")).drop("key")
    stored.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/payloads")


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """Records as their stored header bytes say."""
    h = spark.read.parquet(f"{path}/headers")
    text = F.decode("warc_header", "UTF-8")

    def field(name: str) -> Column:
        return F.regexp_extract(text, rf"\r\n{name}: ([^\r\n]*)\r\n", 1)

    return h.select(
        F.nullif(field("X-Page-ID"), F.lit("")).cast("long").alias("page_id"),
        field("WARC-Type").alias("record_type"),
        F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("payload_digest"),
        F.nullif(field("X-Refers-To-Page-ID"), F.lit("")).cast("long").alias("refers_to"),
        field("WARC-Target-URI").alias("url"),
        "sha256",
        "warc_header",
        "http_header",
    )


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Stored payloads, each verified against its address; a mismatch fails the job."""
    p = spark.read.parquet(f"{path}/payloads")
    ok = F.sha2("payload", 256) == F.col("sha256")
    return p.select("sha256", F.when(ok, F.col("payload")).otherwise(F.raise_error(F.lit("payload does not match its digest")).cast("binary")).alias("payload"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every original record: header fields, payload bytes, and ``record``, the exact WARC record."""
    h, p = read_headers(spark, path), read_payloads(spark, path)
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit("").cast("binary"))
    record = F.concat("warc_header", "http_header", body, F.lit(CRLF * 2).cast("binary"))
    return h.join(p, "sha256", "left").withColumn("record", record)


def archive_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per record: size and digest measured on the stored payload, kind and reference from its header.

    The payload is measured once where it is stored, and only the measures travel through the join.
    """
    facts = read_payloads(spark, path).select("sha256", F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("measured"))
    h = read_headers(spark, path).select("page_id", "record_type", "payload_digest", "refers_to", "sha256")
    same = F.col("measured") == F.col("payload_digest")
    return h.join(facts.hint("merge"), "sha256", "left").select(
        "page_id",
        "payload_bytes",
        F.when(same, F.col("measured")).otherwise(F.raise_error(F.lit("record digest does not match its payload"))).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def warc_roundtrip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Archive ``pages`` in the shared folder and read the archive back."""
    path = Scratch(spark, "warc").path("archive")
    write_archive(pages, path)
    return archive_digests(spark, path)
