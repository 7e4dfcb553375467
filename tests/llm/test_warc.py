import base64
import hashlib

from candlewick.llm import warc as A
from candlewick.llm.shared import Scratch

SCHEMA = "page_id long, url string, html string, payload string, sha256 string, key string"
ROWS = [(1, "http://a/\r\nx", "<p>é</p>"), (2, "u", "same"), (5, None, "same"), (3, "u", "same"), (4, "u", None), (6, "u", ""), (7, "u", "big " * 300_000), (9, "u", "twice"), (9, "u", "twice"), (None, "u", "no id"), (None, "u", "same")]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "p", "s", "k") for r in rows], SCHEMA)


def test_records(spark):
    got = sorted((r.page_id or -1, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to or -1) for r in A.warc_roundtrip(spark, pages(spark, ROWS)).collect())
    want = []
    for page_id, _, html in ROWS:
        raw = (html or "").encode()
        keeper = max((p for p, _, h in ROWS if (h or "") == (html or "") and p is not None), default=None)
        own = page_id == keeper
        want.append((page_id or -1, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if own else "revisit", -1 if own else keeper))
    assert got == sorted(want)


def test_exact_bytes_come_back(spark):
    path = Scratch(spark, "w").path("a")
    A.write_archive(pages(spark, ROWS), path)
    assert spark.read.parquet(f"{path}/payloads").count() == len({h or "" for _, _, h in ROWS})
    out = A.read_archive(spark, path).collect()
    assert len(out) == len(ROWS)
    assert sorted(bytes(r.payload) for r in out) == sorted((h or "").encode() for _, _, h in ROWS)
    for r in out:
        record = bytes(r.record)
        head, _, rest = record.partition(b"\r\n\r\n")
        fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
        assert record.startswith(b"WARC/1.1\r\n") and rest.endswith(b"\r\n\r\n") and int(fields[b"Content-Length"]) == len(rest) - 4
        assert fields[b"WARC-Payload-Digest"] == b"sha1:" + base64.b32encode(hashlib.sha1(bytes(r.payload)).digest())
        assert (b"WARC-Refers-To" in fields) == (r.refers_to is not None)
        if r.record_type == "response":
            assert rest[:-4].endswith(bytes(r.payload))


def test_damage_is_found(spark):
    import pytest
    from pyspark.sql import functions as F

    path = Scratch(spark, "w").path("a")
    A.write_archive(pages(spark, ROWS[:2]), path)
    bad = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.lit("other").cast("binary"))
    spark.createDataFrame(bad.collect(), bad.schema).write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="does not match"):
        A.read_archive(spark, path).collect()


def test_smaller_payloads_are_all_responses(spark):
    kinds = {r.page_id: r.record_type for r in A.build_records(pages(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "long one"), (4, "u", "long one")]), min_revisit_bytes=5).collect()}
    assert kinds == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_empty(spark):
    assert A.warc_roundtrip(spark, pages(spark, [])).count() == 0
