import base64
import hashlib

import pytest

from postloom.llm import warc
from postloom.session import fresh_path


def b32(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


PAGES = [(3, "http://a/", "<p>é</p>"), (1, "http://b/", "<p>é</p>"), (2, None, None), (5, "http://c/", ""), (4, "http://d/\r\nx", "z" * 300_000), (None, "http://e/", "<p>é</p>"), (9, "http://f/", "<p>é</p>"), (7, "u", "once")]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, address string").repartition(3)


def test_archive_round_trip(spark):
    path = fresh_path(spark, "warc")
    warc.write_archive(pages(spark), path)
    rows = {r["key"]: r for r in warc.read_records(spark, path).collect()}
    assert len(rows) == len(PAGES)
    for key, url, html in PAGES:
        payload = (html or "").encode()
        assert (rows[key]["payload_bytes"], rows[key]["payload_digest"]) == (len(payload), b32(payload))
    assert {k: (r["record_type"], r["refers_to"]) for k, r in rows.items()} == {
        1: ("response", None), 3: ("revisit", 1), 9: ("revisit", 1), None: ("revisit", 1), 2: ("response", None), 5: ("revisit", 2), 4: ("response", None), 7: ("response", None)}
    assert rows[2]["url"] == "about:blank"
    # Every payload is stored once, and every record comes back whole.
    assert spark.read.parquet(f"{path}/payloads").count() == 4
    for r in warc.reconstruct(spark, path).collect():
        record, payload = bytes(r["record"]), bytes(r["payload"])
        assert payload == (next(h for k, _, h in PAGES if k == r["key"]) or "").encode()
        head, rest = record.split(b"\r\n\r\n", 1)
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and rest.endswith(b"\r\n\r\n") and int(fields["Content-Length"]) == len(rest) - 4
        assert fields["WARC-Payload-Digest"] == "sha1:" + b32(payload)
        if fields["WARC-Type"] == "response":
            assert rest[:-4].split(b"\r\n\r\n", 1)[1] == payload
        else:
            assert fields["WARC-Refers-To"] == next(
                l.split(": ", 1)[1] for k in warc.reconstruct(spark, path).filter("key = 1 OR key = 2").collect() if bytes(k["payload"]) == payload
                for l in bytes(k["record"]).decode().split("\r\n") if l.startswith("WARC-Record-ID"))


def test_small_payloads_and_repeats(spark):
    path = fresh_path(spark, "warc")
    warc.write_archive(pages(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc"), (3, "u", "abc")]), path, min_bytes=3)
    found = sorted((r["key"], r["record_type"]) for r in warc.read_records(spark, path).collect())
    assert found == [(1, "response"), (2, "response"), (3, "response"), (3, "response"), (4, "revisit")]


def test_damage_is_noticed(spark):
    path = fresh_path(spark, "warc")
    warc.write_archive(pages(spark), path)
    stored = spark.read.parquet(f"{path}/payloads")
    damaged = fresh_path(spark, "warc")
    stored.selectExpr("address", "cast('changed' AS binary) AS payload").write.parquet(f"{damaged}/payloads")
    spark.read.parquet(f"{path}/records").write.parquet(f"{damaged}/records")
    for read in (warc.read_records, warc.reconstruct):
        with pytest.raises(Exception, match="damaged payload"):
            read(spark, damaged).collect()


def test_empty(spark):
    path = fresh_path(spark, "warc")
    warc.write_archive(pages(spark, []), path)
    assert warc.read_records(spark, path).collect() == [] and warc.reconstruct(spark, path).collect() == []
