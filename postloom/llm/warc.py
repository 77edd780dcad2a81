"""Content-addressed web archive: payload bytes once by verified digest, record headers apart.

An archive is a folder of two tables. ``payloads`` holds every different payload once under
its SHA-256, ``records`` the exact headers of every WARC/1.1 record with the address of its
payload. A record's bytes are its headers, the payload (of a response) and two line ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from postloom.llm.common import pick

CRLF = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEX32, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of a SHA-1: five hex digits at a time are four base32 digits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, start, 5), 16, 32), 4, "0") for start in range(1, 41, 5)]
    return F.translate(F.upper(F.concat(*parts)), HEX32, BASE32)


def record_id(address: Column, key: Column) -> Column:
    """A stable URN for a record, from its key and payload address."""
    d = F.md5(F.concat_ws("|", F.coalesce(key.cast("string"), F.lit("<null>")), address))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(d, s, n) for s, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def write_archive(df: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write one record per row of ``df`` to the archive at ``path``.

    Of the rows with equal payloads of at least ``min_bytes`` bytes, those with the smallest
    key are responses, the others revisit it; smaller payloads are all responses. A null
    page is an empty payload, a null URL ``about:blank``. Null keys come after all others
    and refer to no row unless a keyed one has their payload. Rows that repeat the key and
    payload of a response are responses too; the bytes are stored once in any case.

    Only digests are grouped and joined. Copies in one task are merged before the payload
    shuffle, so a payload that is a third of all pages is shuffled once per task. Equal
    SHA-256 with unequal SHA-1 or length raises an error.
    """
    pages = pick(df, key=key, url=url, html=html).withColumn("payload", F.coalesce(F.col("html"), F.lit("")).cast("binary"))
    facts = pages.select(
        "key", F.regexp_replace(F.coalesce("url", F.lit("about:blank")), r"[\r\n]", "%0A").alias("url"), F.sha2("payload", 256).alias("address"),
        F.octet_length("payload").cast("long").alias("n"), base32_sha1(F.col("payload")).alias("digest"),
    )
    groups = facts.groupBy("address").agg(F.min("key").alias("first"), F.min("digest").alias("low"), F.max("digest").alias("high"), F.min("n").alias("short"), F.max("n").alias("long"))
    clash = (F.col("low") != F.col("high")) | (F.col("short") != F.col("long"))
    groups = groups.select("address", F.when(clash, F.raise_error(F.lit("one SHA-256, two payloads")).cast(groups.schema["first"].dataType)).otherwise(F.col("first")).alias("first"))

    revisit = (F.col("n") >= min_bytes) & F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("n").cast("string"), F.lit(CRLF * 2))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), record_id(F.col("address"), F.col("key"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), F.col("url")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(F.col("refers_to").isNotNull(), F.concat(F.lit("WARC-Refers-To: "), record_id(F.col("address"), F.col("refers_to")))),
        F.when(F.col("refers_to").isNotNull(), F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), (F.octet_length("http") + F.when(F.col("record_type") == "response", F.col("n")).otherwise(0)).cast("string")),
    ]
    records = (
        facts.join(groups, "address")
        .withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(revisit, F.col("first")))
        .withColumn("http", http)
        .withColumn("header", F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF * 2)))
    )
    records.select("key", "address", "header", "http", "refers_to").write.parquet(f"{path}/records")
    stored = pages.select(F.sha2("payload", 256).alias("address"), "payload").groupBy("address").agg(F.first("payload").alias("payload"))
    stored.write.parquet(f"{path}/payloads")


def header_field(name: str) -> Column:
    return F.regexp_extract("header", rf"(?m)^{name}: ?([^\r\n]*)", 1)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """``(address, payload, n, digest)``; a payload that is not what its address says raises an error."""
    stored = spark.read.parquet(f"{path}/payloads")
    sound = F.sha2("payload", 256) == F.col("address")
    checked = F.when(sound, F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.col("address"))).cast("binary"))
    return stored.select("address", checked.alias("payload")).select(
        "address", "payload", F.octet_length("payload").cast("long").alias("n"), base32_sha1(F.col("payload")).alias("digest"))


def read_records(spark: SparkSession, path: str, payloads: DataFrame | None = None) -> DataFrame:
    """Fields of every record, read from its header and its stored payload.

    ``(key, url, payload_bytes, payload_digest, record_type, refers_to)``. Every stored
    payload is hashed once, and only its length and digest are joined to the records. A
    record whose header names another digest than its payload has raises an error.
    """
    facts = (payloads if payloads is not None else read_payloads(spark, path)).select("address", "n", "digest")
    joined = spark.read.parquet(f"{path}/records").join(facts, "address", "left")
    sound = header_field("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), F.col("digest"))
    return joined.select(
        "key", header_field("WARC-Target-URI").alias("url"), F.col("n").alias("payload_bytes"),
        F.when(sound, F.col("digest")).otherwise(F.raise_error(F.concat(F.lit("no sound payload for "), F.col("address")))).alias("payload_digest"),
        header_field("WARC-Type").alias("record_type"), "refers_to",
    )


def reconstruct(spark: SparkSession, path: str) -> DataFrame:
    """``(key, record, payload)``: the bytes of every WARC record, and its full payload."""
    joined = spark.read.parquet(f"{path}/records").join(read_payloads(spark, path).select("address", "payload"), "address")
    body = F.when(F.col("refers_to").isNull(), F.col("payload")).otherwise(F.lit(b""))
    record = F.concat(F.col("header").cast("binary"), F.col("http").cast("binary"), body, F.lit((CRLF * 2).encode()))
    return joined.select("key", record.alias("record"), "payload")
