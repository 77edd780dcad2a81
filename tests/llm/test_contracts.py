"""Columns that plain Python gives from the contracts' text, over the whole documents of the smallest tables."""

import hashlib
import math
import re
import zlib

import pytest

from postloom.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] for r in rows}


def rows_of(spark, name):
    return {r["doc_id"]: r for r in QUERIES[name](spark, SF_DIR).collect()}


def winning_shard(key, n):
    """The shard of the smallest exponential draw; all weights are one."""
    def draw(shard):
        digest = hashlib.md5(f"{key}:{shard // 4}".encode()).hexdigest()
        return -math.log((int(digest[shard % 4 * 8:shard % 4 * 8 + 8], 16) + 0.5) / 2 ** 32)

    return min(range(n), key=lambda shard: (draw(shard), shard))


def test_op1(spark, texts):
    rows = rows_of(spark, "op1_sharding")
    assert rows.keys() == texts.keys()
    for key, text in texts.items():
        data = (text or "").encode()
        row = rows[key]
        assert (row["size"], row["text_crc32"], row["law"]) == (len(data) + 8, zlib.crc32(data), "key")
        assert (row["shard"], row["grown_shard"]) == (winning_shard(key, 24), winning_shard(key, 25))
    for shard in range(24):
        slots = sorted(r["slot"] for r in rows.values() if r["shard"] == shard)
        assert slots == list(range(len(slots)))


PHRASES = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def test_op2(spark, texts):
    rows, found_any = rows_of(spark, "op2_licences"), False
    assert rows.keys() == texts.keys()
    for key, text in texts.items():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))
        places = [(i, label) for p, label in PHRASES.items() for i in range(len(words) - len(p) + 1) if tuple(words[i:i + len(p)]) == p]
        row = rows[key]
        assert (row["n_words"], row["n_base"]) == (len(words), len(places))
        starts = [start for start, _ in places]
        assert (row["first_word"], row["last_word"]) == ((min(starts), max(starts)) if places else (None, None))
        assert row["base_labels"] == ",".join(sorted({label for _, label in places}))
        labels = row["labels"].split(",") if row["labels"] else []
        assert labels == sorted(set(labels)) and {label for _, label in places} <= set(labels) and 0 <= row["score"] <= 1
        found_any = found_any or bool(places)
    assert found_any


ASSIGN = re.compile(r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
                    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def test_op4(spark, texts):
    rows, found_any = rows_of(spark, "op4_secrets"), False
    assert rows.keys() == texts.keys()
    for key, text in texts.items():
        text = text or ""
        kinds = {
            "assign": [m.span() for m in ASSIGN.finditer(text) if len(m.group(1)) >= 12],
            "access": [m.span() for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 18],
            "hex": [m.span() for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 16],
        }
        spans = sorted((start, order, f"{kind}:{start}:{end}") for order, (kind, found) in enumerate(kinds.items()) for start, end in found)
        row = rows[key]
        assert (row["n_assign"], row["n_access"], row["n_hex"]) == tuple(len(found) for found in kinds.values())
        assert row["base_sha256"] == hashlib.sha256(",".join(s[2] for s in spans).encode()).hexdigest()
        assert {s[2] for s in spans} <= set(row["spans"].split(",") if row["spans"] else [])
        found_any = found_any or bool(spans)
    assert found_any


def test_op9(spark, texts):
    rows = rows_of(spark, "op9_language_id")
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang").collect()}
    learned = {lang for key, lang in langs.items() if lang is not None and zlib.crc32(str(key).encode()) % 4 != 2}
    assert rows.keys() == texts.keys()
    for key, text in texts.items():
        row = rows[key]
        assert row["held_out"] == (zlib.crc32(str(key).encode()) % 4 == 2) and 0 <= row["score"] <= 1
        assert row["lang_pred"] in (learned if any(c.isalpha() for c in text or "") else {"und"})
