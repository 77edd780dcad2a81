import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from postloom.llm import importance as im

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def ngrams(text, order=3):
    words = words_of(text)
    return [" ".join(words[i:i + k]) for k in range(1, order + 1) for i in range(len(words) - k + 1)]


PIECES = st.sampled_from(["Word", "a", "A", "é", "日本語", "x" * 70, "y" * 200, " ", "  ", ".", "\n", "\x00", "9", "-"])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=25).map("".join), max_size=8), st.integers(1, 60))
def test_batches_hash_as_single_texts(texts, block):
    """Whatever the blocks are, every document gets its own n-grams and no others."""
    counts = [np.zeros(97, np.int64) for _ in texts]
    sizes = np.zeros(len(texts), np.int64)
    for word_docs, docs, places in im.hashed_ngrams([t.encode() for t in texts], im.KnownWords(5), buckets=97, block=block):
        sizes += np.bincount(word_docs, minlength=len(texts))
        for d, p in zip(docs.tolist(), places.tolist()):
            counts[d][p] += 1
    for d, text in enumerate(texts):
        assert sizes[d] == len(words_of(text))
        assert counts[d].tolist() == np.bincount([zlib.crc32(g.encode()) % 97 for g in ngrams(text)], minlength=97).tolist()


def brute(docs, target, percent=5, least=20):
    s, t = np.zeros(10_000), np.zeros(10_000)
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for g in ngrams(text):
                counts[zlib.crc32(g.encode()) % 10_000] += 1
    gains = [math.floor(1000 * math.log((b + 1) * (s.sum() + 10_000) / ((a + 1) * (t.sum() + 10_000)))) for a, b in zip(s, t)]
    rows = []
    for key, text in docs:
        grams = ngrams(text)
        weight = sum(gains[zlib.crc32(g.encode()) % 10_000] for g in grams)
        score = None
        if key is not None:
            h = int(hashlib.sha256(f"42:{key}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((key, len(words_of(text)), len(grams), weight, score))
    able = sorted((r for r in rows if r[1] >= least and r[4] is not None), key=lambda r: (-r[4], r[0]))
    drawn = {id(r): i for i, r in enumerate(able[:len(able) * percent // 100], 1)}
    return sorted(((*r, drawn.get(id(r))) for r in rows), key=str)


def found(spark, docs, target, **options):
    d = spark.createDataFrame([(k, t, 1, 2) for k, t in docs], "doc_id long, text string, rank int, n_words int").repartition(3)
    b = spark.createDataFrame([(t, 1) for t in target], "text string, key int")
    return sorted((tuple(r) for r in im.resample(d, b, **options).collect()), key=str)


@pytest.mark.parametrize("percent", [5, 40, 100])
def test_equals_brute_force(spark, percent):
    rng = random.Random(1)
    plain, asked = [f"w{i}" for i in range(80)], [f"q{i}" for i in range(20)]
    docs = [(i * 3, " ".join(rng.choices(plain + asked * rng.randint(0, 2), k=rng.randint(0, 60)))) for i in range(300)]
    docs += [(2000, None), (2001, ""), (2002, "Long text " * 50_000), (None, "no key " * 20), (2003, "x" * 100_000 + " É ")]
    target = [" ".join(rng.choices(asked + plain[:10], k=25)) for _ in range(30)] + [None, ""]
    assert found(spark, docs, target, percent=percent) == brute(docs, target, percent)


def test_repeats_and_empty_tables(spark):
    docs = [(1, "same " * 30)] * 4 + [(2, "same " * 30)]
    rows = found(spark, docs, ["same same"], percent=50)
    assert sorted(r[5] for r in rows if r[5]) == [1, 2] and len(rows) == 5
    assert found(spark, [], ["a"]) == []
    assert found(spark, docs, []) == brute(docs, [])
