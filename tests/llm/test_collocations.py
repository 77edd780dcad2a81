import random
import re
from collections import Counter

from postloom.llm import collocations as co


def brute(rows, order, least, inside, top):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", folded):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            counts.update((lang, *words[i:i + k]) for k in range(1, order + 1) for i in range(len(words) - k + 1))
    candidates = {p: a for p, a in counts.items() if len(p) > 2 and a >= least}
    out = []
    for phrase, a in candidates.items():
        lang, *words = phrase
        cuts = [(1_000_000 * a * a // (counts[lang, *words[:k]] * counts[lang, *words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        holders = [b for other, b in candidates.items() if other[0] == lang and len(other) > len(phrase)
                   and any(list(other[1 + i:1 + i + len(words)]) == words for i in range(len(other) - len(words)))]
        if not any(100 * b >= inside * a for b in holders):
            out.append((lang, " ".join(words), a, counts[lang, *words[:k]], counts[lang, *words[k:]], totals[lang], score))
    ranked = []
    for lang in {r[0] for r in out}:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        ranked += [(lang, i, *r[1:]) for i, r in enumerate(own, 1)]
    return sorted(ranked)


def found(spark, rows, **options):
    df = spark.createDataFrame([(t, lang, "x", 1) for t, lang in rows], "text string, lang string, w1 string, c int").repartition(3)
    return sorted(tuple(r) for r in co.collocations(df, **options).collect())


def corpus(seed, n=150):
    rng = random.Random(seed)
    words = ["New", "york", "new", "city", "a", "É", "the", "of", "state", "x-y", "\x00", "y z"]
    gaps = [" ", "  ", "\t", ". ", ",", "\n", "\r\n", "!? "]
    rows = [("".join(rng.choice(words) + rng.choices(gaps, [30, 2, 2, 2, 1, 1, 1, 1])[0] for _ in range(rng.randint(0, 60))), rng.choice(["en", "de", None])) for _ in range(n)]
    return rows + [(None, "en"), ("", "en"), (" . , ", "de"), ("New York City " * 3000, "en"), ("only once", "fr")] + [("same row again", "en")] * 20


def test_equals_brute_force(spark):
    for seed, options in ((1, {}), (2, {"least": 3, "top": 15}), (3, {"order": 4, "least": 5, "inside_percent": 30}), (4, {"order": 2, "least": 2})):
        rows = corpus(seed)
        full = {"order": 3, "least": 10, "inside_percent": 50, "top": 2000, **options}
        expected = brute(rows, full["order"], full["least"], full["inside_percent"], full["top"])
        assert expected and found(spark, rows, **options) == expected


def test_products_beyond_64_bits(spark):
    """Scores are exact where a * a * 1000000 passes 64 bits."""
    from pyspark.sql import functions as F

    a, l, r = 5_000_000_011, 7_000_000_003, 9_000_000_001
    row = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
    wide = {c: F.col(c).cast("decimal(19,0)") for c in "alr"}
    score = F.call_function("div", (wide["a"] * wide["a"]) * F.lit(1_000_000).cast("decimal(7,0)"), wide["l"] * wide["r"])
    assert row.select(score.alias("s")).first()["s"] == 1_000_000 * a * a // (l * r)


def test_empty(spark):
    assert found(spark, []) == [] and found(spark, [(None, None), ("", "en"), ("one", "en")]) == []
