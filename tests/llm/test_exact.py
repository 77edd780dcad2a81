import hashlib
import random

from postloom.llm import exact


def brute(rows):
    groups = {}
    for key, text in rows:
        groups.setdefault(text or "", []).append(key)
    out = []
    for text, keys in groups.items():
        keys = sorted(keys, key=lambda k: (k is not None, k or 0), reverse=True)
        out += [(k, keys[0], len(keys), i == 0, hashlib.sha256(text.encode()).hexdigest()) for i, k in enumerate(keys)]
    return sorted(out, key=order)


def order(row):
    return (row[0] is not None, row[0] or 0, row[2:])


def found(spark, rows, **options):
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, octets string, kept int").repartition(3)
    return sorted((tuple(r) for r in exact.exact_duplicates(df, **options).collect()), key=order)


def test_equals_brute_force(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choices("ab é", k=rng.randint(0, 4))) for _ in range(60)]
    long = "x" * 300
    rows = [(i, rng.choice(texts)) for i in range(400)] + [(1000 + i, long + t) for i, t in enumerate("abab")] + [(2000, "y" * 500_000), (2001, "y" * 500_000)]
    rows += [(3000 + i, "hot") for i in range(200)] + [(5000, None), (5001, ""), (None, "ab"), (None, "ab"), (7, "again"), (7, "again")]
    assert found(spark, rows, all_digests=True) == brute(rows)
    plain = found(spark, rows)
    assert [r[:4] for r in plain] == [r[:4] for r in brute(rows)]
    assert all((r[4] is None) <= (r[2] == 1) for r in plain) and sum(r[4] is None for r in plain) > 0


def test_prefixes_alone_do_not_decide(spark):
    rows = [(i, "same start " + "z" * 50 + str(i % 5)) for i in range(50)]
    assert found(spark, rows, prefix_chars=4, all_digests=True) == brute(rows)


def test_empty_and_dropped(spark):
    assert exact.exact_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    df = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "b", 3), (4, None, 4)], "doc_id long, text string, keep int")
    left = exact.drop_exact_duplicates(df)
    assert left.columns == df.columns and sorted(r["doc_id"] for r in left.collect()) == [2, 3, 4]
