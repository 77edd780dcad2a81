import hashlib
import random

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from postloom.llm import fingerprints as fp

DIGESTS = st.sets(st.integers(0, 2**64 - 1), max_size=60)


def print_of(digests):
    d = np.sort(np.array(sorted(digests), dtype=np.uint64))
    return fp.Fingerprint(d, fp.Sketch.of(d, fp.BASE_CELLS))


@settings(max_examples=200, deadline=None)
@given(DIGESTS, DIGESTS, DIGESTS)
def test_peeling_recovers_the_difference(common, left, right):
    a, b = print_of(common | left), print_of(common | right)
    only_a, only_b, _ = fp.difference(a, b)
    x, y = common | left, common | right
    assert set(only_a.tolist()) == x - y and set(only_b.tolist()) == y - x
    assert fp.likeness(a, b) == (len(x & y) / len(x | y) if x | y else 1.0)


def test_retries_grow():
    rng = random.Random(2)
    sets = [{rng.getrandbits(64) for _ in range(n)} for n in (3, 300)]
    assert fp.difference(print_of(sets[0]), print_of(set()))[2] == fp.BASE_CELLS
    assert fp.difference(print_of(sets[1]), print_of(set()))[2] > fp.BASE_CELLS


def test_cells_follow_the_difference():
    rng = random.Random(3)
    common = {rng.getrandbits(64) for _ in range(5000)}
    assert fp.difference(print_of(common | {1, 2, 3}), print_of(common))[2] <= 4 * fp.BASE_CELLS
    assert fp.difference(print_of(common | set(range(100))), print_of(common))[2] <= 64 * fp.BASE_CELLS


def test_blocks_hold_bounded_text(spark):
    """Long texts lie together: blocks are cut by octets, not by rows."""
    rows = spark.createDataFrame([(i, "x" * (100_000 if i < 60 else 10)) for i in range(3000)], "doc_id long, text string")
    bounds = fp.block_bounds(rows.select(F.col("doc_id").alias("key"), "text"), block_octets=400_000)
    sizes = np.zeros(len(bounds) + 1)
    for i in range(3000):
        sizes[np.searchsorted(bounds, i, side="right")] += 100_000 if i < 60 else 10
    total, blocks = 60 * 100_000 + 2940 * 10, 4 * spark.sparkContext.defaultParallelism
    assert sizes.sum() == total and sizes.max() <= 3 * total / blocks + 100_000


def test_sketches_survive_text():
    sketch = fp.Fingerprint.of("one. two.\nthree").base
    again = fp.Sketch.parse(sketch.text())
    assert again.text() == sketch.text() and not again.minus(sketch).counts.any() and len(again.minus(fp.Fingerprint.of("").base).peel()[0]) == 3


def test_paragraphs():
    text = "First. Second! third\nfourth " + "x" * 400
    assert len(fp.paragraph_digests(text)) == 6
    assert len(fp.paragraph_digests("same.same.same.")) == 3  # each repetition is one of its own
    assert len(fp.paragraph_digests("")) == 0


def expected(rows):
    """Brute force over rows in the order of keys."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or ""))
    result = []
    for i, (key, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        changed = text[:len(text) - half] + following[:half]
        sets = [set(fp.paragraph_digests(t).tolist()) for t in (text, changed, following)]
        alike = [len(sets[0] & s) / len(sets[0] | s) if sets[0] | s else 1.0 for s in sets[1:]]
        result.append((key, len(text), hashlib.sha256(changed.encode()).hexdigest(), *alike))
    return result


def compared(spark, rows, **options):
    df = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, block int").repartition(3)
    found = fp.compare_versions(df).collect()
    assert len({r["fingerprint"] for r in found}) <= len({t or "" for _, t in rows})
    return [(r["doc_id"], r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in found]


def order(row):
    return (row[0] is None, row[0] or 0, row[1:])


def test_versions_equal_brute_force(spark):
    rng = random.Random(5)
    lines = ["".join(rng.choices("abc é", k=rng.randint(1, 60))) for _ in range(40)]
    rows = [(k * 7 - 300, "\n".join(rng.choices(lines, k=rng.randint(0, 12)))) for k in range(150)]
    rows += [(5000, None), (5001, ""), (5002, "y" * 200_000), (1 << 40, "far away")]
    assert sorted(compared(spark, rows), key=order) == sorted(expected(rows), key=order)


def test_repeats_and_nulls(spark):
    rows = [(1, "a. b."), (2, "c. d."), (2, "e. f."), (2, "c. d."), (None, "no key"), (3, "g")]
    found = compared(spark, rows)
    assert sorted((r[0] or 0) for r in found) == [0, 1, 2, 2, 2, 3]
    assert sorted(found, key=order) == sorted(expected(rows), key=order)
    assert compared(spark, [(9, "alone. here.")]) == expected([(9, "alone. here.")])
    assert compared(spark, []) == []
    prints = fp.fingerprint(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(prints) == 6 and len({r["fingerprint"] for r in prints}) == 5
