import random

import numpy as np
import pytest

from postloom.llm import decontamination as dc

ITEM = "Anna has 12 apples and gives Bert 5 of them. How many apples does Anna still have after 3 days and 20 km of walking?"
OTHER = "Carl has 40 apples and gives Dora 7 of them. How many apples does Carl still have after 9 days and 55 miles of walking?"
MIXED_UP = "There Carl has 40 apples and gives Dora 7 of them. How many apples does Emil still have after 9 days and 55 km of walking?"


def found(spark, docs, items, **options):
    d = spark.createDataFrame([(k, t, 0) for k, t in docs], "doc_id long, text string, item_id int").repartition(2)
    b = spark.createDataFrame([(k, t, "") for k, t in items], "item_id long, text string, key string")
    return {(r["doc_id"], r["item_id"]): r for r in dc.contaminated(d, b, **options).collect()}


def test_verbatim_and_re_parameterised(spark):
    rng = random.Random(1)
    noise = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))
    docs = [
        (1, f"{noise(80)}. {ITEM} {noise(50)}"), (2, f"{noise(30)}. {OTHER}"), (3, noise(300)), (4, ITEM.upper()), (5, ITEM.lower()),
        (6, f"{noise(20)}.\n" + ITEM.replace(" ", "\n")), (7, " ".join(ITEM.split()[:8])), (8, ITEM + " " + OTHER), (9, None), (10, ""), (None, ITEM),
    ]
    rows = found(spark, docs, [(100, ITEM), (200, "an item about something else that nobody has copied so far"), (300, None), (None, ITEM)])
    assert set(rows) == {(d, 100) for d in (1, 2, 4, 5, 6, 8)}
    assert {d: r["kind"] for (d, _), r in rows.items()} == {1: "exact", 2: "re-parameterised", 4: "exact", 5: "exact", 6: "exact", 8: "exact"}
    assert all(r["cover"] >= 0.8 and r["n_consistent"] == r["n_slots"] for r in rows.values())


def test_inconsistent_fillers_are_another_question(spark):
    item = "There " + ITEM
    assert found(spark, [(1, MIXED_UP)], [(1, item)], least_consistent=1.0) == {}
    assert set(found(spark, [(1, "There " + OTHER)], [(1, item)], least_consistent=1.0)) == {(1, 1)}


def test_clean_texts_and_repeats(spark):
    rng = random.Random(3)
    words = ["the", "of", "and", "in", "to", "is", "that", "it"]
    docs = [(i, " ".join(rng.choices(words, k=400))) for i in range(40)] + [(50, ITEM), (50, ITEM), (60, "word " * 60_000 + ITEM)]
    items = [(i, " ".join(rng.choices(words, k=30))) for i in range(20)] + [(99, ITEM), (99, OTHER.lower()), (98, "short one")]
    assert set(found(spark, docs, items)) == {(50, 99), (60, 99)}
    assert found(spark, [], items) == {} and found(spark, docs, []) == {}


WORDS = ["".join(random.Random(0).choices("abcdefgh", k=4)) + str(i).translate(str.maketrans("0123456789", "ijklmnopqr")) for i in range(500)]


def edit(rng, words, times):
    words = list(words)
    for _ in range(times):
        kind, at = rng.choice(["change", "insert", "delete"]), rng.randrange(len(words))
        if kind == "change":
            words[at] = rng.choice(WORDS)
        elif kind == "insert":
            words.insert(at, rng.choice(WORDS))
        elif len(words) > 1:
            del words[at]
    return words


def common(a, b):
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = row
        row = [0]
        for j, y in enumerate(b):
            row.append(before[j] + 1 if x == y else max(before[j + 1], row[j]))
    return row[-1]


@pytest.mark.parametrize("seed", [1, 2])
def test_edited_copies_against_alignment(spark, seed):
    """One edit in any item of eight words or more is found always, more edits mostly; whatever is found aligns."""
    rng = random.Random(seed)
    items = [(i, rng.choices(WORDS, k=rng.randint(8, 40))) for i in range(60)]
    docs, planted = [], {}
    for d in range(300):
        i, item = rng.choice(items)
        times = rng.randint(0, 4)
        copy = edit(rng, item, times)
        docs.append((d, " ".join(rng.choices(WORDS, k=50) + copy + rng.choices(WORDS, k=50))))
        planted[d, i] = times
    rows = found(spark, docs, [(i, " ".join(w)) for i, w in items])
    by_id = dict(items)
    for (d, i), row in rows.items():
        whole = common(by_id[i], dict(docs)[d].split())
        assert row["n_aligned"] <= whole and (row["cover"] >= 0.8 or row["longest_run"] >= 13)
    share = lambda t: np.mean([p in rows for p, times in planted.items() if times == t])
    assert share(0) == 1 and share(1) == 1
    wide = [p for p, times in planted.items() if times in (2, 3) and len(by_id[p[1]]) >= 20]
    assert np.mean([p in rows for p in wide]) >= 0.9
    assert {r["kind"] for p, r in rows.items() if planted.get(p) == 0} == {"exact"}
    assert {r["kind"] for p, r in rows.items() if planted.get(p) == 1} <= {"edited", "exact"}


def test_every_single_changed_word(spark):
    rng = random.Random(5)
    items = [(length, rng.sample(WORDS[:250], length)) for length in range(8, 26)]
    docs, planted = [], set()
    for length, item in items:
        for at in range(length):
            copy = list(item)
            copy[at] = rng.choice(WORDS[250:])
            docs.append((len(docs), " ".join(rng.choices(WORDS[250:], k=30) + copy + rng.choices(WORDS[250:], k=30))))
            planted.add((docs[-1][0], length))
    assert set(found(spark, docs, [(i, " ".join(w)) for i, w in items])) == planted


def test_verbatim_runs_and_short_items(spark):
    rng = random.Random(4)
    item = rng.sample(WORDS, 60)
    around = lambda words: " ".join(rng.choices(WORDS[250:], k=20) + words + rng.choices(WORDS[250:], k=20))
    runs = [(size, around(item[10:10 + size])) for size in (5, 9, 11, 13, 18)]
    assert set(found(spark, runs, [(1, " ".join(item))])) == {(13, 1), (18, 1)}
    texts = [(1, "He asked: What is 2+2? Nobody knew."), (2, "He asked: What is 7+7? Nobody knew."), (3, "He asked: What is 7+9? Nobody knew."), (4, "so what 2 2"), (5, "deep blue sea, and more")]
    assert set(found(spark, texts, [(1, "What is 2+2?"), (2, "blue sea"), (3, "Sea blue")])) == {(1, 1), (2, 1), (5, 2)}


def test_tables_of_numbers_are_clean(spark):
    table = " ".join(str(n) for n in range(4000))
    items = [(1, "1 2 3 4 5 6"), (2, "There are 12 34 56 78 90 numbers in this row of ours"), (3, "9 9 9 9 9 9 9 9")]
    rows = found(spark, [(1, table), (2, "x " + "7 " * 5000), (3, "look: 1 2 3 4 5 6 end")], items)
    assert set(rows) == {(1, 1), (3, 1)}  # literally there


def test_canonical_tokens():
    known = dc.TypedTokens()
    template, caseless, literal, slot = dc.canonical("He ran 5 km. Then Bob ran 7.5 miles, Bob", known)
    assert slot.tolist() == [False, False, True, True, False, True, False, True, True, True]
    assert template[2] == template[7] and template[3] == template[8] and template[5] == template[9] and literal[5] == literal[9] != template[5]
    assert caseless[5] == literal[5] and caseless[2] == template[2]
    assert len(dc.windows(template)) == 6 and len(dc.windows(template[:3])) == 1 and len(dc.windows(template[:0])) == 0
    text = "Some words go on. " * 40
    whole = dc.canonical(text, known)
    try:
        dc.BLOCK_CHARS, old = 50, dc.BLOCK_CHARS
        assert all(np.array_equal(a, b) for a, b in zip(whole, dc.canonical(text, known)))
    finally:
        dc.BLOCK_CHARS = old
