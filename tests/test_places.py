import random

import pytest

from postloom.operators import places as module
from postloom.operators.filters import country_filter
from postloom.operators.places import tag_countries
from postloom.sources.countries import country_values
from tests.test_filters import DICTIONARY

VALUES = "country_name string, value string"


def test_all_values_of_the_dictionary(spark):
    dictionary = spark.createDataFrame([(DICTIONARY,)], "dictionary string")
    names = {r["country_name"] for r in country_values(dictionary).collect()}
    assert names == {"Germany", "Malta", "Japan"} and country_values(dictionary).count() == 5 + 3 + 3


def test_tags_equal_the_filter_of_each_country(spark):
    rng = random.Random(3)
    letters = "abAİß. (+"
    values = [(f"C{i % 7}", "".join(rng.choice(letters) for _ in range(rng.randint(1, 3)))) for i in range(40)] + [("C1", "ab"), ("C2", "ab")]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 9))) for _ in range(150)] * 2 + [None, ""]
    rows = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(texts)], "id int, location string, value string").repartition(3)
    table = spark.createDataFrame(values, VALUES)
    tagged = tag_countries(rows, table)
    assert tagged.columns == ["id", "location", "value", "countries"]
    found = {r["id"]: r["countries"] for r in tagged.collect()}
    assert len(found) == len(texts) and all(names == sorted(set(names)) for names in found.values())
    for country in {c for c, _ in values}:
        kept = country_filter(rows, table.filter(table.country_name == country), literal=True)
        assert {r["id"] for r in kept.collect()} == {i for i, names in found.items() if country in names}, country


def test_nulls_empty_values_and_no_values(spark, monkeypatch):
    rows = spark.createDataFrame([(1, "Berlin"), (2, None), (3, "")], "id int, location string")

    def tags(*values):
        return {r["id"]: r["countries"] for r in tag_countries(rows, spark.createDataFrame(values, VALUES)).collect()}

    assert tags(("Germany", "BERLIN"), ("Nowhere", None), (None, "berlin")) == {1: ["Germany"], 2: [], 3: []}
    assert tags(("Anywhere", ""), ("Germany", "berlin")) == {1: ["Anywhere", "Germany"], 2: [], 3: ["Anywhere"]}
    assert tags() == {1: [], 2: [], 3: []}
    assert tag_countries(rows.limit(0), spark.createDataFrame([("Germany", "x")], VALUES)).count() == 0
    monkeypatch.setattr(module, "MAX_VALUES", 1)
    with pytest.raises(ValueError, match="more than 1 values"):
        tags(("A", "a"), ("B", "b"))


def test_locations_are_neither_joined_nor_shuffled(spark, plan):
    rows = spark.createDataFrame([(1, "Berlin")], "id int, location string")
    text = plan(tag_countries(rows, spark.createDataFrame([("Germany", "berlin")], VALUES)))
    assert "Join" not in text and "Exchange" not in text and "ArrowEvalPython" in text
