import datetime

import pytest
from pyspark.sql import functions as F

from postloom.functions.text import word_count
from postloom.operators.filters import any_value_pattern, country_filter, id_lookup, id_lookup_in, needs_summary, recent_filter
from postloom.sources.countries import country_values, read_country_dictionary

DICTIONARY = """{"Europe": {"Countries": [
  {"country_name": "Germany", "country_code": "DE", "capital_english": "Berlin",
   "subdivisions": [{"subdivisions_code": "BY", "subdivisions_name": "Bavaria"}]},
  {"country_name": "Malta", "country_code": "MT", "capital_english": "Valletta", "subdivisions": []}]},
  "Asia": {"Countries": [{"country_name": "Japan", "country_code": "JP", "capital_english": "Tokyo", "subdivisions": []}]}}"""


@pytest.fixture(scope="module")
def dictionary(spark):
    return spark.createDataFrame([(DICTIONARY,)], "dictionary string")


@pytest.fixture(scope="module")
def places(spark):
    names = ["Berlin", "Sweden", "Remote", None, "BAVARIA, all", "C++ town"]
    return spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id int, location string")


def test_country_values(dictionary):
    values = {(r["kind"], r["value"]) for r in country_values(dictionary, "Germany").collect()}
    assert values == {("name", "Germany"), ("code", "DE"), ("capital", "Berlin"), ("subdivision_code", "BY"), ("subdivision_name", "Bavaria")}
    assert country_values(dictionary, "Malta").count() == 3
    assert country_values(dictionary, "germany").count() == 0


def test_dictionary_file(spark, tmp_path):
    (tmp_path / "d.json").write_text(DICTIONARY)
    assert country_values(read_country_dictionary(spark, str(tmp_path / "d.json")), "Japan").count() == 3


def test_codes_match_inside_words_and_locations_come_back_lowercase(dictionary, places):
    found = country_filter(places, country_values(dictionary, "Germany"))
    assert sorted((r["id"], r["location"]) for r in found.collect()) == [(0, "berlin"), (1, "sweden"), (4, "bavaria, all")]
    kept = country_filter(places, country_values(dictionary, "Germany"), lowercase=False)
    assert {r["location"] for r in kept.collect()} == {"Berlin", "Sweden", "BAVARIA, all"}


def test_unknown_country_gives_nothing(dictionary, places):
    assert country_filter(places, country_values(dictionary, "Atlantis")).count() == 0


def test_values_are_patterns_unless_literal(spark, places):
    def values(*v):
        return spark.createDataFrame([(x,) for x in v], "value string")

    assert [r["id"] for r in country_filter(places, values("b.rlin")).collect()] == [0]
    assert country_filter(places, values("b.rlin"), literal=True).count() == 0
    assert [r["id"] for r in country_filter(places, values("C++"), literal=True).collect()] == [5]


def test_long_value_lists_need_several_patterns(spark, places):
    many = [f"value{i}" for i in range(1200)] + ["remote"]
    assert len(any_value_pattern(many)) == 3
    found = country_filter(places, spark.createDataFrame([(v,) for v in many], "value string"))
    assert [r["id"] for r in found.collect()] == [2]


def test_recent_filter_is_inclusive(spark, plan):
    day = datetime.datetime(2024, 1, 16)
    stamps = [day, day - datetime.timedelta(seconds=1), day + datetime.timedelta(days=20), None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(stamps)], "id int, timestamp timestamp")
    assert [r["id"] for r in recent_filter(df, as_of="2024-01-30").collect()] == [0, 2]
    fresh = spark.range(1).select(F.current_timestamp().alias("timestamp"))
    assert recent_filter(fresh).count() == 1


def test_recent_filter_reaches_the_scan(spark, plan):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    assert "GreaterThanOrEqual(ts,2024-01-16" in plan(recent_filter(events, "2024-01-30", ts="ts"))


def test_lookups(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    keys = spark.createDataFrame([(2,), (2,)], "ids long")
    assert [r["v"] for r in id_lookup(df, 2).collect()] == ["b"]
    assert [r["v"] for r in id_lookup_in(df, keys, 2).collect()] == ["b"]
    assert id_lookup_in(df, keys, 1).count() == 0


def test_the_length_gate_splits_no_more_than_it_needs(spark, plan):
    spaces = (" ", "\n", "\x1c", "\x85", "\u00a0", "\u3000", " \t ")
    texts = [None, "", *spaces] + [lead + gap.join(["é"] * n) + end for n in (1, 2, 3, 4, 9) for gap in spaces for lead in ("", gap) for end in ("", gap)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for most in (-1, 0, 1, 2, 3, 8):
        gate = needs_summary(F.col("text"), most)
        assert df.filter(~gate.eqNullSafe(word_count("text") > most)).count() == 0
    # A count makes a list of all words of the text; a split with a limit stops after the words that decide.
    assert "regexp_extract_all" in plan(df.select(word_count("text")))
    shown = plan(df.select(needs_summary(F.col("text"), 8)))
    assert "regexp_extract_all" not in shown and ", 10)" in shown
