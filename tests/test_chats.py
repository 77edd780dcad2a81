import json
import os

import pytest
from pyspark.sql import functions as F

from postloom.hooks import complete_udf
from postloom.operators import chat
from postloom.operators.matching import category_rank, match_prompt, match_results
from postloom.operators.sections import CV_SECTION_LABELS, split_summary_sections
from postloom.plans.matching import eligible_postings, prompts_for_cvs
from postloom.plans.summaries import keyed_requests, long_requests, summary_run
from postloom.session import fresh_path

LONG = "word " * 51


def response(content="sum", prompt=3000, completion=100):
    return json.dumps({"choices": [{"message": {"content": content}}], "usage": {"prompt_tokens": prompt, "completion_tokens": completion}})


def test_requests(spark):
    df = spark.createDataFrame([(1, "abc")], "id long, text string")
    job = chat.build_requests(df, "job").first()
    assert [m["role"] for m in job["messages"]] == ["user", "user"]
    assert job["messages"][1]["content"] == "Job Opening: ----abc----"
    assert all(label + ":" in job["messages"][0]["content"] for label in chat.JOB_LABELS)
    assert (job["model"], job["temperature"], job["max_tokens"]) == ("gpt-3.5-turbo", 0, 400)
    cv = chat.build_requests(df, "cv", instructions="Do it").first()
    assert [m["content"] for m in cv["messages"]] == ["Do it", "CV: ####abc####"]
    assert (cv["model"], cv["max_tokens"]) == ("gpt-3.5-turbo-16k", 4000)
    body = json.loads(chat.request_json(chat.build_requests(df, "job_single")).first()["request"])
    assert body["max_tokens"] == 350 and body["messages"][1]["role"] == "user"


@pytest.mark.parametrize("text", ["{", "", None, '{"choices": []}', '{"choices": [{"message": {"content": "x"}}]}', "[1]"])
def test_unusable_responses(spark, text):
    row = chat.parse_responses(spark.createDataFrame([(1, text)], "id long, response string")).first()
    assert (row["summary"], row["prompt_tokens"], row["completion_tokens"], row["cost"]) == (None, None, None, None)


def test_parsed_response(spark):
    row = chat.parse_responses(spark.createDataFrame([(1, response())], "id long, response string")).first()
    assert (row["summary"], row["prompt_tokens"], row["cost"]) == ("sum", 3000, round(3000 / 1000 * 0.0015, 3) + round(100 / 1000 * 0.002, 3))


def test_fallback_and_attempts(spark):
    texts = spark.createDataFrame([(1, LONG), (2, "short"), (3, LONG), (4, LONG), (5, None)], "id long, text string")
    answers = spark.createDataFrame(
        [(1, 1, "{"), (1, 2, response("second")), (1, 3, response("third")), (2, 1, response("unused")), (4, 6, response("late"))],
        "id long, attempt int, response string")
    rows = {r["id"]: r for r in chat.summarise_with_fallback(texts, answers, attempt_col="attempt").collect()}
    assert (rows[1]["summary"], rows[1]["status"]) == ("second", "ok") and rows[1]["cost"] > 0
    assert (rows[2]["summary"], rows[2]["status"], rows[2]["cost"]) == ("short", "short", 0.0)
    assert (rows[3]["summary"], rows[3]["status"]) == (LONG, "failed")
    assert rows[4]["status"] == "failed" and rows[5]["status"] == "short"


def flaky_service():
    seen = {}

    def call(request):
        text = json.loads(request)["messages"][1]["content"]
        seen[text] = seen.get(text, 0) + 1
        if "broken" in text or seen[text] < 3:
            raise ConnectionError("busy")
        return {"choices": [{"message": {"content": "Title: ok"}}], "usage": {"prompt_tokens": 1000, "completion_tokens": 500}}

    return call


def test_summary_run_retries_and_falls_back(spark):
    texts = spark.createDataFrame([(1, LONG), (2, "tiny"), (3, LONG + "broken")], "id long, text string")
    run = summary_run(texts, flaky_service, fresh_path(spark, "answers"), backoff=0.0, pause=0.0)
    rows = {r["id"]: r for r in run.summaries.collect()}
    assert {i: r["status"] for i, r in rows.items()} == {1: "ok", 2: "short", 3: "failed"}
    assert rows[3]["summary"] == LONG + "broken"
    assert run.total_cost == round(1000 / 1000 * 0.0015, 3) + round(500 / 1000 * 0.002, 3)


def test_attempts_are_bounded(spark):
    requests = spark.createDataFrame([(1, '{"messages": [{}, {"content": "broken"}]}')], "id long, request string")
    call = complete_udf(flaky_service, attempts=4, backoff=0.0, pause=0.0)
    assert requests.select(call(F.col("request")).alias("a")).first()["a"]["attempts"] == 4


def test_answers_are_paid_once(spark, tmp_path):
    asked, failing = spark.sparkContext.accumulator(0), str(tmp_path / "failing")
    texts = spark.createDataFrame([(i, f"{LONG} {i % 30}") for i in range(60)], "id long, text string")

    def service():
        def call(request):
            if os.path.exists(failing) and "17" in json.loads(request)["messages"][1]["content"]:
                os._exit(1)  # the worker dies, not just the call
            asked.add(1)
            return {"choices": [{"message": {"content": "Title: ok"}}], "usage": {"prompt_tokens": 1000, "completion_tokens": 500}}

        return call

    answers = fresh_path(spark, "answers")
    open(failing, "w").close()
    with pytest.raises(Exception):
        summary_run(texts, service, answers, pause=0.0, wave_requests=6)
    stored = spark.read.parquet(answers).count()
    os.remove(failing)
    run = summary_run(texts, service, answers, pause=0.0, wave_requests=6)
    assert {r["status"] for r in run.summaries.collect()} == {"ok"} and run.summaries.count() == 60
    assert spark.read.parquet(answers).count() == 30 and run.total_cost == pytest.approx(0.003 * (30 - stored), abs=1e-9)
    before = asked.value
    again = summary_run(texts, service, answers, pause=0.0)
    assert asked.value == before and again.total_cost == 0 and again.summaries.count() == 60


def test_match_results_order(spark):
    answers = spark.createDataFrame([
        ('[{"id": 2, "suitability": "Not Suitable", "explanation": "e"}, {"id": 1, "suitability": "Highly Suitable", "explanation": "f"}]',),
        ('[{"id": 3, "suitability": "Highly Suitable", "explanation": "g"}, {"id": 99, "suitability": "Not Suitable", "explanation": "h"}]',),
        ("not json",), ('[{"id": 4, "suitability": "Odd", "explanation": "i"}]',)], "answer string")
    postings = spark.createDataFrame([(i, f"t{i}") for i in (1, 2, 3, 4)], "id long, title string")
    assert [(r["id"], r["category_rank"]) for r in match_results(answers, postings).collect()] == [(1, 1), (3, 1), (2, 5), (4, 6)]
    assert spark.range(1).select(category_rank(F.lit("Potentially Suitable"))).first()[0] == 3


def test_match_prompt_layout(spark):
    nearest = spark.createDataFrame([(7, 2, 1, 0.5), (7, 1, 3, 0.9)], "query_id long, rank int, id long, score double")
    postings = spark.createDataFrame([(1, "one"), (3, "three")], "id long, text string")
    cvs = spark.createDataFrame([(7, "me")], "query_id long, text string")
    prompt = match_prompt(nearest, postings, cvs, "Judge.").first()["prompt"]
    assert prompt == "Judge.\n\n####me####\n\nAvailable job openings:\n\n<3> ---three---\n<1> ---one---"


def test_prompts_from_the_embedding_table(spark):
    table = spark.createDataFrame([(1, "alpha beta", [1.0, 0.0]), (2, "gamma", [0.0, 1.0])], "id long, job_info string, embedding array<float>")
    cvs = spark.createDataFrame([(5, "cv")], "query_id long, text string")
    prompts = prompts_for_cvs(table, cvs, k=1, encoder=lambda: lambda texts: [[0.1, 0.9] for _ in texts])
    assert prompts.first()["prompt"].endswith("<2> ---gamma---")


def test_eligible_postings(spark):
    df = spark.createDataFrame([(1, "Berlin", "2024-01-20 00:00:00"), (2, "Berlin", "2023-01-20 00:00:00"), (3, "Rome", "2024-01-20 00:00:00")],
                               "id long, location string, t string").withColumn("timestamp", F.to_timestamp("t"))
    values = spark.createDataFrame([("Berlin",)], "value string")
    assert [r["id"] for r in eligible_postings(df, "2024-01-30", values).collect()] == [1]


def test_sections(spark):
    text = ("Title: Analyst\nLocation: \nJob Objective: Line one\nline two: more\n\n"
            "Qualifications/Requirements/Experience: A\n- B\nPreferred Skills/Experience:\n\nX\n  About the company: Y ")
    df = spark.createDataFrame([(1, text), (2, "no labels"), (3, None)], "id long, summary string")
    rows = [(r["id"], r["pos"], r["section"], r["value"]) for r in split_summary_sections(df).orderBy("id", "pos").collect()]
    assert rows == [
        (1, 0, "Title", "Analyst"), (1, 1, "Location", ""), (1, 2, "Job Objective", "Line one\nline two: more"),
        (1, 3, "Qualifications/Requirements/Experience", "A\n- B"), (1, 4, "Preferred Skills/Experience", "X"), (1, 5, "About the company", "Y")]
    cv = spark.createDataFrame([(1, "Skills: a\nOther Achivements: b")], "id long, summary string")
    assert [r["value"] for r in split_summary_sections(cv, CV_SECTION_LABELS).collect()] == ["a", "b"]


def test_long_requests_have_the_keys_of_their_texts(spark, plan):
    texts = spark.createDataFrame([(i, "word " * n) for i, n in enumerate((0, 50, 51, 51, 90))] + [(9, None)], "id long, text string")
    keyed = keyed_requests(texts, "job", None, "m")
    asked = long_requests(keyed)
    assert sorted(asked.collect()) == sorted(keyed.filter("_long").select("key", "request").collect())
    assert asked.count() == 3 and asked.select("key").distinct().count() == 2
    # The gate is asked by the filter alone (its scan repeats it), not by the key again.
    assert "CASE WHEN" not in plan(asked.select("key").distinct())
