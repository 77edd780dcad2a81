import json
from datetime import datetime, timedelta, timezone

from postloom import hooks
from postloom.plans.retries import ask_due, dead_letters, request_schedule, scheduled_run
from postloom.plans.summaries import request_waves
from postloom.session import fresh_path

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def at(seconds):
    return lambda: START + timedelta(seconds=seconds)


def service(calls, *broken):
    """Fails requests that hold any of the words; writes a line per call."""
    def factory():
        def complete(request):
            content = json.loads(request)["messages"][1]["content"]
            with open(calls, "a") as log:
                log.write(content[13:40].replace("\n", " ") + "\n")
            if any(word in content for word in broken):
                raise ConnectionError("later")
            return {"choices": [{"message": {"content": "done"}}], "usage": {"prompt_tokens": 1000, "completion_tokens": 0}}
        return complete
    return factory


def texts(spark):
    long = {1: "alpha ", 2: "beta ", 3: "beta ", 4: "gamma "}
    rows = [(i, word * 60) for i, word in long.items()] + [(5, "short"), (6, None)]
    return spark.createDataFrame(rows, "id long, text string").repartition(3)


def statuses(run):
    return {r["id"]: (r["status"], r["attempts"]) for r in run.summaries.collect()}


def test_failed_requests_come_back_when_due_and_stop(spark, tmp_path):
    calls, path = tmp_path / "calls", fresh_path(spark, "attempts")
    calls.touch()

    def asked():
        n = len(calls.read_text().splitlines())
        calls.write_text("")
        return n

    def run(seconds, *broken):
        done = scheduled_run(texts(spark), service(str(calls), *broken), path, max_attempts=3, pause=0.0, clock=at(seconds))
        return statuses(done), asked(), done.total_cost

    rest = {5: ("short", 0), 6: ("short", 0)}
    got, n, cost = run(0, "beta", "gamma")
    assert got == {1: ("ok", 1), 2: ("waiting", 1), 3: ("waiting", 1), 4: ("waiting", 1), **rest}
    assert (n, cost) == (3, 0.002)  # equal texts once; one answer was paid
    assert run(4.999, "beta", "gamma") == (got, 0, 0.0)  # nothing is due
    got, n, _ = run(5, "beta", "gamma")
    assert n == 2 and got[2] == ("waiting", 2)
    due = {r["state"]: r["due"] for r in request_schedule(spark, path, 3).selectExpr("state", "unix_seconds(due) AS due").collect()}
    assert due == {"answered": None, "waiting": int(START.timestamp()) + 5 + 25}
    got, n, _ = run(30, "gamma")
    assert n == 2 and got == {1: ("ok", 1), 2: ("ok", 3), 3: ("ok", 3), 4: ("failed", 3), **rest}
    assert run(10 ** 9) == (got, 0, 0.0)  # a dead letter is not asked again
    assert [r["attempts"] for r in dead_letters(spark, path, 3).collect()] == [3]
    assert run(10 ** 9)[0][4] == ("failed", 3) and dead_letters(spark, path, 4).count() == 0


def test_a_lost_wave_is_asked_again(spark, tmp_path, monkeypatch):
    path = fresh_path(spark, "attempts")
    requests = spark.createDataFrame([(f"k{i % 20}", json.dumps({"messages": [{}, {"content": f"{i % 20}"}]})) for i in range(40)], "key string, request string")
    call = hooks.complete_udf(service(str(tmp_path / "calls"), "7"), 1, pause=0.0)
    clocks = iter([START, START, START])

    def dies():
        try:
            return next(clocks)
        except StopIteration:
            raise RuntimeError("lost") from None

    try:
        ask_due(requests, call, path, "gpt-3.5-turbo", dies, wave_requests=5)  # the clock fails in the third wave
    except RuntimeError:
        pass
    stored = request_schedule(spark, path).count()
    assert 0 < stored < 20
    ask_due(requests, call, path, "gpt-3.5-turbo", at(1), wave_requests=5)
    rows = {r["key"]: (r["attempts"], r["state"]) for r in request_schedule(spark, path).collect()}
    assert rows == {f"k{i}": (1, "waiting" if "7" in str(i) else "answered") for i in range(20)}


def test_nothing_to_ask(spark, tmp_path):
    path = fresh_path(spark, "attempts")
    assert request_schedule(spark, path).count() == 0 and dead_letters(spark, path).count() == 0
    done = scheduled_run(texts(spark).filter("id >= 5"), service(str(tmp_path / "calls")), path, pause=0.0)
    assert statuses(done) == {5: ("short", 0), 6: ("short", 0)} and done.total_cost == 0.0
    assert scheduled_run(texts(spark).limit(0), service(str(tmp_path / "calls")), path, pause=0.0).summaries.count() == 0


def test_waves_hold_each_due_key_once_and_no_other(spark):
    requests = spark.createDataFrame([(None if i % 50 == 49 else f"k{i % 50}", f"r{i % 50}") for i in range(200)], "key string, request string").repartition(3)
    due = spark.createDataFrame([(f"k{i}", i) for i in range(0, 40, 2)] + [(None, 99)], "key string, before int")
    parts = [[tuple(r) for r in part.select("key", "request", "before").collect()] for part in request_waves(requests, due, 7)]
    assert 1 < len(parts) <= 3 and sorted((r for p in parts for r in p), key=str) == sorted([(f"k{i}", f"r{i}", i) for i in range(0, 40, 2)] + [(None, "r49", 99)], key=str)
    assert list(request_waves(requests, due.limit(0), 7)) == []
