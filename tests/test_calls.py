"""Calls of a model: the ways they fail, limits over all tasks, answers that are kept."""

import json
import time

import pytest
from pyspark.sql import functions as F

from graphloom.operators import extraction

GOOD = json.dumps({"entities": [{"name": "Lambda", "type": "Service", "properties": {}}], "relationships": []})


def scenario(kinds):
    """A model that fails in the given ways, one a call, and then answers."""
    left = list(kinds)

    def ask(prompt):
        kind = left.pop(0) if left else GOOD
        if isinstance(kind, Exception):
            raise kind
        return kind

    return ask


def throttled(n):
    return [extraction.RetryableError("slow down")] * n


@pytest.mark.parametrize(
    ("kinds", "attempts", "status", "names"),
    [
        (throttled(9), 3, "failed", []), ([extraction.FatalError("access denied")], 1, "failed", []), ([extraction.FatalError("not valid")], 1, "failed", []), (throttled(1), 2, "ok", ["Lambda"]),
        ([], 1, "ok", ["Lambda"]), (throttled(2), 3, "ok", ["Lambda"]), (["I think so"], 2, "ok", ["Lambda"]), (["no"] * 3, 3, "ok", []), ([OSError("cut off")], 1, "failed", []),
    ],
)
def test_the_ways_a_call_goes(spark, kinds, attempts, status, names):
    chunk = spark.createDataFrame([(1, 0, "We use Lambda.", "s")], "doc_id long, chunk_seq int, content string, section string")
    waits = spark.sparkContext.accumulator(0)
    got = extraction.extract_chunks(chunk, scenario(kinds), [("Service", "one")], [], "JSON", wait=lambda s: waits.add(1)).collect()
    assert [(r.attempts, r.status, [e.name for e in r.extraction.entities], r.section) for r in got] == [(attempts, status, names, "s")]
    retried = [k for k in kinds[:attempts] if isinstance(k, extraction.RetryableError)]
    assert waits.value == len(retried) - (status == "failed" and len(retried) == attempts)


def test_pace_halves_and_rises():
    now, slept = [0.0], []

    def wait(s):
        slept.append(s)
        now[0] += s

    pace = extraction.Pace(10, wait, lambda: now[0])
    for _ in range(20):
        pace.turn()
    assert abs(now[0] - 1.9) < 1e-9
    pace.tell(True)
    assert pace.now == 5
    for _ in range(20):
        pace.tell(False)
    assert pace.now == 10
    for _ in range(99):
        pace.tell(True)
    assert 0 < pace.now < 1


def test_all_tasks_stay_below_the_rate(spark):
    df = spark.range(60).select("id", F.col("id").cast("string").alias("prompt"))
    got = extraction.complete_prompts(df, lambda p: "{%f}" % time.time(), parallel=4, in_flight=3, rate=40).collect()
    at = sorted(float(r.response.strip("{}")) for r in got)
    assert len(at) == 60 and all(sum(a <= b < a + 0.5 for b in at) <= 20 + 4 for a in at)  # and each task's first
    with pytest.raises(ValueError):
        extraction.complete_prompts(df, str, rate=40)


def test_equal_prompts_are_asked_once_and_failures_again(spark, tmp_path):
    asked, answers = spark.sparkContext.accumulator(0), str(tmp_path / "answers")
    big = (1 << 53) + 1

    def model(broken):
        def ask(prompt):
            asked.add(1)
            if broken and prompt == "b":
                raise extraction.FatalError("denied")
            return "{" + prompt

        return ask

    df = spark.createDataFrame([(big, "a"), (None, "a"), (2, "b"), (3, "c"), (4, None), (5, "a")], "doc_id long, prompt string").repartition(3)
    first = {(r.doc_id, r.response, r.status) for r in extraction.answer_prompts(df, model(True), answers, parallel=2).collect()}
    assert first == {(big, "{a", "ok"), (None, "{a", "ok"), (2, None, "failed"), (3, "{c", "ok"), (4, "{", "ok"), (5, "{a", "ok")} and asked.value == 4
    again = extraction.answer_prompts(df, model(False), answers).collect()
    assert asked.value == 5 and {r.doc_id: r.response for r in again}[2] == "{b" and len(again) == 6
    assert extraction.answer_prompts(df.where("false"), model(False), answers).count() == 0 and asked.value == 5
