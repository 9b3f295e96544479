import random

from pyspark.sql import functions as F

from leadloom import Params
from leadloom.constants import STATE_DEFAULTS
from leadloom.operators.state import (
    done_state, due_queries, failure_totals, known_ids, latest_checked, merge_cache, merge_failures, missing_defaults, queue_entries, readable_state,
    refresh_choice, token_state, with_queues,
)
from leadloom.schemas import CACHE_DDL
from leadloom.sources.tables import read_state_json, write_state_json

P = Params(as_of="2026-08-17T12:00:00+00:00")
FAILURES = "key STRING, error STRING, seen_at STRING, seq BIGINT"


def test_failures_over_two_runs(spark):
    rng = random.Random(2)
    runs = [[(f"k{rng.randrange(12)}", "e" * rng.choice([3, 250]) + str(i), f"t{i:03d}", i) for i in range(a, b)] for a, b in ((0, 15), (15, 40))]
    state, retry, dead = {}, [], []
    for run in runs:
        for key, error, seen, _ in run:
            count = state.get(key, (0,))[0] + 1
            state[key] = (count, error[:200], seen)
            target = dead if count >= 3 else retry
            if key not in target:
                target.append(key)
    frames = [spark.createDataFrame(r, FAILURES) for r in runs]
    merged = merge_failures(with_queues(failure_totals(frames[0])), failure_totals(frames[1]))
    found = {r.key: r for r in merged.collect()}
    assert {k: (r["count"], r.last_error, r.last_seen) for k, r in found.items()} == state
    assert {k for k, r in found.items() if r.in_retry} == set(retry) and {k for k, r in found.items() if r.in_dead} == set(dead)
    both = frames[0].union(frames[1])
    assert [r.key for r in queue_entries(both, "dead_letter").orderBy("entered").collect()] == dead
    assert [r.key for r in queue_entries(both, "retry", keep=4).orderBy("entered").collect()] == retry[-4:]


def test_queries_due(spark):
    queries = spark.createDataFrame([("new",), ("edge",), ("recent",), ("odd",)], "query STRING")
    done = spark.createDataFrame([("edge", "2026-08-10T12:00:00+00:00"), ("recent", "2026-08-10T12:00:00.000001+00:00"), ("odd", "?")], "query STRING, done_at STRING")
    assert sorted(r["query"] for r in due_queries(queries, done, P).collect()) == ["edge", "new", "odd"]


def test_tokens(spark):
    stored = spark.createDataFrame([("a", "t1"), ("b", "t2"), ("c", "t3")], "query STRING, token STRING")
    done = spark.createDataFrame([("d", "old"), ("b", "old"), ("e", "old")], "query STRING, done_at STRING")
    answers = spark.createDataFrame([("a", None), ("b", "t9"), ("d", "t8"), ("f", "")], "query STRING, token STRING")
    assert {r["query"]: r.token for r in token_state(stored, answers).collect()} == {"b": "t9", "c": "t3", "d": "t8"}
    assert {r["query"]: r.done_at for r in done_state(done, answers, P).collect()} == {"a": P.as_of, "e": "old", "f": P.as_of}


def test_refresh(spark):
    found = spark.createDataFrame([("n2", 0), ("n1", 1)], "channel_id STRING, found_ord BIGINT")
    known = spark.createDataFrame([(f"k{i:03d}",) for i in range(80)] + [("n1",)], "channel_id STRING")
    checked = spark.createDataFrame([(f"k{i:03d}", f"2026-01-{31 - i:02d}") for i in range(30)], "channel_id STRING, checked_at STRING")
    rows = refresh_choice(found, known, checked, P).orderBy("place").collect()
    assert [r.channel_id for r in rows] == ["n2", "n1"] + [f"k{i:03d}" for i in range(30, 78)] and [r.found_now for r in rows[:3]] == [True, True, False]
    many = spark.createDataFrame([(f"m{i}", i) for i in range(130)], "channel_id STRING, found_ord BIGINT")
    assert refresh_choice(many, known, checked, P).count() == 100


def test_json_state(spark, tmp_path):
    state = spark.createDataFrame([("failed_jobs", '{"é":1}', 0), ("x", "{bad", 1), ("", "1", 2), ("y", "[1]", 3), ("y", "[2]", 4), ("z", "", 5), ("t1", "1 2", 6), ("t2", '{"a":1} x', 7),
                                   ("t3", "1] , [2", 8), ("t4", '1, "x": 2', 9), ("t5", '1} , {"a":2', 10), ("t6", "1, 2", 11)], "key STRING, value STRING, row_no BIGINT")
    write_state_json(missing_defaults(spark, readable_state(state)), str(tmp_path / "s"))
    back = readable_state(read_state_json(spark, str(tmp_path / "s")))
    got = {r.key: r.value for r in back.collect()}
    assert got == {**STATE_DEFAULTS, "failed_jobs": '{"é":1}', "y": "[2]"}


def test_times_ids_and_cache(spark):
    a = spark.createDataFrame([("c1", "2026-01-01"), ("c2", "2026-01-02")], "channel_id STRING, checked_at STRING")
    b = spark.createDataFrame([("c1", "2026-02-01")], "channel_id STRING, checked_at STRING")
    assert {r.channel_id: r.checked_at for r in latest_checked(a, b, "channel_id").collect()} == {"c1": "2026-02-01", "c2": "2026-01-02"}
    ids = known_ids(a, b.union(spark.createDataFrame([("c0", "")], b.schema)), "channel_id", 2)
    assert sorted(r.channel_id for r in ids.collect()) == ["c1", "c2"]
    stored = spark.createDataFrame([("a", "u", "F", "q", 1.0, "2027")], CACHE_DDL)
    answers = spark.createDataFrame([("a", "", "SEARCH_ERROR", "q2", 0.0, P.as_of)], CACHE_DDL)
    assert merge_cache(stored, answers, P).first().status == "SEARCH_ERROR"
    assert merge_cache(stored, answers, Params(as_of=P.as_of, cache_search_errors=False)).first().status == "F"
