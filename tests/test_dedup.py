import random

import pytest

from pyspark.sql import functions as F

from leadloom.functions.ids import stable_id
from leadloom.operators import dedup
from leadloom.operators.dedup import dedup_by_keys, dedup_candidates, first_per_key
from leadloom.operators.order import circular_batch, first_per_group, with_position
from leadloom.schemas import candidates_from


def one_by_one(rows):
    """The sequential rule: drop a row that shares a key with a kept one."""
    taken, kept = set(), []
    for order, keys in sorted(rows):
        if not taken & set(keys):
            kept.append(order)
            taken |= set(keys)
    return kept


def spark_kept(spark, rows):
    df = spark.createDataFrame(rows, "ord BIGINT, keys ARRAY<STRING>")
    return sorted(r.ord for r in dedup_by_keys(df, "ord", F.col("keys")).select("ord").collect())


@pytest.mark.parametrize("tail", [0, 40, 100_000])
def test_same_as_sequential_rule(spark, monkeypatch, tail):
    monkeypatch.setattr(dedup, "TAIL", tail)  # rounds only, rounds and a tail, a tail after the first round
    rng = random.Random(11)
    for size, pool in [(60, 20), (300, 120), (300, 500), (2000, 900)]:
        rows = [(i, [f"k{rng.randrange(pool)}" for _ in range(rng.randint(0, 3))]) for i in range(size)]
        rng.shuffle(rows)
        assert spark_kept(spark, rows) == one_by_one(rows)


def test_chain_of_conflicts(spark, monkeypatch):
    rows = [(i, [f"k{i}", f"k{i + 1}"]) for i in range(10_000)]
    context = spark.sparkContext
    context.setJobGroup("chain", "a long chain")
    try:
        assert spark_kept(spark, rows) == list(range(0, 10_000, 2))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert len(context.statusTracker().getJobIdsForGroup("chain")) < 40
    monkeypatch.setattr(dedup, "TAIL", 0)
    assert spark_kept(spark, rows[:17]) == one_by_one(rows[:17]) == list(range(0, 17, 2))


def test_keys_of_unequal_weight(spark):
    rng = random.Random(5)
    rows = [(i, [f"h{rng.randrange(3)}"] * rng.randint(0, 1) + [f"k{rng.randrange(600)}", f"k{rng.randrange(600)}"]) for i in range(900)]
    assert spark_kept(spark, rows) == one_by_one(rows)


def test_repeated_order_is_refused(spark):
    with pytest.raises(Exception, match="order repeated: 1"):
        spark_kept(spark, [(0, ["a"]), (1, ["b"]), (1, ["c"])])


def test_one_hot_key_and_copies(spark):
    rows = [(i, ["hot", f"own{i}"]) for i in range(3000)] + [(3000 + i, ["copy"]) for i in range(3000)] + [(9000, [])]
    assert spark_kept(spark, rows) == [0, 3000, 9000]


def test_candidates(spark):
    rows = [("YOUTUBE", "UC123", "https://youtube.com/channel/UC123"), ("YOUTUBE", "uc123", "https://youtube.com/channel/UC123?utm_source=x"),
            ("SEED", "UC123", "https://other.org")]
    df = spark.createDataFrame(rows, "source STRING, provider_id STRING, url STRING").coalesce(1).withColumn("i", F.monotonically_increasing_id())
    candidates = candidates_from(df, ord=F.col("i"), source=F.col("source"), platform=F.lit("x"), provider_id=F.col("provider_id"), profile_url=F.col("url"))
    assert sorted(r.ord for r in dedup_candidates(candidates).collect()) == [0, 2]
    same = [r[0] for r in candidates.orderBy("ord").select(stable_id()).collect()]
    assert same[0] == same[1] != same[2]


def test_positions_and_batches(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("v")).repartition(7)
    placed = with_position(df, [F.col("v")])
    assert [(r.v, r.pos) for r in placed.orderBy("v").collect()] == [(i, i) for i in range(1000)]
    batch, following = circular_batch(placed, offset=2998, limit=4)
    assert [r.v for r in batch.orderBy("turn").collect()] == [998, 999, 0, 1] and following == 2
    small, following = circular_batch(placed.filter("pos < 3"), offset=4, limit=10)
    assert [r.v for r in small.orderBy("turn").collect()] == [1, 2, 0] and following == 1
    assert circular_batch(placed, 5, 0)[0].count() == 0 and circular_batch(placed.filter("false"), 5, 3)[1] == 5


def test_first_rows_per_group(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    assert first_per_group(df, ["g"], [F.col("v")], 2).count() == 6
    assert sorted((r.g, r.v) for r in first_per_key(df, ["g"], F.col("v")).collect()) == [(0, 0), (1, 1), (2, 2)]


def test_numbers_of_keys_that_clash(spark, monkeypatch):
    monkeypatch.setattr(dedup, "_number", lambda key, seed: F.xxhash64(key, F.lit(seed)) % (1 << 60 if seed else 7))
    rng = random.Random(12)
    rows = [(i, [f"k{rng.randrange(90)}" for _ in range(rng.randint(0, 3))]) for i in range(200)]
    assert spark_kept(spark, rows) == one_by_one(rows)


def test_rows_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def key(number):
        made.add(1)
        return f"k{number // 3}"

    rows = spark.range(300).select(F.col("id").alias("ord"), F.udf(key)("id").alias("key"))
    assert dedup_by_keys(rows, "ord", F.array("key")).count() == 100 and made.value == 300


def test_large_sets_of_taken_keys(spark, monkeypatch):
    monkeypatch.setattr(dedup, "BROADCAST", 0)
    monkeypatch.setattr(dedup, "TAIL", 0)
    rng = random.Random(13)
    rows = [(i, [f"k{rng.randrange(30)}" for _ in range(rng.randint(0, 3))] + [None] * rng.randint(0, 1)) for i in range(60)]
    assert spark_kept(spark, rows) == one_by_one([(i, [k for k in keys if k]) for i, keys in rows])
