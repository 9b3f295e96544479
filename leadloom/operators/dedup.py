"""Ordered dedup on several keys.

A row is dropped when it shares a key with an earlier row *that was itself kept*; keys of dropped
rows block nothing. That is the first maximal independent set in arrival order, and it is found in
rounds: a row that is the earliest holder of all its keys is kept, every row sharing a key with it
is dropped, and the rest goes on. Each round decides at least the earliest row left, so the rounds
end without a cap.

Only ``(order, keys)`` takes part, with a number for each key. Per key there is a minimum, which combines before the shuffle,
and a join against at most one row per key. The rows themselves are written once, so what made them is not run again. Numbers are
hashes, and it is checked that no two keys share one; another seed is taken else.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegralType, StringType

from leadloom.functions.ids import candidate_keys
from leadloom.operators.checkpoints import let_go, written
from leadloom.operators.counters import Counters

#: open rows that one task finishes
TAIL = 100_000
#: taken keys of a round that every task may hold
BROADCAST = 1 << 20


def _number(key: Column, seed: int) -> Column:
    return F.xxhash64(key, F.lit(seed))


def _numbers(seed: int = 0) -> Column:
    """A number in place of each key in ``_keys``."""
    return F.transform("_keys", lambda key: _number(key, seed))


def _clash(listed: DataFrame, seed: int) -> bool:
    """Whether two keys have one number."""
    pairs = listed.select(F.explode("_keys").alias("key")).select("key", _number(F.col("key"), seed).alias("number")).distinct()
    return not pairs.groupBy("number").count().where("count > 1").isEmpty()


def _first_holders(edges: DataFrame) -> DataFrame:
    """Keys whose earliest holder is the earliest holder of all of its keys."""
    per_key = edges.groupBy("key").agg(
        F.min("ord").alias("ord"), F.min_by("keys_held", "ord").alias("keys_held"))
    won = F.count(F.lit(1)).over(Window.partitionBy("ord"))
    return per_key.withColumn("won", won).filter("won = keys_held").select("key", "ord")


def _untouched(open_rows: DataFrame, taken: DataFrame, n_taken: int, most_keys: int) -> DataFrame:
    """Rows none of whose keys is taken: one join for each place in ``keys``, rows with fewer keys ask for their first again.

    A small set of taken keys is broadcast, a large one hashed in parts; a hot key's partition can be split.
    """
    free, keys = open_rows, taken.select(F.col("key").alias("taken"))
    keys = F.broadcast(keys) if n_taken <= BROADCAST else keys.hint("shuffle_hash")
    for i in range(most_keys):
        free = free.withColumn("asked", F.coalesce(F.get("keys", F.lit(i)), F.get("keys", F.lit(0))))
        free = free.join(keys, F.col("asked") == F.col("taken"), "left_anti").drop("asked")
    return free


def _finished(open_rows: DataFrame) -> DataFrame:
    """The kept ones of at most ``TAIL`` open rows, decided one after another in a task."""
    def run(batches):
        rows, taken, kept = [], set(), []
        for batch in batches:
            rows.extend(zip(batch.column("ord").to_pylist(), batch.column("keys").to_pylist()))
        for order, keys in sorted(rows):
            if taken.isdisjoint(keys):
                taken.update(keys)
                kept.append(order)
        yield pa.RecordBatch.from_arrays([pa.array(kept, kind)], names=["ord"])

    kind = to_arrow_schema(open_rows.select("ord").schema).field(0).type
    return open_rows.select("ord", "keys").repartition(1).mapInArrow(run, open_rows.select("ord").schema)


def kept_orders(rows: DataFrame) -> DataFrame:
    """Orders kept among stored ``rows(ord, keys)``; ``ord`` is unique, ``keys`` are distinct.

    After the first round a tail of at most ``TAIL`` open rows is finished at once, so long chains of conflicts among few
    rows do not cost a round for each of their links.
    """
    kept = rows.filter(F.size("keys") == 0).select("ord")
    open_rows = rows.filter(F.size("keys") > 0)
    plain = isinstance(rows.schema["ord"].dataType, (IntegralType, StringType))  # sorted alike in Python
    left, most_keys = open_rows.agg(F.count(F.lit(1)), F.max(F.size("keys"))).first()
    rounds = 0
    while left:
        if plain and rounds and left <= TAIL:
            return kept.unionAll(written(_finished(open_rows)))
        edges = open_rows.select(
            "ord", F.size("keys").alias("keys_held"), F.explode("keys").alias("key"))
        taken = written(_first_holders(edges))
        kept = kept.unionAll(taken.select("ord").distinct())
        decided, open_rows = open_rows, written(_untouched(open_rows, taken, taken.count(), most_keys))
        if rounds:
            let_go(decided)
        left, rounds = open_rows.count(), rounds + 1
    return kept


def dedup_by_keys(df: DataFrame, order: str, keys: Column, counters: Counters | None = None) -> DataFrame:
    """Rows of ``df`` that survive the ordered dedup; ``order`` names a unique sortable column.

    A repeated order is an error: two rows with one order would be taken for one row with the keys of both. Null is no key,
    and a row without order or list of keys is not kept. ``counters`` are taken of the rows of ``df``.
    """
    listed = df.withColumn("_keys", F.array_compact(F.array_distinct(keys))).withColumn("_numbers", _numbers())
    listed = written(listed if counters is None else counters.of(listed)).withColumn("ord", F.col(order))
    repeated = F.raise_error(F.concat(F.lit("dedup: order repeated: "), F.col("ord").cast("string")))
    listed.groupBy("ord").agg(F.count(F.lit(1)).alias("n")).agg(F.max(F.when(F.col("n") > 1, repeated))).collect()
    seed = next(s for s in count() if not _clash(listed, s))
    rows = listed.where("ord IS NOT NULL").select("ord", (_numbers(seed) if seed else F.col("_numbers")).alias("keys"))
    return listed.select(*df.columns).join(kept_orders(rows).withColumnRenamed("ord", order), order, "left_semi")


def dedup_candidates(candidates: DataFrame, *, provider: bool = True, domain: bool = True,
                     profile: bool = True, counters: Counters | None = None) -> DataFrame:
    """Ordered dedup of candidates by provider id, website domain and profile address."""
    keys = candidate_keys(provider=provider, domain=domain, profile=profile)
    return dedup_by_keys(candidates, "ord", keys, counters)


def dedup_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: found, unique, dropped."""
    found = before.agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit("found"))
    unique = after.agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit("unique"))
    both = found.unionByName(unique).groupBy().agg(
        F.sum(F.when(F.col("side") == "found", F.col("n"))).alias("candidates_found"),
        F.sum(F.when(F.col("side") == "unique", F.col("n"))).alias("unique_candidates"))
    return both.withColumn("duplicates_prevented",
                           F.col("candidates_found") - F.col("unique_candidates"))


def distinct_folded(df: DataFrame, text: str, order: str) -> DataFrame:
    """Distinct texts up to case and spacing; the first spelling wins and is trimmed."""
    folded = F.lower(F.trim(F.regexp_replace(F.col(text), r"\s+", " ")))
    first = df.groupBy(folded.alias("_folded")).agg(
        F.min_by(text, order).alias(text), F.min(order).alias(order))
    return first.select(F.trim(text).alias(text), order)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """The earliest row per key, combined before the shuffle (no window, so no hot task)."""
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_first"))
    return first.select(*keys, "_first.*")
