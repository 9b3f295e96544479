"""Incremental state as tables: failures, caches, last-checked times, rotation, defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadloom.constants import STATE_DEFAULTS
from leadloom.functions.dates import within_days
from leadloom.functions.text import is_json
from leadloom.operators.order import first_per_group, last_rows
from leadloom.params import Params
from leadloom.schemas import STATE_DDL

DEAD_AFTER = 3
FAILURE_DDL = "key STRING, count BIGINT, last_error STRING, last_seen STRING, in_retry BOOLEAN, in_dead BOOLEAN"


def failure_totals(failures: DataFrame) -> DataFrame:
    """Per key of ``failures(key, error, seen_at, seq)``: count, last error (200 chars), last time.

    ``seq`` orders the failures; all parts combine before the shuffle, so a hot key stays small.
    """
    return failures.groupBy("key").agg(
        F.count(F.lit(1)).alias("count"),
        F.substring(F.max_by("error", "seq"), 1, 200).alias("last_error"),
        F.max_by("seen_at", "seq").alias("last_seen"))


def with_queues(totals: DataFrame) -> DataFrame:
    """Mark retry and dead-letter membership of fresh totals; a dead key stays in retry as well."""
    return totals.withColumns({"in_retry": F.lit(True), "in_dead": F.col("count") >= DEAD_AFTER})


def merge_failures(stored: DataFrame, totals: DataFrame) -> DataFrame:
    """Add new totals to stored counts; counts are never reset."""
    old = stored.select("key", F.struct(*stored.columns).alias("old"))
    new = totals.select("key", F.struct("count", "last_error", "last_seen").alias("new"))
    both = old.join(new, "key", "full_outer")
    before = F.coalesce("old.count", F.lit(0))
    count = before + F.coalesce("new.count", F.lit(0))
    seen_now = F.col("new").isNotNull()
    return both.select(
        "key", count.cast("bigint").alias("count"),
        F.when(seen_now, F.col("new.last_error")).otherwise(F.col("old.last_error")).alias("last_error"),
        F.when(seen_now, F.col("new.last_seen")).otherwise(F.col("old.last_seen")).alias("last_seen"),
        (F.coalesce("old.in_retry", F.lit(False)) | (seen_now & (before < DEAD_AFTER - 1))).alias("in_retry"),
        (F.coalesce("old.in_dead", F.lit(False)) | (seen_now & (count >= DEAD_AFTER))).alias("in_dead"))


def queue_entries(failures: DataFrame, queue: str, keep: int | None = None) -> DataFrame:
    """Keys of a queue by entry: the first failure for ``retry``, the third for ``dead_letter``."""
    nth = 1 if queue == "retry" else DEAD_AFTER
    early = first_per_group(failures.select("key", "seq"), ["key"], [F.col("seq")], nth)
    entered = early.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("seq").alias("entered"))
    return last_rows(entered.filter(F.col("n") == nth).select("key", "entered"), keep, "entered")


def latest_checked(stored: DataFrame, now_checked: DataFrame, key: str) -> DataFrame:
    """Last-checked time per key (site, email or channel) after a run."""
    return stored.unionByName(now_checked).groupBy(key).agg(F.max("checked_at").alias("checked_at"))


def merge_cache(stored: DataFrame, answers: DataFrame, params: Params) -> DataFrame:
    """Lookup cache after a run: new answers replace old ones of the same address."""
    fresh = answers if params.cache_search_errors else answers.filter("status != 'SEARCH_ERROR'")
    both = stored.withColumn("_new", F.lit(0)).unionByName(fresh.withColumn("_new", F.lit(1)))
    rest = [c for c in stored.columns if c != "email"]
    return both.groupBy("email").agg(F.max_by(F.struct(*rest), F.struct("_new", "checked_at")).alias("r")).select("email", "r.*")


def due_queries(queries: DataFrame, done: DataFrame, params: Params) -> DataFrame:
    """Queries not finished within the last days (a time exactly that old is due again)."""
    recent = done.filter(within_days(F.col("done_at"), params.query_ttl_days, params, inclusive=False))
    return queries.join(recent.select("query"), "query", "left_anti")


def token_state(stored: DataFrame, answers: DataFrame) -> DataFrame:
    """Page token per query: the token of the latest answer, dropped when the results ended."""
    both = stored.select("query", "token", F.lit(0).alias("run")).unionByName(
        answers.select("query", "token", F.lit(1).alias("run")))
    latest = both.groupBy("query").agg(F.max_by(F.struct("token"), "run").alias("r")).select("query", "r.token")
    return latest.filter(F.coalesce("token", F.lit("")) != "")


def done_state(stored: DataFrame, answers: DataFrame, params: Params) -> DataFrame:
    """Finishing time per query: set when the results ended, removed while pages remain."""
    ended = F.coalesce("token", F.lit("")) == ""
    now = answers.select("query", F.when(ended, F.lit(params.as_of)).alias("done_at"), F.lit(1).alias("run"))
    both = stored.select("query", "done_at", F.lit(0).alias("run")).unionByName(now)
    latest = both.groupBy("query").agg(F.max_by(F.struct("done_at"), "run").alias("r")).select("query", "r.done_at")
    return latest.filter("done_at IS NOT NULL")


def known_ids(stored: DataFrame, seen: DataFrame, column: str, keep: int | None) -> DataFrame:
    """Union of known and seen ids; a limit keeps the last ones in sort order."""
    return last_rows(stored.select(column).union(seen.select(column)).distinct(), keep, column)


def first_seen(stored: DataFrame, seen: DataFrame, column: str, version: int, keep: int | None) -> DataFrame:
    """A set in order of first sight, as ``column, place``: stored values stay where they are, new ones follow in ``ord``.

    A limit keeps the last ones; a value that fell out and is seen again is new.
    """
    place = F.array(F.lit(version), F.col("ord")).cast("array<bigint>").alias("place")
    both = stored.select(column, "place").unionByName(seen.select(column, place))
    return last_rows(both.groupBy(column).agg(F.min("place").alias("place")), keep, "place")


def refresh_choice(found: DataFrame, known: DataFrame, checked: DataFrame, params: Params) -> DataFrame:
    """Channels to refresh: all found now, filled up to a floor with the longest unchecked.

    ``found(channel_id, found_ord)``, ``known(channel_id)``, ``checked(channel_id, checked_at)``.
    """
    n_found = found.agg(F.count(F.lit(1))).scalar()
    older = (known.join(found, "channel_id", "left_anti").join(checked, "channel_id", "left")
             .select("channel_id", F.coalesce("checked_at", F.lit("")).alias("checked_at")))
    stalest = (older.orderBy("checked_at", "channel_id").limit(params.channels_refresh_floor)
               .select("channel_id", F.lit(1).alias("kind"), "checked_at", F.lit(0).cast("bigint").alias("found_ord")))
    fresh = found.select("channel_id", F.lit(0).alias("kind"), F.lit("").alias("checked_at"), "found_ord")
    # both parts are cut to the limit first, so what follows handles that many rows at most
    top_found = fresh.orderBy("found_ord").limit(params.channels_refreshed)
    ranked = top_found.unionByName(stalest).withColumn("n_found", n_found)
    size = F.least(F.greatest(F.col("n_found"), F.lit(params.channels_refresh_floor)), F.lit(params.channels_refreshed))
    place = F.row_number().over(
        Window.partitionBy("n_found").orderBy("kind", "found_ord", "checked_at", "channel_id"))
    return (ranked.withColumn("place", place).filter(F.col("place") <= size)
            .select("channel_id", "place", (F.col("kind") == 0).alias("found_now")))


def missing_defaults(spark: SparkSession, state: DataFrame) -> DataFrame:
    """State rows completed by the default of every missing key; existing values are not touched."""
    defaults = spark.createDataFrame(list(STATE_DEFAULTS.items()), STATE_DDL)
    return state.select("key", "value").unionByName(defaults.join(state.select("key"), "key", "left_anti"))


def readable_state(rows: DataFrame) -> DataFrame:
    """Rows with a key and valid JSON text; the last one of a repeated key (by ``row_no``) counts."""
    valid = rows.filter((F.coalesce("key", F.lit("")) != "") & is_json(F.col("value")))
    return valid.groupBy("key").agg(F.max_by("value", "row_no").alias("value"))


def sorted_state(state: DataFrame) -> DataFrame:
    return state.orderBy("key")
