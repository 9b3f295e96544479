"""One round of discovery: the next queries, their stored search answers, and the channels to look at again."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.operators.checkpoints import cut
from leadloom.operators.order import circular_batch
from leadloom.operators.state import done_state, due_queries, known_ids, refresh_choice, token_state
from leadloom.params import Params
from leadloom.plans.runs import Runs
from leadloom.sources.api import channel_candidates, channel_rollup, channel_videos, describe_channels, search_hits


@dataclass(frozen=True)
class Round:
    """What a round asked and found, and the state that it leaves."""

    asked: DataFrame
    hits: DataFrame
    candidates: DataFrame
    videos: DataFrame
    tokens: DataFrame
    done: DataFrame
    known: DataFrame
    offset: int


def discovery_round(spark: SparkSession, runs: Runs, queries: DataFrame, searches: DataFrame, channels: DataFrame, params: Params,
                    videos: DataFrame | None = None) -> Round:
    """The round after the newest run.

    ``queries(pos, query)`` are dense positions of all queries; a round takes ``params.searches_per_run`` of them from where
    the last one stopped, without those finished lately. ``searches(query, page_token, nextPageToken, items)`` are stored
    answers, one for each page of a query; a page that is not there is a search that failed, and the query's state stays.
    ``channels(answer_no, items)`` and ``videos(answer_no, items)`` are stored answers of the platform.
    """
    turn, offset = circular_batch(queries, runs.offset(spark), params.searches_per_run)
    held = runs.tables(spark)
    tokens, done = runs.read(spark, "query_tokens", held), runs.read(spark, "query_done", held)
    asked = cut(due_queries(turn.select("query", "turn"), done, params).join(tokens, "query", "left"))
    pages = searches.withColumnRenamed("page_token", "token")
    found = asked.join(pages, (asked["query"] == pages["query"]) & F.coalesce(asked["token"], F.lit("")).eqNullSafe(F.coalesce(pages["token"], F.lit(""))))
    answers = cut(found.select(asked["query"], F.col("turn").alias("answer_no"), "nextPageToken", "items"))
    hits = cut(search_hits(answers))
    ended = answers.select("query", F.col("nextPageToken").alias("token"))
    known = cut(known_ids(runs.read(spark, "known_channels", held), hits, "channel_id", None))
    found_ord = F.shiftleft(F.col("found_ord.answer_no"), 31) + F.col("found_ord.item_no")
    chosen = refresh_choice(channel_rollup(hits).select("channel_id", found_ord.alias("found_ord")), known, runs.read(spark, "channels_checked", held), params)
    wanted = channels.select("answer_no", F.posexplode("items").alias("n", "item")).join(
        chosen.select(F.col("channel_id").alias("_id"), "place"), F.col("item.id") == F.col("_id"))
    # refreshed channels are answers of one item, in the order they were chosen
    described = wanted.select(F.col("place").cast("bigint").alias("answer_no"), F.array("item").alias("items"))
    candidates = channel_candidates(described, hits, params)
    if videos is not None:
        candidates = describe_channels(candidates, videos, hits, params.videos_per_channel)
    return Round(asked.select("query", "token", "turn"), hits, candidates, channel_videos(hits), cut(token_state(tokens, ended)),
                 cut(done_state(done, ended, params)),
                 cut(known_ids(known, known.limit(0), "channel_id", params.known_channels_kept)), offset)
