"""Video platform answers in storage: search hits, channels, videos. JSON with a fixed schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.constants import COUNTRY_LANGUAGE, UNKNOWN
from leadloom.functions.text import blank, filled, safe_int
from leadloom.functions.urls import links_in_text, official_website
from leadloom.operators.order import arrival, file_position, first_per_group
from leadloom.params import Params
from leadloom.schemas import candidates_from

SEARCH_SCHEMA = """
    query STRING, nextPageToken STRING,
    items ARRAY<STRUCT<id: STRUCT<videoId: STRING>,
                       snippet: STRUCT<channelId: STRING, publishedAt: STRING>>>
"""
CHANNEL_SCHEMA = """
    items ARRAY<STRUCT<id: STRING,
        snippet: STRUCT<title: STRING, description: STRING, customUrl: STRING, country: STRING,
                        defaultLanguage: STRING, defaultAudioLanguage: STRING>,
        statistics: STRUCT<subscriberCount: STRING>,
        brandingSettings: STRUCT<channel: STRUCT<description: STRING, country: STRING>>>>
"""
VIDEO_SCHEMA = """
    items ARRAY<STRUCT<id: STRING, snippet: STRUCT<channelId: STRING, description: STRING>>>
"""


def read_answers(spark: SparkSession, path: str, schema: str, *, multi_line: bool = False) -> DataFrame:
    """JSON answers, one per line (or one per file), with ``answer_no``, the position in the files."""
    return file_position(spark.read.schema(schema).option("multiLine", multi_line).json(path), "answer_no")


def _items(answers: DataFrame, *keep: str) -> DataFrame:
    return answers.select("answer_no", *keep, F.posexplode("items").alias("item_no", "item")).withColumn(
        "hit_ord", F.struct("answer_no", "item_no"))


def search_hits(answers: DataFrame) -> DataFrame:
    """``(channel_id, published_at, video_id, query, hit_ord)``; items without a channel are dropped."""
    hits = _items(answers, "query").select(
        F.col("item.snippet.channelId").alias("channel_id"),
        blank(F.col("item.snippet.publishedAt")).alias("published_at"),
        F.nullif(F.col("item.id.videoId"), F.lit("")).alias("video_id"), "query", "hit_ord")
    return hits.filter(blank(F.col("channel_id")) != "")


def next_tokens(answers: DataFrame) -> DataFrame:
    return answers.select("query", F.col("nextPageToken").alias("token"))


def channel_rollup(hits: DataFrame) -> DataFrame:
    """Per channel: newest time, query of the last hit, first hit, number of videos.

    Every part combines before the shuffle, so a channel with very many hits costs no more.
    The video ids themselves stay rows: see :func:`channel_videos`.
    """
    return hits.groupBy("channel_id").agg(
        F.coalesce(F.max(F.nullif("published_at", F.lit(""))), F.lit("")).alias("published_at"),
        F.max_by("query", "hit_ord").alias("query"),
        F.min("hit_ord").alias("found_ord"),
        F.count("video_id").alias("n_videos"))


def channel_videos(hits: DataFrame) -> DataFrame:
    return hits.filter("video_id IS NOT NULL").select("channel_id", "video_id", "hit_ord")


def first_videos(hits: DataFrame, k: int) -> DataFrame:
    """``(channel_id, video_ids)``: the first ``k`` video ids of every channel, in order."""
    early = first_per_group(channel_videos(hits), ["channel_id"], [F.col("hit_ord")], k)
    return early.groupBy("channel_id").agg(
        F.array_sort(F.collect_list(F.struct("hit_ord", "video_id"))).alias("v")).select(
        "channel_id", F.transform("v", lambda x: x["video_id"]).alias("video_ids"))


def channel_language(snippet_language: Column, audio_language: Column, country: Column) -> Column:
    by_country = F.create_map(*[F.lit(x) for pair in COUNTRY_LANGUAGE.items() for x in pair])
    return filled(snippet_language, audio_language, F.try_element_at(by_country, country))


def channel_candidates(answers: DataFrame, hits: DataFrame, params: Params, provider_rank: int = 0) -> DataFrame:
    """Channels as candidates, with the newest hit time and the last query as their niche."""
    listed = _items(answers).select(
        "hit_ord", blank(F.col("item.id")).alias("channel_id"),
        F.col("item.snippet").alias("s"), F.col("item.statistics.subscriberCount").alias("subscribers"),
        F.col("item.brandingSettings.channel").alias("b"))
    rollup = channel_rollup(hits).select("channel_id", "published_at", "query")
    found = (listed.join(rollup, "channel_id", "left")
             .join(first_videos(hits, params.videos_per_channel), "channel_id", "left"))
    described = found.withColumns({
        "text": filled(F.col("s.description"), F.col("b.description"), default=""),
        "land": filled(F.col("s.country"), F.col("b.country")),
    }).withColumn("links", links_in_text(F.col("text")))
    # 31 bits hold any item of an answer, 28 are left for the answers
    answer = F.when(F.col("hit_ord.answer_no") < 1 << 28, F.col("hit_ord.answer_no")).otherwise(F.raise_error(F.lit("too many answers")).cast("bigint"))
    described = described.withColumn("found_pos", F.shiftleft(answer, 31) + F.col("hit_ord.item_no"))
    published = blank(F.col("published_at"))
    return candidates_from(
        described, ord=arrival(provider_rank, F.col("found_pos")), source=F.lit("YOUTUBE"), platform=F.lit("YouTube"),
        provider_id=F.col("channel_id"), name=filled(F.col("s.title")), username=filled(F.col("s.customUrl")),
        profile_url=F.concat(F.lit("https://www.youtube.com/channel/"), F.col("channel_id")),
        website=official_website(F.col("links")), niche=F.coalesce("query", F.lit(UNKNOWN)),
        country=F.col("land"),
        language=channel_language(F.col("s.defaultLanguage"), F.col("s.defaultAudioLanguage"), F.col("land")),
        followers=safe_int(F.col("subscribers")),
        recent_activity=filled(published), description=F.col("text"), published_at=published,
        raw_links=F.col("links"), raw_text=F.col("text"),
        video_ids=F.coalesce("video_ids", F.array().cast("array<string>")))


def video_descriptions(answers: DataFrame) -> DataFrame:
    """``(channel_id, video_id, description, hit_ord)`` with channel and description present."""
    videos = _items(answers).select(
        F.col("item.snippet.channelId").alias("channel_id"), F.col("item.id").alias("video_id"),
        F.col("item.snippet.description").alias("description"), "hit_ord")
    return videos.filter((blank(F.col("channel_id")) != "") & (blank(F.col("description")) != ""))


def wanted_videos(videos: DataFrame, hits: DataFrame, k: int) -> DataFrame:
    """Videos among the first ``k`` hits of some channel."""
    ids = first_per_group(channel_videos(hits), ["channel_id"], [F.col("hit_ord")], k).select("video_id").distinct()
    return videos.join(ids, "video_id", "left_semi")


def describe_channels(candidates: DataFrame, answers: DataFrame, hits: DataFrame, k: int) -> DataFrame:
    """Candidates with the texts of the first ``k`` videos found of every channel, blank ones left out."""
    return with_video_texts(candidates, wanted_videos(video_descriptions(answers), hits, k))


def with_video_texts(candidates: DataFrame, videos: DataFrame) -> DataFrame:
    """Append the descriptions of ``videos`` to the text and links of their channel.

    ``videos`` are the wanted ones (see :func:`wanted_videos`), a few of each channel; which are wanted does not depend on
    their texts.
    """
    texts = videos.groupBy("channel_id").agg(
        F.array_sort(F.collect_list(F.struct("hit_ord", "description"))).alias("v")).select(
        F.col("channel_id").alias("_channel"), F.transform("v", lambda x: x["description"]).alias("_texts"))
    joined = candidates.join(texts, candidates["provider_id"] == F.col("_channel"), "left")
    own = filled(F.col("raw_text"), F.col("description"), default="")
    pieces = F.filter(F.concat(F.array(own), F.col("_texts")), lambda t: t != "")
    more_links = F.flatten(F.transform("_texts", links_in_text))
    links = F.when(F.col("_texts").isNull(), F.col("raw_links")).otherwise(
        F.array_distinct(F.concat("raw_links", more_links)))
    linked = joined.withColumn("raw_links", links)
    site = official_website(F.col("raw_links"))
    has_texts = F.col("_texts").isNotNull()
    return linked.withColumns({
        "raw_text": F.when(has_texts, F.array_join(pieces, "\n\n")).otherwise(F.col("raw_text")),
        "website": F.when(has_texts & (site != ""), site).otherwise(F.col("website")),
        "video_descriptions_checked": F.when(has_texts, F.size("_texts")).otherwise(
            F.col("video_descriptions_checked")),
    }).select(*candidates.columns)
