"""Rule scoring of candidates: content type, caption opportunity, signals, class, reasons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.constants import NO_REASON, UNKNOWN
from leadloom.functions.dates import age_days
from leadloom.functions.text import any_of, blank
from leadloom.params import Params

EXPLAINED_KINDS = ["talking_head", "podcast", "educational"]

# signal columns in the order that breaks ties in the explanation
SIGNALS = ["target_niche", "target_language", "target_country", "audience_fit", "recent_activity",
           "content_fit", "caption_opportunity", "public_website", "commercial_creator"]


def recency_points(published_at: Column, params: Params) -> Column:
    age = age_days(published_at, params)
    days = params.recent_days
    return (F.when(age <= max(7, days // 3), 15).when(age <= days, 10)
            .when(age <= days * 2, 4).otherwise(0))


def classify(score: Column, params: Params) -> Column:
    return (F.when(score >= params.hot_score, "HOT").when(score >= params.good_score, "GOOD")
            .when(score >= params.possible_score, "POSSIBLE").otherwise("LOW"))


def content_type(text: Column, own: Column, params: Params) -> Column:
    return (
        F.when(any_of(text, params.talking_head_hints), "talking_head")
        .when(any_of(text, params.podcast_hints), "podcast")
        .when(any_of(text, params.educational_hints), "educational")
        .otherwise(own))


def caption_opportunity(text: Column, kind: Column, own: Column, params: Params) -> Column:
    return (
        F.when(any_of(text, params.caption_hints) | kind.isin(EXPLAINED_KINDS), "GOOD")
        .when(any_of(text, params.short_form_hints), "DECENT")
        .otherwise(own))


def _signals(params: Params) -> dict[str, Column]:
    text, niche = F.col("_text"), F.col("_niche")
    wanted = [n.replace("_", " ") for n in params.target_niches]
    languages = [x.lower() for x in params.target_languages]
    countries = [x.upper() for x in params.target_countries]
    language, country, followers = F.col("language"), F.col("country"), F.col("followers")
    kind, caption = F.col("content_type"), F.col("caption_opportunity")
    in_niche = niche.isin(list(params.target_niches)) | any_of(niche, wanted) | any_of(text, wanted)
    return {
        "target_niche": F.when(in_niche, 18),
        "target_language": F.when(language == UNKNOWN, 2).when(F.lower(language).isin(languages), 10),
        "target_country": F.when(country == UNKNOWN, 1).when(F.upper(country).isin(countries), 8),
        "audience_fit": F.when(followers.between(params.min_subscribers, params.max_subscribers), 15)
        .when(followers > 0, 4),
        "recent_activity": F.nullif(recency_points(F.col("published_at"), params), F.lit(0)),
        "content_fit": F.when(kind.isin(EXPLAINED_KINDS), 16).when(kind != UNKNOWN, 5),
        "caption_opportunity": F.when(caption == "GOOD", 13).when(caption == "DECENT", 7),
        "public_website": F.when(blank(F.col("website")) != "", 5),
        "commercial_creator": F.when(any_of(text, params.commercial_words), 8),
    }


def explanation(signals: Column) -> Column:
    """The five strongest signals of 8 points or more, equal points in signal order."""
    numbered = F.array(*[
        F.struct((-signals[name]).alias("rank"), F.lit(i).alias("pos"),
                 F.lit(name.replace("_", " ")).alias("label"))
        for i, name in enumerate(SIGNALS)])
    strong = F.array_sort(F.filter(numbered, lambda s: s["rank"] <= -8))
    text = F.array_join(F.transform(F.slice(strong, 1, 5), lambda s: s["label"]), ", ")
    return F.when(F.size(strong) > 0, text).otherwise(NO_REASON)


def score_candidates(candidates: DataFrame, params: Params) -> DataFrame:
    """Add ``signals``, ``score``, ``classification`` and ``why_qualified``, and replace
    ``content_type`` and ``caption_opportunity`` by the inferred ones. No shuffle."""
    body = F.concat(blank(F.col("description")), F.lit(" "), blank(F.col("raw_text")))
    columns = candidates.columns
    texts = candidates.withColumn("_body", F.lower(body)).withColumns({
        "_text": F.concat(F.lower(blank(F.col("name"))), F.lit(" "), F.col("_body")),
        "_niche": F.when(F.col("niche") == UNKNOWN, "").otherwise(F.lower(F.col("niche"))),
    })
    typed = texts.withColumn(
        "content_type", content_type(F.col("_text"), F.col("content_type"), params))
    captioned = typed.withColumn(
        "caption_opportunity",
        caption_opportunity(F.col("_body"), F.col("content_type"), F.col("caption_opportunity"), params))
    named = [c.alias(name) for name, c in _signals(params).items()]
    signalled = captioned.select(*columns, F.struct(*named).alias("signals"))
    total = reduce(lambda a, b: a + b,
                   [F.coalesce(F.col("signals")[name], F.lit(0)) for name in SIGNALS])
    scored = signalled.withColumn("score", F.least(F.lit(100), total))
    return scored.withColumns({
        "classification": classify(F.col("score"), params),
        "why_qualified": explanation(F.col("signals")),
    })
