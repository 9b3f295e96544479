"""Search query expansion: niches x terms x language hints, creator types x niches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.constants import LANGUAGE_HINTS, NICHE_TERMS
from leadloom.operators.dedup import distinct_folded
from leadloom.params import Params


def _texts(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def _known_terms() -> Column:
    pairs = [x for name, terms in NICHE_TERMS.items() for x in (F.lit(name), _texts(terms))]
    return F.create_map(*pairs)


def first_hints(languages: tuple[str, ...]) -> list[str]:
    """First hint of each of the first two languages that have one."""
    return [LANGUAGE_HINTS[x][0] for x in languages[:2] if LANGUAGE_HINTS.get(x)]


def expand_queries(niches: DataFrame, params: Params) -> DataFrame:
    """Distinct queries with their order, from ``niches(niche, niche_pos)``.

    Terms, hints and creator types are short literal arrays, so each niche row grows into its
    queries in place and no join is needed.
    """
    spaced = F.replace("niche", F.lit("_"), F.lit(" "))
    terms = F.coalesce(F.try_element_at(_known_terms(), F.col("niche")), F.array(spaced))
    endings = _texts([""] + [" " + h for h in first_hints(params.target_languages)])
    from_terms = F.flatten(F.transform(terms, lambda t: F.transform(endings, lambda e: F.concat(t, e))))
    creators = _texts(list(params.creator_types[:3]))
    from_creators = F.transform(creators, lambda c: F.concat(c, F.lit(" "), spaced))
    listed = niches.select("niche_pos", F.posexplode(F.concat(from_terms, from_creators)).alias("i", "query"))
    ordered = listed.select(
        "query", (F.shiftleft(F.col("niche_pos").cast("bigint"), 16) + F.col("i")).alias("query_ord"))
    return distinct_folded(ordered, "query", "query_ord")


def niche_frame(spark, niches: tuple[str, ...]) -> DataFrame:
    """The configured niches as rows, in their order."""
    return spark.createDataFrame([(n, i) for i, n in enumerate(niches)], "niche STRING, niche_pos BIGINT")
