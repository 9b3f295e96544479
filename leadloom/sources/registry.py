"""Sources by name, and their union in a fixed order."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.operators.checkpoints import cut
from leadloom.operators.order import with_position
from leadloom.params import Params
from leadloom.schemas import CANDIDATE_DDL

# the order decides which of several equal candidates is kept
SOURCE_ORDER = ["YOUTUBE", "SEED", "WEB", "RSS", "SITEMAP"]

Source = Callable[[SparkSession, Params], DataFrame]


def union_sources(spark: SparkSession, sources: Mapping[str, Source], params: Params) -> tuple[DataFrame, DataFrame]:
    """All candidates and the failures of sources that could not be planned or read.

    A source is a function ``(spark, params) -> candidates``. Each is materialised by itself: one that fails, in
    planning (missing path, wrong columns) or in reading (a broken file), is skipped and reported as
    ``(key, error, seen_at, seq)``; the others go on.

    ``ord`` is numbered anew: by the source's place, then its own ``ord``. It is unique whatever the sources number.
    """
    found = spark.createDataFrame([], CANDIDATE_DDL).withColumn("_place", F.lit(0))
    failures = []
    known = [n for n in SOURCE_ORDER if n in sources] + [n for n in sources if n not in SOURCE_ORDER]
    for place, name in enumerate(known):
        try:
            found = found.unionByName(cut(sources[name](spark, params)).withColumn("_place", F.lit(place)))
        except (PySparkException, Py4JError, ValueError) as error:
            failures.append((f"provider:{name}", type(error).__name__, params.as_of, place))
    columns = [c for c in found.columns if c != "_place"]
    own = found.withColumnRenamed("ord", "_own")
    placed = with_position(own, [F.col(c) for c in ("_place", "_own", "provider_id", "profile_url")], "ord").select(*columns)
    return placed, spark.createDataFrame(failures, "key STRING, error STRING, seen_at STRING, seq BIGINT")
