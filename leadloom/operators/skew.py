"""Joins whose left side may hold one key in a large part of its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: a key is hot from this share of the rows on, so fewer keys than its inverse are; and from so many rows on
SHARE, LEAST_ROWS, SALTS = 256, 1_000, 64


def hot_values(df: DataFrame, key: str, least_rows: int = LEAST_ROWS) -> list[str]:
    """The frequent values of a text column, found by a sketch in one pass: no key is shuffled, one row comes back.

    The sketch tracks far more items than there can be hot ones, so none is missed.
    """
    row = df.agg(F.count(key).alias("n"), F.expr(f"approx_top_k(`{key}`, {SHARE}, {64 * SHARE})").alias("top")).first()
    return [r["item"] for r in row["top"] or [] if r["item"] is not None and r["count"] >= max(least_rows, row["n"] / SHARE)]


def skewed_join(left: DataFrame, right: DataFrame, key: str, spread_by: str, least_rows: int = LEAST_ROWS) -> DataFrame:
    """Left join on ``key``, the left rows of hot keys spread by a hash of ``spread_by`` and their right rows repeated."""
    hot = hot_values(left, key, least_rows)
    if not hot:
        return left.join(right, key, "left")
    is_hot, salt = F.col(key).isin(hot), F.pmod(F.xxhash64(spread_by), F.lit(SALTS)).cast("int")
    every = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    spread = left.withColumn("_salt", F.when(is_hot, salt).otherwise(0))
    return spread.join(right.withColumn("_salt", F.explode(every)), [key, "_salt"], "left").drop("_salt")
