"""Stored tables: reading with a fixed shape, guarding and widening, replacing, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.operators.order import with_position
from leadloom.params import Params
from leadloom.schemas import LEAD_COLUMNS, LEAD_FIELDS, SchemaMismatch

NUMBERS = {"followers": "bigint", "lead_score": "int"}


def headers(params: Params) -> list[str]:
    return [params.score_header if name == "lead_score" else shown for name, shown, _ in LEAD_COLUMNS]


def guard_columns(df: DataFrame | None, expected: list[str], *, may_widen: bool = False) -> list[str]:
    """Columns still to be added: none, the missing tail, or all; any other shape is refused."""
    actual = [] if df is None else list(df.columns)
    if actual == expected:
        return []
    if not actual or (may_widen and actual == expected[:len(actual)]):
        return expected[len(actual):]
    raise SchemaMismatch(f"stored columns {actual} do not fit; nothing was changed")


def widen(df: DataFrame, expected: list[str]) -> DataFrame:
    """Add missing trailing columns as empty text; refuse any other difference."""
    return df.withColumns({c: F.lit("") for c in guard_columns(df, expected, may_widen=True)})


def to_display(leads: DataFrame, params: Params) -> DataFrame:
    """The 32 named output columns, all as text, missing numbers as empty text."""
    return leads.select(*[
        F.coalesce(F.col(name).cast("string"), F.lit("")).alias(shown)
        for (name, _, _), shown in zip(LEAD_COLUMNS, headers(params))])


def from_display(rows: DataFrame, params: Params) -> DataFrame:
    """Typed lead columns from display columns; short rows are padded with empty text."""
    full = widen(rows, headers(params))

    def typed(name: str, shown: str) -> Column:
        value = F.coalesce(F.col(f"`{shown}`").cast("string"), F.lit(""))
        return value.try_cast(NUMBERS[name]) if name in NUMBERS else value

    return full.select(*[typed(n, s).alias(n) for n, s in zip(LEAD_FIELDS, headers(params))])


def read_leads_csv(spark: SparkSession, path: str, params: Params) -> DataFrame:
    """Lead rows of CSV files with a header; the position in the files becomes ``row_no``."""
    rows = (spark.read.option("header", True).option("enforceSchema", False).option("multiLine", True)
            .option("escape", '"').csv(path))
    typed = from_display(rows, params)
    return typed.withColumn("row_no", F.monotonically_increasing_id())


def read_leads(spark: SparkSession, path: str) -> DataFrame:
    """A stored lead table: typed columns and ``row_no``, the order of the table."""
    return spark.read.parquet(path)


def empty_leads(spark: SparkSession) -> DataFrame:
    kinds = ", ".join(f"{c} {NUMBERS.get(c, 'string')}" for c in LEAD_FIELDS)
    return spark.createDataFrame([], f"{kinds}, row_no BIGINT")


def write_leads(leads: DataFrame, order: list[Column], path: str) -> None:
    """Write a whole new table, sorted and numbered, to a path that is not being read."""
    numbered = with_position(leads.select(*LEAD_FIELDS, *_order_inputs(leads)), order, "row_no")
    numbered.select(*LEAD_FIELDS, "row_no").write.mode("overwrite").parquet(path)


def _order_inputs(leads: DataFrame) -> list[str]:
    return [c for c in ("stored_ord", "batch_ord", "row_no") if c in leads.columns]


def write_leads_csv(leads: DataFrame, params: Params, path: str) -> None:
    """The display form as CSV files in table order."""
    (to_display(leads.orderBy("row_no"), params).write.mode("overwrite")
     .option("header", True).option("escape", '"').csv(path))


def write_view(view: DataFrame, path: str) -> None:
    view.write.mode("overwrite").parquet(path)


def read_state_json(spark: SparkSession, path: str) -> DataFrame:
    """Key/value rows of a JSON-lines state table; the later row of a key counts."""
    rows = spark.read.schema("key STRING, value STRING").json(path)
    return rows.withColumn("row_no", F.monotonically_increasing_id())


def write_state_json(state: DataFrame, path: str) -> None:
    state.select("key", "value").orderBy("key").write.mode("overwrite").json(path)


def append_report(report: DataFrame, path: str) -> None:
    report.write.mode("append").json(path)
