"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next.

An id names one document. A stage keeps the columns of ``documents``; a filtering stage leaves texts as they are. Null
texts pass as empty ones, rows without id are judged like others. Tables without rows pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.llm import decontaminate as dc
from leadloom.llm import near_dedup, piece_codec, quality_model, substring_dedup
from leadloom.llm.common import fold_of, keep, table
from leadloom.llm.queries import tokenizer

#: no SQL expresses the trained classifier of the first stage
ORACLE_SQL = None


def _whole_rows(docs: DataFrame) -> DataFrame:
    """``row, text``: operators hand the id through, so a row as id comes back with its result, without a join."""
    return docs.select(F.struct(*docs.columns).alias("row"), "text")


def _named_rows(docs: DataFrame) -> DataFrame:
    """``row, name, text``: a name that only equal rows share; names of known ids come first, in their order."""
    every = [F.col(c) for c in docs.columns]
    name = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", F.xxhash64(*every).alias("h1"),
                    F.xxhash64(F.lit(1), *every).alias("h2"))
    return docs.select(F.struct(*docs.columns).alias("row"), name.alias("name"), "text")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject: scores of 0.3 and more. Every row is scored, null texts as empty."""
    labels = table(spark, sf_dir, "labels")
    forest = quality_model.fit(docs, labels.where(fold_of("doc_id") != 0), "quality")
    return quality_model.score(_whole_rows(docs), forest, "row").where("score >= 0.3").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest id.

    Rows without id are judged one by one, and stay behind rows with one. Of rows that are equal in all columns one stays;
    empty and null texts have no duplicates beyond that.
    """
    rows = _named_rows(docs)
    kept = near_dedup.near_duplicates(rows, width=5, percent=80, doc_id="name").where("kept").select("name").distinct()
    return rows.drop("text").join(keep(kept, "kept-names"), "name", "left_semi").dropDuplicates(["name"]).select("row.*")


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that occur elsewhere; a changed text is its kept words joined by one space.

    Every row stays. A text without such passages, null ones too, stays as it is; ``n_chars``, if there is one, follows the text.
    """
    cut = substring_dedup.substring_dedup(docs, window=35).where("kept_text IS NOT NULL").select("link", "kept_text")
    cut = keep(cut.dropDuplicates(["link"]), "cut-texts")
    linked = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64("doc_id", "text").alias("link")).join(cut, "link", "left")
    old = {c: F.col("row").getField(c) for c in docs.columns}
    new = old | {"text": F.coalesce("kept_text", old["text"])}
    if "n_chars" in old:
        new["n_chars"] = F.coalesce(F.length("kept_text").cast(docs.schema["n_chars"].dataType), old["n_chars"])
    return linked.select(*[new[c].alias(c) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items: less than a twentieth of their words is hit.

    Texts without words are clean; without benchmark items every row stays.
    """
    found = dc.decontaminate(_whole_rows(docs), table(spark, sf_dir, "benchmark"), 13, doc_id="row")
    return found.where(~dc.contaminated()).select("row.*")


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the remaining texts and the texts decoded from them, as digests: a row for each row, null texts as empty."""
    return piece_codec.piece_digests(docs, tokenizer("piece_bpe_32k.model"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("substrings", substrings),
          ("decontamination", decontamination), ("pieces", pieces)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
