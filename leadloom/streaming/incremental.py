"""Incremental runs: every batch of new candidate files becomes a committed run on the stored tables."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.operators.order import with_position
from leadloom.params import Params
from leadloom.plans.harvest import Inputs
from leadloom.plans.runs import Runs, run


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps in its checkpoint: another checkpoint is another stream."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first().value)["id"]


def stream_leads(candidates: DataFrame, runs: Runs, checkpoint: str, params: Params, pages: DataFrame | None = None,
                 results: DataFrame | None = None, after: Callable[[dict], None] | None = None) -> None:
    """Run over every batch of new candidates; leads, caches, state and views of a batch are one commit.

    A batch starts from the newest commit, whatever stream or run made it. A batch that is already part of a commit is not
    run again, so a restart after a loss counts nothing twice; a stream with a fresh checkpoint meets its files anew and
    updates the leads that are there. Candidates of a batch are numbered anew, since files of several runs may repeat ``ord``.
    """
    def one(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        stream = stream_id(spark, checkpoint)
        if runs.done(spark, stream, number):
            return
        placed = batch.withColumnRenamed("ord", "_own").withColumn("_read", F.monotonically_increasing_id())
        numbered = with_position(placed, [F.col("_own"), F.col("_read")], "ord").select(*batch.columns)
        counters = run(spark, runs, Inputs(numbered, pages, results), params, run_id=f"{stream}-{number}", stream=stream, batch=number)
        if after is not None:
            after(counters)

    query = (candidates.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def read_candidate_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)
