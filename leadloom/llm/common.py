"""Shared steps: texts in bounded slices, written intermediate tables, the model of words.

``map_texts`` is how every Python step sees a table: Spark reads and splits it, the step gets slices of at most
``SLICE_BYTES`` of text (a longer text comes alone), keeps its caches bounded and returns Arrow rows.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.operators.checkpoints import checkpoint_dir

SLICE_BYTES = 4 << 20
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def keep(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """``batch`` in parts of at most ``SLICE_BYTES`` of text, or of one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(ends):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + SLICE_BYTES, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def ship(spark: SparkSession) -> None:
    """Local Python workers import this package from where the driver did; a cluster gets it by ``--py-files``."""
    environment = spark.sparkContext.environment
    if ROOT not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, environment.get("PYTHONPATH", "")) if x)


_held: dict = {"stage": None}


def of_stage(key, make: Callable):
    """``make()``, once for all tasks of a stage that run in one worker; a task of another stage lets go what was held."""
    task = TaskContext.get()
    stage = task.stageId() if task else None
    if _held["stage"] != stage:
        _held.clear()
        _held["stage"] = stage
    if key not in _held:
        _held[key] = make()
    return _held[key]


def map_texts(df: DataFrame, text: str, make: Callable[[], Callable], schema: str) -> DataFrame:
    """Rows that ``make()(slice, texts)`` returns for each slice; ``texts`` are UTF-8 bytes, null as empty.

    ``make`` is called once in each task. The step returns a list of Arrow arrays or lists in the order of ``schema``.
    """
    ship(df.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        of_stage("", dict)
        step = make()
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.schema.get_field_index(text)
            batch = batch.set_column(at, text, pc.fill_null(batch.column(at).cast(pa.large_binary()), b""))
            for part in slices(batch, text):
                columns = step(part, part.column(text).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, arrow)],
                    schema=arrow)
        finish = getattr(step, "finish", None)
        if finish:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(finish(), arrow)], schema=arrow)

    return df.mapInArrow(run, schema)


def id_type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def fold_of(doc_id: str | Column) -> Column:
    """crc32 of the id as text, modulo 5; null ids count as fold 0."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 5, F.lit(0))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
