"""Where lineage is cut: the shared checkpoint folder that the session names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local one is made only for a local master."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="leadloom-checkpoints-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so that losing an executor does not replay the rounds before."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` in columns in the same folder: for many rows smaller and faster than :func:`cut`, and read by column.

    Rows come back in any order and in other partitions.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/written-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let_go(frame: DataFrame) -> None:
    """Remove the files of a frame of :func:`written` that nothing will read any more."""
    spark = frame.sparkSession
    for file in {f.rsplit("/", 1)[0] for f in frame.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
