"""What Spark's keyed state with lists and timers needs of a session."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, which keyed state needs."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)
