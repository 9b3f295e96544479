"""Failures as a stream: counts and queues of every key live in Spark's keyed state, their totals in one compact table."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from leadloom.operators.order import last_rows
from leadloom.operators.state import DEAD_AFTER, failure_totals, with_queues
from leadloom.sources.buckets import Keyed
from leadloom.streaming.stateful import rocksdb

TOTALS_DDL = "key STRING, count BIGINT, last_error STRING, last_seen STRING"
QUEUES_DDL = TOTALS_DDL + ", retry_at BIGINT, dead_at BIGINT"


def stream_failures(failures: DataFrame, out: str, checkpoint: str) -> None:
    """Run over all files available now and leave the totals of every key in the table ``out``.

    ``failures(key, error, seen_at, seq)`` is a streaming frame. A batch replaces the keys it changed, so the table has one
    row for each key however many batches there were, and a repeated batch changes nothing.
    """
    table = Keyed(out, TOTALS_DDL, "key")
    query = (failure_totals(failures).writeStream.outputMode("update")
             .foreachBatch(lambda changed, _: table.upsert(changed.sparkSession, changed))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def read_failures(spark: SparkSession, out: str) -> DataFrame:
    """The totals of every key, with their queues."""
    return with_queues(Keyed(out, TOTALS_DDL, "key").read(spark))


class FailureQueues(StatefulProcessor):
    """Totals of a key as a value, and the places of its first failures as a list: the first one enters the retry queue,
    the third one the dead letters, in whatever order they arrive."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "count BIGINT, last_error STRING, last_seen STRING, last_seq BIGINT")
        self.firsts = handle.getListState("firsts", "seq BIGINT")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        count, error, seen, last = self.total.get() if self.total.exists() else (0, None, None, None)
        firsts = [x[0] for x in self.firsts.get()] if self.firsts.exists() else []
        for row in rows:
            count += 1
            if last is None or row.seq >= last:
                error, seen, last = row.error, row.seen_at, row.seq
            firsts = sorted([*firsts, row.seq])[:DEAD_AFTER]
        self.total.update((count, error, seen, last))
        self.firsts.put([(x,) for x in firsts])
        yield Row(key=key[0], count=count, last_error=None if error is None else error[:200], last_seen=seen, retry_at=firsts[0],
                  dead_at=firsts[DEAD_AFTER - 1] if len(firsts) >= DEAD_AFTER else None)

    def close(self) -> None:
        pass


def stream_queues(failures: DataFrame, out: str, checkpoint: str) -> None:
    """As :func:`stream_failures`, with the places where keys entered the queues."""
    table = Keyed(out, QUEUES_DDL, "key")
    changed = failures.groupBy("key").transformWithState(
        statefulProcessor=FailureQueues(), outputStructType=QUEUES_DDL, outputMode="Update", timeMode="None")
    with rocksdb(failures.sparkSession):
        query = (changed.writeStream.outputMode("update")
                 .foreachBatch(lambda rows, _: table.upsert(rows.sparkSession, rows))
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()


def read_queues(spark: SparkSession, out: str) -> DataFrame:
    """Every key with its totals and the places where it entered the queues; ``in_retry``, ``in_dead`` as in the batch form."""
    table = Keyed(out, QUEUES_DDL, "key").read(spark)
    return table.withColumns({"in_retry": F.col("retry_at").isNotNull(), "in_dead": F.col("dead_at").isNotNull()})


def queue(spark: SparkSession, out: str, name: str, keep: int | None = None) -> DataFrame:
    """Keys of the ``retry`` or ``dead_letter`` queue with the place they ``entered`` at; a limit keeps the last ones."""
    at = "retry_at" if name == "retry" else "dead_at"
    return last_rows(read_queues(spark, out).where(F.col(at).isNotNull()).select("key", F.col(at).alias("entered")), keep, "entered")
