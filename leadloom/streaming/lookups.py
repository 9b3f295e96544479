"""The lookup cache as a stream: answers live in Spark's keyed state until a timer in event time ends them."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from leadloom.functions.dates import iso_micros
from leadloom.params import Params
from leadloom.sources.buckets import Keyed
from leadloom.streaming.stateful import rocksdb

LOOKUPS_DDL = "email STRING, url STRING, status STRING, query STRING, confidence DOUBLE, checked_at STRING, live BOOLEAN"
ANSWER_DDL = "url STRING, status STRING, query STRING, confidence DOUBLE, checked_at STRING, at BIGINT"


class Lookups(StatefulProcessor):
    """The newest answer of an address. A found profile stays; a miss ends when it is older than ``days``."""

    def __init__(self, days: int):
        self.millis = days * 86_400_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.answer = handle.getValueState("answer", ANSWER_DDL)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = newest = tuple(self.answer.get()) if self.answer.exists() else None
        for row in rows:
            if row.url is None:  # a mark that time has gone on
                continue
            if newest is None or (row.at or 0) >= (newest[5] or 0):
                newest = (row.url, row.status, row.query, row.confidence, row.checked_at, row.at)
        if newest is None or newest is held:
            return
        if held is not None and not held[0] and held[5] is not None:
            self.handle.deleteTimer(held[5] + self.millis + 1)
        ends = None if newest[0] or newest[5] is None else newest[5] + self.millis + 1
        # a miss that time has passed already, or whose time cannot be read, is told of but not kept
        live = bool(newest[0]) or (ends is not None and ends > timerValues.getCurrentWatermarkInMs())
        if live:
            self.answer.update(newest)
            if ends is not None:
                self.handle.registerTimer(ends)
        else:
            self.answer.clear()
        yield Row(email=key[0], url=newest[0], status=newest[1], query=newest[2], confidence=newest[3], checked_at=newest[4], live=live)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.answer.exists():
            return
        url, status, query, confidence, checked_at, _ = self.answer.get()
        self.answer.clear()
        yield Row(email=key[0], url=url, status=status, query=query, confidence=confidence, checked_at=checked_at, live=False)

    def close(self) -> None:
        pass


def stream_lookups(answers: DataFrame, out: str, checkpoint: str, params: Params) -> None:
    """Keep the table ``out`` of answers from a streaming frame in the shape of the cache.

    Time is that of the answers. A row without ``url`` is no answer; its ``checked_at`` only moves time on. An answer whose
    time cannot be read is never live, unless it found a profile. An answer older than those of a batch before is left out.
    """
    table = Keyed(out, LOOKUPS_DDL, "email")
    millis = F.floor(iso_micros(F.col("checked_at")) / 1000)
    timed = answers.withColumns({"at": millis, "ts": F.timestamp_millis(millis)}).withWatermark("ts", "0 seconds")
    changed = timed.groupBy("email").transformWithState(
        statefulProcessor=Lookups(params.cache_ttl_days), outputStructType=LOOKUPS_DDL, outputMode="Update", timeMode="EventTime")
    with rocksdb(answers.sparkSession):
        query = (changed.writeStream.outputMode("update")
                 .foreachBatch(lambda rows, _: table.upsert(rows.sparkSession, _last(rows)))
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()


def _last(rows: DataFrame) -> DataFrame:
    """One row for each address: a batch may tell of an answer and of its end."""
    rest = [c for c in rows.columns if c != "email"]
    return rows.groupBy("email").agg(F.min_by(F.struct(*rest), "live").alias("r")).select("email", "r.*")


def read_lookups(spark: SparkSession, out: str) -> DataFrame:
    """All answers ever seen, one for each address, with ``live``."""
    return Keyed(out, LOOKUPS_DDL, "email").read(spark)
