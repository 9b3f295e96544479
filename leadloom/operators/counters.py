"""Counters observed inside a plan."""

from __future__ import annotations

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, Observation


class Counters:
    """Aggregates of the rows of a frame, taken while a plan with them runs; they cost no pass of their own."""

    def __init__(self, **aggregates: Column):
        self.seen, self.aggregates, self.rows = Observation(), aggregates, None

    def of(self, rows: DataFrame) -> DataFrame:
        """``rows``, whose counters are taken by the first action on a plan with them."""
        self.rows = rows
        return rows.observe(self.seen, *[c.alias(name) for name, c in self.aggregates.items()])

    def get(self) -> dict:
        """The counters, once such an action has run.

        Spark drops a part of a plan that turns out to be empty, and the observation in it with it; then the rows are
        counted by themselves.
        """
        try:
            return self.seen.get
        except Py4JError:
            return self.rows.agg(*[c.alias(name) for name, c in self.aggregates.items()]).first().asDict()
