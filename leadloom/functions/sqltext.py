"""Longer expressions as SQL text: parsed once by Spark instead of built call by call."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def q(text: str) -> str:
    """A SQL string literal with this value."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def q_list(values) -> str:
    return ", ".join(q(v) for v in values)


def bind(name: str, value: str, body: str) -> str:
    """SQL that evaluates ``value`` once and uses it as ``name`` in ``body``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def apply(name: str, body: str, value: Column) -> Column:
    """``body``, SQL over ``name``, evaluated for a column."""
    return F.call_function("transform", F.array(value), F.expr(f"{name} -> {body}")).getItem(0)


def apply2(first: str, second: str, body: str, a: Column, b: Column) -> Column:
    """The same for two columns."""
    pair = F.struct(a.alias(first), b.alias(second))
    inner = bind(first, f"_pair.{first}", bind(second, f"_pair.{second}", body))
    return F.call_function("transform", F.array(pair), F.expr(f"_pair -> {inner}")).getItem(0)
