"""ISO-8601 text as microseconds since the epoch (UTC when no offset is given)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadloom.functions.text import let
from leadloom.params import Params

_ISO = (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
        r"(?:[T ][0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:[.,][0-9]{1,6})?)?(?:Z|[+-][0-9]{2}:?[0-9]{2})?)?$")
DAY_MICROS = 86_400_000_000


def iso_micros(text: Column) -> Column:
    """Null when the text is not an extended ISO-8601 date or date-time."""
    def parse(value: Column) -> Column:
        has_offset = value.rlike(r"[T ].*(?:Z|[+-][0-9]{2}:?[0-9]{2})$")
        timed = F.when(F.length(value) == 10, F.concat(value, F.lit("T00:00"))).otherwise(value)
        seconds = F.regexp_replace(timed, r"^(.{16})(?!:)", "$1:00")
        dotted = F.replace(seconds, F.lit(","), F.lit("."))
        colon = F.regexp_replace(dotted, r"([+-][0-9]{2})([0-9]{2})$", "$1:$2")
        zoned = F.when(has_offset, colon).otherwise(F.concat(dotted, F.lit("Z")))
        return F.when(value.rlike(_ISO), F.unix_micros(zoned.try_cast("timestamp")))

    return let(text, parse)


def age_days(text: Column, params: Params) -> Column:
    """Whole days, rounded down, between a time and the run's reference time."""
    age = F.lit(params.as_of_micros).cast("bigint") - iso_micros(text)
    return F.floor(age / F.lit(DAY_MICROS))


def within_days(text: Column, days: int, params: Params, *, inclusive: bool) -> Column:
    """True when the time lies at most (or less than) ``days`` back; unreadable times are not."""
    age = F.lit(params.as_of_micros).cast("bigint") - iso_micros(text)
    limit = F.lit(days * DAY_MICROS).cast("bigint")
    return F.coalesce(age <= limit if inclusive else age < limit, F.lit(False))
