"""The lead table in hash buckets of ``lead_id``: merging a batch rewrites the buckets it falls in.

Instead of numbering the whole table anew, rows keep ``place``: the version and position of their entry. Newest discovery
first, then ``place``, is the order of the table; a row whose blank discovery time is filled moves behind those that had it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.constants import VERIFIED
from leadloom.operators.checkpoints import written
from leadloom.operators.counters import Counters
from leadloom.operators.merge import merge_leads, unique_stored, verified_only
from leadloom.params import Params
from leadloom.schemas import LEAD_FIELDS
from leadloom.sources.buckets import Keyed
from leadloom.sources.tables import NUMBERS

LEADS_DDL = ", ".join(f"{c} {NUMBERS.get(c, 'string')}" for c in LEAD_FIELDS) + ", place ARRAY<BIGINT>"
UNVERIFIED = f"NOT coalesce(trim(email) <> '' AND email_status = '{VERIFIED}', false)"


def lead_store(base: str, buckets: int = 64) -> Keyed:
    return Keyed(base, LEADS_DDL, "lead_id", buckets, UNVERIFIED)


def store_order() -> list[Column]:
    return [F.desc("discovered_at"), F.asc("place")]


def newest_first() -> Column:
    """A value that is largest at the first row in the order of the table."""
    return F.struct("discovered_at", F.transform("place", lambda x: -x))


def start_store(store: Keyed, stored: DataFrame, order: str = "row_no") -> None:
    """Version 0 from a plain lead table, in its order; rows without id go, of a repeated id the last row stays."""
    unique = unique_stored(stored, order)
    placed = unique.withColumn("place", F.array(F.lit(0), F.lit(1), F.col("stored_ord")).cast("array<bigint>"))
    store.replace(stored.sparkSession, placed, 0)


def merge_store(spark: SparkSession, store: Keyed, leads: DataFrame, params: Params, version: int | None = None,
                after: int | None = None) -> dict[str, int]:
    """Merge a batch of leads (with ``ord``) and commit it as ``version``, the next one; returns the counts.

    The batch is merged into version ``after``, the one before; so a repeated run names its version again.
    """
    version, held = store.start(spark, version, after)
    batch = written(verified_only(leads) if params.email_first else leads)
    touched = store.touched_by(batch, held)
    if params.email_first:  # a run of this mode also prunes what is stored
        touched |= {r.bucket for r in held if r.n_marked}
    stored = store.read_held(spark, held, touched)
    stored = (verified_only(stored) if params.email_first else stored).withColumn("at", F.struct("place", "discovered_at"))
    merged = merge_leads(stored, batch, stored_order="at", stored_is_unique=True)
    old = F.col("stored_ord.place")
    moved = (F.coalesce("stored_ord.discovered_at", F.lit("")) == "") & (F.coalesce("discovered_at", F.lit("")) != "")

    def place(kind: int, rest: Column) -> Column:
        return F.concat(F.array(F.lit(version), F.lit(kind)).cast("array<bigint>"), rest)

    placed = merged.withColumn("place", F.when(old.isNull(), place(1, F.array(F.col("batch_ord").cast("bigint"))))
                               .when(moved, place(0, old)).otherwise(old))
    counters = Counters(new=F.count_if(F.col("stored_ord.place").isNull()), folded=F.coalesce(F.sum("rows_folded"), F.lit(0)))
    total = store.write(counters.of(placed), version, held, touched)
    new, folded = (counters.get()[k] for k in ("new", "folded"))
    return {"new_leads": new, "updated_leads": folded - new, "total_leads": total}
