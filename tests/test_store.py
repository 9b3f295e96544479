import random

import pytest
from pyspark.sql import functions as F

from leadloom import Params
from leadloom.operators.merge import merge_counts, merge_leads, table_order, verified_only
from leadloom.operators.order import with_position
from leadloom.schemas import LEAD_FIELDS
from leadloom.sources.buckets import Keyed, versions
from leadloom.sources.store import LEADS_DDL, lead_store, merge_store, start_store, store_order
from leadloom.sources.tables import empty_leads, read_leads, write_leads
from tests.test_merge import frame, lead

P = Params(as_of="2026-08-17T12:00:00+00:00")


def some_leads(rng, n, ids):
    times = ["", "2026-01-01T00:00:00+00:00", "2026-02-01T00:00:00+00:00"]
    return [lead(lead_id=f"l{rng.randrange(ids)}", discovered_at=rng.choice(times), name=f"n{rng.random()}", status=rng.choice(["", "NEW", "DONE"]),
                 email=f"{rng.randrange(9)}@x.org", email_status=rng.choice(["VERIFIED_PUBLIC_SOURCE", "UNKNOWN"]),
                 instagram_url=rng.choice(["", "https://i/1"]), instagram_status=rng.choice(["", "FOUND"])) for _ in range(n)]


def files(folder):
    return {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


@pytest.mark.parametrize("email_first", [False, True])
def test_merges_equal_the_plain_table(spark, tmp_path, email_first):
    rng = random.Random(3)
    params = Params(as_of=P.as_of, email_first=email_first)
    store, plain = lead_store(str(tmp_path / "store"), 8), empty_leads(spark)
    for version, size in enumerate((60, 60, 0, 60)):
        batch = frame(spark, some_leads(rng, size, 50), "ord")
        counts = merge_store(spark, store, batch, params)
        old, new = (verified_only(plain), verified_only(batch)) if email_first else (plain, batch)
        merged = merge_leads(old, new)
        assert counts == merge_counts(merged).first().asDict()
        write_leads(merged, table_order(), str(tmp_path / f"plain{version}"))
        plain = read_leads(spark, str(tmp_path / f"plain{version}"))
        ours = with_position(store.read(spark), store_order(), "row_no").select(*LEAD_FIELDS, "row_no")
        assert ours.orderBy("row_no").collect() == plain.select(*LEAD_FIELDS, "row_no").orderBy("row_no").collect()
    assert versions(spark, f"{store.base}/manifest") == [0, 1, 2, 3]


def test_untouched_buckets_and_lost_merges(spark, tmp_path):
    store = lead_store(str(tmp_path / "store"), 16)
    start_store(store, frame(spark, some_leads(random.Random(5), 400, 300) + [lead(lead_id="known"), lead()], "row_no"))
    data, n = tmp_path / "store" / "data", store.read(spark).count()
    before, held = files(data), store.manifest(spark)
    batch = frame(spark, [lead(lead_id="known", name="changed"), lead(lead_id="known", name="again")], "ord")
    assert merge_store(spark, store, batch, P) == {"new_leads": 0, "updated_leads": 2, "total_leads": n}
    after = files(data)
    assert {k: after[k] for k in before} == before  # nothing stored was written again
    assert {k.split("/")[0] for k in after if k not in before} == {"version=1"}
    newest = {r.bucket: r.data_version for r in store.manifest(spark)}
    assert sorted(newest.values()) == [0] * (len(held) - 1) + [1]  # one bucket was added
    # data of a version whose manifest was not written: the version does not exist, and the merge is made again
    merge_store(spark, store, frame(spark, [lead(lead_id="lost")], "ord"), P)
    (tmp_path / "store" / "manifest" / "version=2").rename(tmp_path / "lost")
    assert store.newest(spark) == 1 and store.read(spark).where("lead_id = 'lost'").isEmpty()
    assert merge_store(spark, store, frame(spark, [lead(lead_id="new")], "ord"), P)["new_leads"] == 1
    # a named version is merged into the one before it, so a repeated run counts nothing twice
    assert merge_store(spark, store, frame(spark, [lead(lead_id="new")], "ord"), P, version=2)["total_leads"] == n + 1
    assert store.read(spark).where("lead_id IN ('new', 'lost')").count() == 1


def test_stored_side_is_not_shuffled(spark, tmp_path):
    store = lead_store(str(tmp_path / "store"), 8)
    start_store(store, frame(spark, some_leads(random.Random(1), 200, 150), "row_no"))
    stored = store.read_held(spark, store.manifest(spark), [1, 2])
    batch = frame(spark, some_leads(random.Random(2), 50, 150), "ord").repartition(3)
    plan = merge_leads(stored, batch, stored_order="place", stored_is_unique=True)._jdf.queryExecution().executedPlan().toString()
    between = plan[plan.index("SortMergeJoin"):plan.index("FileScan parquet")]
    assert "FullOuter" in between and "Exchange" not in between
    assert "PartitionFilters: [bucket" in plan and "Bucketed: true" in plan


def test_tables_of_keys(spark, tmp_path):
    table = Keyed(str(tmp_path / "t"), "id STRING, n BIGINT", "id", 4, "n > 5")
    assert table.read(spark).collect() == [] and table.newest(spark) is None
    assert table.upsert(spark, spark.createDataFrame([], table.ddl)) == 0
    assert table.upsert(spark, spark.createDataFrame([(f"k{i}", i) for i in range(20)] + [(None, 1)], table.ddl)) == 20
    assert table.upsert(spark, spark.createDataFrame([("k3", 99), ("new", None)], table.ddl)) == 21
    assert {r.id: r.n for r in table.read(spark).collect()} == {f"k{i}": 99 if i == 3 else i for i in range(20)} | {"new": None}
    assert {r.id: r.n for r in table.read(spark, 1).collect()}["k3"] == 3  # the version before
    assert sum(r.n_marked for r in table.manifest(spark)) == 15
    assert table.replace(spark, spark.createDataFrame([("z", 0)], table.ddl)) == 1 and table.read(spark).count() == 1


def test_no_leads(spark, tmp_path):
    store = lead_store(str(tmp_path / "store"))
    nothing = spark.createDataFrame([], LEADS_DDL.replace("place ARRAY<BIGINT>", "ord BIGINT"))
    assert merge_store(spark, store, nothing, P)["total_leads"] == 0 and store.read(spark).count() == 0


def test_change_without_rows_is_a_manifest(spark, tmp_path):
    table = Keyed(str(tmp_path / "t"), "id STRING, n BIGINT", "id", 4)
    nothing = spark.createDataFrame([], table.ddl)
    assert table.upsert(spark, nothing) == 0 and table.read(spark).collect() == [] and table.newest(spark) == 0
    assert table.upsert(spark, spark.createDataFrame([("a", 1), ("b", 2)], table.ddl)) == 2
    assert table.upsert(spark, nothing) == 2 and table.newest(spark) == 2
    assert sorted(tuple(r) for r in table.read(spark).collect()) == [("a", 1), ("b", 2)]
    assert sorted(p.name for p in (tmp_path / "t" / "data").iterdir()) == ["version=1"]
