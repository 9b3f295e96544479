import random

from pyspark.sql import functions as F

from leadloom import Params
from leadloom.operators.merge import merge_counts, merge_leads, table_order, verified_only
from leadloom.plans.views import counts_by_dimension, sorted_hot_view, sorted_no_email_view, stats_table
from leadloom.schemas import LEAD_FIELDS, SchemaMismatch
from leadloom.sources.tables import (
    empty_leads, from_display, guard_columns, headers, read_leads, read_leads_csv, to_display, widen, write_leads, write_leads_csv,
)

import pytest

P = Params(as_of="2026-08-17T12:00:00+00:00")


def lead(**values):
    return {c: values.get(c, None if c in ("followers", "lead_score") else "") for c in LEAD_FIELDS}


def frame(spark, rows, order):
    kinds = {"followers": "bigint", "lead_score": "int"}
    ddl = ", ".join(f"{c} {kinds.get(c, 'string')}" for c in LEAD_FIELDS) + f", {order} BIGINT"
    return spark.createDataFrame([tuple(r[c] for c in LEAD_FIELDS) + (i,) for i, r in enumerate(rows)], ddl)


def one_by_one(stored, batch):
    """The merge as a loop over rows."""
    table = {}
    for row in stored:
        if row["lead_id"]:
            table[row["lead_id"]] = dict(row)
    new = updated = 0
    for row in batch:
        row, old = dict(row), table.get(row["lead_id"])
        if old is None:
            new += 1
        else:
            updated += 1
            if old["instagram_url"] and not row["instagram_url"]:
                row["instagram_url"] = old["instagram_url"]
                for c in ("instagram_status", "instagram_search_query"):
                    row[c] = old[c] or row[c]
            for c in ["discovered_at", "status"] + LEAD_FIELDS[26:]:
                row[c] = old[c] or row[c]
        table[row["lead_id"]] = row
    return new, updated, table


def random_lead(rng, ids):
    def maybe(*values):
        return rng.choice(["", *values])

    return lead(lead_id=maybe(*ids), discovered_at=maybe("2026-01-01", "2026-02-02"), name=f"n{rng.randrange(99)}", email=maybe("a@b.c"), status=maybe("NEW", "REPLIED"),
                instagram_url=maybe("u1", "u2"), instagram_status=maybe("FOUND", "NOT_FOUND"), instagram_search_query=maybe("q1", "q2"),
                outreach_status=maybe("SENT"), outreach_attempts=maybe("1", "2"), followers=rng.choice([None, 5]), lead_score=rng.randrange(100))


def test_same_as_loop(spark):
    rng = random.Random(23)
    ids = [f"id{i}" for i in range(40)]
    stored = [random_lead(rng, ids) for _ in range(60)]
    batch = [r for r in (random_lead(rng, ids + [f"new{i}" for i in range(20)]) for _ in range(250)) if r["lead_id"]]
    new, updated, table = one_by_one(stored, batch)
    merged = merge_leads(frame(spark, stored, "row_no"), frame(spark, batch, "ord"))
    found = {r["lead_id"]: {c: r[c] for c in LEAD_FIELDS} for r in merged.collect()}
    assert found == table
    counts = merge_counts(merged).first()
    assert (counts.new_leads, counts.updated_leads, counts.total_leads) == (new, updated, len(table))
    in_order = sorted(table.values(), key=lambda r: r["discovered_at"], reverse=True)
    assert [r.lead_id for r in merged.orderBy(*table_order()).collect()] == [r["lead_id"] for r in in_order]


def test_second_merge_changes_nothing(spark, tmp_path):
    rng = random.Random(4)
    batch = [r for r in (random_lead(rng, [f"id{i}" for i in range(9)]) for _ in range(30)) if r["lead_id"]]
    first = merge_leads(empty_leads(spark), frame(spark, batch, "ord"))
    write_leads(first, table_order(), str(tmp_path / "one"))
    stored = read_leads(spark, str(tmp_path / "one"))
    last = {r["lead_id"]: r for r in batch}
    again = merge_leads(stored, frame(spark, list(last.values()), "ord"))
    assert merge_counts(again).first().new_leads == 0
    write_leads(again, table_order(), str(tmp_path / "two"))
    assert sorted(map(tuple, read_leads(spark, str(tmp_path / "two")).collect()), key=str) == sorted(map(tuple, stored.collect()), key=str)


def test_rows_in_and_out(spark, tmp_path):
    row = lead(lead_id="abc", email="hello@creator.com", lead_score=82, instagram_url="https://www.instagram.com/creator/", outreach_status="SENT",
               gmail_message_id="gmail-123", outreach_attempts="1", why_qualified='a, "b"\nc')
    leads = frame(spark, [row, lead(lead_id="x", followers=7)], "row_no")
    shown = to_display(leads, P).collect()
    assert len(shown[0]) == 32
    assert [shown[0][i] for i in (0, 9, 15, 19, 23, 26, 29, 31)] == ["abc", "hello@creator.com", "", "82", row["instagram_url"], "SENT", "gmail-123", "1"]
    write_leads_csv(leads, P, str(tmp_path / "csv"))
    back = read_leads_csv(spark, str(tmp_path / "csv"), P).orderBy("row_no").collect()
    assert [{c: r[c] for c in LEAD_FIELDS} for r in back] == [row, lead(lead_id="x", followers=7)]


def test_guard(spark):
    names = headers(P)
    short = to_display(frame(spark, [lead(lead_id="a")], "row_no"), P).select(*names[:26])
    assert widen(short, names).columns == names and from_display(short, P).first().outreach_status == ""
    assert guard_columns(None, names) == names and guard_columns(short, names[:26]) == []
    with pytest.raises(SchemaMismatch):
        guard_columns(short, names)
    with pytest.raises(SchemaMismatch):
        widen(short.withColumnRenamed("Email", "Mail"), names)


def test_views_and_statistics(spark):
    rows = [lead(lead_id=str(i), name=f"n{i}", classification=c, email=e, email_status=v, lead_score=s, source=src, niche=n, discovered_at=d) for i, (c, e, v, s, src, n, d) in enumerate([
        ("hot", "a@b.c", "UNKNOWN", 99, "S", "", "2026-08-17T01"), ("HOT", "", "VERIFIED_PUBLIC_SOURCE", 50, "S", "n1", "2026-08-16T01"),
        ("HOT", " ", "VERIFIED_PUBLIC_SOURCE", 70, "T", "n2", "2026-08-17T02"), ("GOOD", "x@y.z", "", None, "U", "n2", "")])]
    leads = frame(spark, rows, "row_no")
    assert [r.name for r in sorted_hot_view(leads).collect()] == ["n2", "n1", "n0"]
    assert [r.name for r in sorted_no_email_view(leads).collect()] == ["n2", "n1"]
    by = {(r.dimension, r.value): (r.leads, r.place) for r in counts_by_dimension(leads).collect()}
    assert by[("source", "S")] == (2, 1) and by[("source", "T")] == (1, 2) and by[("niche", "UNKNOWN")] == (1, 2) and by[("niche", "n2")] == (2, 1)
    assert by[("language", "UNKNOWN")] == (4, 1)
    run = spark.createDataFrame([("f", 1.5, 9, 2, 3, 4, 5, 6, 7, 8, 0)], "finished_at STRING, duration DOUBLE, candidates_found INT, new_leads INT, duplicates_prevented INT, "
                                "websites_crawled INT, youtube_requests INT, youtube_search_requests INT, instagram_lookups INT, instagram_found INT, errors INT")
    stats = [tuple(r) for r in stats_table(leads, run, P.as_of).collect()]
    assert stats[:4] == [("TOTAL LEADS", "4"), ("NEW TODAY", "2"), ("HOT LEADS", "3"), ("EMAILS FOUND", "2")]
    assert stats[9] == ("LAST RUN", "f") and ("LEADS BY NICHE", "") in stats and stats[20:22] == [("LEADS BY SOURCE", ""), ("  S", "2")]


def test_top_fifteen_only(spark):
    rows = [lead(lead_id=str(i), niche=f"n{i % 40:02d}") for i in range(80)]
    niches = counts_by_dimension(frame(spark, rows, "row_no")).filter("dimension = 'niche'").orderBy("place").collect()
    assert [r.value for r in niches] == [f"n{i:02d}" for i in range(15)]


def test_verified_only(spark):
    rows = [lead(lead_id="a", email="a@b.c", email_status="VERIFIED_PUBLIC_SOURCE"), lead(lead_id="b", email="a@b.c", email_status="UNKNOWN"),
            lead(lead_id="c", email=" ", email_status="VERIFIED_PUBLIC_SOURCE")]
    assert [r.lead_id for r in verified_only(frame(spark, rows, "row_no")).collect()] == ["a"]
