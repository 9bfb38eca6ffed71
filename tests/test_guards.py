"""Guarded joins, linked exports and suppressed tables against plain Python."""

import collections
import datetime as dt
import random

import numpy as np
import pytest
from conftest import SF_SMALL

from medloom.operators import deid_linked, guarded, suppress
from medloom.plans import more_queries as Q
from medloom.plans.queries import std

D = dt.date


# Guarded joins -----------------------------------------------------------------------------------------

@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("how", ["left", "inner"])
def test_a_join_reports_what_it_did(spark, seed, how):
    rng = random.Random(seed)
    left = [(rng.choice([None, 1, 1, 1, *range(30)]), i) for i in range(400)]
    right = [(rng.choice([None, 5, *range(10, 40)]), f"r{i}") for i in range(rng.choice([0, 25]))]
    joined, guard = guarded.guarded_join(
        spark.createDataFrame(left, "k int, a int").repartition(4), spark.createDataFrame(right, "k int, b string"), ("k",), "test", how
    )
    rows = joined.collect()
    of = collections.defaultdict(list)
    for k, b in right:
        if k is not None:
            of[k].append(b)
    expected = [(k, a, b) for k, a in left for b in (of.get(k) or ([None] if how == "left" else []))]
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, expected))
    matches = [len(of.get(k, [])) for k, _ in left]
    assert guard.report() == {
        "join_name": "test", "rows_in": 400, "keyless": sum(k is None for k, _ in left), "rows_out": sum(max(1, n) for n in matches),
        "unmatched": matches.count(0), "doubled": sum(n > 1 for n in matches), "most_matches": max(matches),
    }
    if any(n > 1 for n in matches):
        with pytest.raises(guarded.FanOutError):
            guard.check()
    else:
        guard.check()


def test_a_guard_costs_no_further_scan_or_shuffle(spark, tmp_path):
    for name in ("l", "r"):
        spark.range(1000).selectExpr("cast(id % 300 as int) k", "id v").write.parquet(str(tmp_path / name))
    left, right = (spark.read.parquet(str(tmp_path / n)).withColumnRenamed("v", n) for n in ("l", "r"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = left.join(right, "k", "left")._jdf.queryExecution().executedPlan().toString()
        seen = guarded.guarded_join(left, right, ("k",), "x")[0]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plain.count("Exchange") == seen.count("Exchange") == 2 and seen.count("FileScan") == 2


# Linked exports ----------------------------------------------------------------------------------------

def test_keys_still_join_and_intervals_stay(spark):
    tables = {e: std(spark, SF_SMALL, e) for e in deid_linked.POLICY}
    out = deid_linked.export_all(tables, std(spark, SF_SMALL, "patients"), "salt", D(2024, 1, 1))
    stays = out["admissions"]
    assert stays.select("encounter_hash").distinct().count() == tables["admissions"].select("admission_id").distinct().count()
    for entity, day in (("billing", "bill_date"), ("diagnoses", "diagnosis_date"), ("procedures", "procedure_date")):
        before = tables["admissions"].join(tables[entity], "admission_id").selectExpr(f"datediff({day}, admission_date_final) gap")
        after = stays.join(out[entity], "encounter_hash").selectExpr(f"datediff({day}_shifted, admission_date_final_shifted) gap")
        assert before.count() == after.count() == stays.join(out[entity], "encounter_hash").count()
        a, b = (collections.Counter(r.gap for r in x.filter("gap is not null").collect()) for x in (before, after))
        assert b and not b - a  # the intervals that are left are intervals that were there
    moved = out["billing"].filter("bill_date_shifted is not null").count()
    assert 0 < moved < tables["billing"].count()


def test_dates_of_the_old_and_unknown_stay_inside(spark):
    stays = spark.createDataFrame([(1, 10), (2, 11), (3, None), (4, 10), (4, 11), (None, 10)], "admission_id int, patient_id int")
    people = spark.createDataFrame(
        [(10, D(2000, 1, 1), D(1980, 5, 1)), (11, D(2000, 1, 1), D(1920, 1, 1)), (11, D(1999, 1, 1), D(1990, 1, 1))],
        "patient_id int, created_date date, date_of_birth date",
    )
    of = deid_linked.encounters(stays, people, D(2024, 1, 1))
    assert {r.admission_id: r.dates_allowed for r in of.collect()} == {1: True, 2: False, 3: False, 4: False, None: True}
    tests = spark.createDataFrame([(i, i, D(2020, 1, 10)) for i in (1, 2, 3, 4, 5)] + [(6, None, D(2020, 1, 10))], "lab_result_id int, admission_id int, test_date date")
    policy = {"lab_result_id": "row", "admission_id": "encounter", "test_date": "shift"}
    got = deid_linked.export("lab_results", tests, of, "s", policy).collect()
    assert len(got) == 6 and sum(r.test_date_shifted is not None for r in got) == 1
    assert all(abs((r.test_date_shifted - D(2020, 1, 10)).days) <= 3 for r in got if r.test_date_shifted)
    assert len({r.lab_result_id_hash for r in got} & {r.encounter_hash for r in got}) == 0


# Suppressed tables -------------------------------------------------------------------------------------

def determined(counts, blank):
    """Blank cells whose value follows from the row and column totals and the other cells."""
    cells = np.argwhere(blank)
    if not len(cells):
        return []
    lines = np.zeros((sum(counts.shape), len(cells)))
    for k, (r, c) in enumerate(cells):
        lines[r, k] = lines[counts.shape[0] + c, k] = 1
    rank = np.linalg.matrix_rank(lines)
    return [tuple(x) for k, x in enumerate(cells) if np.linalg.matrix_rank(np.vstack([lines, np.eye(len(cells))[k]])) == rank]


@pytest.mark.parametrize("seed", range(40))
def test_totals_give_no_blank_away(seed):
    rng = np.random.default_rng(seed)
    counts = rng.choice([0, 3, 10, 12, 40, 500], size=rng.integers(1, 9, 2), p=[0.1, 0.1, 0.1, 0.2, 0.3, 0.2])
    small, more, totals = suppress.rectangles(counts, 11)
    assert (small == ((counts > 0) & (counts < 11))).all() and not (small & more).any() and not (more & (counts == 0)).any()
    if totals:
        assert determined(counts, small | more) == []
    else:
        assert not more.any()
    naive = determined(counts, small)
    assert not naive or more.any() or not totals


def test_a_whole_table(spark):
    cells = Q.suppressed_bills(spark, SF_SMALL)
    bills = std(spark, SF_SMALL, "billing").selectExpr("year(bill_date) y", "trunc(bill_date, 'MM') m", "payment_status s")
    counts = {(r.y, r.m, r.s): r.n for r in bills.groupBy("y", "m", "s").count().withColumnRenamed("count", "n").collect()}
    got = {(r.bill_year, r.bill_month, r.payment_status): r for r in cells.collect()}
    assert set(got) == set(counts)
    for year in {k[0] for k in counts}:
        own = {k: n for k, n in counts.items() if k[0] == year}
        rows, columns = (sorted({k[i] for k in own}, key=lambda x: (x is not None, x)) for i in (1, 2))
        table, blank = (np.zeros((len(rows), len(columns)), int) for _ in range(2))
        for k, n in own.items():
            at = rows.index(k[1]), columns.index(k[2])
            table[at], blank[at] = n, got[k].n is None
            assert got[k].n in (None, n) and (got[k].suppressed == "small") == (n < 11) and (got[k].suppressed is None) == (got[k].n is not None)
        if all(got[k].totals for k in own):
            assert determined(table, blank) == []


def test_totals_are_withheld_where_nothing_else_helps(spark):
    rows = [("a", "x", "p")] * 3 + [("a", "y", "p")] * 40 + [("b", "x", "p")] * 20 + [("b", "y", "q")] * 20 + [(None, None, "p")] * 12
    df = spark.createDataFrame(rows, "t string, r string, c string")
    cells = suppress.suppressed_table(df, "t", "r", "c")
    assert {(r.t, r.r, r.c): (r.n, r.suppressed, r.totals) for r in cells.collect()} == {
        ("a", "x", "p"): (None, "small", False), ("a", "y", "p"): (40, None, False), ("b", "x", "p"): (20, None, True),
        ("b", "y", "q"): (20, None, True), (None, None, "p"): (12, None, True),
    }
    totals = suppress.published_totals(df, cells, "t", "r", "c").collect()
    assert sorted((r.t or "", r.is_row, r.r or r.c or "", r.n) for r in totals) == [
        ("", False, "p", 12), ("", True, "", 12), ("b", False, "p", 20), ("b", False, "q", 20), ("b", True, "x", 20), ("b", True, "y", 20),
    ]
    assert suppress.suppressed_table(df.limit(0), "t", "r", "c").count() == 0
