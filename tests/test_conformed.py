"""Conformed entities: chains of aliases against plain Python, plan shapes, and odd values."""

import datetime as dt
import random

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from medloom.operators import conformed
from medloom.plans import more_queries as Q
from medloom.plans.queries import std
from test_plans import explained

CODES = "domain string, code string, canonical_id long, label string"
ALIASES = "domain string, source_value string, target_value string"


@pytest.fixture(scope="module")
def maps(spark):
    return Q.lookup(spark, SF_SMALL)


def resolved(codes, aliases):
    best = {}
    for d, c, i, label in codes:
        if None not in (d, c, i):
            best[d, c] = min(best.get((d, c), (i, label)), (i, label), key=lambda x: (x[0], x[1] is not None, x[1] or ""))
    step = {}
    for d, s, t in aliases:
        if None not in (d, s, t) and (d, s) not in best:
            step[d, s] = min(step.get((d, s), t), t)
    out = {(d, c, *v) for (d, c), v in best.items()}
    for d, s in step:
        at, seen = s, set()
        while (d, at) in step and at not in seen:
            seen.add(at)
            at = step[d, at]
        if (d, at) in best:
            out.add((d, s, *best[d, at]))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_aliases_are_followed_to_their_end(spark, seed):
    rng = random.Random(seed)
    names = [str(i) for i in range(60)]
    codes = [(rng.choice("ab"), rng.choice(names[:12]), rng.choice([1, 2, 3, None]), rng.choice(["x", "y"])) for _ in range(25)]
    aliases = [(rng.choice("ab"), rng.choice(names[8:]), rng.choice(names)) for _ in range(70)] + [("a", None, "1"), ("a", "1", None), (None, "2", "3")]
    aliases += [("c", str(i), str(i + 1)) for i in range(100, 140)] + [("c", "7", "7"), ("c", "8", "9"), ("c", "9", "8"), ("c", "6", "9")]
    codes += [("c", "140", 5, "end"), (None, "1", 1, "x"), ("c", None, 1, "x")]
    got = conformed.combined(spark.createDataFrame(codes, CODES), spark.createDataFrame(aliases, ALIASES)).collect()
    assert len(got) == len({(r.domain, r.source_value) for r in got})
    assert {tuple(r) for r in got} == resolved(codes, aliases)


def test_rows_stay_and_unmapped_values_are_counted(spark):
    lookup = conformed.combined(spark.createDataFrame([("d", "1", 10, "one"), ("e", "x", 11, "ex")], CODES), spark.createDataFrame([("d", "2", "1")], ALIASES))
    rows = [(1, "x"), (2, None), (3, "y"), (None, "y"), (1, "x")] + [(3, "hot")] * 500
    df = spark.createDataFrame(rows, "k int, v string")
    got = conformed.conform_entity(df, lookup, {"k": "d", "v": "e"})
    assert got.count() == len(rows)
    assert {tuple(r) for r in got.collect()} == {
        (1, "x", 10, "one", 11, "ex", 0), (2, None, 10, "one", None, None, 0), (3, "y", None, None, None, None, 2),
        (None, "y", None, None, None, None, 1), (3, "hot", None, None, None, None, 2),
    }
    assert {tuple(r) for r in conformed.unmapped_values(got, {"k": "d", "v": "e"}).collect()} == {("d", "3", 501), ("e", "y", 2), ("e", "hot", 500)}
    none = conformed.combined(spark.createDataFrame([], CODES), spark.createDataFrame([], ALIASES))
    assert none.count() == 0 and conformed.conform_entity(df, none, {"k": "d"}).filter("unmapped = 0").count() == 1
    assert conformed.conform_entity(df.limit(0), lookup, {"k": "d"}).count() == 0


@pytest.mark.parametrize("entity", sorted(conformed.ENTITY_DOMAINS))
def test_an_entity_is_conformed_in_one_stage(spark, maps, entity):
    df = conformed.conformed(entity, std(spark, SF_SMALL, entity), maps)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]
    assert "hashpartitioning" not in final and "CartesianProduct" not in final


def test_facts_are_shuffled_once_at_most(spark, maps):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stays = conformed.one_stay(Q._stays(spark, SF_SMALL, maps))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    bills = Q._bills(spark, SF_SMALL, maps, stays)
    plan = explained(bills, "simple")
    assert plan.count("Exchange hashpartitioning(admission_id") <= 2  # one of bills, one of stays


def test_measures_add_up(spark):
    rows = Q.kpi_payer_amounts(spark, SF_SMALL).collect()
    assert sum(r.bills for r in rows) == std(spark, SF_SMALL, "billing").count()
    assert abs(sum(r.amount_share or 0 for r in rows) - 1) < 1e-5


def test_measures_take_narrow_stays(spark, maps, monkeypatch):
    """Only what the measures need of a stay is computed, shuffled and written, and the same stay is chosen."""
    day = dt.date(2020, 1, 5)
    rows = [
        (1, None, 7, 1, 1, day, "b"), (1, None, 7, 1, 2, day, "a"), (1, None, 6, 2, 3, day, "c"), (1, None, 9, 2, 3, None, "d"),
        (2, day, None, 1, 1, None, "e"), (2, None, 8, 3, 9, day, "f"), (3, day, 2, None, None, day, "g"), (None, day, 2, 1, 1, day, "h"),
    ]
    stays = spark.createDataFrame(rows, "admission_id int, admission_date date, patient_id int, hospital_id int, department_id int, admission_date_final date, room_number string")
    stays = stays.select("patient_id", "admission_id", "admission_date", "hospital_id", "department_id", "room_number", "admission_date_final", F.lit(day).alias("discharge_date_final"), *[
        F.concat(F.lit(f"{c} "), F.coalesce(F.col(of).cast("string"), F.lit("-"))).alias(c) for c, of in zip(conformed.OF_BILLED, ("department_id",) * 2 + ("patient_id",) * 2, strict=True)
    ], F.datediff("discharge_date_final", "admission_date_final").alias("los_days"))
    whole = conformed.one_stay(stays)
    frames, keep = {}, conformed.written
    monkeypatch.setattr(conformed, "written", lambda df, name: keep(frames.setdefault(name, df), name))
    narrow = conformed.one_stay(stays, conformed.OF_ACTIVE)
    assert sorted(map(tuple, narrow.collect())) == sorted(map(tuple, whole.select(narrow.columns).collect())) and narrow.count() == 3
    monkeypatch.setattr(Q, "lookup", lambda *_: maps)
    for query in (Q.kpi_payer_amounts, Q.kpi_department_activity):
        frames.clear()
        query(spark, SF_SMALL)
        plan = frames["stays"]._jdf.queryExecution().optimizedPlan().toString()
        assert "discharge_date_final" in plan and "room_number" not in plan and "attending_physician" not in plan
