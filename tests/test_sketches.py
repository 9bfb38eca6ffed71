"""Profiles by sketch: joined sketches, error bounds, and top values against plain counting."""

import collections
import datetime as dt
import random

import pytest
from conftest import SF_SMALL

from medloom.operators import profile, sketches
from medloom.sources.tables import table


def test_days_join_to_what_one_pass_gives(spark, tmp_path):
    events = table(spark, SF_SMALL, "events")
    path = str(tmp_path / "s")
    for part in events.randomSplit([0.5, 0.5], 3):
        sketches.add_days(part, path, "ts")
    once = {r.column_name: r for r in sketches.merged(sketches.day_sketches(events)).collect()}
    joined = sketches.merged(sketches.stored(path, spark)).collect()
    assert {r.column_name: r for r in joined} == once
    for r in profile.profile_columns(events).collect():
        found = once[r.column_name]
        assert (found.rows, found.nulls) == (r.sample_rows, r.null_count)
        assert abs(found.distinct_estimate - r.distinct_count) <= 5 * found.relative_error * r.distinct_count
    some = sketches.stored(path, spark, dt.date(2024, 1, 3), dt.date(2024, 1, 5))
    assert sketches.merged(some).first().rows == events.filter("cast(ts as date) between date'2024-01-03' and date'2024-01-05'").count()


def test_a_finer_sketch_errs_less(spark):
    df = spark.range(50_000).selectExpr("cast(id as string) v")
    for lg_k in (8, 16):
        r = sketches.merged(sketches.day_sketches(df, None, lg_k), lg_k).first()
        assert abs(r.distinct_estimate - 50_000) <= 5 * r.relative_error * 50_000
    assert sketches.relative_error(16) < sketches.relative_error(8) / 10


def test_no_value_is_shuffled(spark):
    plan = sketches.merged(sketches.day_sketches(table(spark, SF_SMALL, "orders")))._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for x in plan.splitlines() if "Exchange" in x]
    assert exchanges and not any("o_orderkey" in x or "value" in x for x in exchanges)


def plain_top(rows, width, k):
    out = set()
    for i in range(width):
        freq = collections.Counter(str(r[i]) for r in rows if r[i] is not None)
        out |= {(i, p + 1, v, n) for p, (v, n) in enumerate(sorted(freq.items(), key=lambda x: (-x[1], x[0]))[:k])}
    return out


@pytest.mark.parametrize("seed,buckets,fullest", [(0, 8, 2), (1, 64, 4), (2, 1 << 14, 64)])
def test_top_values_are_exact(spark, seed, buckets, fullest):
    rng = random.Random(seed)
    skewed = lambda: f"v{min(int(rng.paretovariate(0.8)), 400)}"
    rows = [(skewed(), rng.choice([None, "x", "X", ""]), i, None, rng.randrange(50)) for i in range(3000)]
    df = spark.createDataFrame(rows, "a string, b string, c int, d string, e int").repartition(6)
    found = sketches.top_values(df, 5, buckets, fullest).collect()
    assert {(r.column_no, r.place, r.value, r.freq) for r in found} == plain_top(rows, 5, 5)
    ways = {r.column_no: r.counted for r in found}
    assert ways[1] == "summary" and ways[2] == "exact" if buckets > 64 else True


def test_skewed_values_need_no_second_look(spark):
    df = spark.range(40_000).selectExpr("case when id % 3 > 0 then concat('hot', cast(id % 7 as string)) else cast(id as string) end v")
    found = sketches.top_values(df).collect()
    assert {r.counted for r in found} == {"summary"} and all(r.value.startswith("hot") for r in found)


def test_odd_tables(spark):
    none = spark.createDataFrame([], "a string, b int")
    assert sketches.top_values(none).count() == 0
    assert [(r.column_name, r.sample_rows, r.distinct_estimate) for r in sketches.profile_sketched(none).collect()] == [("a", 0, 0), ("b", 0, 0)]
    nulls = spark.createDataFrame([(None, 1), (None, 1)], "a string, b int")
    got = {r.column_name: r for r in sketches.profile_sketched(nulls).collect()}
    assert got["a"].null_count == 2 and got["a"].sample_values is None and got["b"].sample_values == "1 (2)"


def test_case_blind_profile(spark):
    rows = [("a ",), ("A",), ("b",), ("B ",), ("B ",), (None,), ("é",), ("É",), (" a",), ("",), (" ",)]
    got = profile.profile_columns(spark.createDataFrame(rows, "s string"), case_blind=True).first()
    assert (got.distinct_count, got.null_count, got.sample_values) == (5, 1, "B  (3),  (2), A (2), É (2),  a (1)")
    assert profile.profile_columns(spark.createDataFrame(rows, "s string")).first().distinct_count == 9
