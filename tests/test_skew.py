"""Measures and guards against plain Python on small inputs with very frequent keys and odd dates."""

import calendar
import datetime as dt
import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from medloom.operators import conform, deid, health, kpis, profile, quality, standardize
from medloom.operators.conform import conform_column, map_frame

D = dt.date
STAY = (
    "admission_id int, patient_id int, department_id int, discharge_status string, "
    "admission_date_final date, discharge_date_final date"
)


def stays(rng, n):
    rows = []
    for i in range(n):
        patient = 1 if rng.random() < 0.5 else rng.choice([None, 2, 3, 4, 5])
        begin = D(2020, 1, 1) + dt.timedelta(days=rng.choice([0, 0, 0, rng.randrange(400)]))
        end = None if rng.random() < 0.1 else begin + dt.timedelta(days=rng.choice([0, 0, 1, 5, 40, -3]))
        if rng.random() < 0.05:
            begin = None
        rows.append((i, patient, rng.choice([1, 1, 1, 2, None]), rng.choice(["Expired", "Discharged", "NA"]), begin, end))
    rng.shuffle(rows)
    return rows


def readmissions(rows, days=30):
    by_patient = defaultdict(list)
    for a, p, _, status, begin, end in rows:
        if p is not None and begin is not None:
            by_patient[p].append((begin, a, end, status))
    index, back = Counter(), Counter()
    for visits in by_patient.values():
        visits.sort(key=lambda v: (v[0], v[1]))
        for i, (_, _, end, status) in enumerate(visits):
            if end is None or status == "Expired":
                continue
            month = end.replace(day=1)
            index[month] += 1
            if i + 1 < len(visits) and 0 <= (visits[i + 1][0] - end).days <= days:
                back[month] += 1
    return {m: (n, back[m]) for m, n in index.items()}


def test_readmissions_with_a_hot_patient(spark):
    for seed in range(3):
        rows = stays(random.Random(seed), 600)
        df = spark.createDataFrame(rows, STAY).repartition(7)
        got = {r.discharge_month: (r.index_discharges, r.readmissions) for r in kpis.kpi_readmit_30d(df).collect()}
        assert got == readmissions(rows)


def test_readmission_window_is_bounded_by_days(spark):
    """All stays of one patient on one day become one row before any window."""
    rows = [(i, 1, 1, "Discharged", D(1900, 1, 1), D(1900, 1, 1)) for i in range(5000)]
    df = spark.createDataFrame(rows, STAY)
    got = kpis.kpi_readmit_30d(df).collect()
    assert [(r.index_discharges, r.readmissions) for r in got] == [(5000, 4999)]
    plan = kpis.kpi_readmit_30d(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1 and "SortAggregate" not in plan
    assert "HashAggregate" in plan[plan.index("Window [") :]


def occupancy(rows):
    days = Counter()
    for _, _, dept, _, begin, end in rows:
        if dept is None or begin is None or end is None:
            continue
        day = begin
        while day < end:
            days[dept, day.replace(day=1)] += 1
            day += dt.timedelta(days=1)
    return days


def test_occupancy(spark):
    rows = stays(random.Random(5), 500)
    rows.append((9001, 1, 1, "NA", D(2020, 3, 15), D(2023, 2, 2)))
    rows.append((9002, 1, 2, "NA", D(2018, 12, 31), D(2019, 1, 1)))
    departments = spark.createDataFrame([(1, 10), (2, 3), (2, 4)], "department_id smallint, bed_count smallint")
    got = kpis.kpi_occupancy(spark.createDataFrame(rows, STAY), departments).collect()
    expected = occupancy(rows)
    assert {(r.department_id, r.month): r.patient_days for r in got} == dict(expected)
    beds = {1: 10, 2: 7}
    for r in got:
        full = beds[r.department_id] * calendar.monthrange(r.month.year, r.month.month)[1]
        assert abs(r.occupancy - r.patient_days / full) < 1e-6


def test_occupancy_of_endless_stays_stays_small(spark):
    rows = [(i, 1, 1, "NA", D(2020, 1, 10), D(9999, 12, 31)) for i in range(2000)]
    departments = spark.createDataFrame([(1, 10)], "department_id smallint, bed_count smallint")
    got = kpis.kpi_occupancy(spark.createDataFrame(rows, STAY), departments)
    assert got.count() == (9999 - 2020) * 12 + 12
    assert got.filter("month = '2021-02-01'").first().patient_days == 2000 * 28


def test_prior_month_needs_the_calendar_month_before(spark):
    rows = [(D(2020, 1, 1), 5), (D(2020, 2, 1), 8), (D(2020, 4, 1), 2)]
    got = kpis.with_prior_month(spark.createDataFrame(rows, "m date, n int"), "m", "n", "prior").collect()
    assert sorted((r.m.month, r.n, r.prior) for r in got) == [(1, 5, None), (2, 8, 5), (4, 2, None)]


def test_top_codes_leave_out_small_cells(spark):
    codes = ["A123"] * 30 + ["B12.3"] * 11 + ["C129"] * 10 + [None] * 7
    diagnoses = spark.createDataFrame([(c,) for c in codes], "icd_code string")
    procedures = spark.createDataFrame([("00099",)] * 12, "cpt_code string")
    got = {(r.code_system, r.code): r for r in kpis.kpi_top_codes(diagnoses, procedures).collect()}
    assert set(got) == {("ICD", "A123"), ("ICD", "B12.3"), ("CPT", "00099")}
    assert got["ICD", "B12.3"].place == 2
    assert abs(got["ICD", "B12.3"].running_share - 41 / 51) < 1e-6


def test_suppression_blanks_dependents(spark):
    df = spark.createDataFrame([("a", 10, 1.0), ("b", 11, 2.0)], "k string, n int, m double")
    assert {tuple(r) for r in kpis.suppress_small(df, "n", ("m",)).collect()} == {("a", None, None), ("b", 11, 2.0)}


def test_latest_row_per_key_and_refresh(spark, tmp_path):
    rng = random.Random(2)
    schema = "patient_id int, created_date timestamp_ntz, area string"
    start = dt.datetime(2020, 1, 1)
    rows = [(1 if rng.random() < 0.5 else rng.randrange(2, 40), start + dt.timedelta(hours=i), f"a{i}") for i in range(300)]
    rows += [(None, start, "x"), (50, None, "y")]
    path = str(tmp_path / "dim")

    def latest(seen):
        best = {}
        for p, t, a in seen:
            if p is not None and (p not in best or (t or dt.datetime.min, a) > (best[p][0] or dt.datetime.min, best[p][1])):
                best[p] = (t, a)
        return {(p, t, a) for p, (t, a) in best.items()}

    seen = []
    for part in (rows[:100], rows[100:200], rows[200:]):
        seen += part
        quality.refresh_latest(path, spark.createDataFrame(part, schema), "patient_id", ("created_date",), buckets=8)
        got = {(r.patient_id, r.created_date, r.area) for r in spark.read.parquet(path).collect()}
        assert got == latest(seen)


def test_profile_of_hot_values_empty_and_null_columns(spark):
    rows = [(1, "x", None)] * 500 + [(i, f"v{i}", None) for i in range(200)] + [(None, None, None)] * 3
    df = spark.createDataFrame(rows, "a bigint, b string, c date").repartition(5)
    got = {r.column_name: r for r in profile.profile_columns(df).collect()}
    assert (got["a"].sample_rows, got["a"].null_count, got["a"].distinct_count) == (703, 3, 200)
    assert (got["a"].min_value, got["a"].max_value) == ("0", "199")
    assert got["a"].sample_values == "1 (501), 0 (1), 10 (1), 100 (1), 101 (1)"
    assert got["b"].sample_values.startswith("x (500), v0 (1), v1 (1)")
    assert (got["c"].null_count, got["c"].distinct_count, got["c"].sample_values) == (703, 0, None)
    empty = profile.profile_columns(df.limit(0)).collect()
    assert [(r.sample_rows, float(r.null_pct)) for r in empty] == [(0, 0.0)] * 3


def test_profile_range_is_exact_for_large_numbers_and_decimals(spark):
    big = 2**62
    df = spark.createDataFrame([(big, "-1.50"), (big + 1, "10"), (9, "9.25")], "a bigint, t string").select(
        "a", F.col("t").cast("decimal(5,2)").alias("d"), (F.col("a") > 9).alias("flag")
    )
    got = {r.column_name: r for r in profile.profile_columns(df).collect()}
    assert (got["a"].min_value, got["a"].max_value) == ("9", str(big + 1))
    assert (got["d"].min_value, got["d"].max_value) == ("-1.50", "10.00")
    assert (got["flag"].min_value, got["flag"].max_value) == ("0", "1")


def test_key_sample_is_repeatable_and_near_its_size(spark):
    df = spark.range(20000)
    first = {r.id for r in profile.sample_by_key(df, 0.1, ("id",)).collect()}
    again = {r.id for r in profile.sample_by_key(df.repartition(9), 0.1, ("id",)).collect()}
    assert first == again and 1700 < len(first) < 2300


def test_conform_keeps_rows_with_a_doubled_map(spark):
    lookup = map_frame(spark, {"a": "A"}).unionByName(map_frame(spark, {"a": "B", "b": "X"}))
    df = spark.createDataFrame([("a",), ("a",), ("c",), (None,)], "k string")
    got = sorted(str(r.out) for r in conform_column(df, "k", lookup, "out").collect())
    assert got == ["A", "A", "None", "Unmapped"]


def test_exclude_rows_keeps_rows_without_key(spark):
    df = spark.createDataFrame([(1, False), (2, True), (None, None), (3, None)], "k int, gone boolean")
    tests = spark.createDataFrame([(3,), (3,), (None,)], "k int")
    got = quality.exclude_rows(df, F.col("gone"), tests, "k").collect()
    assert sorted(str(r.k) for r in got) == ["1", "None"]


SPLIT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
}


@pytest.fixture
def small_partitions(spark):
    before = {k: spark.conf.get(k, None) for k in SPLIT}
    for k, v in SPLIT.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_frequent_and_missing_keys_are_split(spark, small_partitions):
    """Half of the rows have one key, a sixth has none."""
    key = F.when(F.col("id") % 2 == 0, 1).when(F.col("id") % 3 == 0, None).otherwise(F.col("id")).cast("string")
    df = spark.range(120_000).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    keys = spark.range(1, 120_000, 2).select(F.col("id").cast("string").alias("k"))
    pairs = keys.select(F.col("k").alias("source_value"), F.lit("x").alias("standard_value"))
    assert "skew=true" in final_plan(quality.with_match(df, keys, "k"))
    assert "skew=true" in final_plan(quality.exclude_rows(df, None, keys.filter("k <> '1'"), "k"))
    conformed = conform.conform(df, {"k": pairs})
    assert "skew=true" in final_plan(conformed) and conformed.count() == 120_000


def test_health_skips_values_that_do_not_fit(spark):
    labs = spark.createDataFrame(
        [(D(2024, 1, 29), Decimal("99999999999999.5")), (D(2024, 1, 29), Decimal("2.5"))], "test_date date, result_value decimal(18,4)"
    )
    values = {r.metric: r.value_num for r in health.health_lab_results(labs, D(2024, 1, 30)).collect()}
    assert values["avg_result_value_last_30d"] == 2.5 and values["lab_results_last_30d"] == 2
    bills = spark.createDataFrame(
        [(D(2024, 1, 29), Decimal("9999999999999999.99"), Decimal("1.00")), (D(2024, 1, 29), Decimal("3.00"), Decimal("9999999999999999.99"))],
        "bill_date date, total_amount decimal(18,2), patient_due decimal(18,2)",
    )
    values = {r.metric: r.value_num for r in health.health_billing(bills, D(2024, 1, 30)).collect()}
    assert values["total_amount_last_30d"] == 3 and values["patient_due_last_30d"] == 1


def test_shift_does_not_follow_from_exported_hashes(spark):
    ids = spark.range(3000).select(F.col("id").cast("int").alias("admission_id"))
    rows = ids.select(
        deid.hashed_encounter(F.col("admission_id"), "s").alias("h"), deid.hashed(F.col("admission_id"), "s").alias("p"),
        deid.shift_of(F.col("admission_id"), "s").alias("shift"),
    ).collect()
    for column in ("h", "p"):
        guessed = sum((int(r[column][:8], 16) % 7 - 3) == r["shift"] for r in rows)
        assert guessed < 0.2 * len(rows)  # one in seven by chance
    assert not {r["h"] for r in rows} & {r["p"] for r in rows}
    assert {r["shift"] for r in rows} == set(range(-3, 4))


def test_occupancy_counts_open_stays_and_unknown_departments(spark):
    stays = spark.createDataFrame(
        [(1, 1, 1, 'NA', D(2024, 1, 30), None), (2, 1, 9, 'NA', D(2024, 1, 1), D(2024, 1, 3)), (3, 1, 1, 'NA', D(2024, 3, 1), None)], STAY
    )
    departments = spark.createDataFrame([(1, 300)], "department_id int, bed_count int")
    got = {(r.department_id, r.month): (r.patient_days, r.beds) for r in kpis.kpi_occupancy(stays, departments, D(2024, 2, 3)).collect()}
    assert got == {(1, D(2024, 1, 1)): (2, 300), (1, D(2024, 2, 1)): (2, 300), (9, D(2024, 1, 1)): (2, None)}


def test_large_departments_stay(spark):
    names = ("department_id", "hospital_id", "dept_name", "hod", "bed_count", "avg_occupancy")
    raw = spark.createDataFrame([("300", "7", "icu", "x", "264", "0.5")], ", ".join(f"{n} string" for n in names))
    assert standardize.standardize_departments(raw).first().bed_count == 264
    assert standardize.standardize_departments(raw, source_limits=True).count() == 0
