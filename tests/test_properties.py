"""Any text may arrive in any column: no job fails, keys decide which rows stay, text stays clean."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from medloom.operators import metriclog, runlog
from medloom.operators import standardize as Z
from medloom.operators.health import HEALTH, health_all
from medloom.plans import queries as Q
from medloom.sources import writers
from medloom.sources.tables import all_text, read_text_csv

WORDS = st.one_of(
    st.none(),
    st.text(max_size=40),
    st.sampled_from(
        ["", "NULL", "n/a", "-", "—", "1,234", "1E3", "99999999999999999999", "-2147483648", "2147483648", "0.5.5", "٣",
         "31-02-2021", "2021-02-29", "9999-12-31", "0000-01-01", "Feb 30, 2021", "29.02.2021", "30-02-21", "Dr.",
         "dr", ",", " , ", "<<COMMA>>", "\\", "$1", "A12.3", "+5", "1e400", "NaN", "Infinity", "2021-01-01T25:00:00"]
    ),
    st.from_regex(r"[0-9]{1,4}[-/. ][0-9]{1,2}[-/. ][0-9]{1,4}", fullmatch=True),
)
COLUMNS = {
    "admissions": ("admission_id", "admission_date", "patient_id", "hospital_id", "department_id", "discharge_date",
                   "admission_type", "discharge_status", "length_of_stay", "room_number", "attending_physician"),
    "billing": ("bill_id", "admission_id", "bill_date", "payment_date", "payment_status", *Z.CHARGES),
    "departments": ("department_id", "hospital_id", "dept_name", "hod", "bed_count", "avg_occupancy"),
    "diagnoses": ("diagnosis_id", "admission_id", "diagnosis_date", "icd_code", "diagnosis_type", "diagnosis_description"),
    "hospitals": ("hospital_id", "hospital_name", "branch_location", "total_beds", *Z.HOSPITAL_BEDS, "icu_percentage",
                  "established_year", "accreditation"),
    "lab_results": ("lab_result_id", "admission_id", "test_date", "test_name", "result_value", "unit", "reference_range",
                    "status", "lab_technician"),
    "patients": tuple(Z.PATIENT_WIDTHS),
    "procedures": tuple(Z.PROCEDURE_WIDTHS),
    "providers": tuple(Z.PROVIDER_WIDTHS),
}


def frame(spark, entity, texts):
    rng = random.Random(3)
    names = COLUMNS[entity]
    rows = [tuple([str(i % 200)] + [rng.choice(texts) for _ in names[1:]]) for i in range(60)]
    rows += [tuple(rng.choice(texts) for _ in names) for _ in range(60)]
    return spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names))


@pytest.mark.parametrize("entity", sorted(COLUMNS))
@settings(max_examples=3, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(WORDS, min_size=30, max_size=60))
def test_no_text_makes_a_job_fail(spark, entity, texts):
    raw = frame(spark, entity, texts)
    rows = Z.STANDARDIZE[entity](raw).collect()
    assert len(rows) <= raw.count()
    if entity == "patients":
        assert len(rows) == raw.count()


def test_tables_standardized_twice_stay_the_same(spark):
    """Text columns are already in their final form the first time."""
    sf = "/root/testdata/sf0.001"
    once = Q.std(spark, sf, "providers")
    again = Z.standardize_providers(once.select(*[F.col(c).cast("string") for c in once.columns]))
    a = {(r.provider_id, r.specialty, r.years_experience) for r in once.collect()}
    b = {(r.provider_id, r.specialty, r.years_experience) for r in again.collect()}
    assert a == b


def test_health_has_27_rows_and_is_zero_without_rows(spark):
    empty = {e: df.filter("1 = 0") for e, df in Q.all_std(spark, "/root/testdata/sf0.001").items()}
    rows = health_all(empty, Q.AS_OF).collect()
    assert len(rows) == 27 and {r.value_num for r in rows} == {0.0}
    assert set(HEALTH) == set(empty)


def test_future_dates_count_unless_bounded(spark):
    std = spark.createDataFrame([("2001-08-01",), ("2030-01-01",), ("2001-07-01",)], "d string").select(
        F.col("d").cast("date").alias("diagnosis_date"), F.lit(None).cast("string").alias("icd_code")
    )
    def recent(**kw):
        rows = HEALTH["diagnoses"](std, Q.AS_OF["admissions"], **kw).collect()
        return {r.metric: r.value_num for r in rows}["diagnoses_last_90d"]
    assert recent() == 3.0 and recent(upper_bound=True) == 2.0


def test_run_log_keeps_runs_apart_and_measures_jobs(spark, tmp_path):
    path = str(tmp_path / "log")
    sf = "/root/testdata/sf0.001"
    frames = {"departments": Q.std(spark, sf, "departments"), "hospitals": Q.std(spark, sf, "hospitals")}
    at = dt.datetime(2024, 5, 1, 2)
    metriclog.append_metrics(runlog.measure(frames), path, "a", at)
    metriclog.append_metrics(HEALTH["hospitals"](frames["hospitals"]), path, "b", at + dt.timedelta(days=1))
    one = metriclog.read_run(spark, path, "a").collect()
    assert [r.object_name for r in one] == ["departments", "hospitals"]
    assert all(r.value_num > 0 and r.run_utc == at for r in one)
    assert metriclog.read_run(spark, path, "b", at.date()).count() == 0
    assert metriclog.read_run(spark, path, "b", at.date() + dt.timedelta(days=1)).count() == 3


def test_latest_run_matches_comment_and_from_clause(spark):
    rows = [
        ("/*bench:x;obj:stg.a*/ select 1", 5000, 9000, 7, 2, dt.datetime(2024, 1, 1), 1),
        ("SELECT * FROM stg.a WHERE 1=0", 1000, None, 3, 1, dt.datetime(2024, 1, 2), 2),
        ("select * from stg.other", 9, 9, 9, 9, dt.datetime(2024, 1, 3), 3),
    ]
    log = spark.createDataFrame(
        rows, "query_text string, cpu_us long, duration_us long, reads long, executions long, ended_at timestamp, log_id long"
    )
    got = {(r.object_name, r.metric): r.value_text for r in runlog.latest_run_stats(("stg.a", "stg.b"), log, {"stg.b": 12}).collect()}
    assert got == {
        ("stg.a", "timing:sample_recent"): "cpu_ms=1|elapsed_ms=NULL|logical_reads=3",
        ("stg.a", "timing:recent_aggregate"): "cpu_ms=3|elapsed_ms=9|logical_reads=5|exec_count=3",
        ("stg.b", "timing:sample_recent"): "cpu_ms=NULL|elapsed_ms=12|logical_reads=NULL",
    }


def test_csv_in_is_all_text_and_csv_out_reads_back(spark, tmp_path):
    path = str(tmp_path / "out")
    raw = spark.createDataFrame([("007", "1,5"), ("x", None)], "a string, b string")
    writers.export_csv(raw, path)
    back = read_text_csv(spark, path, ["a", "b"])
    assert sorted(back.collect()) == sorted(raw.collect())
    assert all_text(spark.range(1)).dtypes == [("id", "string")]


def test_run_log_of_many_objects(spark):
    objects = [f"stg.T{i}" for i in range(1500)] + ["", "a b"]
    texts = ["select 1 FROM stg.t12 x from stg.t12", "/*bench;obj:stg.t7*/ select 2", "/*bench;obj:stg.t77 */", "from\nstg.t5", "x from stg.t", "from from a b", ";obj:*/", None, "from ", "from stg.t1499\n;obj:a b*/"]
    rows = [(i, t, 1000, 2000, 3, 1, f"2024-01-{i + 1:02d}") for i, t in enumerate(texts)]
    log = spark.createDataFrame(rows, "log_id long, query_text string, cpu_us long, duration_us long, reads long, executions long, ended_at string")
    got = {r.object_name: r.value_text for r in runlog.latest_run_stats(objects, log).collect() if r.metric == "timing:recent_aggregate"}
    expected = {}
    for o in objects:
        n = sum(f";obj:{o.lower()}*/" in (t or "").lower() or f"from {o.lower()}" in (t or "").lower() for t in texts)
        if n:
            expected[o] = f"cpu_ms=1|elapsed_ms=2|logical_reads=3|exec_count={n}"
    assert got == expected and {"stg.T1", "stg.T12", "stg.T7", "stg.T1499", "", "a b"} <= set(got)
