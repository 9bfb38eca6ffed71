"""Dates and keys are read by one expression each, which Spark compiles and a filter does not double; tables are treated at once."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from medloom.functions import dates as D
from medloom.functions import numbers as N
from medloom.operators import health_daily
from medloom.operators.standardize import STANDARDIZE
from medloom.plans.queries import AS_OF

NAMES = {
    "admissions": ("admission_id", "admission_date", "patient_id", "hospital_id", "department_id", "discharge_date", "admission_type", "discharge_status", "length_of_stay", "room_number", "attending_physician"),
    "diagnoses": ("diagnosis_id", "admission_id", "diagnosis_date", "icd_code", "diagnosis_type", "diagnosis_description"),
    "procedures": ("procedure_id", "admission_id", "provider_id", "cpt_code", "procedure_description", "procedure_date", "procedure_cost"),
}
KEYS = {"admissions": 1, "diagnoses": 2, "procedures": 2}
ALL_MONTHS = "|jan01feb02mar03apr04may05jun06jul07aug08sep09oct10nov11dec12"


@pytest.mark.parametrize("entity", sorted(NAMES))
def test_partial_results_compile_and_read_keys_once(spark, tmp_path, entity):
    path = str(tmp_path / "raw")
    spark.createDataFrame([tuple("1" for _ in NAMES[entity])], ", ".join(f"{n} string" for n in NAMES[entity])).write.parquet(path)
    plan = health_daily.partial(entity, STANDARDIZE[entity](spark.read.parquet(path)))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan
    assert plan.partition("Filter ")[2].count("[0-9]{1,10}") == KEYS[entity]


@pytest.mark.parametrize("classes, text, expected", [
    (D.DIAGNOSIS_CLASSES, "1 2 - 0 5 - 2 9", dt.date(2029, 5, 12)), (D.DIAGNOSIS_CLASSES, "5-13-30", dt.date(1930, 5, 13)),
    (D.DIAGNOSIS_CLASSES, "3 - 4 - 99", dt.date(1999, 4, 3)), (D.DIAGNOSIS_CLASSES, "3-4-99|1920", None), (D.DIAGNOSIS_CLASSES, "31-02-21", None),
    (D.DIAGNOSIS_CLASSES, "2021-02-03 1:02:03.5", dt.date(2021, 2, 3)), (D.DIAGNOSIS_CLASSES, "1-2" + " " * 5000 + "x", None), (D.DIAGNOSIS_CLASSES, "20 21-02-03", None),
    (D.STAY_CLASSES, "sEPTEMBER 9 2021", dt.date(2021, 9, 9)), (D.STAY_CLASSES, "Sept 9, 2021", None), (D.STAY_CLASSES, "may 31,2021", dt.date(2021, 5, 31)),
    (D.STAY_CLASSES, "Jan 3, 2021" + ALL_MONTHS, None), (D.STAY_CLASSES, "2021-01-03" + ALL_MONTHS, None), (D.STAY_CLASSES, ALL_MONTHS, None),
    (D.PROCEDURE_CLASSES, "3 dec-2021", dt.date(2021, 12, 3)), (D.PROCEDURE_CLASSES, "Dec 3 2021 11:05 pm", dt.date(2021, 12, 3)),
    (D.PROCEDURE_CLASSES, "02/13/2021", dt.date(2021, 2, 13)), (D.PROCEDURE_CLASSES, "13.02.2021", dt.date(2021, 2, 13)),
    (D.BIRTH_CLASSES, "Jan 3, 2021", None), (D.TEST_CLASSES, "", None), (D.TEST_CLASSES, None, None), (D.TEST_CLASSES, "20210203", None),
])
def test_dates(spark, classes, text, expected):
    df = spark.createDataFrame([(text,)], "x string").repartition(1)
    assert df.select(D.parse_date(D.date_text(F.col("x")), classes)).head()[0] == expected


def test_procedure_codes_from_numbers(spark):
    texts = ["7", "0", "-0", "-1", "99999", "99999.999994", "1.00001", "0.00001", "100000", "00012.000", None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string").repartition(2)
    found = [r[1] for r in sorted(df.select("i", N.cpt_code(N.cpt_number(F.col("x")))).collect())]
    assert found == ["00007", "00000", "00000", None, "99999", None, None, None, None, "00012", None, None]


def test_tables_are_treated_at_once(spark, tmp_path):
    """Each table's rows wait for the other's; one table after the other would never go on."""
    both = threading.Barrier(2, timeout=30)

    def rows(entity):
        raw = spark.createDataFrame([tuple("1" for _ in NAMES[entity])], ", ".join(f"{n} string" for n in NAMES[entity]))
        return lambda: both.wait() is not None and STANDARDIZE[entity](raw)

    path, names = str(tmp_path / "stored"), ("diagnoses", "procedures")
    health_daily.add_all(path, {e: rows(e) for e in names}, "d0")
    found = health_daily.run_all(spark, path, {e: {"d0": None, "d1": rows(e)} for e in names}, AS_OF).collect()
    assert [r.value_num for r in found if r.metric == "rowcount_metadata"] == [2, 2]
    assert [r.object_name for r in found] == sorted(r.object_name for r in found)


def test_a_table_that_fails_is_reported(spark, tmp_path):
    def broken():
        raise ValueError("no rows")

    with pytest.raises(ValueError, match="no rows"):
        health_daily.add_all(str(tmp_path), {"diagnoses": broken}, "d0")
