"""Shapes of the physical plans."""

import re

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from medloom.operators.health import HEALTH
from medloom.operators.profile import profile_columns
from medloom.operators.standardize import STANDARDIZE
from medloom.plans import queries as Q
from medloom.sources.raw import raw_table
from medloom.sources.tables import table

COMPILED_SIZE = 8000  # longer methods are never compiled by the JVM


def explained(df, mode="formatted"):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Raw tables as text files would arrive, without the adapters in the plan."""
    out = {}
    for entity in STANDARDIZE:
        path = str(tmp_path_factory.mktemp("raw") / entity)
        raw_table(spark, SF_SMALL, f"raw_{entity}").write.parquet(path)
        out[entity] = spark.read.parquet(path)
    return out


@pytest.mark.parametrize("entity", sorted(STANDARDIZE))
def test_standardizing_is_one_map_stage_of_compiled_code(stored, entity):
    df = STANDARDIZE[entity](stored[entity])
    plan = explained(df)
    assert "Exchange" not in plan and "Python" not in plan and "Generate" not in plan
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", explained(df, "codegen"))]
    assert sizes and max(sizes) < COMPILED_SIZE


@pytest.mark.parametrize("entity", sorted(STANDARDIZE))
def test_registered_standardizing_has_no_exchange(spark, entity):
    assert "Exchange" not in explained(Q.QUERIES[f"std_{entity}"](spark, SF_SMALL))


def test_profile_counts_once(spark):
    """Counts and top values read one exchange of (column, value) counts."""
    df = profile_columns(table(spark, SF_SMALL, "orders"))
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]
    keyed = [x for x in final.splitlines() if re.search(r"Exchange hashpartitioning\(column_no#\d+, value#\d+", x)]
    assert len(keyed) == 2 and sum("ReusedExchange" in x for x in keyed) == 1


def test_stay_lengths_parse_dates_once(spark):
    def patterns(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace")

    for name in ("kpi_los_monthly", "kpi_occupancy", "kpi_readmit_30d"):
        assert patterns(Q.QUERIES[name](spark, SF_SMALL)) <= patterns(Q.QUERIES["std_admissions"](spark, SF_SMALL)), name


@pytest.mark.parametrize("entity", sorted(STANDARDIZE))
def test_health_is_one_aggregate(spark, stored, entity):
    df = HEALTH[entity](STANDARDIZE[entity](stored[entity]), Q.AS_OF[entity])
    plan = explained(df, "simple")
    assert plan.count("Exchange") == 1 and plan.count("Scan parquet") == 1


def test_health_reads_only_its_columns(stored):
    plan = explained(HEALTH["billing"](STANDARDIZE["billing"](stored["billing"]), Q.AS_OF["billing"]))
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert sorted(x.split(":")[0] for x in schema.split(",")) == ["bill_date", "bill_id", "patient_due", "total_amount"]


def test_profile_cuts_top_values_before_the_shuffle(spark):
    plan = explained(profile_columns(table(spark, SF_SMALL, "orders")), "simple")
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_filters_on_final_dates_do_not_multiply(stored):
    """A filter on imputed dates is copied below the projections; it must stay of moderate size."""
    df = STANDARDIZE["admissions"](stored["admissions"]).filter(
        (F.col("discharge_date_final") > F.col("admission_date_final")) & (F.col("discharge_status") != "Expired")
    )
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") < 120


def test_no_cross_joins_in_any_query(spark):
    eager = {"metrics_append", "metrics_run_read", "export_csv", "dim_patients_latest"}
    for name, query in Q.QUERIES.items():
        if name in eager:
            continue
        plan = explained(query(spark, SF_SMALL), "simple")
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
