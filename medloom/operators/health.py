"""Data-quality metrics per standardized table, in long form.

Each table gives three metrics out of one aggregate, so a run reads each table once and only the three or
four columns the metrics need. Partial sums leave every task as one row; nothing else is shuffled.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Object names in the metric log.
OBJECT_NAMES = {
    "admissions": "stg_optimized.admissions_std",
    "billing": "stg_optimized.billing_std",
    "departments": "stg_optimized.departments_std",
    "diagnoses": "stg_optimized.diagnoses_std",
    "hospitals": "stg_optimized.hospitals_std",
    "lab_results": "stg_optimized.lab_results_std",
    "patients": "stg_optimized.patients_std",
    "procedures": "stg_optimized.procedures_std",
    "providers": "stg_optimized.providers_std",
}
HIGH_OCCUPANCY = 0.85
EXPERIENCED_YEARS = 5


def _since(name: str, as_of: dt.date, days: int, upper_bound: bool) -> Column:
    """Rolling window test. Future dates count unless ``upper_bound`` is set."""
    day = F.col(name).cast("date")
    inside = day >= F.date_sub(F.lit(as_of), days)
    return inside & (day <= F.lit(as_of)) if upper_bound else inside


def _rows() -> Column:
    return F.count(F.lit(1))


def _sum_where(condition: Column, value: Column, kind: str) -> Column:
    zero = F.lit(0).cast(kind)
    total = F.sum(F.when(condition, F.coalesce(value.try_cast(kind), zero)).otherwise(zero))
    return F.coalesce(total, zero)


def _mean_where(condition: Column, value: Column, kind: str) -> Column:
    """Sum by count over rows that meet the condition and have a value that fits; 0 when there is none."""
    n = F.count_if(condition & value.try_cast(kind).isNotNull())
    total = _sum_where(condition, value, kind)
    return F.when(n > 0, (total / F.nullif(n, F.lit(0))).cast("decimal(38,6)")).otherwise(
        F.lit(0).cast("decimal(38,6)")
    )


def _long(df: DataFrame, entity: str, metrics: dict[str, Column], decimals: tuple[str, ...] = ()) -> DataFrame:
    wide = df.agg(*[metric.cast("string").alias(name) for name, metric in metrics.items()])
    long = wide.unpivot([], list(metrics), "metric", "value_text")
    kind = F.when(F.col("metric").isin(list(decimals)), F.lit("decimal")) if decimals else F.lit(None)
    return long.select(
        F.lit(OBJECT_NAMES[entity]).alias("object_name"),
        "metric",
        F.round(F.col("value_text").cast("double"), 6).alias("value_num"),
        "value_text",
        F.coalesce(kind, F.lit("bigint")).alias("value_type"),
    )


def health_patients(std: DataFrame, as_of: dt.date, upper_bound: bool = False) -> DataFrame:
    recent = _since("created_date", as_of, 30, upper_bound)
    no_gender = F.col("gender").isNull() | F.col("gender").isin("Unknown", "NA")
    return _long(std, "patients", {
        "rowcount_metadata": _rows(),
        "rows_last_30d": F.count_if(recent),
        "null_gender_last_30d": F.count_if(recent & no_gender),
    })


def health_admissions(std: DataFrame, as_of: dt.date, upper_bound: bool = False) -> DataFrame:
    recent = _since("admission_date", as_of, 30, upper_bound)
    return _long(std, "admissions", {
        "rowcount_metadata": _rows(),
        "admissions_last_30d": F.count_if(recent),
        "avg_los_last_30d": _mean_where(recent, F.col("length_of_stay"), "decimal(18,4)"),
    }, ("avg_los_last_30d",))


def health_billing(std: DataFrame, as_of: dt.date, upper_bound: bool = False) -> DataFrame:
    recent = _since("bill_date", as_of, 30, upper_bound)
    return _long(std, "billing", {
        "rowcount_metadata": _rows(),
        "total_amount_last_30d": _sum_where(recent, F.col("total_amount"), "decimal(19,4)"),
        "patient_due_last_30d": _sum_where(recent, F.col("patient_due"), "decimal(19,4)"),
    }, ("total_amount_last_30d", "patient_due_last_30d"))


def health_diagnoses(std: DataFrame, as_of: dt.date, upper_bound: bool = False) -> DataFrame:
    recent = _since("diagnosis_date", as_of, 90, upper_bound)
    return _long(std, "diagnoses", {
        "rowcount_metadata": _rows(),
        "diagnoses_last_90d": F.count_if(recent),
        "null_icd_last_90d": F.count_if(recent & F.col("icd_code").isNull()),
    })


def health_procedures(std: DataFrame, as_of: dt.date, upper_bound: bool = False) -> DataFrame:
    recent = _since("procedure_date", as_of, 90, upper_bound)
    return _long(std, "procedures", {
        "rowcount_metadata": _rows(),
        "procedures_last_90d": F.count_if(recent),
        "null_cpt_last_90d": F.count_if(recent & F.col("cpt_code").isNull()),
    })


def health_lab_results(std: DataFrame, as_of: dt.date, upper_bound: bool = False) -> DataFrame:
    recent = _since("test_date", as_of, 30, upper_bound)
    return _long(std, "lab_results", {
        "rowcount_metadata": _rows(),
        "lab_results_last_30d": F.count_if(recent),
        "avg_result_value_last_30d": _mean_where(recent, F.col("result_value"), "decimal(18,6)"),
    }, ("avg_result_value_last_30d",))


def health_providers(std: DataFrame, as_of: dt.date | None = None, upper_bound: bool = False) -> DataFrame:
    years = F.col("years_experience")
    return _long(std, "providers", {
        "rowcount_metadata": _rows(),
        "active_providers": _rows(),
        "avg_experience_ge5": _mean_where(years >= EXPERIENCED_YEARS, years, "decimal(18,2)"),
    }, ("avg_experience_ge5",))


def health_departments(
    std: DataFrame, as_of: dt.date | None = None, upper_bound: bool = False, threshold: float = HIGH_OCCUPANCY
) -> DataFrame:
    """``threshold`` is a fraction, as the source rule has it."""
    high = F.col("avg_occupancy") >= F.lit(threshold).cast("decimal(9,4)")
    return _long(std, "departments", {
        "rowcount_metadata": _rows(),
        "high_occupancy_units": F.count_if(high),
        "beds_high_occupancy": _sum_where(high, F.col("bed_count"), "bigint"),
    })


def health_hospitals(std: DataFrame, as_of: dt.date | None = None, upper_bound: bool = False) -> DataFrame:
    return _long(std, "hospitals", {
        "rowcount_metadata": _rows(),
        "beds_total": _sum_where(F.lit(True), F.col("total_beds"), "bigint"),
        "avg_icu_pct_recent": _mean_where(F.lit(True), F.col("icu_percentage"), "decimal(5,2)"),
    }, ("avg_icu_pct_recent",))


HEALTH = {
    "admissions": health_admissions,
    "billing": health_billing,
    "departments": health_departments,
    "diagnoses": health_diagnoses,
    "hospitals": health_hospitals,
    "lab_results": health_lab_results,
    "patients": health_patients,
    "procedures": health_procedures,
    "providers": health_providers,
}


def health_all(std: dict[str, DataFrame], as_of: dt.date | dict[str, dt.date]) -> DataFrame:
    """Every metric of every given table as one long set, sorted by object and metric.

    ``as_of`` is one date, or one per table where their data end on different days.
    """
    parts = [
        HEALTH[entity](df, as_of[entity] if isinstance(as_of, dict) else as_of) for entity, df in std.items()
    ]
    return reduce(DataFrame.unionByName, parts).orderBy("object_name", "metric")
