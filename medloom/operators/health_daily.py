"""Health metrics from partial results: a run reads only the deliveries it has not seen.

Every metric is a count, a sum, or a mean (a sum and a count) over rows of a window of days. All of them add up over
any split of the rows, so a delivery of a table is reduced once to one row per day of its dates, a few numbers wide,
and stored. The metrics of any day, for windows of any length, are sums over stored rows. A delivery that is sent again
replaces its stored rows. What is stored grows with the number of days in the deliveries, not with their rows.

The numbers and their texts equal those of ``health``, which reads whole tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from medloom.operators.dimension import _Folder
from medloom.operators.health import EXPERIENCED_YEARS, HIGH_OCCUPANCY, OBJECT_NAMES

c = F.col

#: Tables treated at once: while the last tasks of one table's job run, those of the next fill the cores.
AT_ONCE = 4


@dataclass(frozen=True)
class Measure:
    """``kind`` is 'count', 'sum' or 'mean'; a row counts if it meets ``where``; values are cast to ``type``."""

    name: str
    kind: str
    where: Callable[[], Column] = lambda: F.lit(True)
    value: str | None = None
    type: str = "bigint"

    def number(self) -> Column:
        """How many rows count."""
        met = self.where() if self.kind != "mean" else self.where() & c(self.value).try_cast(self.type).isNotNull()
        return F.count_if(met)

    def total(self) -> Column:
        zero = F.lit(0).cast(self.type)
        return F.coalesce(F.sum(F.when(self.where(), F.coalesce(c(self.value).try_cast(self.type), zero)).otherwise(zero)), zero)


@dataclass(frozen=True)
class Plan:
    """The measures of a table, and the date and days of their window; without a date they cover all rows."""

    measures: tuple[Measure, ...]
    day: str | None = None
    days: int = 0


def _no_gender() -> Column:
    return c("gender").isNull() | c("gender").isin("Unknown", "NA")


# Names, dates and windows of the metrics.
PLANS: dict[str, Plan] = {
    "admissions": Plan((Measure("admissions_last_30d", "count"), Measure("avg_los_last_30d", "mean", value="length_of_stay", type="decimal(18,4)")), "admission_date", 30),
    "billing": Plan(tuple(Measure(f"{x}_last_30d", "sum", value=x, type="decimal(19,4)") for x in ("total_amount", "patient_due")), "bill_date", 30),
    "departments": Plan((
        Measure("high_occupancy_units", "count", lambda: c("avg_occupancy") >= F.lit(HIGH_OCCUPANCY).cast("decimal(9,4)")),
        Measure("beds_high_occupancy", "sum", lambda: c("avg_occupancy") >= F.lit(HIGH_OCCUPANCY).cast("decimal(9,4)"), "bed_count"),
    )),
    "diagnoses": Plan((Measure("diagnoses_last_90d", "count"), Measure("null_icd_last_90d", "count", lambda: c("icd_code").isNull())), "diagnosis_date", 90),
    "hospitals": Plan((Measure("beds_total", "sum", value="total_beds"), Measure("avg_icu_pct_recent", "mean", value="icu_percentage", type="decimal(5,2)"))),
    "lab_results": Plan((Measure("lab_results_last_30d", "count"), Measure("avg_result_value_last_30d", "mean", value="result_value", type="decimal(18,6)")), "test_date", 30),
    "patients": Plan((Measure("rows_last_30d", "count"), Measure("null_gender_last_30d", "count", _no_gender)), "created_date", 30),
    "procedures": Plan((Measure("procedures_last_90d", "count"), Measure("null_cpt_last_90d", "count", lambda: c("cpt_code").isNull())), "procedure_date", 90),
    "providers": Plan((Measure("active_providers", "count"), Measure("avg_experience_ge5", "mean", lambda: c("years_experience") >= EXPERIENCED_YEARS, "years_experience", "decimal(18,2)"))),
}


def partial(entity: str, std: DataFrame) -> DataFrame:
    """One row per day of a table's date, NULL for rows without one: day, rows, and numbers and totals of its measures."""
    plan = PLANS[entity]
    day = c(plan.day).cast("date") if plan.day else F.lit(None).cast("date")
    sums = [F.count(F.lit(1)).alias("rows")]
    for m in plan.measures:
        sums.append(m.number().alias(f"{m.name}_n"))
        if m.value:
            sums.append(m.total().cast(_stored(m)).alias(f"{m.name}_s"))
    return std.groupBy(day.alias("day")).agg(*sums)


def _stored(m: Measure) -> str:
    """The type of a sum, as Spark types sums of the measure's values."""
    if m.type == "bigint":
        return m.type
    precision, scale = (int(x) for x in m.type[8:-1].split(","))
    return f"decimal({min(38, precision + 10)},{scale})"


def schema_of(entity: str) -> str:
    parts = ["day date", "rows bigint"]
    for m in PLANS[entity].measures:
        parts.append(f"{m.name}_n bigint")
        if m.value:
            parts.append(f"{m.name}_s {_stored(m)}")
    return ", ".join(parts)


def metrics(entity: str, stored: DataFrame, as_of: dt.date, upper_bound: bool = False) -> DataFrame:
    """The metrics of a day from stored rows, in the form of ``health``."""
    plan = PLANS[entity]
    inside = F.lit(True)
    if plan.day:
        inside = c("day") >= F.date_sub(F.lit(as_of), plan.days)
        inside = inside & (c("day") <= F.lit(as_of)) if upper_bound else inside
    wide, names, decimals = [F.coalesce(F.sum("rows"), F.lit(0)).cast("string").alias("rowcount_metadata")], ["rowcount_metadata"], []
    for m in plan.measures:
        n = F.coalesce(F.sum(F.when(inside, c(f"{m.name}_n"))), F.lit(0))
        value = n
        if m.value:
            total = F.coalesce(F.sum(F.when(inside, c(f"{m.name}_s"))), F.lit(0).cast(m.type)).cast(_stored(m))
            mean = F.when(n > 0, (total / F.nullif(n, F.lit(0))).cast("decimal(38,6)")).otherwise(F.lit(0).cast("decimal(38,6)"))
            value = total if m.kind == "sum" else mean
        wide.append(value.cast("string").alias(m.name))
        names.append(m.name)
        if m.type != "bigint":
            decimals.append(m.name)
    long = stored.agg(*wide).unpivot([], names, "metric", "value_text")
    kind = F.when(c("metric").isin(decimals), F.lit("decimal")).otherwise(F.lit("bigint")) if decimals else F.lit("bigint")
    return long.select(
        F.lit(OBJECT_NAMES[entity]).alias("object_name"), "metric", F.round(c("value_text").cast("double"), 6).alias("value_num"), "value_text", kind.alias("value_type")
    )


def _place(path: str, entity: str, delivery: str) -> str:
    return f"{entity}/delivery={delivery}"


def known(spark: SparkSession, path: str, entity: str) -> list[str]:
    """The deliveries whose partial results are stored. One that was being written when its job died is not."""
    folder = _Folder(spark, path)
    names = [n.removeprefix("delivery=") for n in folder.names(entity) if n.startswith("delivery=")]
    return sorted(n for n in names if "_SUCCESS" in folder.names(_place(path, entity, n)))


def add(path: str, entity: str, std: DataFrame, delivery: str) -> None:
    """Store the partial results of a delivery, in place of earlier ones of that name."""
    partial(entity, std).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{_place(path, entity, delivery)}")


def _each(work: Callable, items: Iterable[tuple]) -> list:
    """The results of ``work`` for each item, in order."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        started = [pool.submit(inheritable_thread_target(work), *item) for item in items]
        return [s.result() for s in started]


def add_all(path: str, rows: Mapping[str, Callable[[], DataFrame]], delivery: str) -> None:
    """Store the partial results of a delivery of several tables."""
    _each(lambda entity, std: add(path, entity, std(), delivery), rows.items())


def stored(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """The partial results of all complete deliveries."""
    places = [f"{path.rstrip('/')}/{_place(path, entity, d)}" for d in known(spark, path, entity)]
    if not places:
        return spark.createDataFrame([], schema_of(entity))
    return spark.read.schema(schema_of(entity)).parquet(*places)


def run(spark: SparkSession, path: str, entity: str, deliveries: Mapping[str, Callable[[], DataFrame]], as_of: dt.date, upper_bound: bool = False) -> DataFrame:
    """The metrics of a day over all deliveries, of which only those not stored yet are read.

    ``deliveries`` names each delivery and how to get its standardized rows; names are used in paths.
    """
    seen = set(known(spark, path, entity))
    for name, rows in deliveries.items():
        if name not in seen:
            add(path, entity, rows(), name)
    return metrics(entity, stored(spark, path, entity), as_of, upper_bound)


def run_all(spark: SparkSession, path: str, deliveries: Mapping[str, Mapping[str, Callable[[], DataFrame]]], as_of: Mapping[str, dt.date]) -> DataFrame:
    """The metrics of all given tables as one set, sorted by object and metric."""
    parts = _each(lambda entity, of: run(spark, path, entity, of, as_of[entity]), deliveries.items())
    return reduce(DataFrame.unionByName, parts).orderBy("object_name", "metric")
