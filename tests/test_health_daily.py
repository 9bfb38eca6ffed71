"""Health metrics from partial results: equal to whole-table runs, and only new deliveries are read."""

import datetime as dt
import re

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from medloom.operators import health, health_daily, metriclog
from medloom.plans import queries as Q


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("entity", sorted(health_daily.PLANS))
def test_any_split_gives_the_whole(spark, tmp_path, entity):
    std = Q.std(spark, SF_SMALL, entity)
    path = str(tmp_path)
    key = F.xxhash64(*[c for c in std.columns])
    for i in range(3):
        health_daily.add(path, entity, std.filter(F.pmod(key, F.lit(3)) == i), f"d{i}")
    found = health_daily.stored(spark, path, entity)
    day = Q.AS_OF[entity]
    for as_of in (day, day - dt.timedelta(days=45), day + dt.timedelta(days=400)):
        assert rows_of(health_daily.metrics(entity, found, as_of)) == rows_of(health.HEALTH[entity](std, as_of))
    bounded = rows_of(health_daily.metrics(entity, found, day - dt.timedelta(days=45), upper_bound=True))
    assert bounded == rows_of(health.HEALTH[entity](std, day - dt.timedelta(days=45), upper_bound=True))


def test_a_second_run_reads_new_deliveries_only(spark, tmp_path):
    std = Q.std(spark, SF_SMALL, "billing")
    source, path, read = str(tmp_path / "bills"), str(tmp_path / "store"), []
    std.withColumn("arrived", F.col("bill_id") % 3).write.partitionBy("arrived").parquet(source)

    def delivery(i):
        def get():
            df = spark.read.parquet(source).filter(F.col("arrived") == i).drop("arrived")
            plan = health_daily.partial("billing", df)._jdf.queryExecution().executedPlan().toString()
            assert re.search(rf"PartitionFilters: \[isnotnull\(arrived#\d+\), \(arrived#\d+ = {i}\)\]", plan)
            read.append(i)
            return df

        return get

    whole = {f"d{i}": delivery(i) for i in range(3)}
    health_daily.run(spark, path, "billing", {k: whole[k] for k in ("d0", "d1")}, Q.AS_OF["billing"]).collect()
    read.clear()
    found = health_daily.run(spark, path, "billing", whole, Q.AS_OF["billing"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert read == [2] and source not in plan
    assert rows_of(found) == rows_of(health.health_billing(std, Q.AS_OF["billing"]))


def test_a_delivery_sent_again_replaces_itself_and_a_broken_one_is_made_again(spark, tmp_path):
    std, path = Q.std(spark, SF_SMALL, "admissions"), str(tmp_path)
    for rows in (std.limit(10), std):
        health_daily.add(path, "admissions", rows, "d0")
    (tmp_path / "admissions" / "delivery=d1").mkdir()
    (tmp_path / "admissions" / "delivery=d1" / "half.parquet").write_bytes(b"x")
    assert health_daily.known(spark, path, "admissions") == ["d0"]
    found = health_daily.run(spark, path, "admissions", {"d1": lambda: std.limit(0)}, Q.AS_OF["admissions"])
    assert rows_of(found) == rows_of(health.health_admissions(std, Q.AS_OF["admissions"]))


def test_nothing_delivered(spark, tmp_path):
    for entity in health_daily.PLANS:
        empty = Q.std(spark, SF_SMALL, entity).limit(0)
        found = health_daily.metrics(entity, health_daily.stored(spark, str(tmp_path), entity), Q.AS_OF[entity])
        assert rows_of(found) == rows_of(health.HEALTH[entity](empty, Q.AS_OF[entity]))


def test_a_run_is_found_without_reading_other_days(spark, tmp_path):
    path = str(tmp_path / "log")
    metrics = health.health_departments(Q.std(spark, SF_SMALL, "departments"))
    for i in range(3):
        metriclog.append_metrics(metrics, path, f"run-{i}", dt.datetime(2024, 2, 1 + i, 2))
    found = metriclog.read_run(spark, path, "run-1")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_date" in plan or "run_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert found.count() == metrics.count() and metriclog.days_of_run(spark, path, "run-1") == [dt.date(2024, 2, 2)]
    assert metriclog.read_run(spark, path, "run-1", dt.date(2024, 2, 1)).count() == 0
    assert metriclog.read_run(spark, path, "no such run").count() == 0
