"""Every registered query: a name and a function of (spark, sf_dir)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from medloom.functions import dates as D
from medloom.functions import folds as M
from medloom.functions import numbers as N
from medloom.functions import text as S
from medloom.operators import catalog, conform, deid, health, kpis, metriclog, quality, runlog
from medloom.operators.profile import profile_columns
from medloom.operators.standardize import STANDARDIZE
from medloom.sources import writers
from medloom.sources.raw import raw_table
from medloom.sources.shared import new_path, written
from medloom.sources.tables import publish_views, read_text_csv, table

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = {
    "admissions": dt.date(2001, 8, 1),
    "billing": dt.date(2001, 8, 1),
    "departments": dt.date(2001, 8, 1),
    "diagnoses": dt.date(2001, 11, 4),
    "hospitals": dt.date(2001, 8, 1),
    "lab_results": dt.date(2024, 1, 30),
    "patients": dt.date(2001, 8, 1),
    "procedures": dt.date(2001, 11, 4),
    "providers": dt.date(2001, 8, 1),
}
RUN_UTC = dt.datetime(2024, 2, 1, 2, 0, 0)
EXAMPLE_SALT = "example-salt"
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)
RUN_OBJECTS = ("click", "error", "purchase", "signup", "view", "missing_object")
FALLBACK_MS = {"missing_object": 7}


def std(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return STANDARDIZE[entity](raw_table(spark, sf_dir, f"raw_{entity}"))


def all_std(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {entity: std(spark, sf_dir, entity) for entity in STANDARDIZE}


def on_raw(
    raw: str, column: str, build: Callable[..., Column], alias: str,
    tokens: tuple[str, ...] = S.COMMON_TOKENS, prepare: Callable[..., Column] | None = None,
) -> Query:
    """One rule over one raw column: distinct (input, output) pairs with their row counts.

    Inputs are counted first, so a rule runs once per distinct text. ``prepare`` is a first step of the rule.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        cleaned = raw_table(spark, sf_dir, raw).select(S.clean_text(F.col(column)).alias("input"))
        inputs = (
            cleaned.select(S.null_tokens(F.col("input"), tokens).alias("input"))
            .groupBy("input")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        prepared = inputs.select("input", "n", (prepare or (lambda c: c))(F.col("input")).alias("prepared"))
        return prepared.select("input", build(F.col("prepared")).alias(alias), "n")

    return run


def parse_query(
    raw: str, column: str, classes: tuple[str, ...], tokens: tuple[str, ...] = S.COMMON_TOKENS,
    prepare: Callable[..., Column] = D.date_text,
) -> Query:
    return on_raw(raw, column, lambda c: D.parse_date(c, classes), "parsed", tokens, prepare)


def _std_query(entity: str) -> Query:
    return lambda spark, sf_dir: std(spark, sf_dir, entity)


def _health_query(entity: str) -> Query:
    return lambda spark, sf_dir: health.HEALTH[entity](std(spark, sf_dir, entity), AS_OF[entity])


def health_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.health_all(all_std(spark, sf_dir), AS_OF)


def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardized tables as views, then plain SQL over two of them."""
    publish_views({f"{e}_std": std(spark, sf_dir, e) for e in ("admissions", "billing")})
    return spark.sql(
        """select a.admission_type, count(*) as bills, cast(sum(b.total_amount) as decimal(38,2)) as amount
           from billing_std b join admissions_std a on a.admission_id = b.admission_id
           group by a.admission_type"""
    )


def metrics_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs appended to one log; the metrics are computed once."""
    path = new_path(spark, "metrics")
    metrics = written(health_all(spark, sf_dir), "health")
    for run, day in (("run-a", 0), ("run-b", 1)):
        metriclog.append_metrics(metrics, path, run, RUN_UTC + dt.timedelta(days=day))
    return metriclog.read_log(spark, path)


def metrics_run_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "metrics")
    log = raw_table(spark, sf_dir, "old_metric_log")
    log.write.mode("append").partitionBy("run_date").parquet(path)
    metriclog.index_runs(log, path)
    return metriclog.read_run(spark, path, "run-7")


def metrics_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metriclog.backfill_run_id(raw_table(spark, sf_dir, "old_metric_log"))


def table_rowcounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.table_rowcounts({n: table(spark, sf_dir, n) for n in TABLES})


def profile_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile of a tenth of the orders, as the caller asks."""
    return profile_columns(table(spark, sf_dir, "orders"), fraction=0.1, sample_key=("o_orderkey",))


def latest_run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.latest_run_stats(RUN_OBJECTS, raw_table(spark, sf_dir, "run_log"), FALLBACK_MS)


def semi_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Admissions that have a laboratory result."""
    return quality.with_match(std(spark, sf_dir, "admissions"), std(spark, sf_dir, "lab_results"), "admission_id")


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return std(spark, sf_dir, "admissions").orderBy("admission_date", "admission_id").limit(25)


def listagg_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per diagnosis type the five most frequent codes as one text, most frequent first."""
    counts = (
        std(spark, sf_dir, "diagnoses")
        .filter(F.col("icd_code").isNotNull())
        .groupBy("diagnosis_type", "icd_code")
        .agg(F.count(F.lit(1)).alias("freq"))
    )
    order = Window.partitionBy("diagnosis_type").orderBy(F.col("freq").desc(), "icd_code")
    top = counts.withColumn("place", F.row_number().over(order)).filter("place <= 5")
    return top.groupBy("diagnosis_type").agg(
        F.expr(
            "listagg(concat(icd_code, ' (', cast(freq as string), ')'), ', ') within group (order by freq desc, icd_code)"
        ).alias("top_codes")
    )


def export_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = kpis.kpi_labs(std(spark, sf_dir, "lab_results"), std(spark, sf_dir, "admissions")).select(
        "test_name", F.col("results").cast("string"), F.col("timed_results").cast("string")
    )
    path = new_path(spark, "export")
    writers.export_csv(result, path)
    return read_text_csv(spark, path, result.columns)


def _kpi(build: Callable[..., DataFrame], *entities: str) -> Query:
    return lambda spark, sf_dir: build(*[std(spark, sf_dir, e) for e in entities])


def department_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        S.sentence_case(F.col("n_name")).alias("source_value"), F.col("r_name").alias("standard_value")
    )


def cpt_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey").cast("string")
    return table(spark, sf_dir, "part").select(
        F.when(F.length(key) < 5, F.lpad(key, 5, "0")).otherwise(key).alias("source_value"),
        F.col("p_brand").alias("standard_value"),
    )


def icd_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of the catalogue's types; several entries per code, so the map needs reducing."""
    key = F.col("p_partkey")
    letter = F.char((F.lit(65) + key % 26).cast("int"))
    code = F.concat(letter, F.lpad((key % 100).cast("string"), 2, "0"), (key % 10).cast("string"))
    return table(spark, sf_dir, "part").select(
        code.alias("source_value"), F.col("p_type").alias("standard_value")
    )


# Example lookup maps.
GENDER_MAP = {"Male": "M", "Female": "F"}
PAYER_MAP = {"Government": "Public", "Private": "Commercial", "Self Pay": "Self", "Corporate": "Commercial"}
UNIT_MAP = {"mg/dL": "mg_dl"}


def _conform_one(entity: str, column: str, keys: tuple[str, ...], lookup: Callable[..., DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = std(spark, sf_dir, entity).select(*keys, column)
        return conform.conform(df, {column: lookup(spark, sf_dir)})

    return run


def _fixed(pairs: dict[str, str]) -> Callable[..., DataFrame]:
    return lambda spark, sf_dir: conform.map_frame(spark, pairs)


def conform_unmapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    patients = conform.conform(
        std(spark, sf_dir, "patients"),
        {"gender": conform.map_frame(spark, GENDER_MAP), "insurance_type": conform.map_frame(spark, PAYER_MAP)},
    )
    return conform.unmapped_counts(patients, ["gender", "insurance_type"])


def stays_with_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stay with its patient's columns. The patient side, one row per id, is written first, so that adaptive
    execution can split a patient with very many stays, and the stays without a patient."""
    one = written(quality.latest_per_key(std(spark, sf_dir, "patients"), "patient_id", ("created_date",)), "patients")
    return std(spark, sf_dir, "admissions").join(one, "patient_id", "left")


def deid_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deid.deid_export(
        stays_with_patients(spark, sf_dir), deid.STAY_POLICY, EXAMPLE_SALT, dt.date(2024, 1, 1)
    )


def deid_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return std(spark, sf_dir, "admissions").select(
        deid.hashed(F.col("patient_id"), EXAMPLE_SALT).alias("patient_hash"),
        deid.hashed_encounter(F.col("admission_id"), EXAMPLE_SALT).alias("encounter_hash"),
        "length_of_stay",
    )


def deid_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        std(spark, sf_dir, "admissions")
        .groupBy(
            deid.month_bucket(F.col("admission_date_final")).alias("admission_month"),
            deid.month_bucket(F.col("discharge_date_final")).alias("discharge_month"),
        )
        .agg(F.count(F.lit(1)).alias("stays"))
    )


def deid_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("admission_id")
    return std(spark, sf_dir, "admissions").select(
        deid.hashed_encounter(key, EXAMPLE_SALT).alias("encounter_hash"),
        deid.shifted(F.col("admission_date_final"), key, EXAMPLE_SALT).alias("admission_day"),
        deid.shifted(F.col("discharge_date_final"), key, EXAMPLE_SALT).alias("discharge_day"),
    )


def deid_age_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_of = dt.date(2024, 1, 1)
    patients = std(spark, sf_dir, "patients").select(
        "patient_id", "created_date", deid.age_on(F.col("date_of_birth"), as_of).alias("age")
    )
    return patients.select(
        deid.hashed(F.col("patient_id"), EXAMPLE_SALT).alias("patient_hash"),
        deid.age_band(F.col("age")).alias("age_band"),
        deid.date_if_allowed(F.col("created_date").cast("date"), F.col("age")).alias("created_day"),
    )


def suppress_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bills and amounts per status and month, small cells blank."""
    cells = std(spark, sf_dir, "billing").groupBy("payment_status", kpis.month_of("bill_date").alias("bill_month")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("total_amount").cast("decimal(38,2)").alias("amount")
    )
    return kpis.suppress_small(cells, "n", ("amount",))


def dup_key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dup_key_check(std(spark, sf_dir, "diagnoses"), ("diagnosis_id",))


def exclude_test_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stays without cancelled ones and without patients on the test list (customers in debt)."""
    tests = table(spark, sf_dir, "customer").filter("c_acctbal < 0").select(
        F.col("c_custkey").cast("int").alias("patient_id")
    )
    return quality.exclude_rows(
        std(spark, sf_dir, "admissions"), F.col("discharge_status") == "Left Against Medical Advice", tests, "patient_id"
    )


def dim_patients_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First load from the patient table, then the updates; the table as it then stands."""
    path = new_path(spark, "dim-patients")
    quality.refresh_latest(path, std(spark, sf_dir, "patients"), "patient_id", ("created_date",))
    updates = STANDARDIZE["patients"](raw_table(spark, sf_dir, "raw_patient_updates"))
    quality.refresh_latest(path, updates, "patient_id", ("created_date",))
    return spark.read.parquet(path).drop("bucket")


def negative_stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts over stays: negative lengths, ends before beginnings, imputed dates."""
    before = F.col("discharge_date_final") < F.col("admission_date_final")
    return std(spark, sf_dir, "admissions").groupBy("admission_type").agg(
        F.count(F.lit(1)).alias("stays"),
        F.count_if(F.col("length_of_stay") < 0).alias("negative_length"),
        F.count_if(before).alias("ends_before_begin"),
        F.count_if("is_admission_date_imputed").alias("imputed_admissions"),
        F.count_if("is_discharge_date_imputed").alias("imputed_discharges"),
    )


QUERIES: dict[str, Query] = {
    **{f"std_{e}": _std_query(e) for e in STANDARDIZE},
    **{f"health_{e}": _health_query(e) for e in STANDARDIZE},
    "health_all": health_all,
    "publish_views": published,
    "table_rowcounts": table_rowcounts,
    "profile_orders": lambda spark, sf_dir: profile_columns(table(spark, sf_dir, "orders")),
    "profile_events": lambda spark, sf_dir: profile_columns(table(spark, sf_dir, "events")),
    "profile_admissions": lambda spark, sf_dir: profile_columns(std(spark, sf_dir, "admissions")),
    "profile_sampled": profile_sampled,
    "metrics_append": metrics_append,
    "metrics_run_read": metrics_run_read,
    "metrics_backfill": metrics_backfill,
    "latest_run_stats": latest_run_stats,
    "semi_exists": semi_exists,
    "preview": preview,
    "listagg_top": listagg_top,
    "export_csv": export_csv,
    "fold_admission_type": on_raw(
        "raw_admissions", "admission_type", lambda c: M.fold(c, M.ADMISSION_TYPES, "sentence"), "label"
    ),
    "fold_discharge_status": on_raw(
        "raw_admissions", "discharge_status", lambda c: M.fold(c, M.DISCHARGE_STATUSES, "sentence"), "label"
    ),
    "fold_payment_status": on_raw(
        "raw_billing", "payment_status", lambda c: M.fold(c, M.PAYMENT_STATUSES), "label"
    ),
    "fold_diagnosis_type": on_raw(
        "raw_diagnoses", "diagnosis_type", lambda c: M.fold(c, M.DIAGNOSIS_TYPES), "label"
    ),
    "fold_payer": on_raw("raw_patients", "insurance_type", M.fold_payer, "label", S.PATIENT_TOKENS),
    "fold_blood_group": on_raw("raw_patients", "blood_group", M.fold_blood_group, "label", S.PATIENT_TOKENS),
    "fold_gender": on_raw("raw_patients", "gender", M.fold_gender, "label", S.PATIENT_TOKENS),
    "fold_accreditation": on_raw("raw_hospitals", "accreditation", M.fold_accreditation, "label"),
    "valid_icd": on_raw("raw_diagnoses", "icd_code", N.icd_code, "code"),
    "valid_cpt": on_raw(
        "raw_procedures", "cpt_code", N.cpt_code, "code", S.PROCEDURE_TOKENS, N.cpt_number
    ),
    "valid_pincode": on_raw("raw_patients", "pincode", N.pincode, "code", S.PATIENT_TOKENS),
    "title_name": on_raw(
        "raw_providers", "name", lambda c: S.title_words(c, True), "title", S.PROVIDER_TOKENS,
        lambda c: S.squeeze_spaces(c, 2),
    ),
    "title_specialty": on_raw(
        "raw_providers", "specialty", S.title_words, "title", S.PROVIDER_TOKENS, lambda c: S.squeeze_spaces(c, 2)
    ),
    "title_description": on_raw(
        "raw_procedures", "procedure_description", S.title_description, "title",
        S.PROCEDURE_TOKENS, S.spaced_commas,
    ),
    "parse_dates_stay": parse_query("raw_admissions", "admission_date", D.STAY_CLASSES),
    "parse_dates_diagnosis": parse_query(
        "raw_diagnoses", "diagnosis_date", D.DIAGNOSIS_CLASSES
    ),
    "parse_dates_test": parse_query("raw_lab_results", "test_date", D.TEST_CLASSES, S.LAB_TOKENS),
    "parse_dates_birth": parse_query("raw_patients", "date_of_birth", D.BIRTH_CLASSES, S.PATIENT_TOKENS),
    "parse_dates_procedure": parse_query(
        "raw_procedures", "procedure_date", D.PROCEDURE_CLASSES, S.PROCEDURE_TOKENS
    ),
    "parse_dates_created": on_raw(
        "raw_patients", "created_date", D.parse_created, "parsed", S.PATIENT_TOKENS
    ),
    "kpi_los_monthly": _kpi(kpis.kpi_los_monthly, "admissions"),
    "kpi_occupancy": _kpi(lambda a, d: kpis.kpi_occupancy(a, d, AS_OF["admissions"]), "admissions", "departments"),
    "kpi_revenue_tieout": _kpi(kpis.kpi_revenue_tieout, "billing", "admissions"),
    "kpi_payer_mix": _kpi(kpis.kpi_payer_mix, "billing", "admissions", "patients"),
    "kpi_top_codes": _kpi(kpis.kpi_top_codes, "diagnoses", "procedures"),
    "kpi_readmit_30d": _kpi(kpis.kpi_readmit_30d, "admissions"),
    "kpi_labs": _kpi(kpis.kpi_labs, "lab_results", "admissions"),
    "conform_gender": _conform_one("patients", "gender", ("patient_id",), _fixed(GENDER_MAP)),
    "conform_payer": _conform_one("patients", "insurance_type", ("patient_id",), _fixed(PAYER_MAP)),
    "conform_unit": _conform_one("lab_results", "unit", ("lab_result_id",), _fixed(UNIT_MAP)),
    "conform_department": _conform_one("departments", "dept_name", ("department_id",), department_map),
    "conform_cpt": _conform_one("procedures", "cpt_code", ("procedure_id",), cpt_map),
    "conform_icd": _conform_one("diagnoses", "icd_code", ("diagnosis_id",), icd_map),
    "conform_unmapped": conform_unmapped,
    "deid_hash": deid_hash,
    "deid_month": deid_month,
    "deid_shift": deid_shift,
    "deid_age_band": deid_age_band,
    "deid_export": deid_export,
    "suppress_small": suppress_small,
    "dup_key_check": dup_key_check,
    "exclude_test_rows": exclude_test_rows,
    "dim_patients_latest": dim_patients_latest,
    "stay_quality": negative_stays,
}
