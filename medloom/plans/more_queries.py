"""Registered queries over conformed tables, versioned dimensions, stored partial results and loss accounts."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.functions import folds as M
from medloom.functions import text as S
from medloom.operators import conformed, deid_linked, dimension, guarded, health_daily, losses, sketches, suppress
from medloom.operators.kpis import month_of
from medloom.operators.profile import profile_columns
from medloom.operators.standardize import STANDARDIZE
from medloom.plans.queries import AS_OF, EXAMPLE_SALT, GENDER_MAP, PAYER_MAP, UNIT_MAP, Query, cpt_map, icd_map, std
from medloom.sources.raw import raw_table
from medloom.sources.shared import new_path
from medloom.sources.tables import table

PAYMENT_MAP = {"Paid": "Settled", "Pending": "Open", "Partial": "Open", "Outstanding": "Open"}


# Conformed entities -----------------------------------------------------------------------------------

def _fixed_codes(spark: SparkSession, domain: str, pairs: dict[str, str]) -> DataFrame:
    """Codes of a map written in code; ids follow the order of the labels."""
    ids = {label: i for i, label in enumerate(sorted(set(pairs.values())))}
    return spark.createDataFrame([(domain, k, ids[v], v) for k, v in pairs.items()], "domain string, code string, canonical_id long, label string")


def reference_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical codes of all domains, from the test tables."""
    region = table(spark, sf_dir, "region")
    own = lambda domain, code, number, label: (F.lit(domain).alias("domain"), code.alias("code"), number.cast("long").alias("canonical_id"), label.alias("label"))
    parts = [
        region.select(*own("department", F.col("r_name"), F.col("r_regionkey") + 100, F.col("r_name"))),
        region.filter("r_regionkey < 4").select(*own("hospital", F.col("r_regionkey").cast("string"), F.col("r_regionkey"), F.col("r_name"))),
        cpt_map(spark, sf_dir).select(*own("cpt", F.col("source_value"), F.col("source_value").cast("long"), F.col("standard_value"))).filter(F.col("canonical_id") % 7 != 0),
        icd_map(spark, sf_dir).select(*own("icd", F.col("source_value"), F.length("standard_value"), F.col("standard_value"))),
    ]
    fixed = [_fixed_codes(spark, d, m) for d, m in (("gender", GENDER_MAP), ("payer", PAYER_MAP), ("unit", UNIT_MAP), ("payment", PAYMENT_MAP))]
    return reduce(DataFrame.unionByName, parts + fixed)


def reference_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Department codes for their region, some by way of the code before; procedure codes divisible by 7 were replaced."""
    nation, region, part = (table(spark, sf_dir, n) for n in ("nation", "region", "part"))
    number = F.col("n_nationkey")
    target = F.when(number % 5 == 3, (number - 1).cast("string")).otherwise(F.col("r_name"))
    departments = nation.join(region, nation.n_regionkey == region.r_regionkey).filter(number % 10 != 7).select(
        F.lit("department").alias("domain"), number.cast("string").alias("source_value"), target.alias("target_value")
    )
    code = lambda c: F.lpad(c.cast("long").cast("string"), 5, "0")
    key = F.col("p_partkey")
    replaced = part.filter((key % 7 == 0) & (key < 100000)).select(F.lit("cpt").alias("domain"), code(key).alias("source_value"), code(key / 7).alias("target_value"))
    return departments.unionByName(replaced)


def lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conformed.combined(reference_codes(spark, sf_dir), reference_aliases(spark, sf_dir))


def _conformed(entity: str) -> Query:
    return lambda spark, sf_dir: conformed.conformed(entity, std(spark, sf_dir, entity), lookup(spark, sf_dir))


def _stays(spark: SparkSession, sf_dir: str, maps: DataFrame) -> DataFrame:
    return conformed.conformed_stays(std(spark, sf_dir, "admissions"), std(spark, sf_dir, "patients"), maps)


def _procedures(spark: SparkSession, sf_dir: str, maps: DataFrame) -> DataFrame:
    return conformed.conformed_procedures(std(spark, sf_dir, "procedures"), std(spark, sf_dir, "providers"), maps)


def _bills(spark: SparkSession, sf_dir: str, maps: DataFrame, stays: DataFrame) -> DataFrame:
    return conformed.conformed_bills(std(spark, sf_dir, "billing"), stays, maps)


def conformed_admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stays(spark, sf_dir, lookup(spark, sf_dir))


def conformed_procedures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _procedures(spark, sf_dir, lookup(spark, sf_dir))


def conformed_billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = lookup(spark, sf_dir)
    return _bills(spark, sf_dir, maps, conformed.one_stay(_stays(spark, sf_dir, maps), conformed.OF_BILLED))


def kpi_department_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = lookup(spark, sf_dir)
    stays = conformed.one_stay(_stays(spark, sf_dir, maps), conformed.OF_ACTIVE)
    return conformed.department_activity(stays, _procedures(spark, sf_dir, maps), _bills(spark, sf_dir, maps, stays))


def kpi_payer_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conformed.payer_amounts(conformed_billing(spark, sf_dir))


def conformed_unmapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values of all nine entities that no map knows."""
    maps = lookup(spark, sf_dir)
    found = [conformed.unmapped_values(conformed.conformed(e, std(spark, sf_dir, e), maps), d).select(F.lit(e).alias("entity"), "*") for e, d in conformed.ENTITY_DOMAINS.items()]
    return reduce(DataFrame.unionByName, found)


# The patient dimension in versions --------------------------------------------------------------------

#: Updates arrive in three deliveries, up to each of these days.
DELIVERIES = (dt.date(1997, 6, 30), dt.date(1999, 12, 31), dt.date(2001, 12, 31))
FIRST_LOAD = dt.date(1995, 1, 1)


def _patient_versions(spark: SparkSession, sf_dir: str) -> str:
    """A table of patients with a first load and three deliveries of updates; compacted after the second."""
    path = new_path(spark, "patient-versions")
    dimension.refresh(path, std(spark, sf_dir, "patients"), "patient_id", ("created_date",), FIRST_LOAD)
    updates = STANDARDIZE["patients"](raw_table(spark, sf_dir, "raw_patient_updates"))
    since = dt.date(1900, 1, 1)
    for day in DELIVERIES:
        created = F.col("created_date").cast("date")
        dimension.refresh(path, updates.filter((created > F.lit(since)) & (created <= F.lit(day))), "patient_id", ("created_date",), day)
        since = day
        if day == DELIVERIES[1]:
            dimension.compact(spark, path)
    return path


def dim_patients_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest version of the patient dimension."""
    return dimension.read(spark, _patient_versions(spark, sf_dir))


def dim_patients_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The patient dimension as it was known after the first delivery, from the version before the compaction."""
    return dimension.read(spark, _patient_versions(spark, sf_dir), number=3, as_of=DELIVERIES[0])


def dim_patients_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimension.history(spark, _patient_versions(spark, sf_dir))


# Profiles by sketch -----------------------------------------------------------------------------------

SKETCHED_DAYS = (dt.date(2024, 1, 10), dt.date(2024, 1, 20))
#: How many standard errors an estimate may be off to count as right.
ERRORS = 5


def profile_top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five most frequent values of every column of events and orders."""

    def top(name: str) -> DataFrame:
        df = table(spark, sf_dir, name)
        column = F.element_at(F.array(*[F.lit(c) for c in df.columns]), F.col("column_no") + 1).alias("column_name")
        return sketches.top_values(df).select(F.lit(name).alias("table_name"), column, F.col("place").cast("long").alias("place"), "value", "freq")

    return top("events").unionByName(top("orders"))


def sketched_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct counts of ten days of events from stored sketches, against exact ones: do they keep their bound?"""
    events = table(spark, sf_dir, "events")
    path = new_path(spark, "sketches")
    day = F.col("ts").cast("date")
    for half in (day <= F.lit(SKETCHED_DAYS[0]), day > F.lit(SKETCHED_DAYS[0])):  # two deliveries
        sketches.add_days(events.filter(half), path, "ts")
    found = sketches.merged(sketches.stored(path, spark, *SKETCHED_DAYS))
    exact = profile_columns(events.filter(day.between(F.lit(SKETCHED_DAYS[0]), F.lit(SKETCHED_DAYS[1])))).select("column_name", "distinct_count")
    off = F.abs(F.col("distinct_estimate") - F.col("distinct_count")) <= ERRORS * F.col("relative_error") * F.col("distinct_count")
    return found.join(exact, "column_name").select("column_name", "rows", "nulls", "distinct_count", off.alias("within_bound"))


def profile_case_blind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spellings of patients and their updates, letter case and trailing spaces aside."""
    names = ("gender", "blood_group", "insurance_type", "area")
    rows = [raw_table(spark, sf_dir, n).select(*names) for n in ("raw_patients", "raw_patient_updates")]
    return profile_columns(rows[0].unionByName(rows[1]), case_blind=True)


# Health metrics from partial results --------------------------------------------------------------------

#: The first column of each table deals its rows into deliveries.
DELIVERED = 2


def health_daily_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All metrics, from two deliveries that arrive one after the other: the second run reads the second one only."""
    path = new_path(spark, "health-daily")
    deliveries: dict[str, dict] = {}
    for entity in STANDARDIZE:
        raw = raw_table(spark, sf_dir, f"raw_{entity}")
        dealt = F.pmod(F.crc32(F.coalesce(F.col(raw.columns[0]), F.lit(""))), F.lit(DELIVERED))
        deliveries[entity] = {f"part-{i}": lambda e=entity, r=raw.filter(dealt == i): STANDARDIZE[e](r) for i in range(DELIVERED)}
    health_daily.add_all(path, {entity: of["part-0"] for entity, of in deliveries.items()}, "part-0")
    return health_daily.run_all(spark, path, deliveries, AS_OF)


# Losses ------------------------------------------------------------------------------------------------

def losses_of_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows dropped, conversions failed and texts too long in each of the nine tables."""
    return losses.account_of(spark, {e: raw_table(spark, sf_dir, f"raw_{e}") for e in STANDARDIZE})


# Guarded joins, linked exports, suppressed tables -------------------------------------------------------

def guarded_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two joins of stays did: to diagnoses, of which there are many, and to bills."""
    guards = []
    for entity in ("diagnoses", "billing"):
        other = std(spark, sf_dir, entity).select("admission_id", F.lit(1).alias("found"))
        joined, guard = guarded.guarded_join(std(spark, sf_dir, "admissions").select("admission_id", "patient_id"), other, ("admission_id",), entity)
        joined.write.format("noop").mode("overwrite").save()
        guards.append(guard)
    return guarded.reports(spark, guards)


EXPORT_DAY = dt.date(2024, 1, 1)


def _linked(entity: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        of = deid_linked.encounters(std(spark, sf_dir, "admissions"), std(spark, sf_dir, "patients"), EXPORT_DAY)
        return deid_linked.export(entity, std(spark, sf_dir, entity), of, EXAMPLE_SALT)

    return run


def suppressed_bills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bills by year, month and status; small counts blank, with what would give them away."""
    bills = std(spark, sf_dir, "billing").select(F.year("bill_date").alias("bill_year"), month_of("bill_date").alias("bill_month"), "payment_status")
    return suppress.suppressed_table(bills, "bill_year", "bill_month", "payment_status")


# Every spelling of every folded category ------------------------------------------------------------------

# Spellings as they arrive, known ones and others.
SPELLINGS: dict[str, tuple[str, ...]] = {
    "admission_type": (
        "emergency", "er", "e.r", "trauma", "urgent", "elective", "planned", "scheduled", "routine", "observation", "obs", "day care",
        "daycare", "maternity", "maternal", "delivery", "newborn", "nb", "outpatient", "op", "walk-in", "e.r.", "n/a", "emergency room",
    ),
    "discharge_status": (
        "discharged", "home", "standard discharge", "transferred", "transfer", "referred", "moved", "ama", "lama", "left against medical advice",
        "left_against_medical_advice", "expired", "deceased", "dead", "pending", "in progress", "ongoing", "hospice", "snf", "skilled nursing",
        "rehab", "rehabilitation", "went home", "tbd", "-",
    ),
    "payment_status": ("paid", "pending", "partial", "outstanding", "waived", "written off", "null"),
    "diagnosis_type": ("primary", "secondary", "tertiary", "n/a"),
    "blood_group": ("a+", "a -", "b+", "b-", "ab +", "ab-", "o+", "o -", "c+", "a"),
    "payer": ("government", "gov", "private", "pvt", "self pay", "self-pay", "self  pay", "self", "corporate", "corp", "medicare", "gov-"),
    "gender": ("m", "male", "f", "female", "other", "o", "x", "man"),
    "accreditation": ("jci", "nabh", "none", "iso 9001", "j c i"),
}


def fold_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each spelling in three letter cases, dealt over the orders, and the label it gets."""
    key = F.col("o_orderkey")

    def dealt(words: tuple[str, ...]) -> Column:
        word = F.element_at(F.array(*[F.lit(w) for w in words]), (key % len(words) + 1).cast("int"))
        return F.when(key % 3 == 0, F.upper(word)).when(key % 3 == 1, word).otherwise(F.initcap(word))

    rows = table(spark, sf_dir, "orders").select(F.inline(F.array(*[F.struct(F.lit(rule).alias("rule"), dealt(words).alias("input")) for rule, words in SPELLINGS.items()])))
    counted = rows.groupBy("rule", "input").agg(F.count(F.lit(1)).alias("n"))
    text = S.null_tokens(F.col("input"))
    folds = {
        "admission_type": M.fold(text, M.ADMISSION_TYPES, "sentence"),
        "discharge_status": M.fold(text, M.DISCHARGE_STATUSES, "sentence"),
        "payment_status": M.fold(text, M.PAYMENT_STATUSES),
        "diagnosis_type": M.fold(text, M.DIAGNOSIS_TYPES),
        "blood_group": M.fold_blood_group(text),
        "payer": M.fold_payer(text),
        "gender": M.fold_gender(text),
        "accreditation": M.fold_accreditation(text),
    }
    label = F.coalesce(*[F.when(F.col("rule") == rule, fold) for rule, fold in folds.items()])
    return counted.select("rule", "input", label.alias("label"), "n")


QUERIES: dict[str, Query] = {
    "conformed_lookup": lookup,
    "conformed_admissions": conformed_admissions,
    "conformed_billing": conformed_billing,
    "conformed_procedures": conformed_procedures,
    **{f"conformed_{e}": _conformed(e) for e in ("departments", "diagnoses", "hospitals", "lab_results", "patients", "providers")},
    "conformed_unmapped": conformed_unmapped,
    "kpi_department_activity": kpi_department_activity,
    "kpi_payer_amounts": kpi_payer_amounts,
    "dim_patients_versions": dim_patients_versions,
    "dim_patients_as_of": dim_patients_as_of,
    "dim_patients_history": dim_patients_history,
    "profile_top_values": profile_top_values,
    "profile_sketched": lambda spark, sf_dir: sketches.profile_sketched(table(spark, sf_dir, "orders")),
    "sketched_days": sketched_days,
    "profile_case_blind": profile_case_blind,
    "losses": losses_of_all,
    "health_daily": health_daily_all,
    "guarded_joins": guarded_joins,
    **{f"deid_linked_{e}": _linked(e) for e in deid_linked.POLICY},
    "suppressed_bills": suppressed_bills,
    "fold_spellings": fold_spellings,
}
