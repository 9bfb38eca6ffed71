"""Exports of all tables of an encounter that still join: one surrogate and one day shift for each encounter.

The encounter side, one row per admission, says whose stay it is and whether dates may leave (the patient's age is
known and below 89). It is written once; every table is joined to it once, on the admission. A table's dates move by the
shift of their encounter, so intervals inside an encounter stay what they are; row ids become labelled hashes, so no
hash of one table equals one of another by number.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.operators import deid
from medloom.operators.quality import latest_per_key
from medloom.operators.standardize import CHARGES
from medloom.sources.shared import written

# What may leave of each table, and how. Columns that are not listed are dropped.
POLICY: dict[str, dict[str, str]] = {
    "admissions": {
        "admission_id": "encounter", "patient_id": "patient", "hospital_id": "keep", "department_id": "keep", "admission_type": "keep",
        "discharge_status": "keep", "length_of_stay": "keep", "admission_date_final": "shift", "discharge_date_final": "shift",
    },
    "billing": {
        "bill_id": "row", "admission_id": "encounter", "bill_date": "shift", "payment_date": "shift", "payment_status": "keep",
        **dict.fromkeys(CHARGES, "keep"),
    },
    "diagnoses": {"diagnosis_id": "row", "admission_id": "encounter", "diagnosis_date": "shift", "icd_code": "keep", "diagnosis_type": "keep"},
    "procedures": {
        "procedure_id": "row", "admission_id": "encounter", "provider_id": "row", "procedure_date": "shift", "cpt_code": "keep", "procedure_cost": "keep",
    },
    "lab_results": {
        "lab_result_id": "row", "admission_id": "encounter", "test_date": "shift", "test_name": "keep", "result_value": "keep", "unit": "keep", "status": "keep",
    },
}
_NAMES = {"encounter": "encounter_hash", "patient": "patient_hash", "row": "{}_hash", "shift": "{}_shifted", "keep": "{}"}


def labelled(column: str, salt: str) -> Column:
    """Salted hash of a row id, labelled with its column's name."""
    return deid.hashed(F.concat(F.lit(f"{column}|"), F.col(column).cast("string")), salt)


def encounters(admissions: DataFrame, patients: DataFrame, as_of: dt.date) -> DataFrame:
    """One row per admission, written: admission_id, and whether its dates may leave.

    An admission that is listed for several patients has the rule of the strictest.
    """
    people = latest_per_key(patients.select("patient_id", "created_date", "date_of_birth"), "patient_id", ("created_date",))
    age = deid.age_on(F.col("date_of_birth"), as_of)
    allowed = F.coalesce((age >= 0) & (age < deid.SUPPRESSED_AGE), F.lit(False))
    one = written(people.select("patient_id", allowed.alias("allowed")), "people")
    stays = admissions.select("admission_id", "patient_id").join(one, "patient_id", "left")
    return written(stays.groupBy("admission_id").agg(F.min(F.coalesce("allowed", F.lit(False))).alias("dates_allowed")), "encounters")


def export(entity: str, df: DataFrame, of: DataFrame, salt: str, policy: Mapping[str, str] | None = None) -> DataFrame:
    """The columns of a table that may leave. Rows stay as many as they are; those of unknown admissions have no dates."""
    rules = POLICY[entity] if policy is None else policy
    joined = df.join(of, "admission_id", "left")
    may = F.coalesce("dates_allowed", F.lit(False))
    out = []
    for column, rule in rules.items():
        value = {
            "keep": lambda c: F.col(c),
            "patient": lambda c: deid.hashed(F.col(c), salt),
            "encounter": lambda c: deid.hashed_encounter(F.col(c), salt),
            "row": lambda c: labelled(c, salt),
            "shift": lambda c: F.when(may, deid.shifted(F.col(c), F.col("admission_id"), salt)),
        }[rule](column)
        out.append(value.alias(_NAMES[rule].format(column)))
    return joined.select(*out)


def export_all(tables: Mapping[str, DataFrame], patients: DataFrame, salt: str, as_of: dt.date) -> dict[str, DataFrame]:
    """All given tables, 'admissions' among them, under one policy."""
    of = encounters(tables["admissions"], patients, as_of)
    return {entity: export(entity, df, of, salt) for entity, df in tables.items()}
