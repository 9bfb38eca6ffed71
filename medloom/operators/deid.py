"""De-identified exports. Salts are passed in by the caller and never stored."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUPPRESSED_AGE = 89


def hashed(value: Column, salt: str) -> Column:
    """Salted SHA-256 in hex; NULL stays NULL."""
    return F.sha2(F.concat(value.cast("string"), F.lit(salt)), 256)


def month_bucket(day: Column) -> Column:
    """First day of the month."""
    return F.trunc(day, "MM")


def hashed_encounter(encounter: Column, salt: str) -> Column:
    """Salted hash of an encounter; labelled, so it never equals the hash of a patient with the same number."""
    return hashed(F.concat(F.lit("encounter|"), encounter.cast("string")), salt)


def shift_of(encounter: Column, salt: str) -> Column:
    """Whole days from -3 to 3, the same for every date of an encounter.

    The digest is its own: it cannot be had from a hash that is exported.
    """
    own = F.sha2(F.concat(F.lit("shift|"), encounter.cast("string"), F.lit(salt)), 256)
    number = F.conv(F.substring(own, 1, 8), 16, 10).cast("bigint")
    return (F.pmod(number, F.lit(7)) - 3).cast("int")


def shifted(day: Column, encounter: Column, salt: str) -> Column:
    """A date moved by its encounter's shift."""
    return F.date_add(day, shift_of(encounter, salt))


def age_on(birth: Column, as_of: dt.date) -> Column:
    """Completed years on ``as_of``."""
    number = F.year(birth) * 10000 + F.month(birth) * 100 + F.dayofmonth(birth)
    today = as_of.year * 10000 + as_of.month * 100 + as_of.day
    return F.floor((F.lit(today) - number) / 10000).cast("int")


def age_band(age: Column) -> Column:
    """Ten-year band; '90+' from age 89 on; 'Unknown' without an age."""
    low = (F.floor(age / 10) * 10).cast("int")
    band = F.concat(low.cast("string"), F.lit("-"), (low + 9).cast("string"))
    return (
        F.when(age.isNull(), F.lit("Unknown"))
        .when(age >= SUPPRESSED_AGE, F.lit("90+"))
        .when(age >= 80, F.lit("80-88"))
        .when(age < 0, F.lit("Unknown"))
        .otherwise(band)
    )


def date_if_allowed(day: Column, age: Column) -> Column:
    """The date, or NULL for patients of 89 and older and of unknown age."""
    return F.when((age >= 0) & (age < SUPPRESSED_AGE), day)


def zip3(code: Column) -> Column:
    """First three characters of a postal code."""
    return F.substring(code, 1, 3)


# Which columns may leave, and how. Columns that are not listed are dropped.
STAY_POLICY = {
    "patient_id": "hash",
    "admission_id": "hash",
    "hospital_id": "keep",
    "department_id": "keep",
    "admission_type": "keep",
    "discharge_status": "keep",
    "gender": "keep",
    "insurance_type": "keep",
    "pincode": "zip3",
    "date_of_birth": "age_band",
    "admission_date_final": "month",
    "discharge_date_final": "month",
    "length_of_stay": "keep",
    "room_number": "drop",
    "attending_physician": "drop",
    "mrn": "drop",
    "area": "drop",
}
_NAMES = {
    "hash": "{}_hash", "zip3": "{}_zip3", "age_band": "age_band", "month": "{}_month", "shift": "{}_shifted",
    "keep": "{}",
}


def deid_export(
    df: DataFrame,
    policy: Mapping[str, str],
    salt: str,
    as_of: dt.date,
    birth: str = "date_of_birth",
    encounter: str = "admission_id",
) -> DataFrame:
    """The columns the policy lets out, each in the form it prescribes.

    Rules: 'keep', 'hash', 'month', 'shift', 'zip3', 'age_band', 'drop'. Dates go through the age rule.
    """
    age = age_on(F.col(birth), as_of)
    rules = {
        "keep": lambda c: F.col(c),
        "hash": lambda c: (hashed_encounter if c == encounter else hashed)(F.col(c), salt),
        "month": lambda c: date_if_allowed(month_bucket(F.col(c)), age),
        "shift": lambda c: date_if_allowed(shifted(F.col(c), F.col(encounter), salt), age),
        "zip3": lambda c: zip3(F.col(c)),
        "age_band": lambda c: age_band(age),
    }
    out = []
    for column in df.columns:
        rule = policy.get(column, "drop")
        if rule != "drop":
            out.append(rules[rule](column).alias(_NAMES[rule].format(column)))
    return df.select(*out)
