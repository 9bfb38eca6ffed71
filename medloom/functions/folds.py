"""Category folding: many spellings to few labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from medloom.functions.binding import constant_map
from medloom.functions.text import drop_text, sentence_case

# Accepted spellings (upper case) and the label each one gets.
ADMISSION_TYPES = {
    "EMERGENCY": "Emergency",
    "ER": "Emergency",
    "E.R": "Emergency",
    "TRAUMA": "Emergency",
    "URGENT": "Urgent",
    "ELECTIVE": "Elective",
    "PLANNED": "Elective",
    "SCHEDULED": "Elective",
    "ROUTINE": "Elective",
    "OBSERVATION": "Observation",
    "OBS": "Observation",
    "DAY CARE": "Observation",
    "DAYCARE": "Observation",
    "MATERNITY": "Maternity",
    "MATERNAL": "Maternity",
    "DELIVERY": "Maternity",
    "NEWBORN": "Newborn",
    "NB": "Newborn",
    "OUTPATIENT": "Outpatient",
    "OP": "Outpatient",
}
DISCHARGE_STATUSES = {
    "DISCHARGED": "Discharged",
    "HOME": "Discharged",
    "STANDARD DISCHARGE": "Discharged",
    "TRANSFERRED": "Transferred",
    "TRANSFER": "Transferred",
    "REFERRED": "Transferred",
    "MOVED": "Transferred",
    "AMA": "Left Against Medical Advice",
    "LAMA": "Left Against Medical Advice",
    "LEFT AGAINST MEDICAL ADVICE": "Left Against Medical Advice",
    "LEFT_AGAINST_MEDICAL_ADVICE": "Left Against Medical Advice",
    "EXPIRED": "Expired",
    "DECEASED": "Expired",
    "DEAD": "Expired",
    "PENDING": "Pending",
    "IN PROGRESS": "Pending",
    "ONGOING": "Pending",
    "HOSPICE": "Hospice",
    "SNF": "Skilled Nursing Facility",
    "SKILLED NURSING": "Skilled Nursing Facility",
    "REHAB": "Rehabilitation",
    "REHABILITATION": "Rehabilitation",
}
PAYMENT_STATUSES = {
    "PAID": "Paid",
    "PENDING": "Pending",
    "PARTIAL": "Partial",
    "OUTSTANDING": "Outstanding",
    "WAIVED": "Waived",
}
DIAGNOSIS_TYPES = {"PRIMARY": "Primary", "SECONDARY": "Secondary"}
BLOOD_GROUPS = {g: g for g in ("A+", "A-", "B+", "B-", "AB+", "AB-", "O+", "O-")}
PAYERS = {
    "GOVERNMENT": "Government",
    "GOV": "Government",
    "PRIVATE": "Private",
    "PVT": "Private",
    "SELF PAY": "Self Pay",
    "SELF  PAY": "Self Pay",
    "SELF": "Self Pay",
    "CORPORATE": "Corporate",
    "CORP": "Corporate",
}
ACCREDITATIONS = {"JCI": "JCI", "NABH": "NABH", "NONE": "None"}
GENDERS = {"Male": ("M", "MALE"), "Female": ("F", "FEMALE"), "Other": ("OTHER", "O")}


def fold(col: Column, mapping: Mapping[str, str], default: str = "null") -> Column:
    """Label of the upper-cased text; unknown texts become NULL, sentence case, or stay ('keep')."""
    label = F.try_element_at(constant_map(mapping), F.upper(col))
    if default == "null":
        return label
    if default == "sentence":
        return F.coalesce(label, sentence_case(col))
    if default == "keep":
        return F.coalesce(label, col)
    raise ValueError(f"unknown default {default}")


def fold_or_na(col: Column, mapping: Mapping[str, str], tokens: Sequence[str]) -> Column:
    """Like ``fold`` with sentence case, from cleaned text; placeholders and missing texts become 'NA'."""
    known = {**dict.fromkeys(tokens, "NA"), **mapping}
    return F.coalesce(fold(col, known, "sentence"), F.lit("NA"))


def fold_gender(col: Column) -> Column:
    """Male, Female, Other or NULL."""
    key = F.upper(col)
    out = None
    for label, spellings in GENDERS.items():
        hit = key.isin(list(spellings))
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out


def fold_blood_group(col: Column) -> Column:
    """One of the eight groups, spaces ignored, else NULL."""
    return fold(drop_text(col, " "), BLOOD_GROUPS)


def fold_payer(col: Column) -> Column:
    """One of four payer classes, dashes read as spaces, else NULL."""
    return fold(F.replace(col, F.lit("-"), F.lit(" ")), PAYERS)


def fold_accreditation(col: Column) -> Column:
    """JCI, NABH, None, or the text itself."""
    return fold(col, ACCREDITATIONS, "keep")
