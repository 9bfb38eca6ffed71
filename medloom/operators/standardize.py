"""Raw text tables to typed tables, one function per source.

Every job is a chain of narrow projections: clean text, drop placeholder tokens, convert, filter on the
required keys. There is no join, no explode and no shuffle, so each runs as one map stage whose tasks
are independent, and a consumer that needs three columns reads and converts only those three.

Placeholder tokens are tested only in free text: none of them reads as a number, date, code or label.
A text that a later step uses more than once gets a projection of its own, so it is computed once.

Whole texts are kept. ``source_limits=True`` gives the original's limits instead: texts cut to fixed widths, small numbers.
With ``account`` (an ``Observation``) the same pass counts what is lost, see ``losses``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from medloom.functions import dates as D
from medloom.functions import folds as M
from medloom.functions import numbers as N
from medloom.functions import text as S
from medloom.functions.binding import let

c = F.col

CHARGES = (
    "doctor_fees", "insurance_coverage", "lab_charges", "nursing_charges", "pharmacy_charges",
    "procedure_charges", "room_charges", "total_amount", "patient_due",
)
HOSPITAL_BEDS = (
    "ICU_bed_breakdown", "General_bed_breakdown", "Private_bed_breakdown", "Semi_Private_bed_breakdown",
)


# The original's silent cuts on output; on input 255, or as listed further below.
OUTPUT_WIDTHS = {
    "room_number": 12, "dept_name": 100, "hod": 80, "hospital_name": 120, "branch_location": 80, "accreditation": 20,
    "test_name": 120, "unit": 20, "reference_range": 60, "lab_technician": 80, "procedure_description": 200,
    "name": 200, "specialty": 200,
}
INPUT_WIDTH = 255


def _clean(
    raw: DataFrame,
    widths: Mapping[str, int],
    tokens: Sequence[str],
    texts: Sequence[str] = (),
    prepared: Mapping[str, Callable[[Column], Column]] | None = None,
    source_limits: bool = False,
    account: Observation | None = None,
) -> DataFrame:
    """Cleaned columns; ``texts`` lose placeholders, ``prepared`` columns get a first rewriting."""
    prepared = prepared or {}
    clean = raw.select(*[S.clean_text(c(n), w if source_limits else None).alias(n) for n, w in widths.items()], *([_long(widths)] if account else []))

    def second(name: str) -> Column:
        value = S.null_tokens(c(name), tokens) if name in texts else c(name)
        return prepared[name](value).alias(name) if name in prepared else value.alias(name)

    marks = [c(LONG), F.transform(F.array(*widths), lambda x: S.null_tokens(x, tokens).isNotNull()).alias(HAD)]
    return clean.select(*[second(name) for name in widths], *(marks if account else []))


#: Columns of marks for the account: which inputs are too long for the original, and which hold a value.
#: One array each, since a column for each mark would make the generated code too long to be compiled.
LONG, HAD = "_long", "_had"


def _long(widths: Mapping[str, int]) -> Column:
    lengths = F.array(*[F.coalesce(F.length(c(n).cast("string")), F.lit(0)) for n in widths])
    return F.zip_with(lengths, F.array(*[F.lit(w) for w in widths.values()]), lambda n, most: n > most).alias(LONG)


def _typed(
    tokens: DataFrame, columns: Mapping[str, Column], keys: Sequence[str], source_limits: bool = False, account: Observation | None = None
) -> DataFrame:
    """The converted columns of rows that have all ``keys``."""
    marks = [LONG, HAD] if account else []
    names = [n for n in tokens.columns if n not in marks]
    df = tokens.select(*[value.alias(n) for n, value in columns.items()], *marks)
    missing = F.lit(False)
    for key in keys:
        missing = missing | c(key).isNull()
    if account:
        lost = [F.count(F.lit(1)).alias("rows"), F.count_if(missing).alias("dropped")]
        for n in columns:
            at = names.index(n)
            wide = F.coalesce(F.length(c(n)) > OUTPUT_WIDTHS[n], F.lit(False)) if n in OUTPUT_WIDTHS else F.lit(False)
            lost.append(F.count_if(c(HAD)[at] & c(n).isNull()).alias(f"failed {n}"))
            lost.append(F.count_if(c(LONG)[at] | wide).alias(f"cut {n}"))
        df = df.observe(account, *lost)
    kept = df.filter(~missing) if keys else df
    return kept.select(*[S.cut(c(n), OUTPUT_WIDTHS.get(n) if source_limits else None).alias(n) for n in columns]) if source_limits or account else kept


def _same(names: Sequence[str], width: int = INPUT_WIDTH) -> dict[str, int]:
    return dict.fromkeys(names, width)


def standardize_admissions(raw: DataFrame, source_limits: bool = False, account: Observation | None = None) -> DataFrame:
    """Stays with typed dates, folded type and status, and imputed dates."""
    ids = ("admission_id", "patient_id", "hospital_id", "department_id", "length_of_stay")
    days = ("admission_date", "discharge_date")
    texts = ("admission_type", "discharge_status", "room_number", "attending_physician")
    tokens = _clean(
        raw, _same(ids + days + texts), S.COMMON_TOKENS, ("room_number", "attending_physician"),
        dict.fromkeys(days, D.date_text),
        source_limits=source_limits, account=account,
    )
    typed = _typed(
        tokens,
        {
            **{x: N.safe_int(c(x)) for x in ids},
            **{x: D.parse_date(c(x), D.STAY_CLASSES) for x in days},
            "admission_type": M.fold_or_na(c("admission_type"), M.ADMISSION_TYPES, S.COMMON_TOKENS),
            "discharge_status": M.fold_or_na(c("discharge_status"), M.DISCHARGE_STATUSES, S.COMMON_TOKENS),
            "room_number": S.or_na(F.upper(c("room_number"))),
            "attending_physician": S.physician_core(c("attending_physician")),
        },
        ("admission_id",), source_limits, account,
    )
    stay_known = c("length_of_stay").isNotNull()
    begun = D.days_before(c("discharge_date"), c("length_of_stay"))
    ended = D.days_after(c("admission_date"), c("length_of_stay"))
    return typed.select(
        "admission_id",
        "admission_date",
        "patient_id",
        "hospital_id",
        "department_id",
        "discharge_date",
        "admission_type",
        "discharge_status",
        "length_of_stay",
        "room_number",
        S.or_na(S.physician_label(c("attending_physician"))).alias("attending_physician"),
        begun.alias("admission_date_imputed"),
        ended.alias("discharge_date_imputed"),
        (c("admission_date").isNull() & c("discharge_date").isNotNull() & stay_known).alias(
            "is_admission_date_imputed"
        ),
        (c("discharge_date").isNull() & c("admission_date").isNotNull() & stay_known).alias(
            "is_discharge_date_imputed"
        ),
        F.coalesce(c("admission_date"), begun).alias("admission_date_final"),
        F.coalesce(c("discharge_date"), ended).alias("discharge_date_final"),
    )


def standardize_billing(raw: DataFrame, source_limits: bool = False, account: Observation | None = None) -> DataFrame:
    """Bills with nine money columns."""
    names = ("bill_id", "admission_id", "bill_date", "payment_date", "payment_status", *CHARGES)
    days = ("bill_date", "payment_date")
    tokens = _clean(raw, _same(names), S.COMMON_TOKENS, (), dict.fromkeys(days, D.date_text), source_limits=source_limits, account=account)
    return _typed(
        tokens,
        {
            "bill_id": N.safe_int(c("bill_id")),
            "admission_id": N.safe_int(c("admission_id")),
            # Spark does not compile lambdas; with the dates, the method of so many columns would be longer than the JVM compiles.
            **{x: let(c(x), lambda t: D.parse_date(t, D.STAY_CLASSES)) for x in days},
            "payment_status": M.fold(c("payment_status"), M.PAYMENT_STATUSES),
            **{x: N.safe_decimal(c(x), 18, 2) for x in CHARGES},
        },
        ("bill_id",), source_limits, account,
    )


def standardize_departments(raw: DataFrame, source_limits: bool = False, account: Observation | None = None) -> DataFrame:
    """Departments with bed counts. With ``source_limits`` numbers above 255 do not fit and drop the row."""
    kind = "tinyint" if source_limits else "int"
    names = ("department_id", "hospital_id", "dept_name", "hod", "bed_count", "avg_occupancy")
    tokens = _clean(raw, _same(names), S.COMMON_TOKENS, ("dept_name", "hod"), source_limits=source_limits, account=account)
    return _typed(
        tokens,
        {
            "department_id": N.safe_int(c("department_id"), kind),
            "hospital_id": N.safe_int(c("hospital_id"), kind),
            "dept_name": S.sentence_case(c("dept_name")),
            "hod": S.sentence_case(c("hod")),
            "bed_count": N.safe_int(c("bed_count"), kind),
            "avg_occupancy": N.safe_decimal(c("avg_occupancy"), 5, 2),
        },
        ("department_id", "hospital_id", "bed_count",), source_limits, account,
    )


def standardize_diagnoses(raw: DataFrame, source_limits: bool = False, account: Observation | None = None) -> DataFrame:
    """Diagnoses with validated codes; day comes before month in ambiguous dates."""
    names = (
        "diagnosis_id", "admission_id", "diagnosis_date", "icd_code", "diagnosis_type", "diagnosis_description",
    )
    tokens = _clean(
        raw, _same(names), S.COMMON_TOKENS, ("diagnosis_description",),
        {"diagnosis_date": D.date_text},
        source_limits=source_limits, account=account,
    )
    return _typed(
        tokens,
        {
            "diagnosis_id": N.safe_int(c("diagnosis_id")),
            "admission_id": N.safe_int(c("admission_id")),
            "diagnosis_date": D.parse_date(c("diagnosis_date"), D.DIAGNOSIS_CLASSES),
            "icd_code": N.icd_code(c("icd_code")),
            "diagnosis_type": M.fold(c("diagnosis_type"), M.DIAGNOSIS_TYPES),
            "diagnosis_description": S.squeeze_spaces(c("diagnosis_description"), 2),
        },
        ("diagnosis_id", "admission_id",), source_limits, account,
    )


def standardize_hospitals(raw: DataFrame, source_limits: bool = False, account: Observation | None = None) -> DataFrame:
    """Hospitals with bed numbers and accreditation. With ``source_limits`` numbers above 255 do not fit."""
    small, wide = ("tinyint", "smallint") if source_limits else ("int", "int")
    names = (
        "hospital_id", "hospital_name", "branch_location", "total_beds", *HOSPITAL_BEDS,
        "icu_percentage", "established_year", "accreditation",
    )
    tokens = _clean(
        raw, _same(names), S.COMMON_TOKENS, ("hospital_name", "branch_location", "accreditation"),
        source_limits=source_limits, account=account,
    )
    return _typed(
        tokens,
        {
            "hospital_id": N.safe_int(c("hospital_id"), small),
            "hospital_name": S.sentence_case(c("hospital_name")),
            "branch_location": S.sentence_case(c("branch_location")),
            "total_beds": N.safe_int(c("total_beds"), wide),
            **{x: N.safe_int(c(x), small) for x in HOSPITAL_BEDS},
            "icu_percentage": N.safe_decimal(c("icu_percentage"), 5, 2, (",",)),
            "established_year": N.safe_int(c("established_year"), "smallint"),
            "accreditation": M.fold_accreditation(c("accreditation")),
        },
        ("hospital_id",), source_limits, account,
    )


def standardize_lab_results(raw: DataFrame, source_limits: bool = False, account: Observation | None = None) -> DataFrame:
    """Laboratory results; day comes before month in ambiguous dates."""
    names = (
        "lab_result_id", "admission_id", "test_date", "test_name", "result_value", "unit",
        "reference_range", "status", "lab_technician",
    )
    tokens = _clean(
        raw, _same(names), S.LAB_TOKENS,
        ("test_name", "unit", "reference_range", "status", "lab_technician"), {"test_date": D.date_text},
        source_limits=source_limits, account=account,
    )
    return _typed(
        tokens,
        {
            "lab_result_id": N.safe_int(c("lab_result_id")),
            "admission_id": N.safe_int(c("admission_id")),
            "test_date": let(c("test_date"), lambda t: D.parse_date(t, D.TEST_CLASSES)),  # as in bills
            "test_name": S.squeeze_spaces(c("test_name"), 3),
            "result_value": N.safe_decimal(c("result_value"), 18, 4),
            "unit": c("unit"),
            "reference_range": S.tighten_range(c("reference_range")),
            "status": S.sentence_case(c("status")),
            "lab_technician": S.sentence_case(c("lab_technician")),
        },
        ("lab_result_id", "admission_id",), source_limits, account,
    )


# Silent cut widths on read.
PATIENT_WIDTHS = {
    "patient_id": 50, "mrn": 50, "gender": 30, "blood_group": 10, "insurance_type": 60, "area": 120,
    "pincode": 20, "date_of_birth": 60, "created_date": 60,
}
PROCEDURE_WIDTHS = {
    "procedure_id": 40, "admission_id": 40, "provider_id": 40, "cpt_code": 20, "procedure_description": 400,
    "procedure_date": 60, "procedure_cost": 40,
}
PROVIDER_WIDTHS = {
    "provider_id": 40, "department_id": 40, "name": 200, "specialty": 200, "years_experience": 20,
}


def standardize_patients(raw: DataFrame, source_limits: bool = False, account: Observation | None = None) -> DataFrame:
    """Patients. Rows without a patient id stay."""
    tokens = _clean(
        raw, PATIENT_WIDTHS, S.PATIENT_TOKENS, ("mrn", "area"), {"date_of_birth": D.date_text},
        source_limits=source_limits, account=account,
    )
    return _typed(
        tokens,
        {
            "patient_id": N.safe_int(c("patient_id")),
            "mrn": c("mrn"),
            "gender": M.fold_gender(c("gender")),
            "blood_group": M.fold_blood_group(c("blood_group")),
            "insurance_type": M.fold_payer(c("insurance_type")),
            "area": S.squeeze_spaces(c("area"), 2),
            "pincode": N.pincode(c("pincode")),
            "date_of_birth": D.parse_date(c("date_of_birth"), D.BIRTH_CLASSES),
            "created_date": D.parse_created(c("created_date")),
        },
        (), source_limits, account,
    )


def standardize_procedures(raw: DataFrame, source_limits: bool = False, account: Observation | None = None) -> DataFrame:
    """Procedures with five-digit codes and title-cased descriptions."""
    tokens = _clean(
        raw, PROCEDURE_WIDTHS, S.PROCEDURE_TOKENS, ("procedure_description",),
        {
            "cpt_code": N.cpt_number,
            "procedure_description": S.spaced_commas,
            "procedure_date": D.date_text,
        },
        source_limits=source_limits, account=account,
    )
    return _typed(
        tokens,
        {
            "procedure_id": N.safe_int(c("procedure_id")),
            "admission_id": N.safe_int(c("admission_id")),
            "provider_id": N.safe_int(c("provider_id")),
            "cpt_code": N.cpt_code(c("cpt_code")),
            "procedure_description": S.title_description(c("procedure_description")),
            "procedure_date": D.parse_date(c("procedure_date"), D.PROCEDURE_CLASSES),
            "procedure_cost": N.safe_decimal(c("procedure_cost"), 18, 2),
        },
        ("procedure_id", "admission_id",), source_limits, account,
    )


def standardize_providers(raw: DataFrame, source_limits: bool = False, account: Observation | None = None) -> DataFrame:
    """Providers with title-cased names."""
    tokens = _clean(
        raw, PROVIDER_WIDTHS, S.PROVIDER_TOKENS, ("name", "specialty"),
        {"years_experience": lambda x: N.safe_int(x, "tinyint")},
        source_limits=source_limits, account=account,
    )
    return _typed(
        tokens,
        {
            "provider_id": N.safe_int(c("provider_id")),
            "department_id": N.safe_int(c("department_id")),
            "name": S.title_words(S.squeeze_spaces(c("name"), 2), doctor=True),
            "specialty": S.title_words(S.squeeze_spaces(c("specialty"), 2)),
            "years_experience": N.experience_years(c("years_experience")),
        },
        ("provider_id", "department_id",), source_limits, account,
    )


STANDARDIZE = {
    "admissions": standardize_admissions,
    "billing": standardize_billing,
    "departments": standardize_departments,
    "diagnoses": standardize_diagnoses,
    "hospitals": standardize_hospitals,
    "lab_results": standardize_lab_results,
    "patients": standardize_patients,
    "procedures": standardize_procedures,
    "providers": standardize_providers,
}
