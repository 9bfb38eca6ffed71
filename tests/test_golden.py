"""Hand-made inputs with expected outputs, one per cleaning rule."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from medloom.functions import dates as D
from medloom.functions import folds as M
from medloom.functions import numbers as N
from medloom.functions import text as S
from medloom.operators import standardize as Z


def run(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").select("o").collect()]


def token(tokens, fn=None):
    def build(col):
        value = S.null_tokens(S.clean_text(col), tokens)
        return fn(value) if fn else value

    return build


def day(classes):
    return lambda col: D.parse_date(D.date_text(col), classes)


d = date
CASES = [
    ("clean", S.clean_text, ["\t Ab\r\nc "], ["Ab  c"]),
    ("tokens", token(S.COMMON_TOKENS), ["n/a", "tbd", "-", "", "NA", "PENDING"], [None] * 4 + ["NA", "PENDING"]),
    ("tokens patients", token(S.PATIENT_TOKENS), ["pending", "None", "—"], [None] * 3),
    ("tokens labs", token(S.LAB_TOKENS), ["See Attached"], [None]),
    ("tokens procedures", token(S.PROCEDURE_TOKENS), ["—", "pending"], [None, "pending"]),
    ("int", N.safe_int, ["1,234", "12.5", "1e3", ",", "-3", "99999999999", "+7", ""],
     [1234, None, None, None, -3, None, 7, None]),
    ("tinyint", lambda x: N.safe_int(x, "tinyint"), ["200", "255", "256", "-1"], [200, 255, None, None]),
    ("decimal 18,2", lambda x: N.safe_decimal(x, 18, 2), ["1,234.565", "1 000", "1E3", "abc", "-.5"],
     [Decimal("1234.57"), Decimal("1000.00"), None, None, Decimal("-0.50")]),
    ("decimal 5,2", lambda x: N.safe_decimal(x, 5, 2), ["12.345", "1000"], [Decimal("12.35"), None]),
    ("stay dates", day(D.STAY_CLASSES),
     ["03/04/2021", "13/04/2021", "2021.4.3", "20210403", "Apr 03, 2021", "31-02-2021", "2021-04-03 10:11:12",
      "2021-04-03 10:11:12.000", "2021-04-03 25:11:12", "0000-01-01", "2021-13-01", "03-04-21", "april 3, 2021",
      "20211301", "03 Apr 2021"],
     [d(2021, 3, 4), d(2021, 4, 13), d(2021, 4, 3), d(2021, 4, 3), d(2021, 4, 3), None, d(2021, 4, 3),
      None, None, None, None, None, d(2021, 4, 3), None, None]),
    ("diagnosis dates", lambda x: D.parse_date(D.date_text(x), D.DIAGNOSIS_CLASSES),
     ["03/04/2021", "04/13/2021", "05-04-21", "05-04-30", "04-25-29", "05 - 04 - 21", "2021-04-03 10:11:12.5", "30/02/2021",
      "05   -   04-21", "0 5-04-21", "03 - 04 - 2021", "2021-04-03T10:11:12", "2021-04-03\u0085"],
     [d(2021, 4, 3), d(2021, 4, 13), d(2021, 4, 5), d(1930, 4, 5), d(2029, 4, 25), d(2021, 4, 5), d(2021, 4, 3), None,
      d(2021, 4, 5), d(2021, 4, 5), None, None, None]),
    ("test dates", day(D.TEST_CLASSES), ["03/04/2021", "12-25-2021", "20210403"],
     [d(2021, 4, 3), d(2021, 12, 25), None]),
    ("birth dates", day(D.BIRTH_CLASSES), ["03/04/2021", "19700203", "1980-01-1"],
     [d(2021, 3, 4), d(1970, 2, 3), d(1980, 1, 1)]),
    ("procedure dates", day(D.PROCEDURE_CLASSES),
     ["03.04.2021", "Apr 03 2021 10:11AM", "5-jan-2021", "5 January 2021", "25.12.2021", "2021-04-03 10:11",
      "2021-04-03T10:11:12", "2021-04-03T10:11:12.123", "2021-04-03T10:11", "2021-04-03T"],
     [d(2021, 3, 4), d(2021, 4, 3), d(2021, 1, 5), d(2021, 1, 5), d(2021, 12, 25), d(2021, 4, 3), d(2021, 4, 3), d(2021, 4, 3),
      None, None]),
    ("created", D.parse_created,
     ["2001-07-20 08:09:10", "2001-07-20T08:09:10", "2001-07-20", "03-04-2021", "2001-07-20 08:09:10.6",
      "2001-07-20 08:09:10.49", "2001-07-20 08:09", "2001-12-31 23:59:59.5"],
     [datetime(2001, 7, 20, 8, 9, 10), datetime(2001, 7, 20, 8, 9, 10), datetime(2001, 7, 20), None,
      datetime(2001, 7, 20, 8, 9, 11), datetime(2001, 7, 20, 8, 9, 10), datetime(2001, 7, 20, 8, 9),
      datetime(2002, 1, 1)]),
    ("icd", N.icd_code, ["a12.3", "A123", "A1B2", "A12.", "A12.34567", "A12-3", "A12.3.4", "A12..", "A12..3", "a 123", "A123\u0085"],
     ["A12.3", "A123", None, None, None, None, "A12.3.4", None, "A12..3", "A123", None]),
    ("cpt", lambda x: N.cpt_code(N.cpt_number(x)), ["99", "99213.0", "123456", "99,213", "-5", "12.5", "A0001", "0", "99212.999999"],
     ["00099", "99213", None, "99213", None, None, None, "00000", "99213"]),
    ("pincode", N.pincode, ["560 001", "012345", "12345", "1,23,456", "+123456", "0123456"],
     ["560001", "012345", None, None, "123456", "123456"]),
    ("admission type", lambda v: M.fold_or_na(S.clean_text(v), M.ADMISSION_TYPES, S.COMMON_TOKENS),
     ["er", "E.R.", "day care", "walk-in", None, "n/a", " "],
     ["Emergency", "E.r.", "Observation", "Walk-in", "NA", "NA", "NA"]),
    ("discharge status", lambda v: M.fold(v, M.DISCHARGE_STATUSES, "sentence"), ["lama", "SNF", "went home"],
     ["Left Against Medical Advice", "Skilled Nursing Facility", "Went home"]),
    ("physician", lambda v: S.or_na(S.physician_label(S.physician_core(v))),
     ["dr. john SMITH", "Dr Jane", "Drake", "DR.", "ann LEE"],
     ["Dr. John smith", "Dr. Jane", "Dr. Ake", "NA", "Dr. Ann lee"]),
    ("provider name", lambda v: S.title_words(S.squeeze_spaces(v, 2), doctor=True),
     ["dr JOHN  o. smith", "smith,john", ".", "dr dr drake", "o'neil x-ray", "JANE DR"],
     ["Dr. John O Smith", "Smith , John", None, "Dr. Dr. Drake", "O'neil X-ray", "Jane Dr."]),
    ("description", lambda v: S.title_description(S.spaced_commas(v)),
     ["CT scan of chest", "chest x-ray, pa", "MRI,BRAIN", "a         b", "b12 SCAN"],
     ["CT Scan Of Chest", "Chest X-ray, Pa", "MRI, Brain", "A  B", "B12 SCAN"]),
    ("experience", lambda v: N.experience_years(N.safe_int(v, "tinyint")), ["60", "61", "-1"], [60, None, None]),
    ("range", S.tighten_range, ["3.5 - 5.0", "3.5- 5.0", "3.5 -5.0"], ["3.5-5.0"] * 3),
    ("payer", M.fold_payer, ["self-pay", "PVT", "medicare"], ["Self Pay", "Private", None]),
    ("gender", M.fold_gender, ["m", "Female", "o", "x"], ["Male", "Female", "Other", None]),
    ("blood", M.fold_blood_group, ["a +", "ab-", "C+"], ["A+", "AB-", None]),
    ("accreditation", M.fold_accreditation, ["jci", "none", "Iso 9", "x" * 30], ["JCI", "None", "Iso 9", "x" * 30]),
    ("spaces", lambda v: S.squeeze_spaces(v, 2), ["a     b", "a    b"], ["a  b", "a b"]),
]


@pytest.mark.parametrize("name,fn,values,expected", CASES, ids=[x[0] for x in CASES])
def test_rule(spark, name, fn, values, expected):
    assert run(spark, fn, values) == expected


def stay(**given):
    names = (
        "admission_id", "admission_date", "patient_id", "hospital_id", "department_id", "discharge_date",
        "admission_type", "discharge_status", "length_of_stay", "room_number", "attending_physician",
    )
    return tuple(given.get(n) for n in names), names


def test_imputation(spark):
    rows = [
        stay(admission_id="1", discharge_date="2021-04-10", length_of_stay="3")[0],
        stay(admission_id="2", admission_date="2021-04-07", discharge_date="2021-04-10", length_of_stay="5")[0],
        stay(admission_id="3", admission_date="2021-04-07", length_of_stay="2000000000")[0],
        stay(admission_id="4", admission_date="2021-04-07", length_of_stay="-2")[0],
        stay(admission_id="5", admission_date="2021-04-07", length_of_stay="3652058")[0],
        stay(admission_id="6", discharge_date="2021-04-07", length_of_stay="-2147483648")[0],
        stay(admission_id=",", admission_date="2021-04-07")[0],
    ]
    names = stay()[1]
    raw = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    got = {r.admission_id: r for r in Z.standardize_admissions(raw).collect()}
    assert sorted(got) == [1, 2, 3, 4, 5, 6]
    assert got[1].admission_date_imputed == got[1].admission_date_final == date(2021, 4, 7)
    assert got[1].is_admission_date_imputed and not got[1].is_discharge_date_imputed
    assert got[2].discharge_date_imputed == date(2021, 4, 12)
    assert got[2].discharge_date_final == date(2021, 4, 10)
    assert not got[2].is_discharge_date_imputed
    assert got[3].discharge_date_imputed is None and got[3].is_discharge_date_imputed
    assert got[4].discharge_date_final == date(2021, 4, 5)
    assert got[5].discharge_date_imputed is None
    assert got[6].admission_date_imputed is None
    assert got[1].room_number == got[1].attending_physician == "NA"


def test_patients_without_id_stay(spark):
    raw = spark.createDataFrame([("unknown",) + (None,) * 8], ", ".join(f"{n} string" for n in Z.PATIENT_WIDTHS))
    assert [r.patient_id for r in Z.standardize_patients(raw).collect()] == [None]
