"""Dates from text in several notations.

A column accepts a list of order classes, tried in the listed order. Each class has a shape that is
checked first, months and days in range included, and the text is then rearranged to year-month-day and
cast with ``try_cast``. A cast or a formatter given a bad date raises and catches an exception in the JVM,
so only days like 31 February get that far. One pattern holds all shapes of a column, which keeps the generated code short.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from medloom.functions.binding import let

YMD = "YMD"
YMD_TIME = "YMD_TIME"
YMD_TIME_FRACTION = "YMD_TIME_FRACTION"
COMPACT = "COMPACT"
MDY = "MDY"
DMY = "DMY"
DMY2 = "DMY2"
YMD_TIME_ISO = "YMD_TIME_ISO"
MDY2 = "MDY2"
MON = "MON"
MON_TIME = "MON_TIME"
DAY_MON = "DAY_MON"

# Order in which each column's notations are tried.
STAY_CLASSES = (YMD, YMD_TIME, COMPACT, MDY, DMY, MON)
BIRTH_CLASSES = (YMD, COMPACT, MDY, DMY)
PROCEDURE_CLASSES = (YMD, YMD_TIME_ISO, COMPACT, MDY, DMY, MON, MON_TIME, DAY_MON)
DIAGNOSIS_CLASSES = (YMD, YMD_TIME_FRACTION, DMY, MDY, DMY2, MDY2)
TEST_CLASSES = (YMD, DMY, MDY)

# Month names and their numbers.
MONTHS = {
    "jan": "01", "feb": "02", "mar": "03", "apr": "04", "may": "05", "jun": "06",
    "jul": "07", "aug": "08", "sep": "09", "oct": "10", "nov": "11", "dec": "12",
}
_MONTH = (
    "(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?"
    "|sep(?:tember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
)
_YEAR = "(?!0000)[0-9]{4}"
_MM = "(?:0?[1-9]|1[0-2])"
_DD = "(?:0?[1-9]|[12][0-9]|3[01])"
_CLOCK = "(?:[01]?[0-9]|2[0-3]):[0-5][0-9]"
_CLOCK12 = "(?:0?[1-9]|1[0-2]):[0-5][0-9](?::[0-5][0-9])? ?[AaPp][Mm]"

# Shapes of each class, on text whose '/' and '.' are already '-'. '(<y>', '(<m>' and '(<d>' begin the parts of a date.
_ISO = f"(<y>{_YEAR})-(<m>{_MM})-(<d>{_DD})"
_SHAPES = {
    YMD: _ISO,
    YMD_TIME: f"{_ISO}(?: +{_CLOCK}(?::[0-5][0-9])?)?",
    YMD_TIME_FRACTION: f"{_ISO}(?: +{_CLOCK}(?::[0-5][0-9](?:-[0-9]{{1,7}})?)?)?",
    YMD_TIME_ISO: f"{_ISO}(?: +{_CLOCK}(?::[0-5][0-9](?:-[0-9]{{1,7}})?)?|T{_CLOCK}:[0-5][0-9](?:-[0-9]{{1,7}})?)?",
    COMPACT: f"(<y>{_YEAR})(<m>0[1-9]|1[0-2])(<d>0[1-9]|[12][0-9]|3[01])",
    MDY: f"(<m>{_MM})-(<d>{_DD})-(<y>{_YEAR})",
    DMY: f"(<d>{_DD})-(<m>{_MM})-(<y>{_YEAR})",
}
_TIMED = (YMD_TIME, YMD_TIME_FRACTION, YMD_TIME_ISO)

# Months by name and years of two digits need a text that the date does not hold: the number of the month, the century.
# It is put behind the date, after a bar, and a match takes it from there.
_NAME = f"(<n>(?={_MONTH}[- ])[a-z]{{3}})[a-z]*"
_NAMED = {
    MON: f"(?i:{_NAME} +(<d>{_DD})(?:, *| +)(<y>{_YEAR}))",
    MON_TIME: f"(?i:{_NAME} +(<d>{_DD}),? +(<y>{_YEAR}) +{_CLOCK12})",
    DAY_MON: f"(?i:(<d>{_DD})[- ]{_NAME}[- ](<y>{_YEAR}))",
}
_MONTH_TABLE = "".join(name + number for name, number in MONTHS.items())
_IN_TABLE = "(?:[a-z]{3}[0-9]{2})*(?i:<same name>)(<m>[0-9]{2})(?:[a-z]{3}[0-9]{2})*"

# Two-digit years may have spaces anywhere, and only they: 00-29 are 2000-2029, 30-99 are 1930-1999.
_SHORT_DAY = " *+(?=(?:0? *+[1-9]|[12] *+[0-9]|3 *+[01]) *+-)(<d>[0-3]?) *+(<d>[0-9]) *+"
_SHORT_MONTH = " *+(?=(?:0? *+[1-9]|1 *+[0-2]) *+-)(<m>[01]?) *+(<m>[0-9]) *+"
_SHORT_YEAR = r" *+(?:(?=[0-2].*\|19(<c>20)\z)|(?=[3-9].*\|(<c>19)20\z))(<y>[0-9]) *+(<y>[0-9]) *+"
_SHORT = {DMY2: f"{_SHORT_DAY}-{_SHORT_MONTH}-{_SHORT_YEAR}", MDY2: f"{_SHORT_MONTH}-{_SHORT_DAY}-{_SHORT_YEAR}"}
_CENTURIES = "1920"
_MARK = re.compile(r"\(<(.)>|<same name>")

CREATED_SHAPE = (
    f"^{_YEAR}-[0-9]{{1,2}}-[0-9]{{1,2}}"
    r"(?:[ T](?:[01]?[0-9]|2[0-3]):[0-5][0-9](?::[0-5][0-9](?:\.[0-9]{1,7})?)?)?\z"
)
FIRST_DAY, LAST_DAY = "0001-01-01", "9999-12-31"


def date_text(col: Column) -> Column:
    """The text with '/' and '.' written as '-'."""
    return F.replace(F.replace(col, F.lit("/"), F.lit("-")), F.lit("."), F.lit("-"))


def _rewriting(classes: Sequence[str]) -> tuple[str, str, str]:
    """What to put behind a text, the pattern for the whole, and how to write a match in year-month-day order.

    The classes are alternatives, tried in order; a part of the date is the groups of that part in all of them, of which one
    alternative's are filled. A text that fits none matches as well, with all groups empty, and gives no date.
    """
    if any(k in _TIMED for k in classes):  # their time may be missing
        classes = [k for k in classes if k != YMD]
    months = rf"\|{_MONTH_TABLE}" if any(k in _NAMED for k in classes) else ""
    centuries = rf"\|{_CENTURIES}" if any(k in _SHORT for k in classes) else ""
    ends = {k: rf"\|{_IN_TABLE}{centuries}" if k in _NAMED else months + centuries for k in classes}
    marked = "|".join({**_SHAPES, **_NAMED, **_SHORT}[k] + ends[k] for k in classes)
    groups: list[str] = []

    def numbered(mark: re.Match) -> str:
        if mark[1] is None:
            return rf"\{len(groups) - groups[::-1].index('n')}"
        groups.append(mark[1])
        return "("

    pattern = _MARK.sub(numbered, marked)
    century, year, month, day = ("".join(f"${i}" for i, g in enumerate(groups, 1) if g == part) for part in "cymd")
    return (months + centuries).replace("\\", ""), rf"^(?:{pattern})\z|(?s:.+)", f"{century}{year}-{month}-{day}"


def parse_date(text: Column, classes: Sequence[str]) -> Column:
    """First class, in order, whose shape and calendar fit. ``text`` must come from ``date_text``.

    The text is used once and matched once, without a lambda function: Spark compiles the whole expression, and a filter on the
    result is pushed below the projections without copies.
    """
    behind, pattern, order = _rewriting(classes)
    whole = F.concat(text, F.lit(behind)) if behind else text
    return F.regexp_replace(whole, pattern, order).try_cast("date")


def parse_created(text: Column) -> Column:
    """ISO date or date-time, rounded half up to whole seconds, without a time zone."""

    def read(t: Column) -> Column:
        seconds = F.substring_index(t, ".", 1).try_cast("timestamp_ntz")
        rounds_up = t.rlike(r"\.[5-9]")
        value = F.when(rounds_up, seconds + F.expr("INTERVAL '1' SECOND")).otherwise(seconds)
        return F.when(t.rlike(CREATED_SHAPE), value)

    return let(text, read)


def in_calendar(day: Column) -> Column:
    """NULL for dates outside years 1 to 9999."""
    first, last = F.lit(FIRST_DAY).cast("date"), F.lit(LAST_DAY).cast("date")
    return let(day, lambda d: F.when(d.between(first, last), d))


def days_after(day: Column, days: Column) -> Column:
    """``day`` plus whole days; NULL outside the calendar."""
    return in_calendar(F.try_add(day, days))


def days_before(day: Column, days: Column) -> Column:
    """``day`` minus whole days; NULL outside the calendar."""
    return in_calendar(F.try_subtract(day, days))
