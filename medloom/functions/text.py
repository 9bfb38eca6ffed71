"""Text cleaning and casing as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from medloom.functions.binding import constant_array, let

# Placeholder texts that mean "no value", per source (upper case).
COMMON_TOKENS = ("", "NULL", "N/A", "TBD", "-")
LAB_TOKENS = ("", "NULL", "N/A", "TBD", "-", "SEE ATTACHED")
PROCEDURE_TOKENS = ("", "NULL", "N/A", "TBD", "-", "—")
PROVIDER_TOKENS = ("", "NULL", "N/A", "NA", "TBD", "UNKNOWN", "-", "—")
PATIENT_TOKENS = (
    "", "NULL", "N/A", "NA", "NOT PROVIDED", "PENDING", "TBD", "UNKNOWN", "NONE", "-", "—",
)


def clean_text(col: Column, width: int | None = None) -> Column:
    """Turn tabs and line breaks into spaces and trim spaces; with ``width`` cut to so many characters first.

    ``replace`` returns at once where nothing matches; ``translate`` rebuilds every text and costs far more.
    """
    text = cut(col.cast("string"), width)
    for control in "\t\n\r":
        text = F.replace(text, F.lit(control), F.lit(" "))
    return F.trim(text)


def null_tokens(col: Column, tokens: Sequence[str] = COMMON_TOKENS) -> Column:
    """NULL where the cleaned text is one of the placeholder tokens, in any letter case.

    A constant array compiles to one small loop; ``isin`` would unroll into a comparison per token.
    """
    return F.when(~F.array_contains(constant_array(tokens), F.upper(col)), col)


def matched(col: Column, shape: str, group: int = 0) -> Column:
    """The part of the text that fits ``shape``, NULL without a match. ``col`` is evaluated once."""
    return F.nullif(F.regexp_extract(col, shape, group), F.lit(""))


def drop_text(col: Column, *parts: str) -> Column:
    """Remove every occurrence of each given text."""
    for part in parts:
        col = F.replace(col, F.lit(part), F.lit(""))
    return col


def squeeze_spaces(col: Column, passes: int) -> Column:
    """Halve runs of spaces ``passes`` times; long runs may keep more than one space."""
    for _ in range(passes):
        col = F.replace(col, F.lit("  "), F.lit(" "))
    return col


def sentence_case(col: Column) -> Column:
    """First letter upper, everything after it lower."""
    return F.concat(F.upper(F.substring(col, 1, 1)), F.lower(F.substring(col, 2, 2**31 - 1)))


def cut(col: Column, width: int | None) -> Column:
    """The first ``width`` characters; the whole text without a width."""
    return col if width is None else F.substring(col, 1, width)


def or_na(col: Column) -> Column:
    """'NA' where the value is missing; for texts that cannot be blank."""
    return F.coalesce(col, F.lit("NA"))


def physician_core(col: Column) -> Column:
    """The name without a leading 'Dr.'/'Dr'; NULL when nothing is left.

    Any name that starts with the letters 'dr' loses them ('Drake' -> 'ake'), as in the source rule.
    """
    def strip(name: Column) -> Column:
        head = F.upper(F.substring(name, 1, 3))
        return (
            F.when(head == "DR.", F.substring(name, 4, 4000))
            .when(head.startswith("DR"), F.substring(name, 3, 4000))
            .otherwise(name)
        )

    return F.nullif(F.ltrim(let(col, strip)), F.lit(""))


def physician_label(core: Column) -> Column:
    """'Dr. ' plus the name in sentence case."""
    return F.concat(F.lit("Dr. "), sentence_case(core))


def tighten_range(col: Column) -> Column:
    """Remove the spaces around dashes in a reference range, then halve doubled spaces once."""
    for spaced in (" - ", "- ", " -"):
        col = F.replace(col, F.lit(spaced), F.lit("-"))
    return squeeze_spaces(col, 1)


def title_words(col: Column, doctor: bool = False) -> Column:
    """Title case word by word; a comma is a word of its own and a dot is a space.

    With ``doctor`` the word 'dr' becomes 'Dr.'. NULL when no word is left.
    """
    spaced = F.replace(F.replace(col, F.lit(","), F.lit(" , ")), F.lit("."), F.lit(" "))
    words = F.initcap(F.trim(F.regexp_replace(spaced, " +", " ")))
    if doctor:
        words = F.regexp_replace(words, "(?<![^ ])Dr(?![^ ])", "Dr.")
    return F.nullif(words, F.lit(""))


def spaced_commas(col: Column) -> Column:
    """A space on both sides of every comma, then runs of spaces halved twice."""
    return squeeze_spaces(F.replace(col, F.lit(","), F.lit(" , ")), 2)


def title_description(spaced: Column) -> Column:
    """Title case that keeps 2-4 letter capital words ('CT', 'MRI') and glues commas to the left word.

    ``spaced`` comes from ``spaced_commas``. Only texts with such a capital word are split into words.
    """
    words = F.transform(
        F.split(spaced, " "),
        lambda w: F.when(w.rlike("^[A-Z]{2,4}$"), w).otherwise(F.initcap(w)),
    )
    has_short_capitals = spaced.rlike("(?<![^ ])[A-Z]{2,4}(?![^ ])")
    titled = F.when(has_short_capitals, F.array_join(words, " ")).otherwise(F.initcap(spaced))
    return F.trim(squeeze_spaces(F.replace(titled, F.lit(" ,"), F.lit(",")), 1))
