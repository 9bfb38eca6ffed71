"""Joins that say what they did: rows in, rows out and doubled matches, observed in the pass that joins.

A join on a key that should be unique but is not multiplies rows without an error. Counting keys beforehand takes a
scan of its own; here the right side numbers the rows of each key in the partitions the join needs anyway, and the
counts come as observed metrics of the one job that runs the join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

SCHEMA = "join_name string, rows_in long, keyless long, rows_out long, unmatched long, doubled long, most_matches long"
_MATCH = "_match"


class FanOutError(RuntimeError):
    """A join gave more than one row for a row of its left side."""


@dataclass(frozen=True)
class Guard:
    """What a join did. Answers once an action has gone through the joined table."""

    name: str
    before: Observation
    after: Observation

    def report(self) -> dict[str, object]:
        """rows_in, keyless (rows without a key), rows_out, unmatched, doubled (rows that met more than one), most_matches."""
        return {"join_name": self.name, **self.before.get, **{k: v or 0 for k, v in self.after.get.items()}}

    def check(self) -> None:
        found = self.report()
        if found["doubled"]:
            raise FanOutError(f"{self.name}: {found['doubled']} of {found['rows_in']} rows met up to {found['most_matches']} rows")


def guarded_join(left: DataFrame, right: DataFrame, keys: Sequence[str], name: str, how: str = "left") -> tuple[DataFrame, Guard]:
    """``left`` joined to ``right`` on ``keys``, and its guard. ``how`` is 'left' or 'inner'.

    Rows without a key match nothing. The right side is dealt and sorted by the key once, for numbering and joining both.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"no guard for {how} joins")
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    guard = Guard(name, Observation(f"{name} in"), Observation(f"{name} out"))
    counted = left.observe(guard.before, F.count(F.lit(1)).alias("rows_in"), F.count_if(missing).alias("keyless"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    numbered = right.filter(~missing).withColumn(_MATCH, place)
    joined = counted.join(numbered, list(keys), "left").observe(
        guard.after,
        F.count(F.lit(1)).alias("rows_out"),
        F.count_if(F.col(_MATCH).isNull()).alias("unmatched"),
        F.count_if(F.col(_MATCH) == 2).alias("doubled"),
        F.max(_MATCH).alias("most_matches"),
    )
    kept = joined.filter(F.col(_MATCH).isNotNull()) if how == "inner" else joined
    return kept.drop(_MATCH), guard


def reports(spark: SparkSession, guards: Sequence[Guard]) -> DataFrame:
    """One row per guard."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(g.report()[n] for n in names) for g in guards], SCHEMA)
