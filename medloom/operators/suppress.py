"""Small cells of a table with totals, blanked so that the totals do not give them away.

A cell below the least count is blank. If its line shows all other cells and a total, the blank is their difference, so
further cells must go. A blank is safe against any sums and differences of published numbers if it is the corner of
a rectangle of four blanks: moving one count round the corners changes no total. For each blank that has no such
rectangle the cheapest one is taken, the one that hides the fewest counts; smaller blanks are served first. Cells
without a count are published as zero and never serve as corners. Where no rectangle exists, the totals of the
table are withheld instead.

Counts are summed in Spark; a table, whose cells are as many as its categories allow, is treated in one task, tables
side by side.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medloom.sources.shared import importable

SMALL, COMPLEMENT = "small", "complement"


def rectangles(counts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """Which cells are small, which go with them, and whether the totals may be published."""
    small = (counts > 0) & (counts < least)
    blank = small.copy()
    cost = counts.astype(np.float64)
    cost[counts == 0] = np.inf
    cells = np.argwhere(small)
    for r, c in cells[np.argsort(counts[small], kind="stable")].tolist():
        price = np.where(blank, 0.0, cost)
        corner = price + price[r, :][None, :] + price[:, c][:, None]
        corner[r, :] = np.inf
        corner[:, c] = np.inf
        if not corner.size or not np.isfinite(corner.min()):
            return small, np.zeros_like(small), False
        r2, c2 = np.unravel_index(int(corner.argmin()), corner.shape)
        blank[[r, r2, r2], [c2, c, c2]] = True
    return small, blank & ~small, True


def _table(rows: str, columns: str, least: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(cells: pd.DataFrame) -> pd.DataFrame:
        cells = cells.sort_values([rows, columns], na_position="first", ignore_index=True)
        r, _ = pd.factorize(cells[rows], use_na_sentinel=False)
        c, _ = pd.factorize(cells[columns], use_na_sentinel=False, sort=False)
        counts = np.zeros((r.max() + 1, c.max() + 1), np.int64)
        counts[r, c] = cells["n"]
        small, more, totals = rectangles(counts, least)
        why = np.where(small[r, c], SMALL, np.where(more[r, c], COMPLEMENT, ""))
        shown = pd.array([None if w else n for n, w in zip(cells["n"].tolist(), why.tolist(), strict=True)], dtype="Int64")
        return cells.assign(n=shown, suppressed=[w or None for w in why.tolist()], totals=totals)

    return run


def suppressed_table(df: DataFrame, table: str, rows: str, columns: str, least: int = 11) -> DataFrame:
    """Counts of ``df`` by table, row and column: the three, n (NULL where blank), suppressed, totals.

    ``suppressed`` is 'small', 'complement' or NULL; ``totals`` says whether the table's totals may be published. A
    missing category is a category. Combinations that do not occur are not listed.
    """
    importable(df.sparkSession)
    counts = df.groupBy(table, rows, columns).agg(F.count(F.lit(1)).alias("n"))
    schema = T.StructType([*counts.schema.fields[:3], T.StructField("n", T.LongType()), T.StructField("suppressed", T.StringType()), T.StructField("totals", T.BooleanType())])
    return counts.groupBy(table).applyInPandas(_table(rows, columns, least), schema)


def published_totals(df: DataFrame, cells: DataFrame, table: str, rows: str, columns: str) -> DataFrame:
    """The totals that may be published: table, row or NULL, column or NULL, is_row, is_column, n."""
    allowed = cells.groupBy(table).agg(F.min("totals").alias("totals"))
    of_row, of_column = (df.groupBy(table, x).agg(F.count(F.lit(1)).alias("n")) for x in (rows, columns))
    nothing = F.lit(None)
    both = of_row.select(table, F.col(rows), nothing.cast(df.schema[columns].dataType).alias(columns), F.lit(True).alias("is_row"), "n").unionByName(
        of_column.select(table, nothing.cast(df.schema[rows].dataType).alias(rows), F.col(columns), F.lit(False).alias("is_row"), "n")
    )
    keep = both[table].eqNullSafe(allowed[table]) & allowed["totals"]
    return both.join(allowed, keep, "left_semi")
