"""What standardizing loses, counted in the pass that standardizes.

Rows without a required key are dropped, texts that do not convert become NULL, and with the original's limits long texts are cut.
None of it is an error. :func:`accounted` returns the standardized table together with an ``Observation`` that any
action on it fills: no second scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession

from medloom.operators.standardize import STANDARDIZE

SCHEMA = "table_name string, rule string, column_name string, n long"


def accounted(entity: str, raw: DataFrame, source_limits: bool = False) -> tuple[DataFrame, Observation]:
    """The standardized table, and the account of it once the table has been written or otherwise gone through."""
    account = Observation(f"losses {entity}")
    return STANDARDIZE[entity](raw, source_limits=source_limits, account=account), account


def entries(entity: str, account: Observation) -> list[tuple[str, str, str | None, int]]:
    """Rows of the account: table, rule, column, count. Waits for an action on the table.

    Rules: 'rows' (read), 'dropped' (a required key is missing), and for each column 'failed' (a value that is no placeholder
    became NULL) and 'cut' (longer than the original's width; cut only with its limits).
    """
    out = []
    for name, n in account.get.items():
        rule, _, column = name.partition(" ")
        out.append((entity, rule, column or None, int(n)))
    return out


def account_of(spark: SparkSession, raws: dict[str, DataFrame], paths: dict[str, str] | None = None, source_limits: bool = False) -> DataFrame:
    """Standardize each raw table, write it where ``paths`` says (or nowhere), and return the whole account."""
    rows = []
    for entity, raw in raws.items():
        std, account = accounted(entity, raw, source_limits)
        if paths and entity in paths:
            std.write.mode("overwrite").parquet(paths[entity])
        else:
            std.write.format("noop").mode("overwrite").save()
        rows += entries(entity, account)
    return spark.createDataFrame(rows, SCHEMA)  # two rows for each column of the tables
