"""Naming an intermediate value inside an expression."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it.

    A projection of its own would do the same for a result, but not for a filter on that result: Spark pushes
    the filter below the projections and copies every expression into each place that uses it. A rule that
    mentions its input six times on top of one that mentions its input four times then becomes 24 copies.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def constant_map(pairs: Mapping[str, str]) -> Column:
    """A map of texts as one constant; a literal per entry would cost the driver a call each."""
    return F.expr("map(" + ", ".join(f"{_quoted(k)}, {_quoted(v)}" for k, v in pairs.items()) + ")")


def constant_array(texts: Sequence[str]) -> Column:
    """An array of texts as one constant."""
    return F.expr("array(" + ", ".join(_quoted(t) for t in texts) + ")")
