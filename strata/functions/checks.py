"""Boolean expressions behind the data-quality rules. Each is TRUE or FALSE, never NULL."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.text import is_blank


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def keys_present(columns: Iterable[str]) -> Column:
    return all_of(~is_blank(F.col(c)) for c in columns)


def castable(expected: Mapping[str, str]) -> Column:
    """NULL is castable to everything; any other value must survive a tolerant cast."""
    return all_of(F.col(c).isNull() | F.col(c).try_cast(t).isNotNull() for c, t in expected.items())


def not_allowed(col: Column, values: Iterable[str]) -> Column:
    return F.coalesce(~col.isin(*values), F.lit(False))


def out_of_range(col: Column, low=None, high=None) -> Column:
    bad = []
    if low is not None:
        bad.append(F.coalesce(col < F.lit(low), F.lit(False)))
    if high is not None:
        bad.append(F.coalesce(col > F.lit(high), F.lit(False)))
    return any_of(bad)
