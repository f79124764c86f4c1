"""Row filters with the null rules of the measures spelled out.

A filter written here as "not equal" or "not in" keeps rows whose value is null: an unknown
value is not the excluded one. A comparison of any other kind drops them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from opsgauge.functions.text import contains_ci, starts_with


def ne(c: Column, value) -> Column:
    return ~c.eqNullSafe(F.lit(value))


def not_in(c: Column, values: Iterable) -> Column:
    return F.coalesce(~c.isin(*values), F.lit(True))


def has_prefix(c: Column, *prefixes: str) -> Column:
    return F.coalesce(starts_with(c.cast("string"), *prefixes), F.lit(False))


def lacks_prefix(c: Column, *prefixes: str) -> Column:
    return ~has_prefix(c, *prefixes)


def where_eq(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(F.col(col) == F.lit(value))


def where_ne(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(ne(F.col(col), value))


def where_in(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    return df.filter(F.col(col).isin(*values))


def where_not_in(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    return df.filter(not_in(F.col(col), values))


def where_prefix(df: DataFrame, col: str, prefixes: Sequence[str], negate: bool = False) -> DataFrame:
    test = lacks_prefix if negate else has_prefix
    return df.filter(test(F.col(col), *prefixes))


def where_contains_ci(df: DataFrame, col: str, part: str, negate: bool = False) -> DataFrame:
    test = contains_ci(F.col(col), part)
    return df.filter(~test if negate else test)


def where_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def where_not_null(df: DataFrame, *cols: str) -> DataFrame:
    return df.dropna(subset=list(cols))


def exclude_when(df: DataFrame, *conditions: Column) -> DataFrame:
    """Drop the rows for which every condition holds; an unknown condition does not hold."""
    return df.filter(~F.coalesce(reduce(and_, conditions), F.lit(False)))


def drop_all_null(df: DataFrame, *cols: str) -> DataFrame:
    """Drop the rows in which all of the columns are null."""
    return df.dropna(how="all", subset=list(cols))


def flag(condition: Column, yes=1, no=0) -> Column:
    """Two-way choice; an unknown condition takes `no`."""
    return F.when(condition, F.lit(yes)).otherwise(F.lit(no))


def case_flag(first: Column, second: Column, rules: Sequence[tuple[Sequence, Sequence]]) -> Column:
    """1 when some rule lists both values, else 0. A rule is (first values, second values)."""
    out = F.lit(0)
    for firsts, seconds in reversed(rules):
        out = F.when(first.isin(*firsts) & second.isin(*seconds), F.lit(1)).otherwise(out)
    return out


def bucketize(c: Column, cuts: Sequence[tuple[float, str]], above: str) -> Column:
    """Label of the first bound the value is under; null and large values take `above`."""
    out = F.lit(above)
    for bound, label in reversed(cuts):
        out = F.when(c < bound, F.lit(label)).otherwise(out)
    return out


def map_default(c: Column, mapping: Mapping[str, int], default: int) -> Column:
    """Look a value up in a small fixed table."""
    out = F.lit(default)
    for result in sorted(set(mapping.values()), reverse=True):
        keys = [k for k, v in mapping.items() if v == result]
        out = F.when(c.isin(*keys), F.lit(result)).otherwise(out)
    return out
