"""Aggregates that combine on the map side, so that no key is ever gathered whole."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def sum_by(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Grouped sums; rows with a null in any key are left out."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def count_rows(df: DataFrame, by: Sequence[str], **conditions: Column) -> DataFrame:
    """Rows per group that meet each condition; an unknown condition is not met."""
    return df.groupBy(*by).agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])


def distinct_counts(
    df: DataFrame, key: str | Column, by: Sequence[str] = (), **conditions: Column | None
) -> DataFrame:
    """Distinct non-null keys per group, for many conditions in one pass.

    Several conditional distinct counts in one aggregate would make Spark copy every row once
    per condition. Here each key is reduced to one row of 0/1 marks (combined before the
    shuffle), and the marks are then summed. A condition of None counts all keys.
    """
    c = F.col(key) if isinstance(key, str) else key
    marks = {n: F.max(F.when(t, 1).otherwise(0)) if t is not None else F.lit(1) for n, t in conditions.items()}
    keyed = df.withColumn("_key", c).filter(F.col("_key").isNotNull())
    tested = [m.alias(n) for n, m in marks.items() if conditions[n] is not None]
    per_key = keyed.groupBy(*by, "_key").agg(*tested) if tested else keyed.select(*by, "_key").distinct()
    sums = [
        (F.count(F.lit(1)) if t is None else F.coalesce(F.sum(n), F.lit(0))).alias(n)
        for n, t in conditions.items()
    ]
    return per_key.groupBy(*by).agg(*sums)


def nunique(df: DataFrame, col: str, by: Sequence[str] = (), alias: str | None = None) -> DataFrame:
    """Distinct non-null values, of the whole frame or per group (groups with a null key dropped)."""
    if by:
        df = df.dropna(subset=list(by))
    return df.groupBy(*by).agg(F.count_distinct(F.col(col)).alias(alias or col))


def repeat_groups(df: DataFrame, keys: Sequence[str], at_least: int, alias: str = "repeat") -> DataFrame:
    """Size of each group and a 0/1 mark for the large ones."""
    sized = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    return sized.withColumn(alias, F.when(F.col("count") >= at_least, 1).otherwise(0))


def max_by_key(df: DataFrame, key: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    return df.dropna(subset=[key]).groupBy(*by, key).agg(F.max(value).alias(value))


def mean_of_max(df: DataFrame, key: str, value: str, by: Sequence[str] = (), alias: str = "mean") -> DataFrame:
    """Largest value per key, then the mean over the keys."""
    return max_by_key(df, key, value, by).groupBy(*by).agg(F.avg(value).alias(alias))


def distinct_rows(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols).distinct()


def dedupe_first(df: DataFrame, key: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under a total order.

    The filter on the row number lets Spark keep one row per key in every map task before the
    shuffle, so a key that holds much of the table still sends few rows.
    """
    keys = [key] if isinstance(key, str) else list(key)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def first_group(df: DataFrame, by: Sequence[str], order: str, **values: Column) -> DataFrame:
    """Each value as it stands in the first sub-group of `order` (e.g. the earliest year)."""
    return df.groupBy(*by).agg(*[F.min_by(v, F.col(order)).alias(n) for n, v in values.items()])
