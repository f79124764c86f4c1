"""Joins.

No side is broadcast by a hint. Spark compares the size of a dimension with its broadcast
limit when it plans, and again at run time with measured sizes; a dimension over the limit is
joined through a shuffle, in which adaptive execution splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F


def enrich(fact: DataFrame, dim: DataFrame, left: str, right: str, null_safe: bool = False) -> DataFrame:
    """Left join of facts to a dimension on differently named keys; the dimension key is kept.

    With `null_safe` a null key matches a null key.
    """
    test = fact[left].eqNullSafe(dim[right]) if null_safe else fact[left] == dim[right]
    return fact.join(dim, test, "left")


def left_join(a: DataFrame, b: DataFrame, on: str) -> DataFrame:
    return a.join(b, on, "left")


def left_join_suffix(a: DataFrame, b: DataFrame, left: str, right: str, suffix: str) -> DataFrame:
    """Left join in which right-hand columns whose name is taken get a suffix."""
    taken = set(a.columns)
    b = b.toDF(*[c + suffix if c in taken else c for c in b.columns])
    return enrich(a, b, left, right + suffix if right in taken else right)


def matched_only(a: DataFrame, b: DataFrame, left: str, right: str, keep_duplicates: bool = True) -> DataFrame:
    """Rows of `a` whose key occurs in `b`.

    `keep_duplicates` repeats a row for every match, as a left join followed by "matched in
    both" does; otherwise each row appears once.
    """
    b = b.select(F.col(right).alias("_match"))
    how = "inner" if keep_duplicates else "left_semi"
    out = a.join(b, a[left] == b["_match"], how)
    return out.drop("_match") if keep_duplicates else out


def match_flag(a: DataFrame, b: DataFrame, left: str, right: str, out: str = "matched") -> DataFrame:
    """Left join that only adds a 0/1 mark for "the key occurs in b"."""
    keys = b.select(F.col(right).alias("_match")).dropna().distinct()
    joined = a.join(keys, a[left] == keys["_match"], "left")
    return joined.withColumn(out, F.when(F.col("_match").isNotNull(), 1).otherwise(0)).drop("_match")


def any_label(df: DataFrame, key: str | list[str], **labels: Column) -> DataFrame:
    """Per key, whether any of its rows carries each label.

    One aggregate takes the place of joining the table to itself once per label.
    """
    keys = [key] if isinstance(key, str) else key
    marks = [F.max(F.when(c, 1).otherwise(0)).alias(n) for n, c in labels.items()]
    return df.groupBy(*keys).agg(*marks)


def latest_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """All rows that hold their key's largest value; ties are kept.

    Two steps: the largest value of each key, combined before the shuffle, then a semi-join on key and
    value. Rows that tie on a hot key never have to meet in one task: they stay where they are when Spark
    broadcasts the largest values, and a join by shuffle splits them where they pile up.
    """
    known = df.dropna(subset=[key, order])
    largest = known.groupBy(F.col(key).alias("_key")).agg(F.max(order).alias("_largest"))
    test = (known[key] == largest["_key"]) & (known[order] == largest["_largest"])
    return known.join(largest, test, "left_semi")
