"""Header and value cleaning."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F, types as T

from opsgauge.functions.text import strip


def clean_headers(df: DataFrame, plain: bool = False) -> DataFrame:
    """Trim the column names; with `plain`, also turn symbols into single underscores."""
    names = [c.strip() for c in df.columns]
    if plain:
        names = [re.sub(r"[\W_]+", "_", n).strip("_").lower() for n in names]
    return df.toDF(*names)


def trim_all(df: DataFrame) -> DataFrame:
    """Trim every text column."""
    return df.select(
        *[
            strip(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def trim_col(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: strip(F.col(c)) for c in cols})


def rename(df: DataFrame, **new_to_old: str) -> DataFrame:
    """Keep the named columns under their new names, in the order given."""
    return df.select(*[F.col(old).alias(new) for new, old in new_to_old.items()])


def fill(df: DataFrame, col: str, value) -> DataFrame:
    """Replace null by a value of the column's own type."""
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(value).cast(df.schema[col].dataType)))
