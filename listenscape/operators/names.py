"""Column-name housekeeping on wide frames."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Fixed names: the unknown column and the junk pair that is dropped only when both appear.
FIXED_UNKNOWN_COLUMN = "u"
FIXED_JUNK_PAIR = ('""""""', "U")


def clean_column_names(df: DataFrame) -> DataFrame:
    """Strip single quotes from every column name (a warehouse PIVOT quotes the values)."""
    return df.toDF(*[c.replace("'", "") for c in df.columns])


def drop_junk_columns(df: DataFrame) -> DataFrame:
    """Drop the unknown column `u`, and the junk pair only when both of its names are present."""
    drop = [FIXED_UNKNOWN_COLUMN] if FIXED_UNKNOWN_COLUMN in df.columns else []
    if all(c in df.columns for c in FIXED_JUNK_PAIR):
        drop += list(FIXED_JUNK_PAIR)
    return df.drop(*drop)
