"""Column naming: lower case, underscores, no accents."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame


def plain_name(name: str) -> str:
    """Lower-case name with ``_`` for spaces and without accents or cedillas."""
    decomposed = unicodedata.normalize("NFD", name.lower().replace(" ", "_"))
    return "".join(ch for ch in decomposed if not unicodedata.combining(ch))


def plain_columns(df: DataFrame) -> DataFrame:
    """Rename all columns with :func:`plain_name` in one projection."""
    return df.toDF(*map(plain_name, df.columns))
