"""Cleaning operators: blank materials (F1), tiny prices (E1), duplicates (D1)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cargoline.functions import is_blank_free, tiny_price_to_zero


def drop_blank_material(df: DataFrame, column: str = "material") -> DataFrame:
    """Keep rows whose material is not NULL, not blank and not the text ``""``."""
    return df.filter(is_blank_free(column))


def fix_tiny_price(df: DataFrame, column: str = "precio") -> DataFrame:
    """Replace prices below 1e-6 in magnitude with 0 (they print as ``0E-18`` style)."""
    return df.withColumn(column, tiny_price_to_zero(column))


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Drop rows equal in every column (NULLs compare equal).

    Planned as a partial + final hash aggregate, so a heavily repeated row is
    collapsed map-side before the shuffle and never lands whole in one task.
    """
    return df.dropDuplicates()


def clean(
    df: DataFrame,
    remove_empty_material: bool = True,
    remove_duplicates: bool = True,
    fix_scientific_notation: bool = True,
) -> DataFrame:
    """F1 -> E1 -> D1, each switchable (X1)."""
    if remove_empty_material:
        df = drop_blank_material(df)
    if fix_scientific_notation:
        df = fix_tiny_price(df)
    if remove_duplicates:
        df = drop_duplicates(df)
    return df
