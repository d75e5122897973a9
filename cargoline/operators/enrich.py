"""Derived columns: units (E2/E3), classification (E4/E5), values (E6-E9),
standard names (E10) and the final projection (E11)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoline.functions import (
    box_to_units,
    in_codes,
    quality_flag,
    total_value,
    unit_price,
)
from cargoline.schema import (
    BONUS_TYPES,
    BOX_FACTOR,
    FINAL_COLUMNS,
    RENAME_TO_STANDARD,
    ROUTINE_TYPES,
    STANDARD_UNIT,
)


def convert_units(df: DataFrame, factor: int = BOX_FACTOR) -> DataFrame:
    """Add ``quantity_standardized`` (decimal(38,6)) and ``unit_standardized``."""
    return df.withColumns(
        {
            "quantity_standardized": box_to_units("cantidad", "unidad", factor),
            "unit_standardized": F.lit(STANDARD_UNIT),
        }
    )


def classify_deliveries(
    df: DataFrame,
    routine_types: Iterable[str] = ROUTINE_TYPES,
    bonus_types: Iterable[str] = BONUS_TYPES,
) -> DataFrame:
    """Add never-NULL boolean flags for routine and bonus delivery types."""
    return df.withColumns(
        {
            "is_routine_delivery": in_codes("tipo_entrega", routine_types),
            "is_bonus_delivery": in_codes("tipo_entrega", bonus_types),
        }
    )


def add_calculated_columns(df: DataFrame, with_timestamp: bool = True) -> DataFrame:
    """E6-E9 in one projection: total value, unit price, run timestamp, flag."""
    cols = {
        "total_value": total_value("precio", "quantity_standardized"),
        "unit_price": unit_price("precio", "cantidad"),
    }
    if with_timestamp:
        cols["processing_timestamp"] = F.current_timestamp()
    cols["data_quality_flag"] = quality_flag("precio", "cantidad", "material")
    return df.withColumns(cols)


def rename_to_standard(df: DataFrame) -> DataFrame:
    """Spanish source names to English snake_case; absent names are skipped."""
    present = {k: v for k, v in RENAME_TO_STANDARD.items() if k in df.columns}
    return df.withColumnsRenamed(present)


def select_final(df: DataFrame, columns: Iterable[str] = FINAL_COLUMNS) -> DataFrame:
    """The standard output columns in their fixed order; absent ones skipped."""
    have = set(df.columns)
    return df.select([c for c in columns if c in have])
