"""Column expressions shared by the operators (all JVM-side built-ins)."""

from cargoline.functions.columns import (
    box_to_units,
    in_codes,
    is_blank_free,
    parse_process_date,
    process_date_between,
    quality_flag,
    tiny_price_to_zero,
    total_value,
    unit_price,
)

__all__ = [
    "box_to_units",
    "in_codes",
    "is_blank_free",
    "parse_process_date",
    "process_date_between",
    "quality_flag",
    "tiny_price_to_zero",
    "total_value",
    "unit_price",
]
