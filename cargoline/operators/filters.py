"""Row filters: date range (F2), country (F3), valid delivery types (F4)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoline.functions import process_date_between
from cargoline.schema import BONUS_TYPES, ROUTINE_TYPES


def to_day(value: str | dt.date) -> dt.date:
    """``YYYY-MM-DD`` (or a date) to a date; anything else raises ``ValueError``."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.datetime.strptime(value, "%Y-%m-%d").date()


def filter_date_range(
    df: DataFrame,
    start_date: str | dt.date,
    end_date: str | dt.date,
    column: str = "fecha_proceso",
) -> DataFrame:
    """Keep rows whose ``yyyyMMdd`` date lies in ``[start_date, end_date]``.

    Bounds are date literals, so the result does not depend on the session
    time zone.  NULL or unparseable dates are dropped; ``start > end`` keeps
    nothing.
    """
    return df.filter(process_date_between(column, to_day(start_date), to_day(end_date)))


def filter_country(df: DataFrame, country: str | None, column: str = "pais") -> DataFrame:
    """Case-insensitive country match; the stored case is kept.  Falsy -> no-op."""
    if not country:
        return df
    return df.filter(F.upper(F.col(column)) == F.lit(country.upper()))


def filter_delivery_types(
    df: DataFrame,
    valid_types: Iterable[str] = ROUTINE_TYPES + BONUS_TYPES,
    column: str = "tipo_entrega",
) -> DataFrame:
    """Keep rows whose type is in ``valid_types`` (case-sensitive, NULL dropped)."""
    return df.filter(F.col(column).isin(list(valid_types)))
