"""Data audits (V1, V2): the run-argument checks applied to every row."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoline.functions import parse_process_date
from cargoline.schema import COUNTRY_CODES


def audit_bad_dates(df: DataFrame, column: str = "fecha_proceso") -> DataFrame:
    """Non-NULL values that are not a real ``yyyyMMdd`` day: ``(value, rows)``."""
    c = F.col(column)
    return (
        df.filter(c.isNotNull() & parse_process_date(c).isNull())
        .groupBy(c.alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def audit_bad_countries(
    df: DataFrame, codes: Iterable[str] = COUNTRY_CODES, column: str = "pais"
) -> DataFrame:
    """Non-NULL values whose upper case is not a known code: ``(value, rows)``.

    The code list is a literal set (no join, no shuffle before the partial
    aggregation).
    """
    c = F.col(column)
    known = [x.upper() for x in codes]
    return (
        df.filter(c.isNotNull() & ~F.upper(c).isin(known))
        .groupBy(c.alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def audit_countries_table(
    df: DataFrame, codes: DataFrame, code_column: str = "code", column: str = "pais"
) -> DataFrame:
    """Non-NULL values whose upper case is not among ``codes``' own (upper-cased): ``(value, rows)``.

    The rows are counted per value first, inside every task, so what meets the code table is one row a
    distinct value, whatever share of the rows a value holds.  How they meet is left to
    Spark's size check: a small code table is broadcast, a large one is merged.  A
    null code matches nothing; an empty code table reports every value.
    """
    c = F.col(column)
    found = df.filter(c.isNotNull()).groupBy(c.alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    known = codes.select(F.upper(F.col(code_column)).alias("_known")).filter("_known IS NOT NULL").distinct()
    return found.join(known, F.upper(found["value"]) == known["_known"], "left_anti")
