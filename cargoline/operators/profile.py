"""Profiling aggregations (P1-P3), each a single Spark job.

All of them are partial + final hash aggregations: rows are combined inside
each task before the shuffle, so a value that holds a large share of the
rows (one hot date, one country) costs one small record per task, never a
whole group in one task or in the driver.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoline.functions import is_blank_free, process_date_between, tiny_price_to_zero
from cargoline.operators.filters import to_day
from cargoline.schema import BONUS_TYPES, RAW_COLUMNS, ROUTINE_TYPES

PROFILE_COLUMNS = ("pais", "fecha_proceso", "tipo_entrega")
ALL_TYPES = ("*",)  # stands for a type filter that is switched off


def profile_values(df: DataFrame, columns: Iterable[str] = PROFILE_COLUMNS) -> DataFrame:
    """Distinct values with their row counts: ``(column_name, value, rows)``.

    One pass: the present columns are unpivoted to ``(column_name, value)``
    and grouped once.  NULL is a value of its own.  Absent columns are
    skipped.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "column_name string, value string, rows bigint")
    text = df.select([F.col(c).cast("string").alias(c) for c in present])
    long = text.unpivot([], present, "column_name", "value")
    return long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("rows"))


def profile_rows(df: DataFrame, columns: Iterable[str] = PROFILE_COLUMNS) -> DataFrame:
    """Per profiled column: ``(column_name, distinct_values, total_records)``."""
    return profile_values(df, columns).groupBy("column_name").agg(
        F.count(F.lit(1)).alias("distinct_values"),
        F.sum("rows").cast("bigint").alias("total_records"),
    )


def dataset_info(df: DataFrame, columns: Iterable[str] = PROFILE_COLUMNS) -> dict:
    """Driver-side summary: row count, column names, schema text and the
    number of distinct values per profiled column (one small job)."""
    values = profile_values(df, columns)
    return info_of(df, values, df.count if not [c for c in columns if c in df.columns] else None)


def info_of(df: DataFrame, values: DataFrame, count=None) -> dict:
    """``dataset_info`` of ``df`` from its profile ``(column_name, value, rows)``; ``count`` for no profiled column."""
    stats = {
        r["column_name"]: r
        for r in values.groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_values"), F.sum("rows").alias("total_records")).collect()
    }
    total = next(iter(stats.values()))["total_records"] if stats else count() if count else 0
    return {
        "total_records": int(total or 0),
        "columns": list(df.columns),
        "schema": df.schema.simpleString(),
        "distinct_values": {c: int(stats[c]["distinct_values"]) for c in stats},
    }


def rows_per_partition(df: DataFrame, column: str = "process_date") -> DataFrame:
    """``(column, rows)``; empty result with a warning-free no-op if absent."""
    if column not in df.columns:
        return df.sparkSession.createDataFrame([], f"{column} string, rows bigint")
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def output_summary(df: DataFrame, column: str = "process_date") -> DataFrame:
    """One row: total records and number of partition values (P2)."""
    if column not in df.columns:
        return df.agg(
            F.count(F.lit(1)).alias("total_records"),
            F.lit(0).cast("bigint").alias("partition_values"),
        )
    return rows_per_partition(df, column).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("total_records"),
        F.count(F.lit(1)).alias("partition_values"),
    )


def with_multiplicity(
    df: DataFrame,
    remove_empty_material: bool = True,
    remove_duplicates: bool = True,
    fix_scientific_notation: bool = True,
) -> DataFrame:
    """The cleaned rows with what the reports need: ``dropped, <nine raw columns>, m``.

    Rows are grouped on all raw columns (after the tiny-price fix) with their
    multiplicity ``m``, so one exchange de-duplicates them and still tells how many there were.
    Rows that the blank-material check removes (``dropped``) keep only the profiled
    columns: the partial aggregation turns them into few records before the shuffle.
    Without de-duplication every row stays, ``m`` is 1 and nothing is shuffled.
    """
    base = df.select(*RAW_COLUMNS)
    if fix_scientific_notation:
        base = base.withColumn("precio", tiny_price_to_zero("precio"))
    kept = is_blank_free("material") if remove_empty_material else F.lit(True)
    marked = base.select(
        (~kept).alias("dropped"),
        *[F.col(c) if c in PROFILE_COLUMNS else F.when(kept, F.col(c)).alias(c) for c in RAW_COLUMNS],
    )
    if not remove_duplicates:
        return marked.withColumn("m", F.lit(1).cast("bigint"))
    return marked.groupBy("dropped", *RAW_COLUMNS).agg(F.count(F.lit(1)).alias("m"))


def profile_of(grouped: DataFrame, columns: Iterable[str] = PROFILE_COLUMNS) -> DataFrame:
    """``profile_values`` of the rows behind a ``with_multiplicity`` frame."""
    columns = list(columns)
    long = grouped.select("m", *columns).unpivot(["m"], columns, "column_name", "value")
    return long.groupBy("column_name", "value").agg(F.sum("m").alias("rows"))


def funnel_of(
    grouped: DataFrame,
    start_date: str | dt.date,
    end_date: str | dt.date,
    country: str | None = None,
    valid_types: Iterable[str] | None = None,
) -> DataFrame:
    """``(step, stage, rows)``: rows left after each step, from a ``with_multiplicity`` frame.

    Counts before de-duplication are ``sum(m)``, later ones numbers of rows.  ``valid_types``
    None or empty means the default types, as everywhere; ``ALL_TYPES`` a type filter
    that is switched off.
    """
    keep = ~F.col("dropped")
    types = list(valid_types or ROUTINE_TYPES + BONUS_TYPES)
    typed = keep if types == list(ALL_TYPES) else keep & F.col("tipo_entrega").isin(types)
    dated = typed & process_date_between("fecha_proceso", to_day(start_date), to_day(end_date))
    located = dated & (F.upper(F.col("pais")) == F.lit(country.upper())) if country else dated

    def count(pred=None, rows=F.lit(1)):
        return F.coalesce(F.sum(rows if pred is None else F.when(pred, rows)), F.lit(0)).cast("bigint")

    stages = [
        ("read", count(rows=F.col("m"))),
        ("non_blank_material", count(keep, F.col("m"))),
        ("deduplicated", count(keep)),
        ("valid_delivery_type", count(typed)),
        ("in_date_range", count(dated)),
        ("country", count(located)),
    ]
    wide = grouped.agg(*[expr.alias(f"s{i}") for i, (_, expr) in enumerate(stages)])
    pairs = ", ".join(f"{i}, '{name}', s{i}" for i, (name, _) in enumerate(stages))
    return wide.select(
        F.expr(f"stack({len(stages)}, {pairs}) AS (step, stage, rows)")
    )


def cleaning_funnel(
    df: DataFrame,
    start_date: str | dt.date,
    end_date: str | dt.date,
    country: str | None = None,
    valid_types: Iterable[str] | None = None,
    remove_empty_material: bool = True,
    remove_duplicates: bool = True,
    fix_scientific_notation: bool = True,
) -> DataFrame:
    """Rows left after each step of the transformation, in one job (P3): ``(step, stage, rows)``."""
    grouped = with_multiplicity(df, remove_empty_material, remove_duplicates, fix_scientific_notation)
    return funnel_of(grouped, start_date, end_date, country, valid_types)
