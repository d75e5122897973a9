"""Column builders for the delivery rules.

Each function returns a ``Column`` made of Spark built-ins only, so whole
stage codegen keeps them in one generated function.  Arithmetic uses the
``try_*`` forms: the value is NULL on overflow / bad input whether
``spark.sql.ansi.enabled`` is on or off, which keeps results identical in
both modes.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from cargoline.schema import (
    BOX_UNIT,
    FLAG_REVIEW,
    FLAG_VALID,
    MONEY,
    PROCESS_DATE_FORMAT,
    QUOTED_EMPTY,
    RAW_DECIMAL,
)

# A decimal whose text form would need an exponent (|p| < 1e-6) is a
# scientific-notation artefact of the source system and counts as zero.
_TINY = Decimal("0.000001")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank_free(material: str | Column = "material") -> Column:
    """True when the text is not NULL, not only spaces and not the literal ``""``."""
    m = _col(material)
    return m.isNotNull() & (F.trim(m) != F.lit("")) & (m != F.lit(QUOTED_EMPTY))


def tiny_price_to_zero(price: str | Column = "precio") -> Column:
    """Prices with magnitude below 1e-6 become 0; NULL stays NULL."""
    p = _col(price)
    return F.when(F.abs(p) < F.lit(_TINY), F.lit(0).cast(RAW_DECIMAL)).otherwise(p)


def parse_process_date(text: str | Column = "fecha_proceso") -> Column:
    """``yyyyMMdd`` text to DATE; unparseable text gives NULL (never an error)."""
    return F.try_to_date(_col(text), PROCESS_DATE_FORMAT)


def process_date_between(
    text: str | Column, start: dt.date, end: dt.date
) -> Column:
    """Inclusive date-range test on ``yyyyMMdd`` text.

    The parser accepts exactly eight digits, so a parseable value inside the
    range is also inside the text range ``[yyyyMMdd(start), yyyyMMdd(end)]``.
    That text comparison is added first because Spark can push it into file
    scans (Parquet row-group statistics, hive partition pruning); the parsed
    comparison keeps the exact semantics.
    """
    t = _col(text)
    lo, hi = (d.isoformat().replace("-", "") for d in (start, end))
    return (
        (t >= F.lit(lo))
        & (t <= F.lit(hi))
        & parse_process_date(t).between(*(F.lit(d.isoformat()).cast("date") for d in (start, end)))
    )


def in_codes(code: str | Column, codes: Iterable[str]) -> Column:
    """Case-sensitive membership; NULL gives False."""
    return F.coalesce(_col(code).isin(list(codes)), F.lit(False))


def box_to_units(
    quantity: str | Column = "cantidad",
    unit: str | Column = "unidad",
    factor: int = 20,
) -> Column:
    """Quantity in standard units: boxes (any case) times ``factor``, else as is."""
    q = _col(quantity)
    return (
        F.when(F.upper(_col(unit)) == F.lit(BOX_UNIT), F.try_multiply(q, F.lit(factor)))
        .otherwise(q)
        .cast(MONEY)
    )


def total_value(
    price: str | Column = "precio", quantity: str | Column = "quantity_standardized"
) -> Column:
    """price x standard quantity at scale 6 (half-up); NULL on NULL or overflow."""
    return F.try_multiply(_col(price), _col(quantity)).cast(MONEY)


def unit_price(price: str | Column = "precio", quantity: str | Column = "cantidad") -> Column:
    """price / original quantity at scale 6 (half-up) when quantity > 0, else 0."""
    q = _col(quantity)
    return F.when(q > F.lit(0), F.try_divide(_col(price), q).cast(MONEY)).otherwise(
        F.lit(0).cast(MONEY)
    )


def quality_flag(
    price: str | Column = "precio",
    quantity: str | Column = "cantidad",
    material: str | Column = "material",
) -> Column:
    """``VALID`` for positive price and quantity with a non-blank material."""
    m = _col(material)
    ok = (
        (_col(price) > F.lit(0))
        & (_col(quantity) > F.lit(0))
        & m.isNotNull()
        & (F.trim(m) != F.lit(""))
    )
    return F.when(ok, F.lit(FLAG_VALID)).otherwise(F.lit(FLAG_REVIEW))
