"""The delivery transformation (X1-X3, X5) as one lazy DataFrame plan.

No step runs an action: the whole chain is handed to Catalyst at once, which
pushes the type / date / country filters below the de-duplication and into
the scan, and collapses the projections into one.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoline.operators.clean import clean
from cargoline.operators.enrich import (
    add_calculated_columns,
    classify_deliveries,
    convert_units,
    rename_to_standard,
    select_final,
)
from cargoline.operators.filters import (
    filter_country,
    filter_date_range,
    filter_delivery_types,
)
from cargoline.schema import BONUS_TYPES, BOX_FACTOR, RENAME_TO_STANDARD, ROUTINE_TYPES


@dataclasses.dataclass(frozen=True)
class DeliveryRules:
    """Business rules (X5): box factor and the two delivery-type lists.

    An empty or missing list means the default list.
    """

    cs_to_st_factor: int = BOX_FACTOR
    routine_delivery_types: tuple[str, ...] | None = None
    bonus_delivery_types: tuple[str, ...] | None = None

    def __post_init__(self) -> None:
        object.__setattr__(
            self, "routine_delivery_types", tuple(self.routine_delivery_types or ROUTINE_TYPES)
        )
        object.__setattr__(
            self, "bonus_delivery_types", tuple(self.bonus_delivery_types or BONUS_TYPES)
        )

    @property
    def valid_delivery_types(self) -> tuple[str, ...]:
        return self.routine_delivery_types + self.bonus_delivery_types


@dataclasses.dataclass(frozen=True)
class QualityChecks:
    """Data-quality switches; every one defaults to on."""

    remove_empty_material: bool = True
    remove_duplicates: bool = True
    fix_scientific_notation: bool = True
    filter_valid_delivery_types: bool = True

    @classmethod
    def of(cls, value: QualityChecks | Mapping[str, Any] | None) -> QualityChecks:
        """Accept a ``QualityChecks``, a mapping of switches (missing -> on) or None."""
        if value is None or isinstance(value, QualityChecks):
            return value or cls()
        known = {f.name for f in dataclasses.fields(cls)}
        return cls(**{k: bool(v) for k, v in value.items() if k in known})


def transform(
    df: DataFrame,
    start_date: str | dt.date,
    end_date: str | dt.date,
    country: str | None = None,
    quality: QualityChecks | Mapping[str, Any] | None = None,
    rules: DeliveryRules = DeliveryRules(),
    with_timestamp: bool = True,
) -> DataFrame:
    """Clean -> valid types -> date range -> country -> units -> classes ->
    values -> standard names -> final columns (X3).

    ``with_timestamp=False`` leaves out ``processing_timestamp`` (used where a
    result is compared by value).
    """
    q = QualityChecks.of(quality)
    out = clean(
        df,
        remove_empty_material=q.remove_empty_material,
        remove_duplicates=q.remove_duplicates,
        fix_scientific_notation=q.fix_scientific_notation,
    )
    return standardize(out, start_date, end_date, country, q, rules, with_timestamp)


def standardize(
    cleaned: DataFrame,
    start_date: str | dt.date,
    end_date: str | dt.date,
    country: str | None = None,
    quality: QualityChecks = QualityChecks(),
    rules: DeliveryRules = DeliveryRules(),
    with_timestamp: bool = True,
) -> DataFrame:
    """The transformation's steps after cleaning."""
    out = cleaned
    if quality.filter_valid_delivery_types:
        out = filter_delivery_types(out, rules.valid_delivery_types)
    out = filter_date_range(out, start_date, end_date)
    out = filter_country(out, country)
    out = convert_units(out, rules.cs_to_st_factor)
    out = classify_deliveries(out, rules.routine_delivery_types, rules.bonus_delivery_types)
    out = add_calculated_columns(out, with_timestamp=with_timestamp)
    return select_final(rename_to_standard(out))


def from_standard(df: DataFrame) -> DataFrame:
    """The nine raw columns of standard output (E10 backwards), so a run can read an earlier run's files.

    Over a sink partitioned by ``process_date`` the date range becomes a filter on the partition
    column: folders outside it are not listed into the scan, let alone read.
    """
    return df.select([F.col(new).alias(raw) for raw, new in RENAME_TO_STANDARD.items()])
