"""Shared fixtures: one local session and a few rows that cover every rule."""

from __future__ import annotations

import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cargoline.schema import DELIVERY_SCHEMA  # noqa: E402
from cargoline.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8)
    yield s


D = Decimal

# The first four rows are clean, one per valid type.  Then one of every case the
# rules treat: no price, a year too early, no material twice, an exact
# repetition and a type that is neither routine nor bonus.
SAMPLE_ROWS = [
    ("GT", "20250307", "VAN-12", "NORTH", "ZPRE", "BOLT7", D("12.60"), D("4"), "ST"),
    ("GT", "20250307", "VAN-12", "COAST", "ZVE1", "CRATE2", D("36.00"), D("3"), "CS"),
    ("HN", "20250418", "TRUCK-3", "HILLS", "Z04", "PUMP9", D("7.50"), D("6"), "ST"),
    ("JM", "20250526", "SHIP-1", "PORT", "Z05", "HOSE4", D("81.25"), D("13"), "CS"),
    ("EC", "20250830", "TRUCK-8", "SOUTH", "ZPRE", "FREE5", D("0"), D("9"), "ST"),
    ("GT", "20231109", "VAN-40", "NORTH", "ZPRE", "OLD3", D("44.10"), D("7"), "ST"),
    ("GT", "20250307", "VAN-12", "NORTH", "ZPRE", None, D("3.30"), D("11"), "ST"),
    ("GT", "20250307", "VAN-12", "NORTH", "ZPRE", "", D("3.30"), D("11"), "ST"),
    ("GT", "20250307", "VAN-12", "NORTH", "ZPRE", "BOLT7", D("12.60"), D("4"), "ST"),
    ("GT", "20250307", "VAN-12", "COAST", "COBR", "CASH1", D("5.05"), D("2"), "ST"),
]


@pytest.fixture
def sample(spark):
    return spark.createDataFrame(SAMPLE_ROWS, DELIVERY_SCHEMA)


@pytest.fixture
def sample_clean(spark):
    return spark.createDataFrame(SAMPLE_ROWS[:4], DELIVERY_SCHEMA)


def rows(spark, data):
    """A deliveries frame from a list of 9-tuples."""
    return spark.createDataFrame(data, DELIVERY_SCHEMA)


def one(df, **where):
    """The single row matching ``column == value`` filters."""
    got = [r for r in df.collect() if all(r[k] == v for k, v in where.items())]
    assert len(got) == 1, got
    return got[0]
