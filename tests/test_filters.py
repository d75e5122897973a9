import datetime as dt

import pytest

from cargoline.operators.filters import filter_country, filter_date_range, filter_delivery_types
from tests.conftest import rows
from decimal import Decimal as D


def test_date_range(sample_clean):
    assert filter_date_range(sample_clean, "2025-01-01", "2025-03-31").count() == 2


def test_date_bounds_inclusive(sample_clean):
    assert filter_date_range(sample_clean, "2025-03-07", "2025-05-26").count() == 4


def test_date_out_of_range_empty(sample_clean):
    assert filter_date_range(sample_clean, "2026-01-01", "2026-12-31").count() == 0


def test_start_after_end_empty(sample_clean):
    assert filter_date_range(sample_clean, "2025-12-31", "2025-01-01").count() == 0


def test_date_objects_accepted(sample_clean):
    assert filter_date_range(sample_clean, dt.date(2025, 3, 7), dt.date(2025, 3, 7)).count() == 2


def test_bad_bound_raises(sample_clean):
    with pytest.raises(ValueError):
        filter_date_range(sample_clean, "2025/01/01", "2025-12-31")


def test_null_and_bad_dates_dropped(spark):
    data = [
        ("GT", d, "T", "R", "ZPRE", "M", D(1), D(1), "ST")
        for d in [None, "bad", "20250230", "2025011", "20250101"]
    ]
    assert filter_date_range(rows(spark, data), "2000-01-01", "2100-01-01").count() == 1


def test_date_filter_independent_of_session_zone(spark, sample_clean):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("Asia/Tokyo", "America/Lima", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert filter_date_range(sample_clean, "2025-03-07", "2025-05-26").count() == 4
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_country_case_insensitive_keeps_case(spark, sample_clean):
    assert filter_country(sample_clean, "gt").count() == filter_country(sample_clean, "GT").count() == 2
    df = rows(spark, [("gt", "20250101", "T", "R", "ZPRE", "M", D(1), D(1), "ST")])
    assert [r.pais for r in filter_country(df, "GT").collect()] == ["gt"]


def test_country_falsy_is_noop(sample_clean):
    assert filter_country(sample_clean, None).count() == 4
    assert filter_country(sample_clean, "").count() == 4


def test_valid_types(sample):
    out = filter_delivery_types(sample)
    assert out.filter("tipo_entrega = 'COBR'").count() == 0
    assert {r.tipo_entrega for r in out.collect()} <= {"ZPRE", "ZVE1", "Z04", "Z05"}


def test_valid_types_case_sensitive_and_null(spark):
    data = [("GT", "20250101", "T", "R", t, "M", D(1), D(1), "ST") for t in ["zpre", None, "ZPRE", " ZPRE"]]
    assert filter_delivery_types(rows(spark, data)).count() == 1


def test_text_range_prefilter_is_exact(spark):
    """The pushed text range must never drop a row the parsed test keeps."""
    import random

    from pyspark.sql import functions as F

    from cargoline.functions import parse_process_date, process_date_between

    rnd = random.Random(7)
    start, end = dt.date(1997, 1, 1), dt.date(1998, 6, 30)
    texts = set()
    for _ in range(3000):
        kind = rnd.randrange(5)
        if kind == 0:  # real days around the bounds
            d = start + dt.timedelta(days=rnd.randrange(-40, 600))
            texts.add(d.strftime("%Y%m%d"))
        elif kind == 1:  # digit strings of other lengths
            texts.add("".join(rnd.choice("0123456789") for _ in range(rnd.randrange(5, 11))))
        elif kind == 2:  # signs, spaces, separators
            d = start + dt.timedelta(days=rnd.randrange(0, 500))
            pre = rnd.choice(["+", "-", " ", "0", "1", ""])
            post = rnd.choice(["", " ", "0", "Z"])
            texts.add(pre + d.strftime(rnd.choice(["%Y%m%d", "%Y-%m-%d", "%y%m%d"])) + post)
        elif kind == 3:  # impossible days
            texts.add(f"{rnd.randrange(1995, 2000)}{rnd.randrange(0, 14):02d}{rnd.randrange(0, 33):02d}")
        else:
            texts.add(rnd.choice(["bad", "", "19970101\n", "１９９７０１０１"]))
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    both = df.select(
        process_date_between("s", start, end).alias("fast"),
        parse_process_date("s").between(F.lit(start), F.lit(end)).alias("exact"),
    )
    assert both.filter("coalesce(fast, false) <> coalesce(exact, false)").count() == 0
    assert both.filter("exact").count() > 100
