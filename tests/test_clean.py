from decimal import Decimal as D

from cargoline.operators.clean import clean, drop_blank_material, drop_duplicates, fix_tiny_price
from tests.conftest import rows


def _row(material="M", precio=D("1"), pais="GT"):
    return (pais, "20250101", "T", "R", "ZPRE", material, precio, D("1"), "ST")


def test_blank_material_removed(spark, sample):
    out = drop_blank_material(sample)
    assert out.count() == 8
    assert out.filter("material IS NULL OR trim(material) = ''").count() == 0


def test_blank_material_edge_text(spark):
    df = rows(spark, [_row(m) for m in ["", "   ", '""', ' "" ', "\tx", None, "M"]])
    kept = sorted(r.material for r in drop_blank_material(df).collect())
    # trim strips spaces only; the quoted-empty text is dropped only unpadded
    assert kept == ["\tx", ' "" ', "M"]


def test_tiny_price_zeroed(spark):
    prices = [D("0.0000005"), D("-0.0000005"), D("0.000001"), D("0"), None, D("12.5")]
    df = rows(spark, [_row(precio=p) for p in prices])
    got = [r.precio for r in fix_tiny_price(df).collect()]
    assert got == [D(0), D(0), D("0.000001"), D(0), None, D("12.5")]
    assert fix_tiny_price(df).schema["precio"].dataType.simpleString() == "decimal(38,18)"


def test_duplicates_nulls_equal_case_distinct(spark):
    df = rows(spark, [_row(None), _row(None), _row(pais="gt"), _row(pais="GT")])
    assert drop_duplicates(df).count() == 3


def test_duplicates_after_tiny_price_fix_merge(spark):
    df = rows(spark, [_row(precio=D("0.0000001")), _row(precio=D("0"))])
    assert clean(df).count() == 1
    assert clean(df, fix_scientific_notation=False).count() == 2


def test_clean_funnel_on_sample(spark, sample):
    assert clean(sample).count() == 7
    assert clean(sample, remove_duplicates=False).count() == 8
    assert clean(sample, False, False, False).count() == sample.count()
