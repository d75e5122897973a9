from decimal import Decimal as D

import pytest

from cargoline.operators.enrich import (
    add_calculated_columns,
    classify_deliveries,
    convert_units,
    rename_to_standard,
    select_final,
)
from cargoline.schema import FINAL_COLUMNS
from tests.conftest import one, rows


def test_box_to_units(sample_clean):
    out = convert_units(sample_clean)
    cs = one(out, material="CRATE2")
    assert cs.quantity_standardized == D("60.000000")
    assert cs.unit_standardized == "ST"
    st = one(out, material="BOLT7")
    assert st.quantity_standardized == D("4.000000")
    assert out.schema["quantity_standardized"].dataType.simpleString() == "decimal(38,6)"


def test_custom_factor(sample_clean):
    assert one(convert_units(sample_clean, factor=10), material="CRATE2").quantity_standardized == D(30)


def test_unit_case_and_unknown(spark):
    data = [("GT", "20250101", "T", "R", "ZPRE", m, D(1), D("2.5"), u)
            for m, u in [("a", "cs"), ("b", None), ("c", "KG")]]
    out = {r.material: r for r in convert_units(rows(spark, data)).collect()}
    assert out["a"].quantity_standardized == D(50)
    assert out["b"].quantity_standardized == D("2.5")
    assert out["c"].quantity_standardized == D("2.5")
    assert {r.unit_standardized for r in out.values()} == {"ST"}


def test_classification(sample_clean):
    out = classify_deliveries(sample_clean)
    for m, routine, bonus in [("BOLT7", True, False), ("CRATE2", True, False),
                              ("PUMP9", False, True), ("HOSE4", False, True)]:
        r = one(out, material=m)
        assert (r.is_routine_delivery, r.is_bonus_delivery) == (routine, bonus)


def test_classification_null_is_false(spark):
    data = [("GT", "20250101", "T", "R", None, "M", D(1), D(1), "ST")]
    r = classify_deliveries(rows(spark, data)).collect()[0]
    assert r.is_routine_delivery is False and r.is_bonus_delivery is False


def test_calculated_values(sample_clean):
    out = add_calculated_columns(convert_units(sample_clean))
    r = one(out, material="BOLT7")
    assert r.total_value == D("50.400000")
    assert r.unit_price == D("3.150000")
    assert r.processing_timestamp is not None
    assert {x.data_quality_flag for x in out.collect()} == {"VALID"}


def test_unit_price_rounds_half_up_and_zero_quantity(spark):
    data = [
        ("GT", "20250101", "T", "R", "ZPRE", "a", D("2"), D("3"), "ST"),
        ("GT", "20250101", "T", "R", "ZPRE", "b", D("1"), D("0"), "ST"),
        ("GT", "20250101", "T", "R", "ZPRE", "c", D("1"), D("-4"), "ST"),
        ("GT", "20250101", "T", "R", "ZPRE", "d", D("1"), None, "ST"),
        ("GT", "20250101", "T", "R", "ZPRE", "e", D("0.0000025"), D("1"), "ST"),
    ]
    out = {r.material: r.unit_price for r in add_calculated_columns(convert_units(rows(spark, data))).collect()}
    assert out == {"a": D("0.666667"), "b": D(0), "c": D(0), "d": D(0), "e": D("0.000003")}


def test_quality_flag_review_cases(spark):
    data = [
        ("GT", "20250101", "T", "R", "ZPRE", "a", D(0), D(1), "ST"),
        ("GT", "20250101", "T", "R", "ZPRE", "b", D(1), D(-1), "ST"),
        ("GT", "20250101", "T", "R", "ZPRE", "c", None, D(1), "ST"),
        ("GT", "20250101", "T", "R", "ZPRE", "d", D(1), None, "ST"),
        ("GT", "20250101", "T", "R", "ZPRE", "   ", D(1), D(1), "ST"),
        ("GT", "20250101", "T", "R", "ZPRE", "f", D(1), D(1), "ST"),
    ]
    out = {r.material: r.data_quality_flag
           for r in add_calculated_columns(convert_units(rows(spark, data))).collect()}
    assert out == {"a": "REVIEW", "b": "REVIEW", "c": "REVIEW", "d": "REVIEW",
                   "   ": "REVIEW", "f": "VALID"}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_same_results_with_ansi_on_and_off(spark, ansi):
    """Overflowing products and bad dates give NULL in both modes."""
    from cargoline.functions import parse_process_date

    big = D("99999999999999999999.5")  # 20 integer digits; price x quantity overflows
    data = [("GT", "bad", "T", "R", "ZPRE", "a", big, big, "CS")]
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = add_calculated_columns(convert_units(rows(spark, data)), with_timestamp=False)
        r = df.select("quantity_standardized", "total_value", "unit_price",
                      parse_process_date("fecha_proceso").alias("d")).collect()[0]
        assert r.d is None
        assert r.total_value is None
        assert r.unit_price == D("1.000000")
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_rename_all_and_absent(spark, sample_clean):
    out = rename_to_standard(sample_clean)
    assert {"country_code", "process_date", "price", "quantity_original", "unit_original"} <= set(out.columns)
    partial = spark.createDataFrame([("a", 1)], "col1 string, col2 bigint")
    assert rename_to_standard(partial).columns == ["col1", "col2"]


def test_select_final_order_and_absent(sample_clean):
    out = rename_to_standard(add_calculated_columns(classify_deliveries(convert_units(sample_clean))))
    final = select_final(out.withColumn("extra", out.price))
    assert final.columns == list(FINAL_COLUMNS)
    assert select_final(out.drop("processing_timestamp")).columns == list(FINAL_COLUMNS[:-1])


def test_decimal_arithmetic_matches_exact_half_up(spark):
    """Unit price, total value and box conversion equal exact decimal
    arithmetic rounded half-up to 6 places, over random 18-digit values."""
    import decimal
    import random

    ctx = decimal.Context(prec=80, rounding=decimal.ROUND_HALF_UP)
    q6 = D("0.000001")
    rnd = random.Random(11)

    def rand_dec(int_digits):
        sign = -1 if rnd.random() < 0.2 else 1
        whole = rnd.randrange(10 ** rnd.randrange(0, int_digits + 1))
        frac = rnd.randrange(10 ** 18)
        return D(sign * (whole * 10 ** 18 + frac)).scaleb(-18)

    data = []
    for i in range(400):
        p, c = rand_dec(6), rand_dec(4)
        if i % 17 == 0:
            c = D(0)
        unit = rnd.choice(["CS", "cs", "ST", None])
        data.append(("GT", "20250101", "T", "R", "ZPRE", f"m{i}", p, c, unit))
    out = add_calculated_columns(convert_units(rows(spark, data)), with_timestamp=False)
    for r in out.collect():
        p, c = r.precio, r.cantidad
        qstd = (ctx.multiply(c, 20) if (r.unidad or "").upper() == "CS" else c).quantize(q6, context=ctx)
        assert r.quantity_standardized == qstd, r
        assert r.total_value == ctx.multiply(p, qstd).quantize(q6, context=ctx), r
        want = ctx.divide(p, c).quantize(q6, context=ctx) if c > 0 else D(0)
        assert r.unit_price == want, r
