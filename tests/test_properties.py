"""Property tests: the column rules equal their plain-Python statements."""

from decimal import Decimal as D

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cargoline.functions import is_blank_free, quality_flag, tiny_price_to_zero

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _blank_free(m):
    return m is not None and m.strip(" ") != "" and m != '""'


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet=' \t"aZ\n', max_size=5)), min_size=1, max_size=60))
def test_blank_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "material string")
    got = [r.ok for r in df.select(is_blank_free("material").alias("ok")).collect()]
    assert got == [_blank_free(v) for v in values]


prices = st.one_of(
    st.none(),
    st.decimals(min_value=D("-0.00001"), max_value=D("0.00001"), places=18),
    st.decimals(min_value=D("-1000"), max_value=D("1000"), places=18),
)


@SETTINGS
@given(st.lists(prices, min_size=1, max_size=60))
def test_tiny_price_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "precio decimal(38,18)")
    got = [r.p for r in df.select(tiny_price_to_zero("precio").alias("p")).collect()]
    want = [None if v is None else (D(0) if abs(v) < D("0.000001") else v) for v in values]
    assert got == want


@SETTINGS
@given(
    st.lists(
        st.tuples(prices, prices, st.one_of(st.none(), st.text(alphabet=" ab", max_size=3))),
        min_size=1,
        max_size=60,
    )
)
def test_quality_flag_rule(spark, rows):
    df = spark.createDataFrame(rows, "precio decimal(38,18), cantidad decimal(38,18), material string")
    got = [r.f for r in df.select(quality_flag().alias("f")).collect()]
    want = [
        "VALID" if p is not None and c is not None and p > 0 and c > 0 and m is not None and m.strip(" ")
        else "REVIEW"
        for p, c, m in rows
    ]
    assert got == want
