from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import ladders, text
from ledgerline.functions.numbers import clean_round
from ledgerline.operators import shape


def column(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_strip_prefix(spark):
    values = ["011234", "1", "xx12", "01", "2101", "", None, "0A1"]
    got = column(spark, values, lambda c: text.strip_prefix(c, 2, 1))
    assert got == ["1234", "", "xx12", "", "2101", "", None, "0A1"]
    assert column(spark, ["1003345", "10034", "10033"], lambda c: text.strip_prefix(c, 5, 10033)) == ["45", "10034", ""]


def test_is_number(spark):
    got = column(spark, ["6", "06", "+6", "A", "6.0", " 6.00", "6.5", "", None, "16", "60"], lambda c: text.is_number(c, 6))
    assert got == [True, True, True, False, True, True, False, False, None, False, False]


def test_org_code(spark):
    values = ["CPV001234", "CP001234", "12345", "001234", "0123456789", None]
    got = column(spark, values, text.org_code)
    assert got == ["001234", "001234", "012345", "001234", "0123456789", None]


def test_cut_from(spark):
    assert column(spark, ["x BP - y", "none"], lambda c: text.cut_from(c, "BP -")) == ["BP - y", "none"]


def test_clean_round(spark):
    df = spark.createDataFrame(
        [("R$ 1.00005", Decimal("2.00005"), 0.25), ("", None, 1.5), ("1-2", Decimal("-2.00005"), -0.25), (None, None, None)],
        "s string, d decimal(20,6), f double",
    )
    got = [tuple(r) for r in clean_round(df, {"s": 4, "d": 4, "f": 1, "absent": 2}).collect()]
    assert got == [
        (Decimal("1.0001"), Decimal("2.0001"), Decimal("0.3")),
        (None, None, Decimal("1.5")),
        (None, Decimal("-2.0001"), Decimal("-0.3")),
        (None, None, None),
    ]


@pytest.mark.parametrize(
    "kind, tc, tti",
    [("6", "cup", "spr"), ("06", "cup", "spr"), ("7", "idx", "spr"), ("A", "cup", "pre"), ("B", "idx", "pre"),
     ("C", "", ""), ("", "", ""), (None, "", "")],
)
def test_rate_ladders(spark, kind, tc, tti):
    df = spark.createDataFrame([(kind, "cup", "idx", "spr", "pre")], "k string, c string, i string, s string, p string")
    k, c, i, s, p = (F.col(x) for x in "kcisp")
    assert tuple(df.select(ladders.coupon_asset(k, c, i), ladders.coupon_funding(k, s, p)).first()) == (tc, tti)


def test_system_code(spark):
    df = spark.createDataFrame(
        [("GL", "M", "CRE"), ("", "M", "CRE"), (None, "M", "CRE"), ("", "N", "CRE"), (None, None, "CRE")],
        "o string, r string, c string",
    )
    got = [r[0] for r in df.select(ladders.system_code(F.col("o"), F.col("r"), F.col("c"))).collect()]
    assert got == ["GL", "MN", "MN", "CRE", "CRE"]


def spread_of(spark, content, kind, steps):
    df = spark.createDataFrame(
        [(content, kind, "5.5", "2", "10", "3")], "c string, k string, Cupom_tc string, Cupom_tti string, out_tti string, tas_int string"
    )
    rates = {n: F.col(n) for n in ("Cupom_tc", "Cupom_tti", "out_tti", "tas_int")}
    value = df.select(ladders.spread(F.col("c"), F.col("k"), rates, steps)).first()[0]
    return None if value is None else float(value)


@pytest.mark.parametrize("content", ["CRE", "PRE", "CCO", "ARF", "CAP", "COM", "CTA", "PLZ", "FON"])
def test_spread_per_code_and_kind(spark, content):
    as_written = {k: spread_of(spark, content, k, ladders.SPREAD_STEPS) for k in ("V", "F", None)}
    grouped = {k: spread_of(spark, content, k, ladders.SPREAD_STEPS_GROUPED) for k in ("V", "F", None)}
    if content == "COM":
        want = want_grouped = {"V": 3.5, "F": -7.0, None: None}
    elif content == "PLZ":
        want = want_grouped = {"V": 3.5, "F": 7.0, None: None}
    elif content == "FON":
        want = want_grouped = {"V": None, "F": None, None: None}
    else:
        want = {"V": 3.5, "F": 3.5, None: 3.5}
        want_grouped = {"V": 3.5, "F": 7.0 if content == "CTA" else -7.0, None: None}
    assert as_written == want and grouped == want_grouped


def test_trim_all(spark, rows):
    df = spark.createDataFrame([(" a\t", 5, None, Decimal("1.50"))], "A string, b int, c string, d decimal(5,2)")
    got = shape.trim_all(shape.lower_names(df), keep=["d"])
    assert got.dtypes == [("a", "string"), ("b", "string"), ("c", "string"), ("d", "decimal(5,2)")]
    assert rows(got) == [("a", "5", None, Decimal("1.50"))]
    assert rows(shape.trim_all(df, null_token="None"), "c") == [("None",)]


def test_where_in_and_projection(spark, rows):
    df = spark.createDataFrame([("x", "CRE"), ("y", "ZZZ")], "a string, c string")
    assert rows(shape.where_in(df, "c", ["CRE"])) == [("x", "CRE")]
    assert shape.where_in(df, "c", None) is df
    padded = spark.createDataFrame([("CRE",), ("\tCRE ",), ("CREX",), ("ZZZ",), (None,)], "c string")
    assert set(rows(shape.where_may_trim_to(padded, "c", ["CRE"]))) == {("\tCRE ",), ("CRE",), ("CREX",)}
    assert shape.where_may_trim_to(padded, "c", None) is padded
    out = shape.constants(shape.select_map(df, [("N", "a")]), Fonte="")
    assert out.columns == ["N", "Fonte"] and rows(out) == [("x", ""), ("y", "")]


def test_clean_round_rounds_text_once(spark):
    """Digits beyond the tenth decide nothing twice: 0.12345499999999 is 0.12345, not 0.12346."""
    df = spark.createDataFrame([("0.123454999999999",), ("-2.5",), ("123456789012345678901234567.125",), ("1.2.3",), ("-",)], "s string")
    got = [r.s for r in clean_round(df, {"s": 5}).collect()]
    assert got == [Decimal("0.12345"), Decimal("-2.50000"), Decimal("123456789012345678901234567.12500"), None, None]
