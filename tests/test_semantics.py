"""Missing-value rules, text and date expressions on inline frames."""

import datetime as dt

from helpers import frame, rows
from pyspark.sql import functions as F

from gradientlab.functions import semantics as S
from gradientlab.functions import text as X


def values(spark, expr, schema, *data):
    df = frame(spark, "i int, " + schema, *[(i, *r) for i, r in enumerate(data)])
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_sum_rules(spark):
    df = frame(spark, "k string, v double", ("a", 1.0), ("a", None), ("b", 2.0), ("b", 3.0), ("c", None))
    got = df.groupBy("k").agg(S.sum_strict("v").alias("s"), S.sum_zero("v").alias("z"), S.pooled_mean("v", "v").alias("m"))
    assert rows(got, "k", "s", "z", "m") == [("a", None, 1.0, 1.0), ("b", 5.0, 5.0, 2.5), ("c", None, 0.0, None)]


def test_row_sum_and_mean(spark):
    df = frame(spark, "a int, b double", (1, 2.0), (None, 4.0))
    assert [tuple(r) for r in df.select(S.row_sum("a", "b"), S.row_mean("a", "b")).collect()] == [(3.0, 1.5), (4.0, None)]


def test_not_in_keeps_null(spark):
    df = frame(spark, "t string", ("Cold",), (None,), ("Warm",))
    assert rows(df.filter(S.not_in("t", ["Cold"])), "t") == [("Warm",), (None,)]
    assert df.filter(S.not_in("t", [])).count() == 3


def test_paste_writes_na(spark):
    assert values(spark, S.paste("a", "b", "a"), "a int, b string", (1, None), (None, "x")) == ["1_NA_1", "NA_x_NA"]


def test_bounds_keep_null(spark):
    assert values(spark, S.pmax("v", 0), "v double", (-1.0,), (None,), (2.0,)) == [0.0, None, 2.0]
    assert values(spark, S.pmin("v", 80), "v double", (90.0,), (None,), (2.0,)) == [80.0, None, 2.0]


def test_numbers_from_text(spark):
    data = (("1.5",), ("x",), (None,), (" 2 ",), ("NaN",), ("1e2",))
    assert values(spark, S.to_number("t"), "t string", *data) == [1.5, None, None, 2.0, None, 100.0]
    assert values(spark, X.clean_number("t"), "t string", ("1,200 mm",), ("0..123",), ("n.a.",), ("-3g",), ("",)) == [
        1200.0, 0.123, None, -3.0, None]
    assert values(spark, X.decimal_comma("t"), "t string", ("1,5",), ("x",)) == [1.5, None]
    assert values(spark, X.comma_number("t"), "t string", ("1,500",), ("2 g",)) == [1500.0, None]


def test_ratio_by_zero(spark):
    assert values(spark, S.ratio("a", "b"), "a int, b int", (1, 2), (1, 0), (None, 1)) == [0.5, None, None]


def test_recode(spark):
    data = (("a",), ("z",), (None,))
    assert values(spark, S.recode("t", {"a": "b"}), "t string", *data) == ["b", "z", None]
    assert values(spark, S.recode_to("t", {"a": 1.0}), "t string", *data) == [1.0, None, None]
    assert values(spark, S.na_if("t", "a", "q"), "t string", *data) == [None, "z", None]


def test_number_text(spark):
    got = values(spark, S.number_text("v"), "v double", (3200.0,), (0.5,), (12345678.0,), (0.0001,), (-1.5e-7,), (1e15,), (1e22,), (123456789.25,))
    assert got == ["3200", "0.5", "12345678", "0.0001", "-0.00000015", "1000000000000000", "10000000000000000000000", "123456789.25"]
    assert values(spark, S.number_text("v"), "v string", ("7",), ("7.0",), ("1E2",), ("T1E",)) == ["7", "7", "100", "T1E"]


def test_null_safe_join(spark):
    a = frame(spark, "k string, v int", ("x", 1), (None, 2), ("y", 3))
    b = frame(spark, "j string, w int", ("x", 10), (None, 20))
    assert rows(S.null_safe_join(a, b, {"k": "j"}), "k", "v", "w") == [("x", 1, 10), ("y", 3, None), (None, 2, 20)]
    assert rows(S.null_safe_join(a, b, {"k": "j"}, nulls_match=False), "v", "w") == [(1, 10), (2, None), (3, None)]
    assert rows(S.null_safe_join(a, b, {"k": "j"}, "right"), "k", "v", "w") == [("x", 1, 10), (None, 2, 20)]
    assert rows(S.null_safe_join(a, b, {"k": "j"}, "left_anti"), "k", "v") == [("y", 3)]
    assert rows(S.null_safe_join(a, b, {"k": "j"}, "full"), "k", "v", "w") == [("x", 1, 10), ("y", 3, None), (None, 2, 20)]


def test_natural_join_uses_all_shared_columns(spark):
    a = frame(spark, "p int, y int, t int", (1, 1, 5), (1, None, 6))
    b = frame(spark, "y int, p int, r int", (1, 1, 7), (None, 1, 8))
    assert rows(S.natural_left_join(a, b), "p", "y", "t", "r") == [(1, 1, 5, 7), (1, None, 6, 8)]


def test_optional_column(spark):
    df = frame(spark, "a int", (1,))
    assert df.select(S.column_or_null(df, "a"), S.column_or_null(df, "b")).collect()[0] == ("1", None)


def test_extract_and_parts(spark):
    data = (("A_1_12",), ("plain",), (None,))
    assert values(spark, X.extract("t", r"^(.*)_([^_]+)$", 1), "t string", *data) == ["A_1", None, None]
    assert values(spark, X.part("t", "_", 2), "t string", *data) == ["1", None, None]
    assert values(spark, X.word("t", 2), "t string", ("a b c",), ("a",)) == ["b", None]
    assert values(spark, X.replace_first("t", "l"), "t string", ("hello l",), ("x",)) == ["helo l", "x"]


def test_names(spark):
    data = (("Poa alpina L.",), ("Carex",), (None,))
    assert values(spark, X.two_words("t"), "t string", *data) == ["Poa alpina", "Carex", None]
    assert values(spark, X.sp_suffix("t"), "t string", *data) == ["Poa alpina L.", "Carex sp.", None]
    assert values(spark, X.genus("t"), "t string", *data) == ["Poa", "Carex", None]
    assert values(spark, X.squish("t"), "t string", (" a  b c\t",)) == ["a b c"]


def test_substrings(spark):
    t = "um1xxxw1yypf2zz"
    assert values(spark, X.between("t", 7, 8), "t string", (t,)) == ["w1"]
    assert values(spark, X.from_end("t", 4, 2), "t string", (t,)) == ["pf"]
    assert values(spark, X.from_end("t", 2), "t string", (t,)) == ["2"]
    assert values(spark, X.zero_pad2("t"), "t string", ("3",), ("12",)) == ["03", "12"]


def test_dates(spark):
    data = (("41821",), ("7/1/2014",), ("07/01/14",), ("7/1/75",), ("2014-07-01",), ("July",), ("13/45/2014",), (None,))
    d = dt.date(2014, 7, 1)
    assert values(spark, X.mixed_date("t"), "t string", *data) == [d, d, d, dt.date(1975, 7, 1), d, None, None, None]
    assert values(spark, X.leading_year("t"), "t string", ("2017.1 peak",), ("2018",), ("x y",)) == [2017, 2018, None]
    assert values(spark, X.two_digit_year("t"), "t string", ("A_12",), ("A_xx",)) == [2012, None]


def test_expressions_stay_in_the_engine(spark):
    df = frame(spark, "t string", ("a",)).select(X.mixed_date("t"), X.clean_number("t"), S.paste("t", F.lit(1)))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
