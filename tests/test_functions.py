import datetime

import pytest
from pyspark.sql import functions as F

from plumbline.functions import casts
from plumbline.functions.infer import kind_bit, merged_type
from plumbline.functions.names import canonicalize, normalize_name


def column(spark, values, name="v"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} string")


def results(df, expression):
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


@pytest.mark.parametrize("raw, clean", [
    (" Order ID ", "order_id"), ("order--Value($)", "order_value"), ("__x__", "x"), ("a b  c", "a_b_c")])
def test_normalize_name(raw, clean):
    assert normalize_name(raw) == clean


def test_canonicalize_folds_aliases(spark):
    df = spark.createDataFrame([(" a ", None, " 1"), ("", "b", "")], "`Customer ID` string, user_id string, `X-y` string")
    out = canonicalize(df, {"user_id": "customer_id"})
    assert out.columns == ["customer_id", "x_y"]
    assert [tuple(r) for r in out.collect()] == [("a", "1"), ("b", None)]


def test_tolerant_numbers(spark):
    df = column(spark, ["12.5", " 7 ", "", None, "abc", "1e3", "1.5d", "-3.999", "0x10", "."])
    assert results(df, casts.to_float(F.col("v"))) == [12.5, 7.0, 0.0, 0.0, 0.0, 1000.0, 0.0, -3.999, 0.0, 0.0]
    assert results(df, casts.to_int(F.col("v"), 1)) == [12, 7, 1, 1, 1, 1000, 1, -3, 1, 1]
    assert [None if v is None else float(v) for v in results(df, casts.to_money(F.col("v"), None))] == [
        12.5, 7.0, None, None, None, 1000.0, None, -4.0, None, None]


def test_safe_cast_numeric(spark):
    df = column(spark, ["$1,234.50", "EUR -3", "none", "", None, "1-2"])
    got = results(df, casts.safe_cast_numeric(F.col("v")).cast("double"))
    assert got == [1234.5, -3.0, None, None, None, None]


def test_date_from_ts(spark):
    df = column(spark, ["2026-05-09T01:02:03Z", "2026-05-09 01:02:03", "2026-05-09", "short", "", None])
    assert results(df, casts.date_from_ts(F.col("v"))) == ["2026-05-09"] * 3 + ["unknown"] * 3


def test_timestamp_ignores_zone(spark):
    df = column(spark, ["2026-05-09T09:15:00Z", " 2026-05-09 09:15:00 ", "bad"])
    moment = datetime.datetime(2026, 5, 9, 9, 15)
    assert results(df, casts.to_timestamp(F.col("v"))) == [moment, moment, None]


def test_ratio_guard(spark):
    df = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0), (1.0, None)], "n double, d double")
    assert [r[0] for r in df.select(casts.ratio(F.col("n"), F.col("d"))).collect()] == [0.25, 0.0, 0.0]


def test_surrogate_key_keeps_null_places(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    one, two = [r[0] for r in df.select(casts.surrogate_key(F.col("x"), F.col("y"), F.col("z"))).collect()]
    assert one != two


@pytest.mark.parametrize("values, kind", [
    (["1", "2", None, ""], "integer"), (["1", "2.5"], "decimal"), (["true", "FALSE"], "boolean"),
    (["2026-05-09", "2026-01-02"], "date"), (["2026-05-09", "2026-05-09T01:02:03Z"], "timestamp"),
    (["2026-05-09 01:02:03"], "timestamp"), (["1", "x"], "string"), ([None, ""], "string"),
    (["true", "1"], "string"), (["2026-13-40"], "string"), (["nan", "1"], "decimal")])
def test_type_lattice(spark, values, kind):
    bits = column(spark, values).agg(F.bit_or(kind_bit("v")).alias("b"))
    assert bits.select(merged_type("b")).first()[0] == kind


def test_pure_dates_as_timestamp(spark):
    bits = column(spark, ["2026-05-09"]).agg(F.bit_or(kind_bit("v")).alias("b"))
    assert bits.select(merged_type("b", date_as_timestamp=True)).first()[0] == "timestamp"
