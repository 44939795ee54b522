import datetime as dt
import decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions import cleanse as C


def test_active_filter_keeps_false_and_null(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id INT, _deleted BOOLEAN")
    assert sorted(r.id for r in C.active(df).collect()) == [2, 3]


def test_flag_and_status_filters_drop_null(spark):
    df = spark.createDataFrame([(1, "Y"), (2, "N"), (3, None)], "id INT, f STRING")
    assert [r.id for r in df.filter(C.flag_is("f")).collect()] == [1]
    st = spark.createDataFrame([(1, "FLOWN"), (2, "VOID"), (3, "REFUNDED"), (4, None), (5, "CANCELLED")],
                               "id INT, s STRING")
    inc = st.filter(C.status_filter("s", include=["FLOWN"], exclude=["VOID", "REFUNDED"]))
    assert [r.id for r in inc.collect()] == [1]
    exc = st.filter(C.status_filter("s", exclude=["CANCELLED"]))
    assert sorted(r.id for r in exc.collect()) == [1, 2, 3]  # NULL status dropped by NOT IN


def test_try_to_date_edge_values(spark):
    vals = ["2024-02-30", "n/a", "", "2024-01-01T05:00:00+12:00", "2024", "2024-03-05", None]
    df = spark.createDataFrame([(v,) for v in vals], "s STRING")
    got = [r.d for r in df.select(C.try_to_date("s").alias("d")).collect()]
    assert got == [None, None, None, dt.date(2024, 1, 1), None, dt.date(2024, 3, 5), None]


def test_try_to_timestamp_ntz_discards_offset(spark):
    df = spark.createDataFrame([("2024-01-01T05:00:00+12:00",), ("garbage",), ("2024-01-01 05:00:00",)], "s STRING")
    got = [r.t for r in df.select(C.try_to_timestamp_ntz("s").alias("t")).collect()]
    assert got[0] == dt.datetime(2024, 1, 1, 5, 0)
    assert got[1] is None
    assert got[2] == dt.datetime(2024, 1, 1, 5, 0)


def test_decimal_cast_half_up_and_strict(spark):
    df = spark.createDataFrame([("2.675",), ("1.005",)], "s STRING")
    got = [r.d for r in df.select(C.to_decimal("s").alias("d")).collect()]
    assert got == [decimal.Decimal("2.68"), decimal.Decimal("1.01")]
    with pytest.raises(PySparkException):
        spark.createDataFrame([("abc",)], "s STRING").select(C.to_decimal("s")).collect()
    with pytest.raises(PySparkException):
        spark.createDataFrame([("123456789012.5",)], "s STRING").select(C.to_decimal("s")).collect()


def test_net_amount_null_total_stays_null(spark):
    df = spark.createDataFrame([(10.0, 2.0), (10.0, None), (None, 1.0)], "t DOUBLE, c DOUBLE")
    got = [r.n for r in df.select(C.net_amount("t", "c").alias("n")).collect()]
    assert got == [8.0, 10.0, None]


def test_composite_key_null_propagates(spark):
    df = spark.createDataFrame([("A", "B", dt.date(2024, 1, 2)), ("A", None, dt.date(2024, 1, 2))],
                               "a STRING, b STRING, d DATE")
    got = [r.k for r in df.select(C.composite_key("a", "b", C.date_text("d")).alias("k")).collect()]
    assert got == ["A-B-2024-01-02", None]


def test_email_validators(spark):
    vals = ["a.b@example.com", "o'neil@example.com", "user@examplecom", "a@b.com\n", None]
    df = spark.createDataFrame([(v,) for v in vals], "e STRING")
    out = df.select(C.email_structure_valid("e").alias("m"), C.email_test_valid("e").alias("t")).collect()
    assert [r.m for r in out] == [True, True, False, False, False]
    assert [r.t for r in out] == [True, False, False, False, None]


def test_dev_limiter_window(spark):
    df = spark.createDataFrame([("2024-03-31",), ("2024-01-01",), ("n/a",)], "d STRING")
    kept = df.filter(C.within_days("d", 90, "2024-04-01")).collect()
    assert [r.d for r in kept] == ["2024-03-31"]


def test_ts_lit_is_ntz(spark):
    df = spark.range(1).select(C.ts_lit(dt.datetime(2024, 1, 2, 3, 4, 5, 6)).alias("t"))
    assert df.schema["t"].dataType.simpleString() == "timestamp_ntz"
    assert df.first().t == dt.datetime(2024, 1, 2, 3, 4, 5, 6)
    assert F is not None
