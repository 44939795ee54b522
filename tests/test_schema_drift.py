import pytest
from pyspark.sql import types as T

from tidemark.sources.bronze import ALLOW_ALL, ALLOW_COLUMNS, admit_tables, align_schema


def test_table_admission_policies():
    found, enabled = ["a", "b", "new"], ["a", "b"]
    assert admit_tables(found, enabled, ALLOW_ALL) == ["a", "b", "new"]
    assert admit_tables(found, enabled, ALLOW_COLUMNS) == ["a", "b"]
    with pytest.raises(ValueError):
        admit_tables(found, enabled, "BLOCK_EVERYTHING")


def test_new_columns_flow_and_missing_are_null(spark):
    target = T.StructType([T.StructField("k", T.StringType()), T.StructField("gone", T.IntegerType())])
    df = spark.createDataFrame([("a", 1.5)], "K STRING, extra DOUBLE")
    out = align_schema(df, target)
    assert out.columns == ["k", "gone", "extra"]  # case-insensitive match, target order, then new
    assert [tuple(r) for r in out.collect()] == [("a", None, 1.5)]


def test_type_change_is_an_error(spark):
    target = T.StructType([T.StructField("k", T.IntegerType())])
    with pytest.raises(TypeError):
        align_schema(spark.createDataFrame([("a",)], "k STRING"), target)
