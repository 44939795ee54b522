import pytest
from conftest import rows, ts

from tidemark.operators.merge import merge_upsert

T = "k STRING, v INT, _bronze_sync_timestamp TIMESTAMP_NTZ, _silver_load_timestamp TIMESTAMP_NTZ, _run_id STRING"


def _target(spark):
    return spark.createDataFrame([
        ("a", 1, ts("2024-01-01"), ts("2024-01-01 01:00"), "r1"),
        ("b", 1, ts("2024-01-05"), ts("2024-01-01 01:00"), "r1"),
        ("c", 1, ts("2024-01-01"), ts("2024-01-01 01:00"), "r1"),
        (None, 9, ts("2024-01-01"), ts("2024-01-01 01:00"), "r1"),
    ], T)


def _updates(spark):
    return spark.createDataFrame([
        ("a", 2, ts("2024-01-02"), ts("2024-01-02 01:00"), "r2"),   # matched, newer
        ("b", 2, ts("2024-01-03"), ts("2024-01-02 01:00"), "r2"),   # matched, OLDER than target
        ("d", 2, ts("2024-01-02"), ts("2024-01-02 01:00"), "r2"),   # unmatched -> insert
        (None, 8, ts("2024-01-02"), ts("2024-01-02 01:00"), "r2"),  # NULL key -> always inserted
    ], T)


@pytest.mark.parametrize("strategy", ["shuffle", "lookup"])
def test_upsert_contract(spark, strategy):
    out = rows(merge_upsert(_target(spark), _updates(spark), ["k"], strategy=strategy), "k", "v")
    by = {(r["k"], r["v"]): r for r in out}
    assert len(out) == 6
    assert by[("a", 2)]["_silver_load_timestamp"] == ts("2024-01-01 01:00")  # first load time kept
    assert by[("a", 2)]["_run_id"] == "r2"
    assert ("b", 2) in by  # unconditional: older version overwrites newer
    assert by[("c", 1)]["_run_id"] == "r1"  # untouched
    assert by[("d", 2)]["_silver_load_timestamp"] == ts("2024-01-02 01:00")  # insert keeps its own
    assert (None, 9) in by and (None, 8) in by  # NULL keys never match


def test_only_if_newer_blocks_regression(spark):
    out = rows(merge_upsert(_target(spark), _updates(spark), ["k"], only_if_newer=True), "k", "v")
    assert {(r["k"], r["v"]) for r in out if r["k"] == "b"} == {("b", 1)}
    assert {(r["k"], r["v"]) for r in out if r["k"] == "a"} == {("a", 2)}


def test_new_and_removed_columns(spark):
    target = _target(spark)
    from pyspark.sql import functions as F
    updates = _updates(spark).withColumn("extra", F.col("v") * 10).drop("v")
    out = rows(merge_upsert(target, updates, ["k"]), "k")
    cols = list(out[0].keys())
    assert cols[:5] == ["k", "v", "_bronze_sync_timestamp", "_silver_load_timestamp", "_run_id"]
    assert cols[-1] == "extra"
    c = [r for r in out if r["k"] == "c"][0]
    assert c["extra"] is None and c["v"] == 1  # older row: NULL in the new column
    a = [r for r in out if r["k"] == "a"][0]
    assert a["extra"] == 20 and a["v"] == 1  # removed column keeps its target value


def test_type_change_raises(spark):
    from pyspark.sql import functions as F
    bad = _updates(spark).withColumn("v", F.col("v").cast("string"))
    with pytest.raises(TypeError):
        merge_upsert(_target(spark), bad, ["k"])


def test_replay_is_stable(spark):
    once = merge_upsert(_target(spark), _updates(spark), ["k"])
    twice = merge_upsert(once, _updates(spark), ["k"])
    key = lambda r: (r["k"] or "", r["v"])
    a = sorted((r for r in rows(once) if r["k"] is not None), key=key)
    b = sorted((r for r in rows(twice) if r["k"] is not None), key=key)
    assert a == b
    # each replay adds another copy of a NULL-key row, as plain '=' never matches
    assert sum(r["k"] is None for r in rows(twice)) == 3


def test_first_run_without_target(spark):
    assert merge_upsert(None, _updates(spark), ["k"]).count() == 4


def test_row_level_merge_is_refused_on_builtin_parquet_tables(spark):
    from pyspark.errors import PySparkException

    from tidemark.operators.merge import merge_into_table
    spark.sql("DROP TABLE IF EXISTS tm_merge_target")
    _target(spark).filter("k IS NOT NULL").write.format("parquet").saveAsTable("tm_merge_target")
    with pytest.raises(PySparkException) as err:
        merge_into_table("tm_merge_target", _updates(spark).filter("k IS NOT NULL"), ["k"])
    assert "UNSUPPORTED" in str(err.value) or "not support" in str(err.value).lower()
    spark.sql("DROP TABLE IF EXISTS tm_merge_target")


def test_hot_key_holding_a_third_of_rows(spark):
    from pyspark.sql import functions as F

    from tidemark.operators.dedup import latest_per_key
    from tidemark.operators.quality import check_unique
    n = 3000
    df = (spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").cast("int").alias("v"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id"))).alias("_synced")))
    latest = latest_per_key(df, ["k"])
    assert latest.count() == 1 + 2 * n // 3
    assert latest.filter("k = 'hot'").first().v == n - 3
    assert [tuple(r) for r in check_unique(df, "k").collect()] == [("hot", n // 3)]
    t = latest.select("k", "v", F.col("_synced").alias("_bronze_sync_timestamp"))
    merged = merge_upsert(t, t.filter("k = 'hot'").withColumn("v", F.lit(-1)), ["k"], strategy="shuffle")
    assert merged.count() == t.count() and merged.filter("v = -1").count() == 1
