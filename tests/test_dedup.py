from pyspark.sql import functions as F

from conftest import rows, ts

from tidemark.functions.cleanse import active
from tidemark.operators.dedup import latest_per_key

SCHEMA = "k STRING, v INT, _synced TIMESTAMP_NTZ, _deleted BOOLEAN"


def test_latest_wins_and_null_sync_sorts_first(spark):
    df = spark.createDataFrame([
        ("a", 1, ts("2024-01-01"), False), ("a", 2, ts("2024-01-03"), False), ("a", 3, ts("2024-01-02"), False),
        ("b", 1, ts("2024-01-05"), False), ("b", 2, None, False),
        (None, 1, ts("2024-01-01"), False), (None, 2, ts("2024-01-09"), False),
    ], SCHEMA)
    got = {r["k"]: r["v"] for r in rows(latest_per_key(df, ["k"]))}
    assert got == {"a": 2, "b": 2, None: 2}  # NULL sync first under DESC; NULL keys group together


def test_tiebreak_makes_pick_total(spark):
    df = spark.createDataFrame([("a", 1, ts("2024-01-01"), False), ("a", 7, ts("2024-01-01"), False)], SCHEMA)
    assert [r["v"] for r in rows(latest_per_key(df, ["k"], tiebreak=["v"]))] == [7]


def test_filter_before_dedup_lets_older_live_row_win(spark):
    df = spark.createDataFrame([("a", 1, ts("2024-01-01"), False), ("a", 2, ts("2024-01-02"), True)], SCHEMA)
    assert [r["v"] for r in rows(latest_per_key(active(df), ["k"]))] == [1]
    assert [r["v"] for r in rows(active(latest_per_key(df, ["k"])))] == []


def test_plan_uses_partial_window_group_limit(spark, capsys):
    df = spark.createDataFrame([("a", 1, ts("2024-01-01"), False)], SCHEMA)
    latest_per_key(df, ["k"]).explain()
    plan = capsys.readouterr().out
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_shape_counts_rows_keys_null_keys_and_the_largest_task(spark):
    from tidemark.operators.dedup import key_shape
    rows = spark.range(0, 30000, 1, 3).select(F.when(F.col("id") % 10 == 0, None).otherwise(F.col("id") % 9000).alias("k"),
                                              F.concat(F.lit("a"), F.col("id") % 5).alias("t"))
    whole, parted = key_shape(rows, ["k", "t"]), key_shape(rows, ["k", "t"], apart=True)
    keys = rows.filter("k IS NOT NULL").distinct().count()
    assert (whole.rows, whole.alone, parted.rows, parted.alone) == (30000, 0, 27000, 3000)
    assert abs(parted.keys - keys) < 0.15 * keys
    assert key_shape(rows.limit(0), ["k"]).keys == 0
    assert key_shape(rows.filter("k = 5"), ["k"]).keys == 1


def test_buckets_stay_within_the_open_files_of_a_task(spark, monkeypatch):
    from tidemark.operators import dedup
    monkeypatch.setattr(dedup, "BUCKET_ROWS", 100)
    rows = spark.range(0, 3000, 1, 3).select(F.col("id").alias("k"))
    monkeypatch.setattr(dedup, "file_room", lambda spark: 21 * dedup.FILE_BYTES)
    assert dedup.key_shape(rows, ["k"]).buckets == 20  # 30 would not be open at once: somewhat larger ones are
    assert dedup.key_shape(rows, ["k"]).largest == 1000
    monkeypatch.setattr(dedup, "file_room", lambda spark: 11 * dedup.FILE_BYTES)
    assert dedup.key_shape(rows, ["k"]).buckets == 30  # far more than fit: their rows are sorted by file
