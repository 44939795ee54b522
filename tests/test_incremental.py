from conftest import ts

from tidemark.sources.bronze import high_water_mark, incremental, late_rows

S = "id INT, _synced TIMESTAMP_NTZ"


def test_watermark_and_lookback(spark):
    target = spark.createDataFrame([(ts("2024-01-10 00:00"),)], "_bronze_sync_timestamp TIMESTAMP_NTZ")
    src = spark.createDataFrame([
        (1, ts("2024-01-10 00:00")),   # exactly at the mark but inside the lookback -> re-read
        (2, ts("2024-01-10 00:00:01")),  # just above
        (3, ts("2024-01-09 12:00")),   # late, inside lookback (now - 3 days = 01-09 00:00)
        (4, ts("2024-01-05 00:00")),   # late, outside lookback -> lost
        (5, None),                     # NULL sync: dropped on incremental runs
    ], S)
    now = "2024-01-12 00:00:00"
    got = sorted(r.id for r in incremental(src, target, now).collect())
    assert got == [1, 2, 3]
    assert sorted(r.id for r in late_rows(src, target, now).collect()) == [4, 5]


def test_row_exactly_at_mark_outside_lookback_is_skipped(spark):
    target = spark.createDataFrame([(ts("2024-01-05 00:00"),)], "_bronze_sync_timestamp TIMESTAMP_NTZ")
    src = spark.createDataFrame([(1, ts("2024-01-05 00:00")), (2, ts("2024-01-05 00:00:00.000001"))], S)
    assert [r.id for r in incremental(src, target, "2024-01-12 00:00:00").collect()] == [2]


def test_first_run_reads_everything_and_empty_target_uses_floor(spark):
    src = spark.createDataFrame([(1, ts("1999-01-01")), (2, ts("2001-01-01")), (3, None)], S)
    assert incremental(src, None, "2024-01-01").count() == 3
    empty = spark.createDataFrame([], "_bronze_sync_timestamp TIMESTAMP_NTZ")
    assert high_water_mark(empty) == ts("2000-01-01")
    assert sorted(r.id for r in incremental(src, empty, "2024-01-01").collect()) == [2]


def test_filter_pushes_into_parquet_scan(spark, tmp_path, capsys):
    path = str(tmp_path / "b")
    spark.createDataFrame([(1, ts("2024-01-10"))], S).write.parquet(path)
    target = spark.createDataFrame([(ts("2024-01-10"),)], "_bronze_sync_timestamp TIMESTAMP_NTZ")
    incremental(spark.read.parquet(path), target, "2024-01-12").explain()
    plan = capsys.readouterr().out
    assert "PushedFilters: [IsNotNull(_synced), GreaterThanOrEqual(_synced" in plan


def test_landed_bronze_prunes_partitions(spark, tmp_path, capsys):
    from tidemark.plans.models import refine
    from tidemark.sources.bronze import land
    from tidemark.specs import Col, TableSpec

    path = str(tmp_path / "landed")
    data = [("a", i, ts(f"2024-01-{d:02d} 10:00"), False) for i, d in enumerate(range(1, 11))]
    land(spark.createDataFrame(data, "k STRING, v INT, _synced TIMESTAMP_NTZ, _deleted BOOLEAN"), path)
    spec = TableSpec("t", "b", ("k",), (Col("k"), Col("v")))
    out = refine(spec, spark.read.parquet(path), "2024-01-12 00:00:00", "r", watermark=ts("2024-01-10 10:00"))
    assert [r.v for r in out.collect()] == [9]
    out.explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(_sync_date" in plan and "(_sync_date#" in plan
