import pytest
from conftest import rows, ts

from tidemark.operators.quality import (
    CheckFailed, check_column_type, check_rows, check_unique, check_unique_combination, enforce, freshness,
    newest_day, orphans, run_checks, run_checks_once, update_unique,
)
from tidemark.plans.models import run_model
from tidemark.sources.bronze import land
from tidemark.sources.ranges import ranges_changed, rewrite_ranges
from tidemark.sources.tables import VersionedTable, staged
from tidemark.specs import Check, Col, TableSpec


def test_fk_single_and_composite(spark):
    parent = spark.createDataFrame([("F1", "2024-01-01"), ("F1", "2024-01-01"), ("F2", "2024-01-02")],
                                   "fn STRING, fd STRING")
    child = spark.createDataFrame([("F1", "2024-01-01"), ("F3", "2024-01-01"), (None, "2024-01-01"),
                                   ("F2", None), ("F1", "2024-01-01")], "fn STRING, fd STRING")
    single = rows(orphans(child, parent, ["fn"]), "fn")
    assert [r["fn"] for r in single] == ["F3"]  # NULL FK passes; duplicate parents don't multiply
    comp = rows(orphans(child, parent, ["fn", "fd"]), "fn")
    assert [(r["fn"], r["fd"]) for r in comp] == [("F2", None), ("F3", "2024-01-01")]


def test_fk_against_current_history_rows(spark):
    hist = spark.createDataFrame([("R1", False, False), ("R1", True, False), ("R2", False, False),
                                  ("R3", True, True)], "reg STRING, is_current BOOLEAN, is_deleted BOOLEAN")
    child = spark.createDataFrame([("R1",), ("R2",), ("R3",)], "reg STRING")
    from pyspark.sql import functions as F
    got = rows(orphans(child, hist, ["reg"], parent_filter=F.col("is_current")), "reg")
    assert [r["reg"] for r in got] == ["R2"]  # R2 only closed; R3 current tombstone counts as parent


def test_numeric_checks(spark):
    df = spark.createDataFrame([(1, -1.0), (2, 0.0), (3, 5.0), (4, None)], "id INT, x DOUBLE")
    gt = [r.id for r in check_rows(df, Check("expression", ("x",), arg="> 0")).collect()]
    ge = [r.id for r in check_rows(df, Check("expression", ("x",), arg=">= 0")).collect()]
    pos = [r.id for r in check_rows(df, Check("positive", ("x",))).collect()]
    nn = [r.id for r in check_rows(df, Check("not_null", ("x",))).collect()]
    assert sorted(gt) == [1, 2] and ge == [1] and sorted(pos) == [1, 2] and nn == [4]


def test_unique_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, None), (None, None)], "k STRING, n INT")
    assert [r.k for r in check_unique(df, "k").collect()] == ["a"]
    combos = {(r.k, r.n) for r in check_unique_combination(df, ["k", "n"]).collect()}
    assert combos == {("a", 1), (None, None)}  # NULLs group together in the combination test


def test_column_type(spark):
    df = spark.createDataFrame([(1,)], "x INT")
    assert check_column_type(df, "x", "INT").count() == 0
    assert [tuple(r) for r in check_column_type(df, "x", "bigint").collect()] == [("x", "bigint", "int")]
    assert check_column_type(df.limit(0), "x", "bigint").count() == 0  # empty input passes


def test_freshness_levels(spark):
    df = spark.createDataFrame([(ts("2024-01-01 00:00"),)], "_synced TIMESTAMP_NTZ")
    status = lambda now: freshness(df, "s", now, 1, 4).first().status
    assert status("2024-01-01 00:59:59") == "pass"
    assert status("2024-01-01 01:00:01") == "warn"
    assert status("2024-01-01 04:00:01") == "error"
    empty = spark.createDataFrame([], "_synced TIMESTAMP_NTZ")
    assert freshness(empty, "s", "2024-01-01", 1, 4).first().status == "error"


def test_suite_and_severity(spark):
    df = spark.createDataFrame([("a", 1.0, "AB1"), ("a", -1.0, "ab"), (None, 2.0, None)],
                               "k STRING, amt DOUBLE, code STRING")
    checks = (Check("not_null", ("k",)), Check("unique", ("k",)), Check("expression", ("amt",), "error", "> 0"),
              Check("regex", ("code",), "warn", r"^[A-Z0-9]+$"))
    out = {r["check_name"]: r for r in rows(run_checks("t", df, checks))}
    assert out["not_null_k"]["failures"] == 1 and out["unique_k"]["failures"] == 1
    assert out["expression_amt_>0"]["failures"] == 1 and out["regex_code"]["status"] == "warn"
    with pytest.raises(CheckFailed):
        enforce(run_checks("t", df, checks))
    assert enforce(run_checks("t", df, checks[3:]))[0]["status"] == "warn"  # warnings do not fail


# ---- checks while writing, freshness by day, uniqueness by range --------------------------------------------

GATED = TableSpec("out", "b", ("k",), (Col("k"), Col("v")), checks=(
    Check("not_null", ("v",)), Check("expression", ("v",), "warn", "> 0"), Check("unique", ("k",))))


def _rows(spark, values, day):
    return spark.createDataFrame([(k, v, ts(f"2024-01-{day:02d}"), False) for k, v in values],
                                 "k STRING, v INT, _synced TIMESTAMP_NTZ, _deleted BOOLEAN")


def test_error_check_leaves_the_old_version_current(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    run_model(GATED, _rows(spark, [("a", 1), ("b", -1)], 1), t, "2024-01-01", "r1", checked=True)  # a warning passes
    assert t.metrics()["check_expression_v_>0"] == 1
    folders = set((tmp_path / "t" / "data").iterdir())
    with pytest.raises(CheckFailed, match="out.not_null_v: 1"):
        run_model(GATED, _rows(spark, [("a", None), ("c", 3)], 2), t, "2024-01-02", "r2", checked=True)
    assert t.current_version() == 1 and {r["k"]: r["v"] for r in rows(t.read())} == {"a": 1, "b": -1}
    assert set((tmp_path / "t" / "data").iterdir()) == folders  # nothing is left of the refused write
    run_model(GATED, _rows(spark, [("a", 7), ("c", 3)], 2), t, "2024-01-02", "r3", checked=True)
    assert {r["k"]: r["v"] for r in rows(t.read())} == {"a": 7, "b": -1, "c": 3}
    with pytest.raises(CheckFailed):
        run_model(GATED, _rows(spark, [("x", None)], 1), VersionedTable(spark, str(tmp_path / "u")), "2024-01-01", "r1", checked=True)
    assert VersionedTable(spark, str(tmp_path / "u")).current_version() is None


def test_checks_once_equal_the_suite_and_run_the_input_once(spark):
    df = _rows(spark, [("a", 1), ("a", None), ("b", -1), (None, 2), (None, 3)], 1)
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b
    seen = df.coalesce(1).mapInArrow(count, df.schema)
    checks = [*GATED.checks, Check("unique_combination", ("k", "v")), Check("column_type", ("v",), "warn", "bigint")]
    want = rows(run_checks("t", df, checks), "check_name")
    assert rows(run_checks_once("t", seen, checks), "check_name") == want
    assert runs.value == 5
    assert rows(run_checks_once("t", df, GATED.checks[:2]), "check_name") == rows(run_checks("t", df, GATED.checks[:2]), "check_name")


def test_freshness_reads_the_newest_day_only(spark, tmp_path, capsys):
    path = str(tmp_path / "landed")
    for day in (1, 2, 9):
        land(_rows(spark, [("a", day)], day), path)
    land(spark.createDataFrame([("n", 1, None, False)], "k STRING, v INT, _synced TIMESTAMP_NTZ, _deleted BOOLEAN"), path)
    df = newest_day(spark.read.parquet(path))
    df.explain()
    assert "PartitionFilters: [isnotnull(_sync_date" in capsys.readouterr().out
    assert {r._sync_date.isoformat() for r in df.collect()} == {"2024-01-09"}
    out = freshness(df, "s", "2024-01-09 02:00:00", 1, 4).first()
    assert out.max_loaded_at == ts("2024-01-09") and out.status == "warn"


def test_uniqueness_is_recounted_in_touched_ranges_only(spark, tmp_path):
    t, state = VersionedTable(spark, str(tmp_path / "t")), VersionedTable(spark, str(tmp_path / "s"))
    append = lambda stored, new: new if stored is None else stored.unionByName(new)

    def add(values):
        with staged(spark.createDataFrame(values, "a INT, b INT")) as batch:
            rewrite_ranges(t, batch, "a", append, rows_per_range=20)
        return {(r.a, r.b): r.n_records for r in update_unique(t, state, ["a", "b"]).collect()}

    data = [(i, 0) for i in range(160)] + [(5, 0), (150, 0)]
    assert add(data) == {(5, 0): 2, (150, 0): 2}
    assert add([(151, 9)]) == {(5, 0): 2, (150, 0): 2}
    before, counted = set(state.parts()), state.commit_info(state.current_version())["counted"]
    assert add([(159, 0), (200, 1), (200, 1), (None, 1), (None, 1)]) == {(5, 0): 2, (150, 0): 2, (159, 0): 2, (200, 1): 2, (None, 1): 2}
    assert before & set(state.parts()) and len(ranges_changed(t, counted)) < 4
    assert add([(5, 0)])[5, 0] == 3
    v = state.current_version()
    update_unique(t, state, ["a", "b"])
    assert state.current_version() == v  # nothing was rewritten since
    with pytest.raises(ValueError):
        update_unique(t, state, ["b", "a"])
