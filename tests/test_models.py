"""The 13 outputs (M1-M13) end to end on small bronze fixtures built from the source specs."""

import datetime as dt
import decimal
from dataclasses import replace

import pytest
from pyspark.sql import types as T

from tidemark.operators.quality import enforce, run_checks, run_fk_checks
from tidemark.plans.models import refine, run_model, run_snapshot
from tidemark.sources.ingest import SOURCE_KEYS
from tidemark.sources.tables import VersionedTable
from tidemark.specs import FOREIGN_KEYS, MODELS, SNAPSHOTS, SOURCES

TEXT_DATES = {"flight_date", "date_of_birth", "creation_date"}
TEXT_TIMES = {"scheduled_dep", "scheduled_arr", "actual_dep", "actual_arr", "duty_start", "duty_end"}
FIXED = {"ticket_status": "FLOWN", "approved_flag": "Y", "status": "OPEN", "passport_number": "AB123"}


def value(field: T.StructField, i: int, synced: dt.datetime):
    n, t = field.name, field.dataType
    if n == "_synced":
        return synced
    if n == "_deleted":
        return False
    if isinstance(t, T.StringType):
        if n in FIXED:
            return FIXED[n]
        if n in TEXT_DATES:
            return f"2024-01-{i % 28 + 1:02d}"
        if n in TEXT_TIMES:
            return f"2024-01-{i % 28 + 1:02d} 10:30:00"
        if n in ("block_hours", "flight_hours"):
            return f"{i % 10 + 1}.25"
        if n in ("flight_id", "aircraft_reg", "aircraft_type", "airport_code"):
            return f"{n[:3].upper()}{i % 5}"
        return f"{n}-{i}"
    if isinstance(t, T.DecimalType):
        return decimal.Decimal(i % 9 + 1).quantize(decimal.Decimal(1).scaleb(-t.scale))
    if isinstance(t, T.IntegerType):
        return i
    if isinstance(t, T.DateType):
        return dt.date(2024, 1, i % 5 + 1)
    raise TypeError(f"{n}: {t}")


def bronze(spark, source: str, n: int, synced: dt.datetime):
    schema = T._parse_datatype_string(SOURCES[source].schema_ddl)
    data = [tuple(value(f, i, synced) for f in schema.fields) for i in range(n)]
    return spark.createDataFrame(data, schema)


@pytest.mark.parametrize("name", sorted(MODELS))
def test_keyed_model_two_runs(spark, tmp_path, name):
    spec = MODELS[name]
    table = VersionedTable(spark, str(tmp_path / name))
    b1 = bronze(spark, spec.source, 5, dt.datetime(2024, 1, 10))
    run_model(spec, b1, table, "2024-01-10 01:00:00", "r1")
    first = table.read()
    assert first.count() == len({tuple(r) for r in b1.select(*spec.keys).collect()})
    b2 = b1.unionByName(bronze(spark, spec.source, 8, dt.datetime(2024, 1, 11)))
    run_model(spec, b2, table, "2024-01-11 01:00:00", "r2", full_refresh=True)  # refresh is refused
    out = table.read()
    assert table.current_version() == 2
    assert out.count() == len({tuple(r) for r in b2.select(*spec.keys).collect()})
    expected_cols = [c.name for c in spec.columns] + [
        "_bronze_sync_timestamp", "_silver_load_timestamp", "_run_id", "_is_deleted"]
    assert out.columns == expected_cols
    kept = out.filter("_run_id = 'r2'").select("_silver_load_timestamp").distinct().collect()
    assert {r[0] for r in kept} <= {dt.datetime(2024, 1, 10, 1), dt.datetime(2024, 1, 11, 1)}
    enforce(run_checks(name, out, [c for c in spec.checks if c.severity == "error"]))


def test_dev_limiter_applies_only_with_date_column(spark):
    spec = MODELS["flight_leg"]
    b = bronze(spark, "flight_leg", 30, dt.datetime(2024, 1, 10))
    assert refine(spec, b, "2024-01-10", "r", dev_today="2024-01-31", dev_days=10).count() < 30
    assert refine(MODELS["work_order"], bronze(spark, "work_order", 30, dt.datetime(2024, 1, 10)),
                  "2024-01-10", "r", dev_today="2024-01-31", dev_days=10).count() == 30


@pytest.mark.parametrize("name", sorted(SNAPSHOTS))
def test_history_outputs(spark, tmp_path, name):
    spec = SNAPSHOTS[name]
    table = VersionedTable(spark, str(tmp_path / name))
    b1 = bronze(spark, spec.source, 5, dt.datetime(2024, 1, 10))
    run_snapshot(spec, b1, table, "2024-01-10 01:00:00", "r1")
    n1 = table.read().count()
    run_snapshot(spec, b1, table, "2024-01-11 01:00:00", "r2")  # unchanged snapshot: idempotent
    assert table.read().count() == n1
    run_snapshot(spec, b1.limit(0), table, "2024-01-12 01:00:00", "r3")  # everything vanished
    hist = table.read()
    assert hist.filter("is_current AND is_deleted").count() == n1
    enforce(run_checks(name, hist, [c for c in spec.checks if c.severity == "error"]))


def test_foreign_key_suite(spark):
    t = {m: refine(MODELS[m], bronze(spark, MODELS[m].source, 5, dt.datetime(2024, 1, 10)), "2024-01-10", "r")
         for m in MODELS}
    from tidemark.operators.scd2 import scd2_apply
    from tidemark.plans.models import snapshot_source
    fleet = SNAPSHOTS["aircraft_fleet_history"]
    t["aircraft_fleet_history"] = scd2_apply(
        None, snapshot_source(fleet, bronze(spark, "aircraft_fleet", 5, dt.datetime(2024, 1, 10))),
        fleet.keys, "2024-01-10")
    out = {r["check_name"]: r["failures"] for r in run_fk_checks(t, FOREIGN_KEYS).collect()}
    assert out["air_waybill_fk_valid"] == 0 and out["crew_assignment_fk_valid"] == 0
    assert out["work_order_fk_valid"] == 0
    assert out["ticket_coupon_fk_valid"] == 5  # coupon flight numbers are not leg numbers in the fixture


def _messy(spark, source, run):
    """Rows with hot, repeated and NULL keys, ties, deletes and updates."""
    schema = T.StructType.fromDDL(SOURCES[source].schema_ddl)
    data = []
    for i in range(400):
        k = 7 if i % 3 == 0 else i % 90 + (40 if run == 2 else 0)
        row = [value(f, k, dt.datetime(2024, 1, run, i % 20)) for f in schema.fields]
        at = {f.name: n for n, f in enumerate(schema.fields)}
        row[at["_deleted"]] = None if i % 5 else i % 2 == 0
        for key in (SOURCE_KEYS[source] if i % 11 == 0 else ())[-1:]:
            row[at[key]] = None
        for f in schema.fields:
            if isinstance(f.dataType, T.DecimalType):
                row[at[f.name]] = decimal.Decimal(i % 7)
        data.append(tuple(row))
    return spark.createDataFrame(data, schema)


@pytest.mark.parametrize("name", ["crew_assignment", "ticket_coupon", "passenger_name_record", "airport_fees_history"])
def test_runs_in_buckets_give_the_rows_of_shuffled_runs(spark, tmp_path, monkeypatch, name):
    from tidemark.operators import dedup
    spec = MODELS.get(name) or SNAPSHOTS[name]
    run = run_model if name in MODELS else run_snapshot
    first, second = _messy(spark, spec.source, 1), _messy(spark, spec.source, 2)
    both, out = first.unionByName(second), []
    made = []
    real = dedup.key_shape

    def shape(*a, **k):  # few keys would be shuffled: here they go to buckets, every second slot as a hot one
        found = real(*a, **k)
        made.append(found if many > 20 else replace(found, buckets=found.buckets or 3, hot=tuple(range(0, dedup.SLOTS, 2))))
        return made[-1]

    monkeypatch.setattr(dedup, "key_shape", shape)
    for many in (10**9, 20):
        monkeypatch.setattr(dedup, "BUCKET_ROWS", many)
        table = VersionedTable(spark, str(tmp_path / f"t{many}"))
        run(spec, first, table, "2024-01-02", "r1")
        run(spec, both, table, "2024-01-03", "r2")
        out.append(sorted(map(str, table.read().collect())))
    assert out[0] == out[1] and len(out[0]) > 20
    assert [bool(m.buckets) for m in made] == [False, False, True, True]
    assert not [t for t in spark.catalog.listTables() if name in t.name]  # the copies are gone


def test_runs_in_buckets_shuffle_no_rows(spark, tmp_path, monkeypatch):
    from tidemark.operators import dedup
    monkeypatch.setattr(dedup, "BUCKET_ROWS", 200)
    plans = []
    real = VersionedTable.commit
    monkeypatch.setattr(VersionedTable, "commit", lambda self, df, *a, **k:
                        plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(self, df, *a, **k))
    spec, table = MODELS["crew_assignment"], VersionedTable(spark, str(tmp_path / "t"))
    first = _messy(spark, spec.source, 1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        run_model(spec, first, table, "2024-01-02", "r1")
        run_model(spec, first.unionByName(_messy(spark, spec.source, 2)), table, "2024-01-03", "r2")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(plans) == 2 and "FullOuter" in plans[1]
    assert not any("hashpartitioning" in p for p in plans)  # windows and joins read the buckets as they are


def test_runs_in_many_buckets_write_by_few_tasks(spark, tmp_path, monkeypatch):
    from tidemark.operators import dedup
    monkeypatch.setattr(dedup, "BUCKET_ROWS", 20)
    tasks, made, few = [], [], 2 * spark.sparkContext.defaultParallelism
    real, shape = VersionedTable.commit, dedup.key_shape
    monkeypatch.setattr(VersionedTable, "commit", lambda self, df, *a, **k: tasks.append(df.rdd.getNumPartitions()) or real(self, df, *a, **k))
    monkeypatch.setattr(dedup, "key_shape", lambda *a, **k: made.append(replace(shape(*a, **k), buckets=30)) or made[-1])
    spec, table = MODELS["crew_assignment"], VersionedTable(spark, str(tmp_path / "t"))
    first, second = _messy(spark, spec.source, 1), _messy(spark, spec.source, 2)
    run_model(spec, first, table, "2024-01-02", "r1")
    run_model(spec, first.unionByName(second), table, "2024-01-03", "r2")
    # one task a bucket before; the joined rows, and those with a NULL key of either side, each by few tasks of their own
    assert tasks[0] <= few and few < tasks[1] <= 3 * few
