"""Command line: the five things an operator runs on a schedule.

    python -m tidemark.cli ingest     --landing ROOT --bronze ROOT [--select NAME ...] [--schema-policy POLICY]
    python -m tidemark.cli run        --bronze ROOT --silver ROOT [--select NAME ...]
    python -m tidemark.cli snapshot   --bronze ROOT --silver ROOT [--select NAME ...]
    python -m tidemark.cli test       --silver ROOT [--select NAME ...]
    python -m tidemark.cli freshness  --bronze ROOT

What replication delivers for table ``t`` lands at ``{landing}/{t}``. Bronze table ``t`` lives at
``{bronze}/{t}`` (written by ``ingest``, or plain Parquet, optionally partitioned by ``_sync_date``); output ``o`` at ``{silver}/{o}`` (a versioned table). Outputs run
on ``--threads`` concurrent driver threads (default 4), each as its own Spark jobs.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys
import uuid

from tidemark.operators.quality import enforce, freshness, newest_day, run_checks, run_fk_checks
from tidemark.plans.models import MODEL_THREADS, run_model, run_outputs, run_snapshot
from tidemark.session import build_session
from tidemark.sources.bronze import ALLOW_ALL, ALLOW_COLUMNS, scan
from tidemark.sources.ingest import CURSOR, admitted, ingest_source
from tidemark.sources.tables import VersionedTable
from tidemark.specs import FOREIGN_KEYS, MODELS, SNAPSHOTS, SOURCES


def _bronze(spark, root: str, source: str):
    """Ingested bronze, or plain Parquet read with the declared schema (and its day column, if landed by day)."""
    table = _table(spark, root, source)
    if table.current_version() is not None:
        return table.read()
    return scan(spark, table.path, SOURCES[source].schema_ddl)


def _table(spark, root: str, name: str) -> VersionedTable:
    return VersionedTable(spark, f"{root.rstrip('/')}/{name}")


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tidemark")
    ap.add_argument("command", choices=["ingest", "run", "snapshot", "test", "freshness"])
    ap.add_argument("--landing")
    ap.add_argument("--schema-policy", choices=[ALLOW_ALL, ALLOW_COLUMNS], default=ALLOW_ALL,
                    help="new tables flow, or only the declared ones (new columns always flow)")
    ap.add_argument("--bronze")
    ap.add_argument("--silver")
    ap.add_argument("--select", nargs="*")
    ap.add_argument("--scratch", help="folder shared by the driver and all executors (spark.checkpoint.dir)")
    ap.add_argument("--now", help="run clock (default: current UTC time)")
    ap.add_argument("--threads", type=int, default=MODEL_THREADS)
    ap.add_argument("--master", default=None, help="default: as set by spark-submit, else local")
    ap.add_argument("--shuffle-partitions", type=int, default=200)
    args = ap.parse_args(argv)

    spark = build_session(master=args.master, shuffle_partitions=args.shuffle_partitions,
                          extra={"spark.checkpoint.dir": args.scratch} if args.scratch else None)
    now = dt.datetime.fromisoformat(args.now) if args.now else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    run_id = uuid.uuid4().hex
    chosen = set(args.select or [])

    def wanted(names):
        return [n for n in names if not chosen or n in chosen]

    if args.command == "ingest":
        jobs = {n: (lambda n=n: ingest_source(spark, n, f"{args.landing.rstrip('/')}/{n}", _table(spark, args.bronze, n), now, run_id))
                for n in wanted(admitted(spark, args.landing, SOURCES, args.schema_policy))}
        out = run_outputs(jobs, args.threads)
    elif args.command == "run":
        jobs = {n: (lambda n=n: run_model(MODELS[n], _bronze(spark, args.bronze, MODELS[n].source),
                                          _table(spark, args.silver, n), now, run_id))
                for n in wanted(MODELS)}
        out = run_outputs(jobs, args.threads)
    elif args.command == "snapshot":
        jobs = {n: (lambda n=n: run_snapshot(SNAPSHOTS[n], _bronze(spark, args.bronze, SNAPSHOTS[n].source),
                                             _table(spark, args.silver, n), now, run_id))
                for n in wanted(SNAPSHOTS)}
        out = run_outputs(jobs, args.threads)
    elif args.command == "test":
        names = wanted({**MODELS, **SNAPSHOTS})
        fks = [fk for fk in FOREIGN_KEYS if fk.child in names]
        tables = {n: _table(spark, args.silver, n).read() for n in {*names, *(fk.parent for fk in fks)}}
        absent = sorted(n for n, df in tables.items() if df is None)
        if absent:  # an output that was never built has not passed its checks
            print(json.dumps({"status": "error", "detail": f"outputs not built: {', '.join(absent)}"}))
            return 1
        parts = [run_checks(n, tables[n], (MODELS.get(n) or SNAPSHOTS[n]).checks) for n in names]
        if fks:
            parts.append(run_fk_checks(tables, fks))
        summary = parts[0]
        for p in parts[1:]:
            summary = summary.unionByName(p)
        try:
            out = enforce(summary)
        except Exception as e:  # error-severity failures: report and exit non-zero
            print(json.dumps({"status": "error", "detail": str(e)}))
            return 1
    else:
        rows = []
        for t, src in SOURCES.items():
            if chosen and t not in chosen:
                continue
            table = _table(spark, args.bronze, t)
            cursor = table.metrics().get(CURSOR)
            if cursor is not None:  # kept with the data: nothing is read
                df = spark.createDataFrame([(cursor,)], f"{src.loaded_at} timestamp_ntz")
            else:
                df = newest_day(_bronze(spark, args.bronze, t), src.loaded_at)
            rows += [r.asDict() for r in freshness(df, t, now, src.warn_hours, src.error_hours,
                                                   src.loaded_at).collect()]
        out = rows
        if any(r["status"] == "error" for r in rows):
            print(json.dumps(rows, default=str))
            return 1
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
