"""Data-quality, referential and freshness checks (survey Q1-Q12, J1-J3, A3).

Each ``check_*`` returns a DataFrame of violating rows: zero rows passes.
``run_checks`` evaluates a whole suite per table in as few passes as possible:
all row-level predicates (not-null, expression, regex, positive, email) become
conditional counters of ONE aggregation over the table; each uniqueness check is
a single grouped count with partial aggregation before the shuffle. Only the
one-row-per-check summary ever reaches the driver.

The same counters can be observed while a table is written (``check_counters``): ``gate``
then decides between write and publish, so the checks cost no scan of their own.
Uniqueness over a table in key ranges is kept up to date per range (``update_unique``).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions.cleanse import EMAIL_TEST_PATTERN, java_anchored, ts_lit
from tidemark.sources.bronze import SYNC_DATE
from tidemark.sources.ranges import KeyRanges, ranges_changed
from tidemark.sources.tables import RANGE, VersionedTable, stage
from tidemark.specs import Check, ForeignKey

SUMMARY_COLUMNS = ["table_name", "check_name", "severity", "failures", "status"]


# --- row-level predicates: TRUE marks a violation (NULL counts as pass) -------
def violation(check: Check) -> Column:
    c = F.col(check.columns[0])
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "expression":
        return F.coalesce(~F.expr(f"`{check.columns[0]}` {check.arg}"), F.lit(False))
    if check.kind == "regex":
        return F.coalesce(~c.rlike(java_anchored(check.arg)), F.lit(False))
    if check.kind == "positive":
        return F.coalesce(c <= 0, F.lit(False))
    if check.kind == "email":
        return F.coalesce(~c.rlike(java_anchored(check.arg or EMAIL_TEST_PATTERN)), F.lit(False))
    raise ValueError(f"{check.kind} is not a row-level check")


ROW_LEVEL = {"not_null", "expression", "regex", "positive", "email"}


# --- Q1-Q9 as violation DataFrames ---------------------------------------------
def check_unique(df: DataFrame, col: str) -> DataFrame:
    """Q1: values occurring more than once; NULL is ignored."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def check_unique_combination(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q4/A3: key tuples occurring more than once; NULLs group together."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1)


def check_rows(df: DataFrame, check: Check) -> DataFrame:
    """Q2/Q3/Q5/Q6/Q7: the rows violating a row-level check."""
    return df.filter(violation(check))


def check_column_type(df: DataFrame, col: str, expected: str) -> DataFrame:
    """Q8: one row (col, expected, actual) when the type differs, case-insensitively.

    The type comes from the schema, so no rows are read; an empty input passes.
    """
    actual = df.schema[col].dataType.simpleString()
    one = df.select(F.lit(col).alias("col"), F.lit(expected).alias("expected"),
                    F.lit(actual).alias("actual")).limit(1)
    return one.filter(F.lit(actual.upper() != expected.upper()))


def orphans(child: DataFrame, parent: DataFrame, child_cols: Sequence[str],
            parent_cols: Sequence[str] | None = None, parent_filter: Column | None = None) -> DataFrame:
    """Child rows whose first FK column is non-null and that have no parent.

    Only the first FK column must be non-null (a NULL second part is an orphan).
    A left-anti join: a duplicated parent key cannot multiply rows, so the parent keys
    need no distinct - which would also keep AQE from splitting a hot foreign key.
    Spark picks broadcast or shuffle from the sizes.
    """
    parent_cols = list(parent_cols or child_cols)
    p = parent if parent_filter is None else parent.filter(parent_filter)
    p = p.select(*[F.col(pc).alias(f"__p{i}") for i, pc in enumerate(parent_cols)])
    cond = [F.col(cc) == F.col(f"__p{i}") for i, cc in enumerate(child_cols)]
    return child.filter(F.col(child_cols[0]).isNotNull()).join(p, cond, "left_anti")


# --- Q10 freshness ---------------------------------------------------------------
def freshness(df: DataFrame, source: str, now, warn_hours: int, error_hours: int,
              loaded_at: str = "_synced") -> DataFrame:
    """One row: latest load time, age in seconds, and pass / warn / error (empty table = error)."""
    latest = F.max(loaded_at)
    age = F.timestamp_diff("SECOND", latest, ts_lit(now))
    status = (F.when(latest.isNull(), "error")
              .when(age > error_hours * 3600, "error")
              .when(age > warn_hours * 3600, "warn")
              .otherwise("pass"))
    return df.agg(F.lit(source).alias("source"), latest.alias("max_loaded_at"),
                  age.alias("age_seconds"), status.alias("status"))


def newest_day(df: DataFrame, loaded_at: str = "_synced") -> DataFrame:
    """Landed bronze cut to the newest sync day: the latest ``loaded_at`` lies there, and no other folder is read.

    The day comes from the partition values alone (a scan of no columns). Rows without a sync time have no day.
    """
    if SYNC_DATE not in df.columns or loaded_at != "_synced":
        return df
    day = df.agg(F.max(SYNC_DATE)).first()[0]
    return df.filter(F.col(SYNC_DATE) == F.lit(day)) if day is not None else df


# --- Q11 suites with severity routing -------------------------------------------------
def _summary(table: str, name: str, severity: str, failures: Column) -> list[Column]:
    status = F.when(failures == 0, "pass").otherwise(F.lit(severity))
    return [F.lit(table).alias("table_name"), F.lit(name).alias("check_name"),
            F.lit(severity).alias("severity"), failures.cast("long").alias("failures"),
            status.alias("status")]


def run_checks(table: str, df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Summary rows (table_name, check_name, severity, failures, status) for one table."""
    parts: list[DataFrame] = []
    row_checks = [c for c in checks if c.kind in ROW_LEVEL]
    if row_checks:
        counters = [F.count_if(violation(c)).alias(f"f{i}") for i, c in enumerate(row_checks)]
        wide = df.agg(*counters)
        stack = ", ".join(f"{i}, f{i}" for i in range(len(row_checks)))
        long = wide.selectExpr(f"stack({len(row_checks)}, {stack}) AS (idx, failures)")
        names = F.create_map(*[x for i, c in enumerate(row_checks)
                               for x in (F.lit(i), F.struct(F.lit(c.name).alias("n"), F.lit(c.severity).alias("s")))])
        meta = names[F.col("idx")]
        parts.append(long.select(F.lit(table).alias("table_name"), meta["n"].alias("check_name"),
                                 meta["s"].alias("severity"), F.col("failures").cast("long").alias("failures"),
                                 F.when(F.col("failures") == 0, "pass").otherwise(meta["s"]).alias("status")))
    for c in checks:
        if c.kind == "unique":
            v = check_unique(df, c.columns[0])
        elif c.kind == "unique_combination":
            v = check_unique_combination(df, c.columns)
        elif c.kind == "column_type":
            v = check_column_type(df, c.columns[0], c.arg)
        else:
            continue
        parts.append(v.agg(*_summary(table, c.name, c.severity, F.count(F.lit(1)))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def check_counters(checks: Sequence[Check]) -> dict[str, Column]:
    """Violations of the row-level checks as aggregates to observe, by check name."""
    return {f"check_{c.name}": F.count_if(violation(c)) for c in checks if c.kind in ROW_LEVEL}


def gate(table: str, checks: Sequence[Check], found: dict) -> None:
    """Raises if a check of error severity among the observed counters failed."""
    bad = [f"{table}.{c.name}: {found[f'check_{c.name}']}" for c in checks
           if c.kind in ROW_LEVEL and c.severity == "error" and found[f"check_{c.name}"]]
    if bad:
        raise CheckFailed("; ".join(bad))


def run_checks_once(table: str, df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """``run_checks`` for an input that is dear to compute: it is run once.

    Its row-level violations are observed while the columns of the uniqueness checks are staged; those checks
    read the staged columns.
    """
    wide = check_counters(checks)
    held = sorted({c for k in checks if k.kind not in ROW_LEVEL for c in k.columns})
    obs = Observation(f"checks-{uuid.uuid4().hex[:12]}")
    counted = df.observe(obs, F.count(F.lit(1)).alias("rows"), *[e.alias(n) for n, e in wide.items()])
    keys = stage(counted.select(*held), f"{table}-checks") if held else None
    if keys is None:
        counted.write.format("noop").mode("overwrite").save()
    found = obs.get
    rows = [(table, c.name, c.severity, found[f"check_{c.name}"], c.severity if found[f"check_{c.name}"] else "pass")
            for c in checks if c.kind in ROW_LEVEL]
    summary = df.sparkSession.createDataFrame(rows, "table_name string, check_name string, severity string, failures long, status string")
    others = [c for c in checks if c.kind not in ROW_LEVEL]
    return summary.unionByName(run_checks(table, keys, others)) if others else summary


def update_unique(table: VersionedTable, state: VersionedTable, cols: Sequence[str]) -> DataFrame:
    """Q4 kept up to date: the violations of ``check_unique_combination`` over a table in key ranges.

    ``cols`` begin with the table's range key, so a duplicated tuple lies in one range. ``state`` holds the
    violations per range and the version they were counted at; only ranges rewritten since are read again.
    """
    cols = list(cols)
    current, done = table.current_version(), state.current_version()
    info = table.commit_info(current)
    ranges = KeyRanges.load(info["ranges"])
    if ranges.key != cols[0]:
        raise ValueError(f"uniqueness by range needs {ranges.key} as first column")
    counted = state.commit_info(done)["counted"] if done else None
    if counted != current:
        # a version that vacuum removed cannot be compared with: everything is counted again
        since = counted if counted in table.versions() else None
        changed = ranges_changed(table, since)
        gone = changed if since else None
        found = check_unique_combination(table.read(current, changed), cols).withColumn(RANGE, ranges.column())
        live = {p.rsplit("=", 1)[1] for p in table.parts()}
        keep = [] if gone is None else [p for p in state.parts_without(gone) if p.rsplit("=", 1)[1] in live]
        state.commit(found.hint("rebalance", RANGE), partition_by=[RANGE], keep=keep, base=done or 0, extra={"counted": current})
    return state.read()


def run_fk_checks(tables: dict[str, DataFrame], fks: Sequence[ForeignKey]) -> DataFrame:
    parts = []
    for fk in fks:
        pf = F.col("is_current") if fk.parent_current_only else None
        v = orphans(tables[fk.child], tables[fk.parent], fk.child_cols, fk.parent_cols, pf)
        parts.append(v.agg(*_summary(fk.child, fk.name, fk.severity, F.count(F.lit(1)))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class CheckFailed(RuntimeError):
    pass


def enforce(summary: DataFrame) -> list[dict]:
    """Severity routing: collect the (small) summary; raise if any error-severity check failed."""
    rows = [r.asDict() for r in summary.collect()]
    errors = [r for r in rows if r["status"] == "error"]
    if errors:
        raise CheckFailed("; ".join(f"{r['table_name']}.{r['check_name']}: {r['failures']}" for r in errors))
    return rows
