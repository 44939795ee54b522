"""Row filters and typed column helpers (survey F1-F9, X1-X16).

All helpers return Catalyst ``Column`` expressions, so they stay inside
whole-stage codegen and filters push into the Parquet scan where possible.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results)
# ---------------------------------------------------------------------------
# Late-data lookback in days, floor for the high-water mark, dev window in days.
LOOKBACK_DAYS = 3
MIN_DATE = "2000-01-01"
DEV_DAYS = 90
# Open-ended validity sentinel of a current history row.
VALID_TO_SENTINEL = "9999-12-31"
# Email pattern of the generic email test (no apostrophe in the local part).
EMAIL_TEST_PATTERN = r"^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}$"
# Email pattern of the email-structure macro (apostrophe allowed in the local part).
EMAIL_MACRO_PATTERN = r"^[a-zA-Z0-9._%+'-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
# Upper-case alphanumeric code pattern (passport numbers).
UPPER_ALNUM_PATTERN = r"^[A-Z0-9]+$"

# ISO calendar date prefix; guards try_cast against Spark's lenient '2024' -> 2024-01-01.
_ISO_DATE = r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ts_text(v) -> str:
    """ISO text of a datetime/date/str, microsecond precision, no zone."""
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ", timespec="microseconds")
    if isinstance(v, dt.date):
        return f"{v.isoformat()} 00:00:00"
    return str(v)


def ts_lit(v) -> Column:
    """A wall-clock (TIMESTAMP_NTZ) literal; folds to a constant, so comparisons push down."""
    return F.lit(ts_text(v)).cast("timestamp_ntz")


def java_anchored(pattern: str) -> str:
    """Make ``^...$`` mean whole-string in Java regex (``$`` also accepts a trailing newline)."""
    p = pattern
    if p.startswith("^"):
        p = r"\A" + p[1:]
    if p.endswith("$") and not p.endswith(r"\$"):
        p = p[:-1] + r"\z"
    return p


# --- F1 active-record filter ------------------------------------------------
def is_active(deleted: str | Column = "_deleted") -> Column:
    """``deleted = FALSE OR deleted IS NULL``."""
    return ~F.coalesce(_c(deleted), F.lit(False))


def active(df: DataFrame, deleted: str = "_deleted") -> DataFrame:
    return df.filter(is_active(deleted))


# --- F2-F4 business filters -------------------------------------------------
def flag_is(col: str | Column, value: str = "Y") -> Column:
    """Equality filter; NULL drops the row (3-valued logic)."""
    return _c(col) == F.lit(value)


def status_filter(col: str | Column, include: Iterable[str] | None = None,
                  exclude: Iterable[str] | None = None) -> Column:
    """``col IN include AND col NOT IN exclude``; NULL status drops in both forms."""
    c = _c(col)
    cond = F.lit(True)
    if include is not None:
        cond = cond & c.isin(list(include))
    if exclude is not None:
        cond = cond & ~c.isin(list(exclude))
    return cond


# --- X1-X5 casts ------------------------------------------------------------
def try_to_date(col: str | Column) -> Column:
    """NULL unless the text starts with an ISO date that exists on the calendar."""
    c = _c(col).cast("string")
    return F.when(c.rlike(_ISO_DATE), c.try_cast("date"))


def try_to_timestamp_ntz(col: str | Column) -> Column:
    """Wall-clock timestamp; an offset in the text is discarded, bad text gives NULL."""
    return _c(col).cast("string").try_cast("timestamp_ntz")


def to_decimal(col: str | Column, precision: int = 10, scale: int = 2) -> Column:
    """Strict cast (HALF_UP); invalid or overflowing input raises under ANSI mode."""
    return _c(col).cast(f"decimal({precision},{scale})")


def to_varchar(col: str | Column) -> Column:
    return _c(col).cast("string")


def date_text(col: str | Column) -> Column:
    """``TO_VARCHAR(date)`` as ``yyyy-MM-dd``."""
    return F.date_format(_c(col), "yyyy-MM-dd")


# --- F7 derived measure -----------------------------------------------------
def net_amount(total: str | Column, deduction: str | Column) -> Column:
    """``total - COALESCE(deduction, 0)``; a NULL total stays NULL."""
    return _c(total) - F.coalesce(_c(deduction), F.lit(0))


# --- K5 composite business key ------------------------------------------------
def composite_key(*parts: str | Column, sep: str = "-") -> Column:
    """``a || '-' || b ...``: NULL in any part makes the key NULL (unlike concat_ws)."""
    cols: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit(sep))
        cols.append(_c(p).cast("string"))
    return F.concat(*cols)


# --- F8 audit columns -------------------------------------------------------
AUDIT_COLUMNS = ["_bronze_sync_timestamp", "_silver_load_timestamp", "_run_id", "_is_deleted"]


def audit_columns(now, run_id: str, synced: str = "_synced", deleted: str = "_deleted") -> list[Column]:
    return [
        F.col(synced).alias("_bronze_sync_timestamp"),
        ts_lit(now).alias("_silver_load_timestamp"),
        F.lit(run_id).alias("_run_id"),
        F.col(deleted).alias("_is_deleted"),
    ]


# --- X7 / S4 dev date limiter -------------------------------------------------
def within_days(col: str | Column, days: int, today) -> Column:
    """``try_to_date(col) >= today - days``; unparseable dates drop out."""
    return try_to_date(col) >= F.date_sub(F.lit(today).cast("date"), days)


# --- X12 / X13 email validation ---------------------------------------------
def email_structure_valid(col: str | Column) -> Column:
    """Macro form: TRUE on match, FALSE otherwise (NULL -> FALSE)."""
    return F.coalesce(_c(col).rlike(java_anchored(EMAIL_MACRO_PATTERN)), F.lit(False))


def email_test_valid(col: str | Column) -> Column:
    """Generic-test form: NULL passes (returns NULL), otherwise the match result."""
    return _c(col).rlike(java_anchored(EMAIL_TEST_PATTERN))
