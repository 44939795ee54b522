"""Declarative specs: sources, the 10 keyed (SCD1) outputs, the 3 history (SCD2) outputs, checks.

Specs hold only plain Python values (names, kinds, literals) so they can be
built without a Spark session; ``tidemark.plans.models`` turns them into plans.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from tidemark.functions.governance import PASSENGER_TAGS

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results)
# ---------------------------------------------------------------------------
# Freshness limits in hours (warn, error) per source domain.
FRESH_FAST = (1, 4)      # flight operations, reservations, finance
FRESH_DAILY = (26, 30)   # cargo, maintenance, reference data
# Sync interval in minutes per source domain.
SYNC_MINUTES = {"flight_ops": 5, "reservations": 15, "finance": 15,
                "cargo": 1440, "maintenance": 1440, "reference": 1440}


@dataclass(frozen=True)
class Col:
    """One output column: ``kind`` is keep | varchar | date | ts | dec | net."""
    name: str
    kind: str = "keep"
    src: str | None = None          # source column when renamed
    args: tuple = ()                # extra inputs (net: total, deduction)


@dataclass(frozen=True)
class Check:
    """A declared data test. ``kind``: unique | not_null | expression | unique_combination | regex
    | positive | email | column_type."""
    kind: str
    columns: tuple[str, ...]
    severity: str = "error"
    arg: str | None = None           # expression tail ('> 0'), regex, or expected type

    @property
    def name(self) -> str:
        tail = f"_{self.arg}" if self.arg and self.kind in ("expression",) else ""
        return f"{self.kind}_{'_'.join(self.columns)}{tail}".replace(" ", "")


@dataclass(frozen=True)
class ForeignKey:
    """Child rows whose non-null first key column has no parent row (optionally parent current only)."""
    name: str
    child: str
    parent: str
    child_cols: tuple[str, ...]
    parent_cols: tuple[str, ...]
    parent_current_only: bool = False
    severity: str = "error"


_FIELD = re.compile(r"(\w+)\s+([A-Za-z_]+(?:\(\d+\s*,\s*\d+\))?)")


def ddl_fields(ddl: str) -> list[tuple[str, str]]:
    """(name, lower-case Spark type) pairs of a flat ``name TYPE, ...`` schema string."""
    return [(m.group(1), m.group(2).lower().replace(" ", "")) for m in _FIELD.finditer(ddl)]


@dataclass(frozen=True)
class SourceSpec:
    domain: str
    table: str
    schema_ddl: str
    method: str                      # change_feed | api_delta | file_drop | snapshot_diff
    warn_hours: int
    error_hours: int
    loaded_at: str = "_synced"


@dataclass(frozen=True)
class TableSpec:
    """A keyed incremental (SCD1) output."""
    name: str
    source: str
    keys: tuple[str, ...]
    columns: tuple[Col, ...]
    include: dict = field(default_factory=dict)   # column -> allowed values (NULL drops)
    exclude: dict = field(default_factory=dict)   # column -> excluded values (NULL drops)
    dev_date_col: str | None = None
    tiebreak: tuple[str, ...] = ()
    keep_on_update: tuple[str, ...] = ("_silver_load_timestamp",)
    allow_full_refresh: bool = False
    checks: tuple[Check, ...] = ()
    pii_tags: dict = field(default_factory=dict)  # column -> PII tag, kept with every committed version

    @property
    def source_columns(self) -> list[str]:
        cols: list[str] = []
        for c in self.columns:
            for s in ((c.src or c.name),) if c.kind != "net" else c.args:
                if s not in cols:
                    cols.append(s)
        for extra in list(self.include) + list(self.exclude):
            if extra not in cols:
                cols.append(extra)
        return cols


@dataclass(frozen=True)
class SnapshotSpec:
    """A history (SCD2, timestamp strategy, tombstones for hard deletes) output."""
    name: str
    source: str
    keys: tuple[str, ...]            # columns forming the business key
    payload: tuple[str, ...]
    updated_at: str = "_synced"
    checks: tuple[Check, ...] = ()


# ---------------------------------------------------------------------------
# The 13 bronze tables with their names, columns, capture methods and limits. Types are inferred
# from use (see FIXTURES.md).
# ---------------------------------------------------------------------------
_SYS = "_synced TIMESTAMP_NTZ, _deleted BOOLEAN"

SOURCES: dict[str, SourceSpec] = {s.table: s for s in [
    SourceSpec("flight_ops", "flight_leg",
               "flight_id STRING, flight_number INT, flight_date STRING, service_type STRING, origin STRING, "
               "destination STRING, scheduled_dep STRING, scheduled_arr STRING, actual_dep STRING, "
               "actual_arr STRING, aircraft_reg STRING, aircraft_type STRING, block_hours STRING, "
               "flight_hours STRING, distance_km INT, seat_capacity INT, pax_booked INT, pax_boarded INT, "
               "load_factor DECIMAL(5,4), cargo_capacity_kg DECIMAL(12,2), cargo_booked_kg DECIMAL(12,2), "
               "cargo_loaded_kg DECIMAL(12,2), flight_status STRING, cancelled_flag STRING, "
               "diverted_flag STRING, " + _SYS, "change_feed", *FRESH_FAST),
    SourceSpec("flight_ops", "crew_assignment",
               "assignment_id STRING, flight_id STRING, employee_id STRING, crew_role STRING, "
               "crew_type STRING, duty_start STRING, duty_end STRING, block_hours STRING, "
               "hourly_rate DECIMAL(18,2), crew_cost DECIMAL(18,2), overtime_flag STRING, "
               "overtime_hours DECIMAL(10,2), per_diem DECIMAL(18,2), base_station STRING, " + _SYS,
               "snapshot_diff", *FRESH_FAST),
    SourceSpec("reservations", "ticket_coupon",
               "ticket_number STRING, coupon_number INT, pnr_locator STRING, pax_id STRING, "
               "flight_number STRING, flight_date STRING, total_amount DECIMAL(18,2), "
               "commission_amount DECIMAL(18,2), ticket_status STRING, exchange_ticket STRING, " + _SYS,
               "api_delta", *FRESH_FAST),
    SourceSpec("reservations", "passenger_name_record",
               "pnr_locator STRING, pax_id STRING, pax_first_name STRING, pax_last_name STRING, "
               "passport_number STRING, date_of_birth STRING, " + _SYS, "api_delta", *FRESH_FAST),
    SourceSpec("reservations", "reservation_pnr",
               "pnr_locator STRING, creation_date STRING, booking_channel STRING, " + _SYS,
               "api_delta", *FRESH_FAST),
    SourceSpec("cargo", "air_waybill",
               "awb_number STRING, flight_id STRING, fjd_amount DECIMAL(18,2), status STRING, "
               "chargeable_weight_kg DECIMAL(12,2), " + _SYS, "file_drop", *FRESH_DAILY),
    SourceSpec("finance", "gl_journal_entry",
               "journal_id STRING, gl_account_code STRING, base_amount DECIMAL(18,2), flight_id STRING, "
               "approved_flag STRING, " + _SYS, "change_feed", *FRESH_FAST),
    SourceSpec("finance", "fuel_invoice",
               "invoice_id STRING, flight_id STRING, fjd_amount DECIMAL(18,2), "
               "quantity_liters DECIMAL(18,2), " + _SYS, "change_feed", *FRESH_FAST),
    SourceSpec("finance", "flight_cost_allocation",
               "allocation_id STRING, flight_id STRING, cost_category STRING, amount DECIMAL(18,2), "
               "approved_flag STRING, " + _SYS, "change_feed", *FRESH_FAST),
    SourceSpec("maintenance", "work_order",
               "wo_number STRING, aircraft_reg STRING, total_cost DECIMAL(18,2), " + _SYS,
               "snapshot_diff", *FRESH_DAILY),
    SourceSpec("maintenance", "aircraft_fleet",
               "aircraft_reg STRING, aircraft_type STRING, fuel_burn_rate DECIMAL(18,4), "
               "maint_reserve_rate DECIMAL(18,4), " + _SYS, "snapshot_diff", *FRESH_DAILY),
    SourceSpec("reference", "aircraft_cost_rate",
               "aircraft_type STRING, effective_date DATE, crew_cost_per_hour DECIMAL(18,2), "
               "maint_reserve_per_hour DECIMAL(18,2), " + _SYS, "snapshot_diff", *FRESH_DAILY),
    SourceSpec("reference", "airport_fees",
               "airport_code STRING, aircraft_type STRING, effective_date DATE, landing_fee DECIMAL(18,2), "
               + _SYS, "snapshot_diff", *FRESH_DAILY),
]}


def _keep(*names: str) -> tuple[Col, ...]:
    return tuple(Col(n) for n in names)


E, W = "error", "warn"

# ---------------------------------------------------------------------------
# The 10 keyed outputs (M1-M10) with their keys, columns, filters and checks
# ---------------------------------------------------------------------------
MODELS: dict[str, TableSpec] = {m.name: m for m in [
    TableSpec(
        "flight_leg", "flight_leg", ("flight_id",),
        (Col("flight_id"), Col("flight_number", "varchar"), Col("flight_date", "date"))
        + _keep("service_type", "origin", "destination")
        + tuple(Col(c, "ts") for c in ("scheduled_dep", "scheduled_arr", "actual_dep", "actual_arr"))
        + _keep("aircraft_reg", "aircraft_type")
        + (Col("block_hours", "dec"), Col("flight_hours", "dec"))
        + _keep("distance_km", "seat_capacity", "pax_booked", "pax_boarded", "load_factor",
                "cargo_capacity_kg", "cargo_booked_kg", "cargo_loaded_kg", "flight_status",
                "cancelled_flag", "diverted_flag"),
        dev_date_col="flight_date",
        checks=(Check("unique", ("flight_id",)), Check("not_null", ("flight_id",)),
                Check("expression", ("block_hours",), W, "> 0"), Check("not_null", ("flight_date",))),
    ),
    TableSpec(
        "crew_assignment", "crew_assignment", ("assignment_id",),
        _keep("assignment_id", "flight_id", "employee_id", "crew_role", "crew_type")
        + (Col("duty_start", "ts"), Col("duty_end", "ts"), Col("block_hours", "dec"))
        + _keep("hourly_rate", "crew_cost", "overtime_flag", "overtime_hours", "per_diem", "base_station"),
        checks=(Check("unique", ("assignment_id",)), Check("not_null", ("assignment_id",)),
                Check("not_null", ("flight_id",))),
    ),
    TableSpec(
        "ticket_coupon", "ticket_coupon", ("ticket_number", "coupon_number"),
        _keep("ticket_number", "coupon_number", "pnr_locator", "pax_id", "flight_number")
        + (Col("flight_date", "date"), Col("total_amount"), Col("commission_amount"),
           Col("net_passenger_revenue", "net", args=("total_amount", "commission_amount")),
           Col("ticket_status"), Col("exchange_ticket")),
        include={"ticket_status": ("FLOWN",)},
        exclude={"ticket_status": ("VOID", "REFUNDED")},
        dev_date_col="flight_date",
        checks=(Check("not_null", ("ticket_number",)), Check("expression", ("total_amount",), E, "> 0"),
                Check("unique_combination", ("ticket_number", "coupon_number"))),
    ),
    TableSpec(
        "passenger_name_record", "passenger_name_record", ("pnr_locator", "pax_id"),
        _keep("pnr_locator", "pax_id", "pax_first_name", "pax_last_name", "passport_number")
        + (Col("date_of_birth", "date"),),
        checks=(Check("not_null", ("pnr_locator",)),
                Check("regex", ("passport_number",), W, r"^[A-Z0-9]+$"),
                Check("unique_combination", ("pnr_locator", "pax_id"))),
        pii_tags=PASSENGER_TAGS,
    ),
    TableSpec(
        "reservation_pnr", "reservation_pnr", ("pnr_locator",),
        (Col("pnr_locator"), Col("creation_date", "date"), Col("booking_channel")),
        checks=(Check("unique", ("pnr_locator",)), Check("not_null", ("pnr_locator",))),
    ),
    TableSpec(
        "air_waybill", "air_waybill", ("awb_number",),
        (Col("awb_number"), Col("flight_id"), Col("cargo_revenue", src="fjd_amount"), Col("status"),
         Col("chargeable_weight_kg")),
        exclude={"status": ("CANCELLED",)},
        checks=(Check("unique", ("awb_number",)), Check("not_null", ("awb_number",)),
                Check("expression", ("cargo_revenue",), E, "> 0"), Check("not_null", ("flight_id",), W)),
    ),
    TableSpec(
        "gl_journal_entry", "gl_journal_entry", ("journal_id",),
        _keep("journal_id", "gl_account_code", "base_amount", "flight_id", "approved_flag"),
        include={"approved_flag": ("Y",)},
        checks=(Check("unique", ("journal_id",)), Check("not_null", ("journal_id",)),
                Check("not_null", ("flight_id",), W)),
    ),
    TableSpec(
        "fuel_invoice", "fuel_invoice", ("invoice_id",),
        _keep("invoice_id", "flight_id", "fjd_amount", "quantity_liters"),
        checks=(Check("unique", ("invoice_id",)), Check("not_null", ("invoice_id",)),
                Check("expression", ("fjd_amount",), E, "> 0"), Check("not_null", ("flight_id",))),
    ),
    TableSpec(
        "flight_cost_allocation", "flight_cost_allocation", ("allocation_id",),
        _keep("allocation_id", "flight_id", "cost_category", "amount", "approved_flag"),
        include={"approved_flag": ("Y",)},
        checks=(Check("unique", ("allocation_id",)), Check("not_null", ("allocation_id",))),
    ),
    TableSpec(
        "work_order", "work_order", ("wo_number",),
        _keep("wo_number", "aircraft_reg", "total_cost"),
        checks=(Check("unique", ("wo_number",)), Check("not_null", ("wo_number",)),
                Check("not_null", ("aircraft_reg",))),
    ),
]}

# ---------------------------------------------------------------------------
# The 3 history outputs (M11-M13) with their keys, payloads and checks
# ---------------------------------------------------------------------------
SNAPSHOTS: dict[str, SnapshotSpec] = {s.name: s for s in [
    SnapshotSpec(
        "aircraft_fleet_history", "aircraft_fleet", ("aircraft_reg",),
        ("aircraft_reg", "aircraft_type", "fuel_burn_rate", "maint_reserve_rate"),
        checks=(Check("unique", ("scd_id",)), Check("not_null", ("scd_id",)),
                Check("not_null", ("aircraft_reg",)), Check("not_null", ("valid_from",))),
    ),
    SnapshotSpec(
        "aircraft_cost_rate_history", "aircraft_cost_rate", ("aircraft_type", "effective_date"),
        ("aircraft_type", "effective_date", "crew_cost_per_hour", "maint_reserve_per_hour"),
        checks=(Check("unique", ("scd_id",)), Check("not_null", ("scd_id",)),
                Check("not_null", ("aircraft_type",))),
    ),
    SnapshotSpec(
        "airport_fees_history", "airport_fees", ("airport_code", "aircraft_type", "effective_date"),
        ("airport_code", "aircraft_type", "effective_date", "landing_fee"),
        checks=(Check("unique", ("scd_id",)), Check("not_null", ("scd_id",)),
                Check("not_null", ("airport_code",)), Check("not_null", ("effective_date",)),
                Check("expression", ("landing_fee",), W, ">= 0")),
    ),
]}

# ---------------------------------------------------------------------------
# The referential assertions (5)
# ---------------------------------------------------------------------------
FOREIGN_KEYS: tuple[ForeignKey, ...] = (
    ForeignKey("air_waybill_fk_valid", "air_waybill", "flight_leg", ("flight_id",), ("flight_id",)),
    ForeignKey("crew_assignment_fk_valid", "crew_assignment", "flight_leg", ("flight_id",), ("flight_id",)),
    ForeignKey("fuel_invoice_fk_valid", "fuel_invoice", "flight_leg", ("flight_id",), ("flight_id",)),
    ForeignKey("ticket_coupon_fk_valid", "ticket_coupon", "flight_leg",
               ("flight_number", "flight_date"), ("flight_number", "flight_date")),
    ForeignKey("work_order_fk_valid", "work_order", "aircraft_fleet_history", ("aircraft_reg",),
               ("aircraft_reg",), parent_current_only=True),
)
