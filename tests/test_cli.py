"""The command line over landed bronze: run, snapshot, test, freshness."""

import os

from tidemark import cli
from tidemark.plans import airline
from tidemark.sources.tables import VersionedTable

SF = "/root/testdata/sf0.001"
SOURCES = ["flight_leg", "air_waybill", "work_order", "aircraft_fleet"]


def test_cli_end_to_end(spark, tmp_path, capsys):
    if not os.path.isdir(SF):
        return
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    for s in SOURCES:
        airline.bronze(spark, SF, s).write.parquet(f"{bronze}/{s}")
    now = "2001-11-05T00:00:00"
    assert cli.main(["run", "--bronze", bronze, "--silver", silver, "--now", now,
                     "--select", "flight_leg", "air_waybill", "work_order"]) == 0
    assert cli.main(["snapshot", "--bronze", bronze, "--silver", silver, "--now", now,
                     "--select", "aircraft_fleet_history"]) == 0
    for name in ("flight_leg", "air_waybill", "work_order", "aircraft_fleet_history"):
        assert VersionedTable(spark, f"{silver}/{name}").read().count() > 0
    # a second run is incremental (watermark from the commit) and publishes version 2
    assert cli.main(["run", "--bronze", bronze, "--silver", silver, "--now", now, "--select", "work_order"]) == 0
    assert VersionedTable(spark, f"{silver}/work_order").current_version() == 2
    capsys.readouterr()
    # outputs that were never built fail the run; the built ones pass by themselves
    assert cli.main(["test", "--silver", silver]) == 1
    assert "outputs not built: " in capsys.readouterr().out
    assert cli.main(["test", "--silver", silver, "--select", "aircraft_fleet_history"]) == 0
    assert "check_name" in capsys.readouterr().out
    # bronze synced years before 'now' is stale: freshness reports errors and exits non-zero
    assert cli.main(["freshness", "--bronze", bronze, "--now", now, "--select", *SOURCES]) == 1
