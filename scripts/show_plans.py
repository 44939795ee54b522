"""Print the formatted physical plans of the headline operators (dedup, both merge shapes,
history run, change apply, FK check) over a driver scale factor.

usage: python scripts/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from tidemark.functions.cleanse import active  # noqa: E402
from tidemark.operators.dedup import latest_per_key  # noqa: E402
from tidemark.operators.merge import merge_upsert  # noqa: E402
from tidemark.operators.quality import orphans  # noqa: E402
from tidemark.operators.scd2 import scd2_apply  # noqa: E402
from tidemark.plans import views  # noqa: E402
from tidemark.plans.models import refine  # noqa: E402
from tidemark.plans.queries import COUPON_NOW, COUPON_SPEC, DIFF_COMPARE, DIFF_KEYS, RUN_1, state_feed  # noqa: E402
from tidemark.session import build_session, scratch_path  # noqa: E402
from tidemark.sources.changes import apply_changes  # noqa: E402
from tidemark.sources.tables import VersionedTable, stage  # noqa: E402


def show(title, df):
    print("=" * 30, title)
    df.explain("formatted")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    bronze = views.b_coupon(spark, sf)
    silver = refine(COUPON_SPEC, bronze, COUPON_NOW, RUN_1)
    show("latest per key (refine)", silver)

    target = stage(silver, "plans-target")
    batch = stage(refine(COUPON_SPEC, bronze.filter(F.col("_synced") >= "2001-06-01"), COUPON_NOW, "r2"), "b")
    show("merge, broadcast shape", merge_upsert(target, batch, COUPON_SPEC.keys, strategy="lookup"))
    show("merge, shuffle shape", merge_upsert(target, batch, COUPON_SPEC.keys, strategy="shuffle"))

    cols = list(DIFF_KEYS) + list(DIFF_COMPARE) + ["_synced", "_deleted"]
    state = active(latest_per_key(bronze, DIFF_KEYS, "_synced", views.COUPON_TIEBREAK)).select(*cols)
    hist = VersionedTable(spark, scratch_path(spark, "plans-history"))
    hist.commit_history(scd2_apply(None, stage(state, "s"), DIFF_KEYS, "2001-01-01"))
    show("history run (append-only)", scd2_apply(hist.read(), state, DIFF_KEYS, "2002-01-01", include_closed=False))

    feed = state_feed(views.b_state(spark, sf))
    show("change apply, broadcast shape",
         apply_changes(stage(apply_changes(None, feed, ["user_id"]), "b0"), feed, ["user_id"], strategy="lookup"))

    li = views.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    show("FK orphans", orphans(li, views.table(spark, sf, "orders"), ["l_orderkey"], ["o_orderkey"]))
    spark.stop()


if __name__ == "__main__":
    main()
