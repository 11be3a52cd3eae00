"""Print the physical plans of the headline operators (markdown) to stdout.

    python scripts/explain_plans.py /root/testdata/sf0.1 > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from unilake.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16)
    from unilake.operators import quality
    from unilake.operators.change_set import change_set
    from unilake.plans import build
    from unilake.plans.models import INT_UNIFIED_ACTIVITY
    from unilake.plans.queries import activity_snapshots

    act = build.unified_from_tables(spark, sf_dir, "int_unified_activity", loaded_at=False)
    vals = act.select(F.col("activity_sk").alias("v")).where(F.col("v").isNotNull())
    old, new = activity_snapshots(spark, sf_dir)
    compare = [c for c in new.columns if c not in ("activity_sk", "source_system")]
    plans = {
        "unified_activity (3 sources, no Exchange)": act,
        "filter on the source tag (other branches pruned, 2 columns read)":
            act.where(F.col("source_system") == "events").select("activity_sk", "amount"),
        "row checks of a model (one partial aggregate, one tiny final merge)":
            quality.row_checks(act, INT_UNIFIED_ACTIVITY.name, INT_UNIFIED_ACTIVITY.tests),
        "unique check, phase 1 (8-byte hash + count shuffled, map-side partial count)":
            vals.select(F.xxhash64("v").alias("h")).groupBy("h").count().where("count > 1"),
        "unique check, phase 2 (only if a hash repeats: one full shuffle, partial counts)":
            vals.groupBy("v").count().where("count > 1"),
        "change set (one hash shuffle of key + row hash; no join)":
            change_set(old, new, ["source_system", "activity_sk"], compare),
    }
    print(f"# Physical plans ({sf_dir}, local[8])\n")
    print("Generated by `scripts/explain_plans.py`.\n")
    for title, df in plans.items():
        print(f"## {title}\n\n```")
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        print(buf.getvalue().strip())
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
