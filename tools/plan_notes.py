"""Write PLANS.md: physical plans of the headline work (sf0.1).

usage: python tools/plan_notes.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from quarry.operators import nearest as N  # noqa: E402
from quarry.plans import gold  # noqa: E402
from quarry.queries import silver_quakes, silver_rigs  # noqa: E402
from quarry.session import build_session  # noqa: E402
from quarry.sources import adapters as A  # noqa: E402


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree = text.split("\n\n\n")[0]
    details = []
    for block in text.split("\n\n")[1:]:
        block = block.strip()
        if block.startswith("(") and "Scan parquet" in block.splitlines()[0]:
            keep = [ln for ln in block.splitlines() if ln.startswith(("(", "PushedFilters", "ReadSchema"))]
            details.append("\n".join(keep))
    return tree.strip() + ("\n\n" + "\n\n".join(details) if details else "")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16)
    rigs, quakes = silver_rigs(spark, sf_dir), silver_quakes(spark, sf_dir)
    sections = []
    weekly = gold.weekly_activity(rigs, quakes)
    per_state = weekly.groupBy("state").agg(F.sum("total_rigs").alias("total_rigs_count"))
    sections.append(("Flagship before the rank: weekly rigs ⋈ weekly events, per state", per_state))
    per_county = rigs.where(F.col("state_or_province").isNotNull()).groupBy(
        F.col("state_or_province").alias("state"), "county"
    ).agg(F.sum("rig_count").alias("total_rigs"), F.count_distinct("date").alias("active_days"))
    sections.append(("state_rig_count before the ranks", per_county))
    ev = A.raw_quakes(spark, sf_dir).select("id", "latitude", "longitude")
    pl = A.raw_counties(spark, sf_dir)
    located = N.attach_nearest(ev, pl, {"NAME": "county"}, place_id="OBJECTID", place_lat="LATITUDE", place_lon="LONGITUDE")
    sections.append(("Nearest place: events searched where they stand", located))
    sections.append(("Flagship with its rank and position", gold.gold_agg_rig_earthquake(rigs, quakes)))
    out = ["# Physical plans (generated by tools/plan_notes.py at " + os.path.basename(sf_dir) + ")", ""]
    for title, df in sections:
        out += [f"## {title}", "", "```", formatted(df), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write(re.sub(r"#\d+L?", "", "\n".join(out)))
    spark.stop()


if __name__ == "__main__":
    main()
