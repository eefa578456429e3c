"""Print the physical plans of the main pipeline steps (for plan review).

Usage: python tools/show_plans.py [sf_dir] [formatted|simple]
"""

from __future__ import annotations

import os
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gustolake.operators import base, metrics, serving  # noqa: E402
from gustolake.plans import gold, silver  # noqa: E402
from gustolake.session import build_session, scratch_dir  # noqa: E402
from gustolake.sources import fixtures as FX  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    mode = sys.argv[2] if len(sys.argv) > 2 else "simple"
    spark = build_session("local[8]", shuffle_partitions=16, extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    root = scratch_dir(spark, f"plans-{uuid.uuid4().hex[:8]}")
    sv = silver.read(spark, silver.write(silver.build(FX.source_tables(spark, sf)), f"{root}/silver"))
    g = gold.build(sv, FX.AS_OF, stage=gold.path_stage(spark, f"{root}/stage"))
    steps = {
        "silver order_items (typed, key filter, dedup)": silver.order_items(FX.order_items(spark, sf)),
        "order base from silver": base.build(sv),
        "customer aggregate (fused CLV/RFM/churn)": metrics.customer_base(g.orders, FX.AS_OF),
        "thresholds (exact, one pass)": metrics.thresholds(g.customers),
        "sales trends": metrics.sales_trends(g.orders, sv["order_items"], sv["date_dim"]),
        "location performance (distributed rank)": metrics.location(g.orders, FX.AS_OF),
        "top-15 categories": serving.top_categories(g),
    }
    for title, df in steps.items():
        print(f"\n### {title}\n")
        df.explain(mode)


if __name__ == "__main__":
    main()
