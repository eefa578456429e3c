"""Benchmark: the daily pipeline and the serving queries at one scale factor.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_MODE=naive for the comparison plan (no stage points, sequential writes).
Prints one JSON line: {"metric", "value", "unit", "queries": {...}, "sf"}.

Timed steps: ``bronze`` (derive sources from the test tables and ingest),
``silver`` (clean/dedup + partitioned write), ``gold`` (stage order base and
customer aggregate, publish 8 tables), then each serving query over the
published tables (collected). ``value`` is the sum of all steps.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gustolake.operators import serving  # noqa: E402
from gustolake.plans import bronze, gold, silver  # noqa: E402
from gustolake.session import build_session, scratch_dir  # noqa: E402
from gustolake.sources import fixtures as FX  # noqa: E402
from gustolake.sources import io  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(
        f"local[{cpus}]",
        app_name="gustolake-bench",
        shuffle_partitions=max(8, 2 * cpus),
        extra={"spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = scratch_dir(spark, f"bench-{uuid.uuid4().hex[:8]}")
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    as_of = FX.AS_OF
    sources = FX.source_tables(spark, sf_dir)
    bronze_paths = timed("bronze", lambda: bronze.run(spark, sources, f"{root}/bronze", as_of))
    raw = {n: bronze.read(spark, p, as_of) for n, p in bronze_paths.items()}
    silver_paths = timed("silver", lambda: silver.write(silver.build(raw), f"{root}/silver"))
    silver_tables = silver.read(spark, silver_paths)
    if os.environ.get("BENCH_MODE") == "naive":
        # comparison only: no stage points and one table after the other, so every
        # output recomputes the order base and the thresholds (the published job's plan)
        def naive():
            lazy = gold.build(silver_tables, as_of)
            for name in lazy:
                io.write_layer(lazy[name], f"{root}/gold/{name}")
            return {name: io.read_layer(spark, f"{root}/gold/{name}") for name in lazy}

        published = timed("gold", naive)
    else:
        published = timed(
            "gold",
            lambda: gold.run(spark, silver_tables, as_of, f"{root}/gold", database=f"gold_{uuid.uuid4().hex[:6]}"),
        )
    for name, fn in serving.SERVING_QUERIES.items():
        timed(name, lambda fn=fn: fn(published).collect())

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "pipeline_and_serving_wall",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
