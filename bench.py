"""Benchmark: warehouse load, panels in both modes, and the three-scenario comparison.

Prints one JSON line. ``queries`` holds seconds per load step (second load of the session; the first one as a whole
is under ``cold``), per panel (best of three runs after the first, which is under ``cold``) and per refresh (mean of three
after the first). ``panel_means`` has the means of the panels' three runs.
"""

from __future__ import annotations

import json
import os
import sys
from functools import reduce

from pyspark.sql import DataFrame

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bench_modes import compare_modes, timed  # noqa: E402
from epidw.operators import aggregates, facts, mart  # noqa: E402
from epidw.plans import direct, shared_refresh, star  # noqa: E402
from epidw.plans.pipeline import STAGING, run_pipeline  # noqa: E402
from epidw.session import local_session, shared_folder  # noqa: E402
from epidw.sources.fixture import raw_from_test_tables  # noqa: E402
from epidw.sources.microdata import read_microdata  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    root = f"{shared_folder(spark)}/bench"
    # BENCH_REPEAT stacks copies of the rows, to measure at the size of a published run
    copies = [raw_from_test_tables(spark, sf_dir)] * int(os.environ.get("BENCH_REPEAT", "1"))
    rows_to_write = reduce(DataFrame.unionByName, copies)
    fixture_seconds, _ = timed(lambda: rows_to_write.write.mode("overwrite").parquet(f"{root}/raw"))
    raw = read_microdata(spark, f"{root}/raw")
    rows = raw.count()

    queries: dict[str, float] = {}
    cold: dict[str, float] = {}
    means: dict[str, float] = {}
    first_seconds, _ = timed(lambda: run_pipeline(spark, raw, f"{root}/first"))
    load_seconds, load = timed(lambda: run_pipeline(spark, raw, f"{root}/second"))
    cold["load_total"], queries["load_total"] = first_seconds, load_seconds
    steps = {STAGING: "load_staging", facts.NOTIFICATION: "load_notification_fact", facts.EXAM: "load_exam_fact",
             mart.MART: "load_mart", shared_refresh.PANELS: "load_panel_cube", "gate": "load_gate",
             **{a.table: "load_" + a.table.split(".")[1] for a in aggregates.STORED}}
    queries.update({name: load.seconds[table] for table, name in steps.items()})
    queries["load_dimensions"] = max(s for t, s in load.seconds.items() if t.startswith("dw.dim_"))

    for suffix, source, panels in (("direct", raw, direct.PANELS), ("dw", load, star.PANELS)):
        for name, panel in panels.items():
            run = lambda: panel(source).collect()  # noqa: B023, E731
            cold[f"{name}_{suffix}"], _ = timed(run)
            runs = [timed(run)[0] for _ in range(3)]
            queries[f"{name}_{suffix}"], means[f"{name}_{suffix}"] = min(runs), sum(runs) / 3
    modes = compare_modes(raw, load)
    for scenario, found in modes.items():
        queries[f"refresh_direct_{scenario}"] = found["direct_mean"]
        queries[f"refresh_dw_{scenario}"] = found["dw_mean"]

    result = {
        "metric": "warehouse load plus both dashboard refreshes without filter",
        "value": round(load_seconds + queries["refresh_direct_none"] + queries["refresh_dw_none"], 3),
        "unit": "sec",
        "queries": {name: round(seconds, 3) for name, seconds in queries.items()},
        "sf": sf_dir.rsplit("sf", 1)[-1],
        "rows": rows,
        "rows_per_second": {
            name: round(rows / queries[name])
            for name in ("load_staging", "load_notification_fact", "load_exam_fact", "load_total")
        },
        "cold": {name: round(seconds, 3) for name, seconds in cold.items()},
        "panel_means": {name: round(seconds, 3) for name, seconds in means.items()},
        "modes": modes,
        "fixture_seconds": round(fixture_seconds, 3),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
