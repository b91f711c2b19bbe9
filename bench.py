"""Benchmark: wall seconds of the headline queries, printed as one JSON line.

BENCH_SF_DIR names the folder of Parquet tables, BENCH_CPUS the number of local cores, BENCH_QUERIES a comma-separated
choice of queries. Every query runs to its last row; the rows go nowhere.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from catchlake.checks import CHECKS
from catchlake.fixtures import Tables
from catchlake.session import intermediates, local_session

HEADLINE = (
    "s01_summarize_eez", "s03_summarize_lme", "s09_summarize_all", "b10_eez_fact", "b12_lme_fact", "b16_global_fact",
    "b18_all_facts", "c02_c03_cell_catch", "p06_partition_map", "q06_stock_status", "q07_catch_fluctuation",
    "q08_compare_distribution", "q09_taxon_tree", "q11_run_rules", "g01_intersecting", "g06_outside_extent",
    "g07_rollup_extents",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), shared=tempfile.mkdtemp(prefix="bench-"))
    Tables(spark, folder).lineitem.count()
    seconds = {}
    for name in names:
        with intermediates(spark):
            start = time.perf_counter()
            CHECKS[name].run(Tables(spark, folder)).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({"metric": "headline queries, total wall time", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
