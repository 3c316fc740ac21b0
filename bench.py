"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Every query runs its whole result into a no-op sink: once to warm up, then BENCH_RUNS times (default 2),
of which the best counts. Planning and any job run while planning are included.
"""

import json
import os
import sys
import time

from checks.queries import QUERIES
from portledger.session import build_session

HEADLINE = [
    "monthly_by_type",
    "yearly_by_country",
    "type_country_pivot",
    "type_country_pivot_year",
    "importer_totals",
    "importer_ranking",
    "importer_names",
    "dedup_first_wins",
    "new_records",
    "ingest_counters",
    "read_records",
    "lookup_table",
    "translate_importer",
    "cells_to_columns",
    "weekly_records",
    "historical_records",
    "unified_records",
    "pending_files",
    "workbook_scan",
]


def timed(query, spark, sf_dir):
    start = time.time()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.time() - start


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        timed(QUERIES[name], spark, sf_dir)
        seconds[name] = round(min(timed(QUERIES[name], spark, sf_dir) for _ in range(runs)), 3)
    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
