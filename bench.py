"""Time the headline queries: one JSON line on standard output.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and
cores. Each query runs BENCH_RUNS times (default 2); the faster run counts.
The SQL check of each query is timed in single-process DuckDB too, unless BENCH_DUCKDB=0.
"""

import glob
import json
import os
import sys
import time

from patronlens.catalog import QUERIES
from patronlens.session import build_session

HEADLINE = [
    "k01_retail_clean",
    "k05_rfm_segment_profile",
    "k07_revenue_by_country",
    "k09_cltv_segment_summary",
    "k12_retention_matrix",
    "k14_persona_segments",
    "k15_purchase_history",
    "n02_association_rules",
    "n03_rule_measures",
    "j01_table_profile",
    "d13_describe",
    "i10_outlier_limits",
    "e05_pareto_flag",
    "l04_t_test",
    "l06_pairwise_mann_whitney",
    "k23_fixed_price",
    "m05_discounted_value",
    "k17_predicted_value",
    "o10_passenger_features",
    "o03_random_forest",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["k02_rfm_metrics"].run(spark, folder).write.format("noop").mode("overwrite").save()  # start-up
    seconds = {}
    for name in names:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    out = {"metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/"))}
    if os.environ.get("BENCH_DUCKDB", "1") == "1":
        import duckdb

        con = duckdb.connect()
        con.execute(f"SET threads = {cpus}")
        for path in glob.glob(f"{folder}/*.parquet"):
            con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
        out["duckdb"] = {}
        for name in names:
            if QUERIES[name].sql:
                start = time.perf_counter()
                con.execute(QUERIES[name].check_sql()).fetchall()
                out["duckdb"][name] = round(time.perf_counter() - start, 3)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
