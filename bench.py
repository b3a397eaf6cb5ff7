"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Every query is run to completion through the ``noop`` sink (full
computation, no driver collect).  Prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "q01_correlation_batch",    # full lag x basis x target x control sweep, all pairs
    "q02_correlation_window",   # windowed sweep with pinned control + latest changes
    "q03_country_activity",     # article x country bridge aggregate
    "q04_articles",             # filtered newest-first list (top-k)
    "q05_interpret",            # two result runs, cache lookup, rule text
    "q07_macro_ingest",         # orders x customer x lineitem -> monthly macro facts
    "q08_market_ingest",        # lineitem x part -> monthly valuations
    "x01_lexicon_tagger",       # whole-text tagging of every document
    "g13_ols_coefficients",     # regression table per model
    "g24_spearman",             # rank correlation per sweep group
    "g25_multi_control",        # k-control partial r via moment solver
    "t04_budget_slice",         # budgeted FIFO slice per day
    "w13_top_per_category",     # salted top-k per (country, category)
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from ratelens.plans.queries_all import QUERIES
    from ratelens.session import get_spark
    spark = get_spark(f"local[{cpus}]", app_name="ratelens-bench",
                      shuffle_partitions=max(8, 2 * int(cpus)),
                      extra={"spark.driver.memory": "16g"})
    # warm-up: JVM, codegen caches, parquet footers
    QUERIES["q03_country_activity"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
