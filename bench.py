"""Headline queries, timed warm on local[BENCH_CPUS] over BENCH_SF_DIR; prints one JSON line."""

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

from pyspark.sql import SparkSession  # noqa: E402

from tallybrook.plans import registry  # noqa: E402

HEADLINES = ["fy_trend", "hierarchy_rollup", "top_vendors", "best_match_per_key", "best_row_number", "majority_vote", "method_pivot", "rank_matrix", "yoy_change", "low_price_ratio", "insert_ignore", "priority_cascade", "blocked_bidirectional", "dictionary_match", "embedding_argmax", "benchmark_containment"]
RUNS = 3


def main() -> None:
    sf, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    took = {}
    for name in HEADLINES:
        times = []
        for _ in range(RUNS):
            began = time.time()
            registry.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            times.append(time.time() - began)
        took[name] = round(statistics.median(times), 3)
    print(json.dumps({"metric": f"sum of medians of {RUNS} runs", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
