"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""
import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
HEADLINES = ["index_points", "rollup_events", "cell_centroids", "cell_to_parent", "drilldown_cells", "compact_cells",
             "grid_disk", "directed_edges"]


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    from hexatlas.plans.catalog import QUERIES
    times = {}
    for name in HEADLINES:
        runs = []
        for _ in range(2):  # the second run is warm
            start = time.time()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - start)
        times[name] = round(min(runs), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
