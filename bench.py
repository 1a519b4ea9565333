"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from siteweave import queries as engine

HEADLINE = [
    "seed_hosts", "url_normalize", "url_distinct_normalized", "link_extract", "link_extract_builtin", "link_admissible", "heur_score_vocabulary", "heur_score_builtin", "best_page_per_host",
    "bfs_multi_seed", "content_dedupe", "cache_hit_miss", "chunk_text", "minify_body", "chunk_merge", "token_budget_prefix", "session_messages", "validate_details", "static_links",
    "link_fallback", "stage_events_rollup", "job_record_id",
]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("siteweave-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in ("seed_hosts", "link_extract"):  # start the JVM's and Python's workers
        engine.QUERIES[name](spark, "/root/testdata/sf0.001" if os.path.isdir("/root/testdata/sf0.001") else sf_dir).write.format("noop").mode("overwrite").save()
    took = {}
    for name in HEADLINE:
        begin = time.perf_counter()
        engine.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - begin, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
