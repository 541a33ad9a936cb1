"""Wall time of the headline queries; prints one JSON line.

Every query runs on its own: staged artefacts of earlier queries are dropped,
and all result columns are computed (no-op sink).
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from feedplan.plans import queries as catalog  # noqa: E402

HEADLINES = (
    # text and mapping
    "null_token_clean", "map_canonical", "normalize_rows", "contact_extract_documents", "whitespace_norm",
    "redact_documents", "mask_nested",
    # lookups and enrichment
    "identity_match", "code_collision", "code_allocate", "enrich_rows",
    # the flow from raw cells to the plan
    "validate_codes", "plan_rows",
    # diff and upsert of the largest keyed table
    "snapshot_diff_orders", "snapshot_upsert_orders", "duplicate_report",
    # snapshot refresh
    "snapshot_map_users", "refresh_outcome",
    # vault, plan artefacts, outcomes
    "vault_latest", "keyed_fallback", "plan_read_clean", "outcome_classify", "apply_counters",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("feedplan-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.all_queries()
    # one query before the clock starts: class loading is not what is measured
    queries["plan_summary"](spark, "/root/testdata/sf0.001").collect()
    seconds = {}
    for name in HEADLINES:
        catalog.forget()
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
