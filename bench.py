"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) names the input, ``BENCH_CPUS`` the number of local cores. The stored
layers that most queries start from are built first and reported as ``layers``; results go to a no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from premia.catalog import all_queries, layers  # noqa: E402
from premia.session import local_session  # noqa: E402

HEADLINE = (
    "pure_premium_by_area",
    "profile_columns",
    "validate_bronze_freq",
    "validate_lenient",
    "flag_duplicates",
    "join_frequency_severity",
    "silver_ratios",
    "grouped_stratified_split",
    "target_columns",
    "segment_ae",
    "poisson_deviance",
    "lift_table",
    "normalized_gini",
    "psi_report",
    "psi_from_reference",
    "price_quotes",
    "top_reason_codes",
    "glm_frequency",
    "glm_severity",
    "cv_alpha_poisson",
    "gbm_challenger",
    "stream_request_metrics",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session()
    queries = all_queries()
    timings = {}
    started = time.perf_counter()
    for use_case in ("frequency", "severity", "pure_premium"):
        layers.gold(spark, sf_dir, use_case)
    layers.reference(spark, sf_dir)
    layers.quotes(spark, sf_dir)
    timings["layers"] = round(time.perf_counter() - started, 3)
    for name in HEADLINE:
        started = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - started, 3)
    total = round(sum(timings.values()), 3)
    sf = Path(sf_dir).name.removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": timings, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
