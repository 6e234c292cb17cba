"""Time the headline queries and print one JSON line.

BENCH_SF_DIR picks the tables and BENCH_CPUS the local cores. Every query is run to the end and
its rows are fully computed, but not collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

from earshot.plans.queries import QUERIES
from earshot.session import local_session

HEADLINES = [
    "indexed_interactions",
    "holdout_split",
    "popularity_top_k",
    "map_popularity",
    "ranking_metrics",
    "top_k_factors",
    "map_factors",
    "als_top_k",
    "knn_exact",
    "ivf_search",
    "lsh_search",
    "recall_sweep",
    "method_comparison",
    "lyrics_bag_of_words",
    "scaled_features",
    "full_features",
    "cold_vs_full",
    "classifier_eval",
]


def run(name: str, spark, root: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, root).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    run("knn_exact", spark, root)  # start the Python workers
    times = {name: round(run(name, spark, root), 3) for name in sys.argv[1:] or HEADLINES}
    result = {
        "metric": "headline queries, total time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(root.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
