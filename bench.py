"""Wall time of the headline pipelines.

Runs on local[$BENCH_CPUS] (default 8) over $BENCH_SF_DIR (default
/root/testdata/sf0.1) and prints one JSON line. Each query is executed
in full with a ``noop`` write, so nothing is collected to the driver and
every row of the result is produced.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from copse.plans import catalog  # noqa: E402
from copse.session import local_session  # noqa: E402

HEADLINE = [
    "parse_ranked_lines",
    "feature_profile",
    "bag_replace",
    "tree_depth2_predict",
    "tree_depth5_ensemble",
    "nb_predict",
    "nb_documents",
    "ensemble_mixed",
    "knn_l2_predict",
    "knn_bucketed",
    "knn_bagged",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_PARTITIONS", "8")))
    qs = catalog.queries()
    # Warm the JVM (class loading, code generation) and the Python workers
    # on the smallest tables, so start-up is not billed to the first query.
    for warm in ("bag_poisson", "tree_ensemble_accuracy", "nb_predict", "knn_l2_predict"):
        qs[warm](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    out = {
        "metric": "total_wall_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
