"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and
print one JSON line {"metric", "value", "unit", "queries", "sf"}.

Every query is executed in full through the no-op sink (nothing is
collected).  Each query runs once to warm up, then $BENCH_REPS times; the
median is reported.  $BENCH_QUERIES (comma separated) picks a subset.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from sparkmine.operators import clustering as CL  # noqa: E402
from sparkmine.operators import evaluate as EV  # noqa: E402
from sparkmine.plans import queries as Q  # noqa: E402
from sparkmine.plans.catalog import points  # noqa: E402
from sparkmine.session import local_session  # noqa: E402


def kmeans_run(spark, sf_dir):
    """The reference's headline run, scaled to the embeddings: k-means++ seeding
    (k=10), 20 mini-batch rounds of 200 points, full assignment, NMI and SSE."""
    pts = points(spark, sf_dir)
    centers, assigned = CL.minibatch_kmeans(pts, 10, 200, 20, 42, id_col="vec_id", features_col="embedding")
    sse = assigned.agg(F.sum(F.col("dist") * F.col("dist"))).scalar()
    return EV.nmi(assigned, "label", "cluster").select("*", sse.alias("sse"))


EXTRA = {"kmeans_run": kmeans_run}

HEADLINE = [
    "apriori_type",
    "apriori_brand",
    "son_brand",
    "fp_growth",
    "candidate_growth",
    "association_rules",
    "restrict_items",
    "take_fraction",
    "assign_nearest",
    "nmi",
    "kmeanspp_pick",
    "minibatch_2",
    "expand_by_weight",
    "histogram_density",
    "gaussian_smooth",
    "ordinal_gap",
    "frequency_table",
    "contingency",
    "kmeans_run",
]


def run_once(spark, fn, sf_dir: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="sparkmine-bench")
    times = {}
    for name in names:
        fn = EXTRA.get(name) or Q.QUERIES[name]
        run_once(spark, fn, sf_dir)  # warm-up
        times[name] = round(statistics.median(run_once(spark, fn, sf_dir) for _ in range(reps)), 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
