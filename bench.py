"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

First the engine tables are derived from the driver tables and written to the shared
folder as category-partitioned Parquet (``load_sec``, reported on its own: the original
reads its stored datasets too). Then each query is evaluated in full through the
``noop`` sink (no rows to the driver) and timed; ``value`` is the sum of query times.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "category_top",
    "category_stage",
    "route_feedback",
    "parse_ratings",
    "assign_user_ids",
    "sample_new",
    "new_product_recs",
    "promote_products",
    "recommend",
    "recommend_job",
    "als_recommend",
    "mf_job",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from pickwise.plans.queries import REGISTRY
    from pickwise.session import build_session

    spark = build_session(f"local[{cpus}]", partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE

    def run(name: str) -> float:
        t0 = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    from pickwise.plans.fixtures import Fixtures

    t0 = time.perf_counter()
    Fixtures(spark, sf_dir).load()
    load = time.perf_counter() - t0
    times = {n: round(run(n), 3) for n in names}
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "load_sec": round(load, 3),
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
