"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full into Spark's ``noop`` sink (every row computed,
nothing collected). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "rate_more_products",
    "rate_more_recently_products",
    "average_products",
    "hot_products",
    "item_cf_pairs",
    "item_cf_top10",
    "content_pairs",
    "online_recs",
    "online_recs_asof",
    "rating_upsert",
    "factor_topk",
    "als_user_recs",
    "stream_online_recs",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from recolib.plans.catalog import QUERIES
    from recolib.session import build_session

    # 4 shuffle partitions per core, 16 MB AQE target: enough tasks for the
    # exploding pair joins to balance across cores.
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, 4 * int(cpus)),
                          extra={"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"})
    # warm-up: JVM, parquet footers, codegen caches
    QUERIES["rate_more_products"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
