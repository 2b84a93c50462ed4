"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
Each query is run to completion with the ``noop`` sink (the whole plan
executes, nothing is collected to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stellate.plans import catalog, stored  # noqa: E402
from stellate.session import get_session, release  # noqa: E402

QUERIES = {**catalog.QUERIES, **stored.QUERIES}

HEADLINE = [
    "relabel",                  # customer codes: stored neighbours -> components -> relabel
    "stored_neighbors",
    "components_order_part",    # lineitem order-part graph
    "components_all",           # lineitem + orders graph
    "merge_rounds",             # three rounds merged into a table
    "snapshot_components",      # message logs -> per-c2 components
    "round_snapshots",
    "message_format",
    "message_roundtrip",
    "populate_table",
    "dense_order_ids",
]
#: Queries of stored tables and streams.
STORED = ["store_rounds", "stream_rounds"]


def store_cycle(spark, sf_dir: str, root: str) -> dict[str, float]:
    """The stored-table workload: load the customer codes, one mapping round
    (stored neighbours -> components -> label history), a point lookup,
    and compaction."""
    from stellate.plans.catalog import customer_codes
    from stellate.plans.store import ComponentStore

    out = {}
    store = ComponentStore(spark, f"{root}/bench-store-{time.time_ns()}")
    t0 = time.time()
    store.populate(customer_codes(spark, sf_dir).select("uid"))
    out["store_populate"] = round(time.time() - t0, 3)
    t0 = time.time()
    store.map_round(batch_id=0).release()
    out["store_map_round"] = round(time.time() - t0, 3)
    t0 = time.time()
    store.lookup("01234").collect()
    out["store_lookup"] = round(time.time() - t0, 3)
    t0 = time.time()
    store.compact()
    out["store_compact"] = round(time.time() - t0, 3)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE + STORED
    ck = os.environ.get("BENCH_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="bench-ck-", dir="/tmp")
    spark = get_session(f"local[{cpus}]", app="stellate-bench",
                        shuffle_partitions=int(cpus) * 2,
                        conf={"spark.checkpoint.dir": ck, "spark.driver.memory": "16g"})
    # Warm-up (not timed): JVM, code generation and Python workers, on the
    # smallest data set.
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        for name in names:
            QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.time()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        release(df)
    if not sys.argv[1:]:
        times.update(store_cycle(spark, sf_dir, ck))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
