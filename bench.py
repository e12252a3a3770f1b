"""Benchmark: every core query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line. Each query runs to completion through the ``noop``
sink (full execution, nothing collected). A warm-up pass on the smallest
tables runs first so JIT start-up is not billed to the first query. Rounds
over all queries are repeated up to three times within $BENCH_SECONDS; the
figure of a query is the median of its rounds.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from meterflow import queries as q  # noqa: E402
from meterflow.session import build_session  # noqa: E402

ROUNDS = 3


def run(spark, name, sf_dir):
    t0 = time.time()
    q.REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.time() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    limit = float(os.environ.get("BENCH_SECONDS", "480"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, spark__driver__memory="16g")
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):
        for name in ("parse_readings", "route_messages"):
            run(spark, name, warm)
    times: dict[str, list[float]] = {name: [] for name in q.REGISTRY}
    began, rounds = time.time(), 0
    while rounds < ROUNDS and (not rounds or (time.time() - began) * (rounds + 1) / rounds < limit):
        for name in q.REGISTRY:
            times[name].append(run(spark, name, sf_dir))
        rounds += 1
    median = {name: round(statistics.median(t), 3) for name, t in times.items()}
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    producer = sum(median[n] for n in ("frame_telegrams", "parse_readings", "detect_changes", "change_messages"))
    out = {
        "metric": "total_core_seconds",
        "value": round(sum(median.values()), 3),
        "unit": "sec",
        "queries": median,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "rounds": rounds,
        "events": events,
        "telegrams_per_sec_parse": round(events / median["parse_readings"], 1),
        "telegrams_per_sec_to_messages": round(events / median["change_messages"], 1),
        "messages_per_sec_routing": round(events / median["route_messages"], 1),
        "producer_chain_sec": round(producer, 3),
        "cpus": int(cpus),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
