"""Headline benchmark: runs the main queries at $BENCH_SF_DIR on
local[$BENCH_CPUS] and prints one JSON line.

Each query is executed in full with the ``noop`` writer (every row is
produced, nothing is collected to the driver). Queries that write files
(text / binary round trips, partitioned writes) include that write.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "decode_signal_totals",     # A1 + J1 + D2 + P19 (flagship)
    "decode_long_rows",         # long form, codegen'd extraction
    "decode_map_totals",        # text payload -> map decode
    "text_trace_scan",          # write + scan + tokenise text logs
    "binary_trace_scan",        # write + scan + frame binary recordings
    "replay_one_message",       # 11x replay, one message
    "replay_decode_totals",     # 11x replay of every frame, decode, totals
    "insert_statements_batched",  # skew-safe batching + statement text
    "line_protocol_points",     # point shaping
    "key_value_cells",          # cells, range-sorted, parquet round trip
    "csv_message_files",        # partitioned CSV write + read back
]


def _time_job(spark, sf_dir: str) -> float:
    """End to end job: recordings -> chunked scan -> broadcast decode ->
    message-partitioned parquet. Writing the input recordings is untimed."""
    from busframes import fixtures as fx
    from busframes.plans.catalog import _blobs, _dictionary
    from busframes.plans.jobs import JOBS, Target, run
    from busframes.session import shared_dir

    src, out = shared_dir(spark, "bench-recordings"), shared_dir(spark, "bench-messages")
    fx.write_blobs(_blobs(spark, sf_dir), src)
    dictionary = _dictionary(spark)
    t0 = time.time()
    run(spark, JOBS["HexToCK_2"], src, dictionary, Target(path=out))
    return round(time.time() - t0, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from busframes.session import build_session
    from busframes.plans.catalog import QUERIES

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": "16g"})
    names = sys.argv[1:] or HEADLINE
    # warm-up on the smallest fixture (JIT, Python workers), not on the
    # measured data
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in ("decode_signal_totals", "binary_frame_blobs", "binary_trace_scan", "decode_map_totals"):
        QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    if len(sys.argv) == 1:
        times["job_HexToCK_2"] = _time_job(spark, sf_dir)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
