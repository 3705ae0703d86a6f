"""Time the headline queries. Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rigstream import build_session  # noqa: E402
from rigstream.plans.queries import all_queries  # noqa: E402

HEADLINE = [
    "rig_state", "rig_state_counts", "rig_state_previous", "block_dir_vel", "tank_avg", "wind_avg", "rpm_p2p_running",
    "torque_p2p_by_device", "tank_rate", "tank_eta", "tank_series", "mse", "mse_payload", "depth_log", "time_log",
    "message_log", "trajectory", "attr_well", "upsert_latest", "offset_ledger", "payload_tank", "payload_wind",
    "route_tags", "route_time_logs", "route_mse", "decode_block", "ar1_forecast", "arima_forecast",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "rigstream-bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    names = sys.argv[1:] or HEADLINE
    # one untimed run starts the session's Python workers and compiles the common code
    queries["block_dir_vel"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        begin = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    result = {
        "metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(os.path.normpath(sf_dir)),
    }
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
