"""Times the headline queries and prints one JSON line.

Each query runs twice and the second run counts, so that the time is the query's and not that of
starting the JVM's compiler. The first runs are reported beside it as `cold`. Streams run once, from
their first trigger to the end of their input; `streams` has their seconds, which `value` leaves out.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import tidewire.plans.streams  # noqa: E402,F401  (adds the streaming queries)
from tidewire.plans.catalog import QUERIES  # noqa: E402
from tidewire.session import local_session  # noqa: E402

HEADLINE = (
    "validate_status",
    "silver",
    "telemetry_append",
    "rollup_1m",
    "rollup_5m",
    "rollup_1h",
    "history_raw",
    "alerts_rules",
    "anomaly_zscore",
    "alerts_all",
    "realtime_dedup",
    "alert_cooldown",
    "latest_state",
    "device_board",
    "live_fanout",
    "mqtt_normalize",
    "weather_normalize",
    "latency_histogram",
)
STREAMS = (
    "telemetry_stream",
    "silver_stream",
    "rollup_stream",
    "realtime_dedup_stream",
    "alert_cooldown_stream",
    "latest_state_stream",
    "anomaly_stream",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(
        os.environ.get("BENCH_CPUS", "8"), **{"spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds, cold, streams = {}, {}, {}
    runs = [(name, times) for name in HEADLINE for times in (cold, seconds)]
    for name, times in [*runs, *[(name, streams) for name in STREAMS]]:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "cold": cold,
        "streams": streams,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
