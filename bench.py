"""Time the headline queries: one JSON line on stdout.

Each query is planned and run twice, all rows of it; the second run counts, so JVM start-up
and first-use code generation do not.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tickweave.plans.catalog import QUERIES  # noqa: E402
from tickweave.session import build_session  # noqa: E402

HEADLINE = [
    "normalize_frames", "route_raw", "dedupe_trades", "stream_time", "candle_1m", "final_candles", "multi_window_candles",
    "sharded_aggregation", "lineitem_candles", "read_final", "ab_diff", "rolling_volume", "rolling_volatility",
    "volume_scores", "inter_trade_gap", "ingest_gaps", "latest_n_per_instrument", "range_aggregates", "book_metrics",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("OFF")
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            started = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"), "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
