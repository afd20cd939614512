"""Times the headline queries and prints one JSON line. Each query runs once to warm up, then is timed."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ticktide.plans.catalogue import QUERIES  # noqa: E402
from ticktide.session import build_session  # noqa: E402

HEADLINE = [
    "parse_ticks", "tumbling_avg", "lag_features", "batch_delta", "batch_price_stats", "histogram_auto",
    "comment_count", "lexicon_sentiment", "comment_scores", "hourly_sentiment", "kv_scan_posts", "kv_upsert_latest",
    "weather_pivot", "weather_pair_corr", "forward_fill_hour", "asof_hour_join", "feature_table", "results_append",
    "sgd_first_step", "mlp_step", "stream_tumbling_avg", "stream_lag_features", "stream_prequential_sgd", "stream_prequential",
]
ONCE = {"stream_tumbling_avg", "stream_lag_features", "stream_prequential_sgd", "stream_prequential"}


def run(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = [name for name in HEADLINE if len(sys.argv) < 2 or name in sys.argv[1:]]
    seconds = {}
    for name in names:
        if name not in ONCE:
            run(spark, name, sf_dir)
        seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(1 if name in ONCE else 3)), 3)
    scale = Path(sf_dir).name.removeprefix("sf")
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": float(scale)}))
    spark.stop()


if __name__ == "__main__":
    main()
