"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_RUNS (timed
runs after one warm-up; the median counts), BENCH_ONLY (comma-separated names).

Three groups: queries over the raw events (every one decodes, deduplicates and
attributes all of them), the same questions served from stored facts and roll-ups
(``serve_*``, built once under ``build_*``), and streams run to their end.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from datetime import timedelta

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from adtally.catalogue import queries as Q  # noqa: E402
from adtally.operators.attribution import deltas_from_facts  # noqa: E402
from adtally.plans import metrics, rollup  # noqa: E402
from adtally.plans.serving import Serving  # noqa: E402
from adtally.session import STREAMING_CONF, build, working_dir  # noqa: E402
from adtally.sources import facts as fact_tables  # noqa: E402
from adtally.sources import tables  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
ONLY = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]

RAW = [
    "summary_exact",
    "by_campaign_exact",
    "timeseries_minute",
    "timeseries_hour",
    "timeseries_day",
    "summary_rollup",
    "by_campaign_rollup",
    "timeseries_rollup_hour",
    "summary_mixed",
    "by_campaign_mixed",
    "timeseries_mixed",
    "minute_global",
    "minute_campaign",
    "rollup_multires",
    "rebuild_minutes",
    "correction_ledger",
    "read_model_as_of",
    "dedup_bids",
    "attributed_impressions",
    "billing_suppression_24h",
    "facts_bids",
    "change_log",
    "reconcile_layers",
    "stage_counters",
    "response_gaps",
    "load_totals",
    "orders_by_campaign",
    "orders_series_day",
]
STREAMS = ["stream_correction_ledger", "stream_billing_suppression"]


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run) -> float:
    started = time.perf_counter()
    run()
    return time.perf_counter() - started


def main() -> None:
    spark = build(
        "bench",
        f"local[{CPUS}]",
        {
            "spark.sql.shuffle.partitions": str(CPUS),
            # Small tables on one machine: keep reduce tasks on all cores.
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32k",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
            **STREAMING_CONF,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def wanted(name: str) -> bool:
        return not ONLY or name in ONLY

    def measure(name: str, run, warm: bool = True, runs: int = RUNS) -> None:
        if wanted(name):
            if warm:
                run()
            seconds[name] = round(statistics.median(timed(run) for _ in range(runs)), 4)

    for name in RAW:
        measure(name, lambda: drain(Q.QUERIES[name](spark, SF_DIR)))

    # Stored tables: written once, then the serving queries read only what they need.
    events = tables.events(spark, SF_DIR)
    root = working_dir(spark, "bench")
    bids_at, imps_at, minutes_at = f"{root}/bids", f"{root}/impressions", f"{root}/minutes"
    if not ONLY or any(n.startswith(("build", "serve")) for n in ONLY):
        seconds["build_facts"] = round(
            timed(
                lambda: (
                    fact_tables.write_facts(Q.facts_bids(spark, events), bids_at),
                    fact_tables.write_facts(Q.facts_impressions(spark, events), imps_at),
                )
            ),
            4,
        )
        bids, imps = fact_tables.read_facts(spark, bids_at), fact_tables.read_facts(spark, imps_at)
        seconds["build_rollup"] = round(
            timed(
                lambda: rollup.minute_campaign(deltas_from_facts(bids, imps))
                .sortWithinPartitions("minute_ts")
                .write.parquet(minutes_at)
            ),
            4,
        )
        minutes = spark.read.parquet(minutes_at)
        week, across = Q.WEEK, Q.TEN_DAYS
        hot = Serving(deltas_from_facts(bids, imps), minutes, week[0])
        both = Serving(deltas_from_facts(bids, imps, *across), minutes, Q.CUTOFF)
        serve = {
            "serve_summary_facts": lambda: metrics.summary(deltas_from_facts(bids, imps, *week), *week, "facts"),
            "serve_campaigns_facts": lambda: metrics.by_campaign(deltas_from_facts(bids, imps, *week)),
            "serve_summary_rollup": lambda: hot.summary(*week),
            "serve_campaigns_rollup": lambda: hot.by_campaign(*week),
            "serve_series_rollup_hour": lambda: hot.series(*week, "hour"),
            "serve_series_rollup_1h": lambda: hot.series(week[0], week[0] + timedelta(hours=1)),
            "serve_summary_mixed": lambda: both.summary(*across),
            "serve_campaigns_mixed": lambda: both.by_campaign(*across),
        }
        for name, plan in serve.items():
            measure(name, lambda: drain(plan()))

    for name in STREAMS:
        measure(name, lambda: drain(Q.QUERIES[name](spark, SF_DIR)), runs=1)

    rows = events.count()
    result = {
        "metric": "total seconds of headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float((re.search(r"sf([\d.]+)", SF_DIR) or ["0", "0"])[1]),
        "events": rows,
        "cpus": CPUS,
    }
    if "stream_correction_ledger" in seconds:
        result["stream_rows_per_sec"] = round(rows / seconds["stream_correction_ledger"])
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
