"""The load-run report as aggregations over a request log.

``request_log(run_id, stage, op, ts, status_code, network_error, timeout, retries,
bid_id, delayed)``. A run has few stages, so a stage is a large group by nature:
nothing here sorts or collects a stage. Counters combine before the shuffle, the
stage start is a scalar, and the longest silence is found level by level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtally.functions.rates import ratio

# Operations of a run.
BID = "bid"
MATCHED = "billing_matched"
UNKNOWN = "billing_unknown"
DUPLICATE = "billing_duplicate"
INVALID = "billing_invalid"
BILLING = [MATCHED, UNKNOWN, DUPLICATE, INVALID]

# Stage order of the report; others follow by name.
STAGES = ["steady", "burst1", "burst2", "recovery"]

# Targets of a run.
TARGETS = {
    "bid_success": 15000,
    "matched_unique": 12000,
    "unknown_unique": 1000,
    "duplicate_attempts": 1000,
    "nofill_count": 1000,
    "invalid_attempts": 200,
}

# Service levels.
MIN_BURST_SUCCESS = 0.98
MAX_BURST_NETWORK = 0.01
MAX_ERROR_DRIFT = 0.005
LONG_GAP_MICROS = 10_000_000


def _network() -> Column:
    return F.coalesce(F.col("network_error"), F.lit(False))


def _status(low: int, high: int | None) -> Column:
    code = F.col("status_code")
    inside = code >= low if high is None else (code >= low) & (code < high)
    return ~_network() & inside


def _ok() -> Column:
    return _status(200, 300)


def _error() -> Column:
    return _network() | _status(400, None)


def _responded() -> Column:
    """2xx, 4xx and 5xx answers; a redirect or a network error is no response."""
    return _ok() | _status(400, None)


def _bid_success() -> Column:
    return (
        (F.col("op") == BID) & ~_network() & (F.col("status_code") == 200) & (F.coalesce("bid_id", F.lit("")) != "")
    )


def _no_fill() -> Column:
    return (F.col("op") == BID) & ~_network() & (F.col("status_code") == 204)


def named_stages(log: DataFrame) -> DataFrame:
    stage = F.coalesce(F.col("stage"), F.lit(""))
    return log.withColumns(
        {
            "run_id": F.coalesce("run_id", F.lit("")),
            "stage": F.when(stage == "", F.lit("default")).otherwise(stage),
        }
    )


def stage_rank() -> Column:
    rank = F
    for position, name in enumerate(STAGES):
        rank = rank.when(F.col("stage") == name, F.lit(position))
    return rank.otherwise(F.lit(len(STAGES)))


def stage_counters(log: DataFrame) -> DataFrame:
    """Counters, rates and duration per run and stage, in report order."""
    billing = F.col("op").isin(BILLING)
    counted = (
        named_stages(log)
        .groupBy("run_id", "stage")
        .agg(
            F.min("ts").alias("started_at"),
            F.max("ts").alias("ended_at"),
            F.count("*").alias("attempts"),
            F.count_if(_ok()).alias("http_2xx"),
            F.count_if(_status(400, 500)).alias("http_4xx"),
            F.count_if(_status(500, None)).alias("http_5xx"),
            F.count_if(_network()).alias("network_errors"),
            F.count_if(_network() & F.coalesce(F.col("timeout"), F.lit(False))).alias("timeout_errors"),
            F.sum("retries").cast("bigint").alias("retries_total"),
            F.count_if(F.col("op") == BID).alias("bid_attempts"),
            F.count_if(_bid_success()).alias("bid_success"),
            F.count_if(_no_fill()).alias("nofill_count"),
            F.count_if(billing).alias("billing_attempts"),
            F.count_if(billing & _ok()).alias("billing_success_2xx"),
            F.count_if(F.col("op") == DUPLICATE).alias("duplicate_attempts"),
            F.count_if(F.col("op") == INVALID).alias("invalid_attempts"),
        )
    )
    errors = F.col("http_4xx") + F.col("http_5xx") + F.col("network_errors")
    return (
        counted.withColumn(
            "duration_ms", F.floor((F.unix_micros("ended_at") - F.unix_micros("started_at")) / 1000)
        )
        .withColumn("success_rate", ratio(F.col("http_2xx"), F.col("attempts")))
        .withColumn("error_rate", ratio(errors, F.col("attempts")))
        .withColumn("network_error_rate", ratio(F.col("network_errors"), F.col("attempts")))
        .orderBy("run_id", stage_rank(), "stage")
    )


def first_minute_error_rate(log: DataFrame, stage: str = "recovery", seconds: int = 60) -> DataFrame:
    """Error rate per run of a stage's requests up to ``seconds`` after its start, 0 when none.

    The starts are one row for each run; the log joins them and is not windowed.
    """
    rows = named_stages(log)
    here = F.col("stage") == stage
    starts = rows.groupBy(F.col("run_id").alias("_run")).agg(F.min(F.when(here, F.col("ts"))).alias("_start"))
    early = here & (F.col("ts") <= F.col("_start") + F.expr(f"INTERVAL {int(seconds)} SECONDS"))
    counted = (
        rows.join(starts, F.col("run_id") == F.col("_run"))
        .groupBy("run_id")
        .agg(F.count_if(early).alias("attempts"), F.count_if(early & _error()).alias("errors"))
    )
    return counted.select(
        "run_id",
        F.lit(stage).alias("stage"),
        "attempts",
        "errors",
        ratio(F.col("errors"), F.col("attempts")).alias("first_minute_error_rate"),
    )


def response_gaps(log: DataFrame) -> DataFrame:
    """The longest time without a response per run and stage, stage ends included.

    Requests are reduced to the first and last response per millisecond. A gap of a
    millisecond or more always lies between two such buckets, so nothing that shows
    in whole milliseconds is lost. Gaps are then merged upward: milliseconds within
    a second, seconds within an hour, hours within the stage. Each sort sees at most
    a few thousand rows, however many requests there are.
    """
    # Keys by epoch arithmetic: the name and the two coarser buckets it lies in.
    micros = F.unix_micros("ts")

    def start_of(width: int) -> Column:
        return micros - F.pmod(micros, F.lit(width))

    base = (
        named_stages(log)
        .select(
            "run_id",
            "stage",
            start_of(3_600_000_000).alias("hour"),
            start_of(1_000_000).alias("second"),
            start_of(1000).alias("milli"),
            micros.alias("at"),
            F.when(_responded(), micros).alias("answered"),
        )
        .groupBy("run_id", "stage", "hour", "second", "milli")
        .agg(
            F.min("at").alias("first"),
            F.max("at").alias("last"),
            F.min("answered").alias("low"),
            F.max("answered").alias("high"),
        )
        .withColumn("gap", F.lit(0).cast("bigint"))
    )

    def merge(rows: DataFrame, keys: list[str], along: str) -> DataFrame:
        """Neighbouring intervals to one: its ends, and its longest gap."""
        before = Window.partitionBy(*keys).orderBy(along)
        # Buckets without a response keep the last one seen.
        previous = F.last("high", ignorenulls=True).over(before.rowsBetween(Window.unboundedPreceding, -1))
        return (
            rows.withColumn("gap", F.greatest("gap", F.coalesce(F.col("low") - previous, F.lit(0))))
            .groupBy(*keys)
            .agg(
                F.min("first").alias("first"),
                F.max("last").alias("last"),
                F.min("low").alias("low"),
                F.max("high").alias("high"),
                F.max("gap").alias("gap"),
            )
        )

    seconds = merge(base, ["run_id", "stage", "hour", "second"], "milli")
    hours = merge(seconds, ["run_id", "stage", "hour"], "second")
    stages = merge(hours, ["run_id", "stage"], "hour")
    silent = F.col("low").isNull()
    gap = F.when(silent, F.col("last") - F.col("first")).otherwise(
        F.greatest("gap", F.col("low") - F.col("first"), F.col("last") - F.col("high"))
    )
    return stages.select(
        "run_id",
        "stage",
        F.floor(gap / 1000).alias("max_no_response_gap_ms"),
        (gap > LONG_GAP_MICROS).alias("long_no_response_gt_10s"),
    )


def stage_report(log: DataFrame) -> DataFrame:
    """The full stage table: counters, rates, gaps; one row per run and stage."""
    early = first_minute_error_rate(log).select("run_id", "stage", "first_minute_error_rate")
    return (
        stage_counters(log)
        .join(response_gaps(log), ["run_id", "stage"])
        .join(early, ["run_id", "stage"], "left")
        .withColumn("first_minute_error_rate", F.coalesce("first_minute_error_rate", F.lit(0.0)))
        .orderBy("run_id", stage_rank(), "stage")
    )


def burst_slo(report: DataFrame) -> DataFrame:
    """One row per run from a stage table: do the bursts and the recovery meet their levels?

    A recovery first-minute rate of 0 falls back to the stage's overall error rate.
    """

    def of(stage: str, column: str, missing=0.0) -> Column:
        return F.coalesce(F.max(F.when(F.col("stage") == stage, F.col(column))), F.lit(missing))

    def burst(stage: str) -> Column:
        return (
            (of(stage, "success_rate") >= MIN_BURST_SUCCESS)
            & (of(stage, "network_error_rate") < MAX_BURST_NETWORK)
            & ~of(stage, "long_no_response_gt_10s", False)
        )

    early = of("recovery", "first_minute_error_rate")
    recovery_error = F.when(early == 0, of("recovery", "error_rate")).otherwise(early)
    return (
        report.groupBy("run_id")
        .agg(
            burst("burst1").alias("burst1_pass"),
            burst("burst2").alias("burst2_pass"),
            of("steady", "error_rate").alias("steady_error_rate"),
            recovery_error.alias("recovery_error_rate"),
        )
        .withColumn(
            "recovery_pass",
            F.abs(F.col("recovery_error_rate") - F.col("steady_error_rate")) <= MAX_ERROR_DRIFT,
        )
        .withColumn(
            "burst_slo_met", F.col("burst1_pass") & F.col("burst2_pass") & F.col("recovery_pass")
        )
    )


def load_totals(log: DataFrame, targets: dict[str, int] | None = None) -> DataFrame:
    """Totals and whether every target is reached; one row per run.

    Unique ids are counted by reducing to one row per bid id first, so two distinct
    counts and all other totals share one shuffle that combines on the map side.
    """
    targets = TARGETS if targets is None else targets
    billing = F.col("op").isin(BILLING)
    has_id = F.coalesce("bid_id", F.lit("")) != ""

    def counted(condition: Column) -> Column:
        return F.count_if(condition)

    sums = {
        "attempts": F.count("*"),
        "bid_attempts": counted(F.col("op") == BID),
        "bid_success": counted(_bid_success()),
        "billing_attempts_total": counted(billing),
        "billing_success_2xx": counted(billing & _ok()),
        "http_4xx": counted(_status(400, 500)),
        "http_5xx": counted(_status(500, None)),
        "network_errors": counted(_network()),
        "retries_total": F.sum("retries").cast("bigint"),
        "nofill_count": counted(_no_fill()),
        "duplicate_attempts": counted(F.col("op") == DUPLICATE),
        "invalid_attempts": counted(F.col("op") == INVALID),
        "delayed_billing_count": counted(
            (F.col("op") == MATCHED) & _ok() & has_id & F.coalesce(F.col("delayed"), F.lit(False))
        ),
    }

    def seen(op: str) -> Column:
        return F.max(F.when((F.col("op") == op) & _ok() & has_id, 1).otherwise(0))

    run = F.coalesce("run_id", F.lit("")).alias("run_id")
    per_id = log.groupBy(run, "bid_id").agg(
        *[value.alias(name) for name, value in sums.items()],
        seen(MATCHED).alias("matched_unique"),
        seen(UNKNOWN).alias("unknown_unique"),
        F.min("ts").alias("started_at"),
        F.max("ts").alias("ended_at"),
    )
    names = [*sums, "matched_unique", "unknown_unique"]
    totals = per_id.groupBy("run_id").agg(
        *[F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name) for name in names],
        F.min("started_at").alias("started_at"),
        F.max("ended_at").alias("ended_at"),
    )
    met = F.lit(True)
    for name, least in targets.items():
        met = met & (F.col(name) >= least)
    return totals.select(
        "run_id",
        *names,
        F.floor((F.unix_micros("ended_at") - F.unix_micros("started_at")) / 1000).alias("duration_ms"),
        met.alias("targets_met"),
    )
