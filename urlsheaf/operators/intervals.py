"""Per-host interval metrics over the request log.

Request log: ``host, ts, status_code, ttfb, bytes, is_conn_error,
retry_after``.  Intervals are tumbling event-time windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from urlsheaf.functions.status import is_overload
from urlsheaf.functions.urls import UNKNOWN_HOST

# The latency percentiles kept, and the samples they need.
PERCENTILES = {"p10_raw": 0.10, "p50_raw": 0.50, "p95_raw": 0.95}
MIN_SAMPLES = 5

BY_PRESSURE = "pressure"
BY_STATUS = "status"

# Latency buckets per factor e.  A bucket is 1.6 % wide, so a hot host's
# samples spread over many of them.
_BUCKETS_PER_E = 64


def _hosted(log: DataFrame) -> DataFrame:
    """Requests without a host count for the unknown one, as everywhere."""
    return log.withColumn("host", F.coalesce("host", F.lit(UNKNOWN_HOST)))


def _failed(success_rule: str) -> Column:
    if success_rule == BY_STATUS:
        return ~F.coalesce(F.col("status_code").between(200, 399), F.lit(False))
    return is_overload(F.col("status_code"), F.col("is_conn_error"))


def _sample(success_rule: str) -> Column:
    """The latency of a successful request, else null."""
    return F.when(~_failed(success_rule) & (F.col("ttfb") > 0), F.col("ttfb"))


def hosted_samples(log: DataFrame, interval: str, success_rule: str = BY_PRESSURE) -> DataFrame:
    """``(host, window, sample)``: the latencies that count, each with its interval."""
    samples = _hosted(log).select("host", F.window("ts", interval).alias("window"), _sample(success_rule).alias("sample"))
    return samples.filter(F.col("sample").isNotNull())


def _interval_seconds() -> Column:
    start, end = F.col("window.start").cast("double"), F.col("window.end").cast("double")
    return end - start


def _counts(success_rule: str) -> list[Column]:
    failed = _failed(success_rule)
    size = F.when(~failed, F.coalesce(F.col("bytes"), F.lit(0)))
    # fixed-width buffers only, so that the aggregation stays a hash aggregation
    asked = F.max_by("retry_after", F.when(F.col("retry_after").isNotNull(), F.col("ts")))
    return [
        F.count("*").alias("total"),
        F.count_if(~failed).alias("n_success"),
        F.count_if(failed).alias("n_errors"),
        F.count(_sample(success_rule)).alias("n_samples"),
        F.coalesce(F.sum(size), F.lit(0)).alias("bytes"),
        F.count(F.when(size > 0, size)).alias("_files"),
        asked.alias("retry_after"),
    ]


def _metric_columns(*extra: str) -> list:
    secs = _interval_seconds()
    return [
        "host",
        F.col("window.start").alias("interval_start"),
        F.col("window.end").alias("interval_end"),
        "total",
        "n_success",
        "n_errors",
        "n_samples",
        "bytes",
        (F.col("n_errors") > 0).alias("has_overload"),
        (F.col("n_success") / secs).alias("goodput_rps"),
        (F.col("bytes") / secs).alias("goodput_bps"),
        secs.alias("duration"),
        "retry_after",
        F.when(F.col("_files") > 0, F.col("bytes") / F.col("_files")).alias("mean_file_size"),
        *extra,
    ]


def interval_metrics(log: DataFrame, interval: str, success_rule: str = BY_PRESSURE) -> DataFrame:
    """Counts, bytes and goodput per host and interval."""
    grouped = _hosted(log).groupBy("host", F.window("ts", interval)).agg(*_counts(success_rule))
    return grouped.select(*_metric_columns())


def interval_percentiles(
    log: DataFrame, interval: str, min_samples: int = MIN_SAMPLES, success_rule: str = BY_PRESSURE
) -> DataFrame:
    """Exact interpolated latency percentiles per host and interval.

    Selection in two passes over latency buckets: bucket counts tell which
    buckets hold a wanted rank, and only those buckets are ranked, each in a
    group of its own.  No task has to hold all samples of a host.
    """
    cell = ["host", "interval_start", "interval_end"]
    value = F.col("_v")
    samples = (
        _hosted(log)
        .select("host", F.window("ts", interval).alias("window"), _sample(success_rule).alias("_v"))
        .filter(value.isNotNull())
        .select(
            "host",
            F.col("window.start").alias("interval_start"),
            F.col("window.end").alias("interval_end"),
            F.floor(F.log(value) * _BUCKETS_PER_E).alias("_b"),
            "_v",
        )
        # stated, as the join below would add it to one of its sides only, and
        # the log would be read and shuffled for each side
        .filter(F.col("_b").isNotNull())
        .groupBy(*cell, "_b", "_v")
        .agg(F.count("*").alias("_n"))
    )
    whole = W.partitionBy(*cell)
    ranks = F.array(
        *[
            F.struct(F.lit(name).alias("name"), lower.alias("rank"), weight.alias("weight"))
            for name, p in PERCENTILES.items()
            for lower, weight in _neighbours(p)
        ]
    )
    before = F.sum("_bn").over(whole.orderBy("_b").rowsBetween(W.unboundedPreceding, -1))
    buckets = (
        samples.groupBy(*cell, "_b")
        .agg(F.sum("_n").alias("_bn"))
        .withColumn("n_samples", F.sum("_bn").over(whole))
        .withColumn("_before", F.coalesce(before, F.lit(0)))
        .withColumn("_ranks", ranks)
        .withColumn(
            "_ranks",
            F.filter(
                "_ranks",
                lambda r: (r["rank"] >= F.col("_before")) & (r["rank"] < F.col("_before") + F.col("_bn")),
            ),
        )
    )
    wanted = buckets.filter(F.size("_ranks") > 0).select(*cell, "_b", "_before", "_ranks", "n_samples")
    inside = W.partitionBy(*cell, "_b").orderBy("_v").rowsBetween(W.unboundedPreceding, W.currentRow)
    upto = F.col("_before") + F.sum("_n").over(inside)
    found = (
        samples.join(wanted, [*cell, "_b"])
        .withColumn("_upto", upto)
        .select(
            *cell,
            "_v",
            "n_samples",
            (F.col("_upto") - F.col("_n")).alias("_from"),
            "_upto",
            F.explode("_ranks").alias("_r"),
        )
        .filter((F.col("_r.rank") >= F.col("_from")) & (F.col("_r.rank") < F.col("_upto")))
    )
    parts = [
        F.sum(F.when(F.col("_r.name") == name, F.col("_r.weight") * value)).alias(name) for name in PERCENTILES
    ]
    values = found.groupBy(*cell).agg(F.max("n_samples").alias("n_samples"), *parts)
    return values.select(
        *cell,
        "n_samples",
        *[F.when(F.col("n_samples") >= min_samples, F.col(name)).alias(name) for name in PERCENTILES],
    )


def _neighbours(p: float) -> list[tuple[Column, Column]]:
    """The two ranks a percentile lies between, with their weights."""
    place = (F.col("n_samples") - 1) * F.lit(p)
    lower = F.floor(place)
    upper = F.least(lower + 1, F.col("n_samples") - 1)
    weight = place - lower
    return [(lower, 1 - weight), (upper, weight)]


def interval_snapshot(
    log: DataFrame, interval: str, min_samples: int = MIN_SAMPLES, success_rule: str = BY_PRESSURE
) -> DataFrame:
    """Metrics and percentiles in one row per host and interval."""
    metrics = interval_metrics(log, interval, success_rule)
    latency = interval_percentiles(log, interval, min_samples, success_rule).drop("n_samples", "interval_end")
    return metrics.join(latency, ["host", "interval_start"], "left")


def streaming_snapshot(
    log: DataFrame,
    interval: str,
    delay: str = "1 minute",
    min_samples: int = MIN_SAMPLES,
    success_rule: str = BY_PRESSURE,
    accuracy: int | None = None,
    sketch_k: int | None = None,
) -> DataFrame:
    """``interval_snapshot`` of a stream; late rows are dropped.

    The state of an open interval holds its distinct latencies.  Where a host
    sends too many of them, ``accuracy`` bounds the state with an approximate
    percentile, or ``sketch_k`` with a sketch of that size, of a stated rank
    error (``sketches.rank_error``), which is handed on as ``sketch``.
    """
    marks = F.array(*[F.lit(p) for p in PERCENTILES.values()])
    sample = _sample(success_rule)
    if sketch_k is not None:
        latency = F.kll_sketch_agg_double(sample, sketch_k)
    elif accuracy is None:
        latency = F.percentile(sample, marks)
    else:
        latency = F.percentile_approx(sample, marks, accuracy)
    grouped = (
        _hosted(log)
        .withWatermark("ts", delay)
        .groupBy("host", F.window("ts", interval))
        .agg(*_counts(success_rule), latency.alias("_p"))
    )
    enough = F.col("n_samples") >= min_samples
    if sketch_k is not None:
        marks = [F.kll_sketch_get_quantile_double("_p", F.lit(p)) for p in PERCENTILES.values()]
        named = [F.when(enough, m).alias(name) for name, m in zip(PERCENTILES, marks)]
        return grouped.select(*_metric_columns(), *named, F.when(F.col("n_samples") > 0, F.col("_p")).alias("sketch"))
    named = [F.when(enough, F.col("_p")[i]).alias(name) for i, name in enumerate(PERCENTILES)]
    return grouped.select(*_metric_columns(), *named)
