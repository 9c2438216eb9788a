"""Signals over interval rows.

Input rows are already one per host and interval, so a host has at most its
time span divided by the interval of them, however many requests it served.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Smoothing, latency thresholds, cooldown and pacing defaults.
ALPHA = 0.3
SIZE_ALPHA = 0.1
RTPROP_WINDOW = 35
DEFAULT_RTPROP = 0.2
STEADY_THETA = (1.5, 2.0)
STARTUP_THETA = (3.0, 4.0)
EFFICIENCY_WINDOW = 5
EFFICIENCY_THRESHOLD = 0.5
COOLDOWN_RTPROPS = 5
COOLDOWN_FLOOR = 2.0
INTERVAL_RTPROPS = 8
INTERVAL_SAMPLES = 50
INTERVAL_FLOOR = 0.2
UNDERPERFORMANCE = 0.5
UNDERPERFORMANCE_RUNS = 5
GOODPUT_HISTORY = 10


def _by_time():
    return W.partitionBy("host").orderBy("interval_start")


def _rtprop() -> Column:
    return F.coalesce(F.col("rtprop"), F.lit(DEFAULT_RTPROP))


def ema(df: DataFrame, cols: dict[str, str], alpha: float = ALPHA) -> DataFrame:
    """Exponential moving averages per host; ``cols`` maps input to output.

    A null input keeps the previous value; the first value starts the average.
    The recurrence ``e = (1 - a) e + a x`` is linear, so it is computed in
    blocks of rows: each block on its own, then the carry from block to block
    (one row per block), then carry and block together.
    """
    if alpha >= 1.0:
        return df.select(
            "*", *[F.last(c, ignorenulls=True).over(_by_time()).alias(out) for c, out in cols.items()]
        )
    keep = 1.0 - alpha
    # powers of 1 / keep must stay well inside the range of doubles
    block_rows = max(1, min(512, int(200 / -math.log10(keep))))
    span = (F.col("interval_end").cast("double") - F.col("interval_start").cast("double")) * block_rows
    rows = df.withColumn("_blk", F.floor(F.col("interval_start").cast("double") / span))
    inside = W.partitionBy("host", "_blk").orderBy("interval_start").rowsBetween(W.unboundedPreceding, 0)
    for c in cols:
        seen = F.count(c).over(inside)
        rows = rows.withColumn(f"_k_{c}", seen)
        scaled = F.col(c) * alpha * F.pow(F.lit(1 / keep), F.col(f"_k_{c}"))
        rows = rows.withColumn(f"_s_{c}", F.coalesce(F.sum(scaled).over(inside), F.lit(0.0)))
    last = [
        F.max_by(F.struct(F.col(f"_k_{c}").alias("k"), F.col(f"_s_{c}").alias("s")), "interval_start").alias(f"_e_{c}")
        for c in cols
    ]
    first = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col("interval_start"))).alias(f"_f_{c}") for c in cols]
    ends = rows.groupBy("host", "_blk").agg(*last, *first)
    carries = _carries(ends, list(cols), keep)
    joined = rows.join(carries, ["host", "_blk"])
    result = [
        F.when(
            F.col(f"_c_{c}_seen") | (F.col(f"_k_{c}") > 0),
            F.pow(F.lit(keep), F.col(f"_k_{c}")) * (F.col(f"_c_{c}") + F.col(f"_s_{c}")),
        ).alias(out)
        for c, out in cols.items()
    ]
    return joined.select(*df.columns, *result)


def _carries(ends: DataFrame, cols: list[str], keep: float) -> DataFrame:
    """Value each block starts from, and whether any came before it.

    One pass over the block ends in order, with one value per column as state;
    a host's first value stands in for the average before it.
    """
    flat = [F.col(f"_e_{c}.{x}").alias(f"{x}_{i}") for i, c in enumerate(cols) for x in ("k", "s")]
    firsts = [F.col(f"_f_{c}").cast("double").alias(f"f_{i}") for i, c in enumerate(cols)]
    ordered = ends.select("host", "_blk", *flat, *firsts).repartition("host").sortWithinPartitions("host", "_blk")
    n = len(cols)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        host, values, seen = None, None, None
        for pdf in batches:
            made = []
            for row in pdf.itertuples(index=False, name=None):
                if values is None or row[0] != host:
                    host, values, seen = row[0], [0.0] * n, [False] * n
                out = [row[0], row[1]]
                for i in range(n):
                    k, s, f = row[2 + 2 * i], row[3 + 2 * i], row[2 + 2 * n + i]
                    if k > 0 and not seen[i]:
                        values[i] = f
                    out += [values[i], seen[i]]
                    if k > 0:
                        values[i], seen[i] = keep**k * (values[i] + s), True
                made.append(out)
            yield pd.DataFrame(made, columns=names)

    kinds = [T.StructField("host", ends.schema["host"].dataType), T.StructField("_blk", ends.schema["_blk"].dataType)]
    for c in cols:
        kinds += [T.StructField(f"_c_{c}", T.DoubleType()), T.StructField(f"_c_{c}_seen", T.BooleanType())]
    names = [k.name for k in kinds]
    return ordered.mapInPandas(fold, T.StructType(kinds))


def avg_size_ema(df: DataFrame, alpha: float = SIZE_ALPHA) -> DataFrame:
    """Smoothed mean file size."""
    return ema(df, {"mean_file_size": "avg_file_size"}, alpha)


def rtprop(df: DataFrame, window_seconds: float = RTPROP_WINDOW, reset: bool = False) -> DataFrame:
    """Smallest raw p10 of the last seconds; kept through intervals without one.

    ``reset`` takes the current value instead of the window, as after a full
    refresh.
    """
    if reset:
        lowest = F.col("p10_raw")
    else:
        ordered = W.partitionBy("host").orderBy(F.col("interval_start").cast("double"))
        lowest = F.min("p10_raw").over(ordered.rangeBetween(-window_seconds, 0))
    known = df.withColumn("_low", F.when(F.col("p10_raw").isNotNull(), lowest))
    return known.withColumn("rtprop", F.last("_low", ignorenulls=True).over(_by_time())).drop("_low")


def goodput_history(df: DataFrame, n: int = GOODPUT_HISTORY) -> DataFrame:
    frame = _by_time().rowsBetween(-(n - 1), W.currentRow)
    return df.withColumn("goodput_history", F.collect_list("goodput_rps").over(frame))


def _slow(theta: tuple[float, float]) -> Column:
    median = F.col("p50") > F.col("rtprop") * theta[0]
    tail = F.col("p95") > F.col("rtprop") * theta[1]
    return F.coalesce(median, F.lit(False)) | F.coalesce(tail, F.lit(False))


def latency_degraded(df: DataFrame, t50: float = STEADY_THETA[0], t95: float = STEADY_THETA[1]) -> DataFrame:
    """Adds ``degraded`` and ``degraded_start``, its first interval."""
    flagged = df.withColumn("degraded", _slow((t50, t95)))
    before = F.lag("degraded", 1, False).over(_by_time())
    return flagged.withColumn("degraded_start", F.col("degraded") & ~before)


def latency_plateau(df: DataFrame, t50: float = STARTUP_THETA[0], t95: float = STARTUP_THETA[1]) -> DataFrame:
    return df.withColumn("latency_plateau", _slow((t50, t95)))


def efficiency_plateau(
    df: DataFrame, window: int = EFFICIENCY_WINDOW, threshold: float = EFFICIENCY_THRESHOLD
) -> DataFrame:
    """Goodput gained per step is below a share of proportional growth."""
    past = F.lag("goodput_rps", window).over(_by_time())
    past_c = F.col("concurrency") - window
    gain = (F.col("goodput_rps") - past) / window
    flat = (past > 0) & (past_c > 0) & (gain * past_c < past * threshold)
    return df.withColumn("efficiency_plateau", F.coalesce(flat, F.lit(False)))


def cooldown(df: DataFrame, mult: float = COOLDOWN_RTPROPS, floor: float = COOLDOWN_FLOOR) -> DataFrame:
    asked = F.when(F.col("retry_after") > 0, F.col("retry_after"))
    return df.withColumn("cooldown", F.greatest(_rtprop() * mult, F.lit(floor), asked))


def control_interval(df: DataFrame) -> DataFrame:
    by_samples = F.when(F.col("goodput_rps") > 0, INTERVAL_SAMPLES / F.col("goodput_rps"))
    wanted = F.greatest(_rtprop() * INTERVAL_RTPROPS, by_samples, F.lit(INTERVAL_FLOOR))
    return df.withColumn("control_interval", wanted)


def underperformance(
    df: DataFrame, threshold: float = UNDERPERFORMANCE, runs: int = UNDERPERFORMANCE_RUNS
) -> DataFrame:
    """Adds ``streak`` and ``revise_ceiling``, true on every ``runs``-th in a row.

    Intervals below one request per second neither extend nor end a streak.
    """
    counted = F.col("goodput_rps") >= 1.0
    low = counted & (F.col("goodput_rps") < F.col("concurrency") / _rtprop() * threshold)
    flagged = df.withColumn("_low", low).withColumn("_fine", counted & ~low)
    upto = _by_time().rowsBetween(W.unboundedPreceding, W.currentRow)
    islands = flagged.withColumn("_island", F.sum(F.col("_fine").cast("int")).over(upto))
    in_island = W.partitionBy("host", "_island").orderBy("interval_start").rowsBetween(W.unboundedPreceding, 0)
    streak = F.sum(F.col("_low").cast("int")).over(in_island)
    return (
        islands.withColumn("streak", streak)
        .withColumn("revise_ceiling", F.col("_low") & (F.col("streak") % runs == 0))
        .drop("_low", "_fine", "_island")
    )


def inferred_rate(df: DataFrame) -> DataFrame:
    """Requests and bytes per second that concurrency and latency imply."""
    rate = F.when(F.col("rtprop") > 0, F.col("concurrency") / F.col("rtprop"))
    return df.withColumn("inferred_rps", rate).withColumn("inferred_bps", rate * F.col("avg_file_size"))
