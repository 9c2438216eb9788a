"""Request pacing: evenly spaced release times per host."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from urlsheaf.functions.urls import UNKNOWN_HOST
from urlsheaf.operators.ordering import in_ranges

# Spacing when nothing is known, and the smallest latency used.
UNKNOWN_DELAY = 0.01
MIN_RTPROP = 0.001


def pace_requests(
    df: DataFrame, host: str, arrival: str, rtprop: str, c: str, tie: str | list[str]
) -> DataFrame:
    """Adds ``delay``, ``release`` and ``rate``.

    Each release is the later of the arrival and the previous release plus
    the request's own ``rtprop / c``.  Credit does not build up while idle.
    With ``s`` the running sum of a host's delays, from its second request on,
    this is ``s_i + max(arrival_j - s_j, j <= i)``: a sum and a maximum, both
    of which add up over chunks, so a busy host is cut into many.
    """
    ties = [tie] if isinstance(tie, str) else list(tie)
    spacing = F.greatest(F.col(rtprop), F.lit(MIN_RTPROP)) / F.greatest(F.col(c), F.lit(1))
    known = F.col(rtprop).isNotNull() & F.col(c).isNotNull()
    order = [arrival, *ties]
    # never null, so rows are shuffled once by host and chunk for all that follows
    keyed = df.withColumn("_host", F.coalesce(F.col(host), F.lit(UNKNOWN_HOST)))
    delayed = keyed.withColumn("delay", F.when(known, spacing).otherwise(UNKNOWN_DELAY))
    written, _ = in_ranges(delayed, [F.col(k) for k in ("_host", *order)], "paced")
    ranged = written.filter(F.col("_host").isNotNull() & F.col("_chunk").isNotNull())
    inside = W.partitionBy("_host", "_chunk").orderBy(*order)
    upto = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    local = ranged.withColumn("_s", F.sum("delay").over(upto)).withColumn("_ahead", F.col(arrival) - F.col("_s"))
    chunk = local.groupBy("_host", "_chunk").agg(F.max("_s").alias("_d"), F.max("_ahead").alias("_top"))
    # at most one row per chunk of a host
    earlier = W.partitionBy("_host").orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    starts = chunk.withColumn("_start", F.coalesce(F.sum("_d").over(earlier), F.lit(0.0)))
    starts = starts.withColumn("_carry", F.max(F.col("_top") - F.col("_start")).over(earlier))
    top = F.max("_ahead").over(upto) - F.col("_start")
    return (
        local.join(starts.select("_host", "_chunk", "_start", "_carry"), ["_host", "_chunk"])
        .withColumn("release", F.greatest(top, F.col("_carry")) + F.col("_start") + F.col("_s"))
        .withColumn("rate", 1.0 / F.col("delay"))
        .select(*df.columns, "delay", "release", "rate")
    )
