"""Mergeable sketches: latency quantiles, and distinct hosts and URLs.

A sketch is a column of bytes of bounded size.  It is made once for each interval, group or manifest and can be stored;
coarser intervals and larger sets are made by merging sketches, without reading the rows again.  The exact operators
(``interval_percentiles``, ``hosts_per_partition``, ``distinct``) stay the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlsheaf.functions.urls import extract_host
from urlsheaf.operators.intervals import BY_PRESSURE, PERCENTILES, hosted_samples

#: Size of a quantile sketch, and of a distinct count.
QUANTILE_K = 200
LG_K = 12


def rank_error(k: int = QUANTILE_K) -> float:
    """How far the rank of a sketched quantile lies from the one that was asked for, at a confidence of 99 %."""
    # The fitted error law of this kind of sketch.
    return 2.296 / k**0.9723


def distinct_error(lg_k: int = LG_K) -> float:
    """Relative standard error of a sketched distinct count."""
    return 1.04 / (1 << lg_k) ** 0.5


def latency_sketches(log: DataFrame, interval: str, success_rule: str = BY_PRESSURE, k: int = QUANTILE_K) -> DataFrame:
    """``(host, interval_start, interval_end, sketch)`` of the latencies of each host and interval that has any."""
    samples = hosted_samples(log, interval, success_rule)
    return samples.groupBy("host", "window").agg(F.kll_sketch_agg_double("sample", k).alias("sketch")).select(
        "host", F.col("window.start").alias("interval_start"), F.col("window.end").alias("interval_end"), "sketch"
    )


def coarser(sketches: DataFrame, interval: str, k: int = QUANTILE_K) -> DataFrame:
    """Sketches of longer intervals, from those of the shorter ones inside them."""
    return sketches.groupBy("host", F.window("interval_start", interval).alias("window")).agg(
        F.kll_merge_agg_double("sketch", k).alias("sketch")
    ).select("host", F.col("window.start").alias("interval_start"), F.col("window.end").alias("interval_end"), "sketch")


def sketched_percentiles(sketches: DataFrame, min_samples: int = 1) -> DataFrame:
    """Adds ``n_samples`` and the percentiles, null below ``min_samples``."""
    n = F.kll_sketch_get_n_double("sketch")
    enough = F.col("n_samples") >= min_samples
    return sketches.withColumn("n_samples", n).withColumns(
        {name: F.when(enough, F.kll_sketch_get_quantile_double("sketch", F.lit(p))) for name, p in PERCENTILES.items()}
    )


def sketched_rank(sketch: str | Column, value: float) -> Column:
    """The share of a sketch's samples up to a value, such as a limit that latencies have to keep."""
    return F.kll_sketch_get_rank_double(sketch, F.lit(float(value)))


def host_sketches(df: DataFrame, url_col: str, by: str = "group", lg_k: int = LG_K) -> DataFrame:
    """``(by, hosts)``: a sketch of the hosts of each group, also of several manifests' rows."""
    host = F.col("host") if "host" in df.columns else extract_host(F.col(url_col))
    return df.select(by, host.alias("_host")).groupBy(by).agg(F.theta_sketch_agg("_host", lg_k).alias("hosts"))


def merged_hosts(*sketches: DataFrame, by: str = "group", lg_k: int = LG_K) -> DataFrame:
    """The sketches of several manifests as one for each group."""
    whole = sketches[0]
    for more in sketches[1:]:
        whole = whole.unionByName(more)
    return whole.groupBy(by).agg(F.theta_union_agg("hosts", lg_k).alias("hosts"))


def estimated_hosts(sketches: DataFrame) -> DataFrame:
    """Adds ``n_hosts``; exact while there are fewer hosts than the sketch has places."""
    return sketches.withColumn("n_hosts", F.theta_sketch_estimate("hosts"))


def shared_hosts(sketches: DataFrame, pairs: DataFrame, by: str = "group") -> DataFrame:
    """``pairs (a, b)`` of groups with ``n_shared``, the hosts that both have."""
    a = sketches.select(F.col(by).alias("a"), F.col("hosts").alias("_a"))
    b = sketches.select(F.col(by).alias("b"), F.col("hosts").alias("_b"))
    met = pairs.select("a", "b").join(a, "a").join(b, "b")
    return met.select("a", "b", F.theta_sketch_estimate(F.theta_intersection("_a", "_b")).alias("n_shared"))


def url_sketch(df: DataFrame, url_col: str, lg_k: int = LG_K) -> DataFrame:
    """One row ``urls``: a sketch of a manifest's different URLs."""
    return df.agg(F.hll_sketch_agg(F.col(url_col), lg_k).alias("urls"))


def estimated_urls(*sketches: DataFrame) -> DataFrame:
    """One row ``n_urls``: different URLs of all manifests together, from their sketches alone."""
    whole = sketches[0]
    for more in sketches[1:]:
        whole = whole.unionByName(more)
    return whole.agg(F.hll_sketch_estimate(F.hll_union_agg("urls")).alias("n_urls"))
