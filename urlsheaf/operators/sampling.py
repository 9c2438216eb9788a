"""Stratified samples of a stated size, and totals estimated from them with their error.

A stratum keeps the ``k`` rows of smallest hash, so samples of several manifests merge into the sample of all of them:
the smallest hashes of the union are among those that were kept.  A stratum's rows are known by count, so each sampled
row stands for ``rows / sampled`` of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Half the width of an interval that holds the truth in 95 of 100 samples, in standard errors.
Z95 = 1.96


def _smallest(rows: DataFrame, by: list[str], key: list[str], k: int) -> DataFrame:
    """The ``k`` rows of smallest priority of each stratum; tasks cut their own before anything is shuffled."""
    order = W.partitionBy(*by).orderBy("_priority", *key)
    return rows.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= k).drop("_place")


def _null_safe(a: DataFrame, b: DataFrame, by: list[str]) -> DataFrame:
    """``a`` with the columns of ``b``, whose strata are told apart with their nulls."""
    named = b.withColumnsRenamed({c: f"_{c}" for c in by})
    same = [a[c].eqNullSafe(named[f"_{c}"]) for c in by]
    on = same[0]
    for more in same[1:]:
        on = on & more
    return a.join(named, on).drop(*[f"_{c}" for c in by])


def stratified_sample(df: DataFrame, by: list[str], key: list[str], k: int, seed: int = 0) -> DataFrame:
    """At most ``k`` rows of each stratum, uniform and reproducible, with ``stratum_rows``, the rows it has.

    ``key`` tells rows apart.  A null is a stratum like any other.
    """
    if k < 2:
        raise ValueError("an error can only be estimated from two rows or more")
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in key], F.lit(str(seed)))
    taken = _smallest(df.withColumn("_priority", F.md5(text)), by, key, k)
    counted = df.groupBy(*by).agg(F.count("*").alias("stratum_rows"))
    return _null_safe(taken, counted, by)


def merged_samples(samples: list[DataFrame], by: list[str], key: list[str], k: int) -> DataFrame:
    """The sample of several manifests together, from samples that were taken with the same seed."""
    whole = samples[0]
    for more in samples[1:]:
        whole = whole.unionByName(more)
    counted = None
    for number, sample in enumerate(samples):
        own = sample.select(*by, "stratum_rows").distinct().withColumn("_from", F.lit(number))
        counted = own if counted is None else counted.unionByName(own)
    counted = counted.groupBy(*by).agg(F.sum("stratum_rows").alias("stratum_rows"))
    return _null_safe(_smallest(whole.drop("stratum_rows"), by, key, k), counted, by)


def stratum_totals(sample: DataFrame, by: list[str], value: str) -> DataFrame:
    """Per stratum ``stratum_rows, n_sampled, total, std_error``; a null value counts as zero.

    A stratum that was sampled whole has no error.
    """
    y = F.coalesce(F.col(value).cast("double"), F.lit(0.0))
    sums = sample.groupBy(*by).agg(
        F.max("stratum_rows").alias("stratum_rows"),
        F.count("*").alias("n_sampled"),
        F.avg(y).alias("_mean"),
        F.coalesce(F.var_samp(y), F.lit(0.0)).alias("_spread"),
    )
    n, m = F.col("stratum_rows"), F.col("n_sampled")
    variance = n * (n - m) * F.col("_spread") / m
    return sums.select(*by, "stratum_rows", "n_sampled", (n * F.col("_mean")).alias("total"), F.sqrt(variance).alias("std_error"))


def estimated_total(totals: DataFrame) -> DataFrame:
    """One row: ``total``, ``std_error`` and the interval ``low`` to ``high`` of all strata together."""
    whole = totals.agg(
        F.coalesce(F.sum("total"), F.lit(0.0)).alias("total"),
        F.sqrt(F.coalesce(F.sum(F.col("std_error") * F.col("std_error")), F.lit(0.0))).alias("std_error"),
    )
    reach = F.col("std_error") * Z95
    return whole.select("total", "std_error", (F.col("total") - reach).alias("low"), (F.col("total") + reach).alias("high"))
