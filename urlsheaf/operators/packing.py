"""Greedy bin packing of keys, exact at any number of keys.

The rule: take keys from the largest count down (ties by key), put each into
the lightest bin (ties by bin number).  Keys of equal count are
interchangeable for the bins, so the sequential part only has to walk the
*distinct counts*: with N rows there can be no more than sqrt(2 N) of them.
Every run of equal counts c visits the bins in the order of the values
``level + t * c``; the r-th smallest of these pairs tells the bin of the r-th
key, which the tasks work out independently for their slice of the run.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urlsheaf.functions.text import whole_quotient
from urlsheaf.operators.ordering import prefix_sums
from urlsheaf.session import materialise

SLICE_KEYS = 1 << 17
TIED_KEYS_PER_TASK = 1 << 20


def _taken(levels: np.ndarray, step: int, limit: int) -> np.ndarray:
    """How many items of size ``step`` each bin takes at values <= ``limit``."""
    return np.where(levels <= limit, (limit - levels) // step + 1, 0)


def _level_reaching(levels: np.ndarray, step: int, wanted: int) -> int:
    """Smallest value up to which at least ``wanted`` items are taken."""
    low, high = int(levels.min()), int(levels.min()) + step * (wanted - 1)
    while low < high:
        middle = (low + high) // 2
        if int(_taken(levels, step, middle).sum()) >= wanted:
            high = middle
        else:
            low = middle + 1
    return low


def bins_between(levels: np.ndarray, step: int, start: int, stop: int) -> np.ndarray:
    """0-based bins of items ``start`` to ``stop - 1`` of a run of equal items."""
    first = _level_reaching(levels, step, start + 1)
    last = _level_reaching(levels, step, stop)
    skipped = _taken(levels, step, first - 1)
    visits = _taken(levels, step, last) - skipped
    bins = np.repeat(np.arange(len(levels)), visits)
    turn = np.arange(len(bins)) - np.repeat(np.cumsum(visits) - visits, visits)
    values = levels[bins] + (skipped[bins] + turn) * step
    order = np.lexsort((bins, values))
    offset = start - int(skipped.sum())
    return bins[order][offset : offset + stop - start]


def levels_after(levels: np.ndarray, step: int, items: int) -> np.ndarray:
    """Bin levels once a whole run of equal items is placed."""
    last = _level_reaching(levels, step, items)
    taken = _taken(levels, step, last - 1)
    ties = np.flatnonzero(levels + taken * step == last)[: items - int(taken.sum())]
    taken[ties] += 1
    return levels + taken * step


def walk_runs(runs: Iterator[tuple[int, int]], n: int) -> Iterator[tuple[int, int, list | None, list | None]]:
    """For each (count, keys) run: the bins of a short one, or the bin levels
    at the start of a long one."""
    heap = [(0, b) for b in range(n)]
    for count, keys in runs:
        if keys <= n:
            bins = []
            for _ in range(keys):
                level, b = heap[0]
                bins.append(b)
                heapq.heapreplace(heap, (level + count, b))
            yield count, keys, bins, None
        else:
            levels = np.zeros(n, dtype=np.int64)
            for level, b in heap:
                levels[b] = level
            yield count, keys, None, levels.tolist()
            heap = [(int(v), b) for b, v in enumerate(levels_after(levels, count, keys))]
            heapq.heapify(heap)


def greedy_pack(counts: DataFrame, key: str, count: str, n: int) -> DataFrame:
    """``key, count, group`` with groups 1 to n; written, so it is computed once."""
    if n < 1:
        raise ValueError("the number of groups must be positive")
    base = materialise(
        counts.select(F.col(key), F.col(count).cast("long").alias("_c")).filter(F.col("_c") > 0), "counts"
    )
    runs = base.groupBy("_c").agg(F.count("*").alias("_m"))
    longest = runs.agg(F.coalesce(F.max("_m"), F.lit(0))).first()[0]
    by_key = F.col(key).asc_nulls_first()
    if longest <= TIED_KEYS_PER_TASK:
        tied = W.partitionBy("_c").orderBy(by_key)
        ranked = base.withColumn("_r", (F.row_number().over(tied) - 1).cast("long"))
    else:
        ordered = prefix_sums(base, [F.col("_c").desc(), by_key], None, "_i")
        # one row per distinct count: at most sqrt(2 * rows)
        first = F.broadcast(ordered.groupBy("_c").agg(F.min("_i").alias("_first")))
        ranked = ordered.join(first, "_c").withColumn("_r", F.col("_i") - F.col("_first")).drop("_i", "_first")
    ranked = ranked.withColumn("_s", whole_quotient(F.col("_r"), F.lit(SLICE_KEYS)))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = ((int(c), int(m)) for pdf in batches for c, m in zip(pdf["_c"], pdf["_m"]))
        for step in walk_runs(rows, n):
            yield pd.DataFrame([step], columns=["_c", "_m", "_bins", "_levels"])

    steps = (
        runs.repartition(1)
        .sortWithinPartitions(F.col("_c").desc())
        .mapInPandas(walk, "_c long, _m long, _bins array<int>, _levels array<long>")
    )
    last_slice = whole_quotient(F.col("_m") - 1, F.lit(SLICE_KEYS))
    plan = materialise(
        steps.select("_c", "_bins", "_levels", F.explode(F.sequence(F.lit(0).cast("long"), last_slice)).alias("_s")),
        "packing",
    )

    def place(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left = left.sort_values("_r")
        step = right.iloc[0]
        if step["_bins"] is not None:
            bins = np.asarray(step["_bins"])[left["_r"].to_numpy()]
        else:
            start = int(left["_r"].iloc[0])
            bins = bins_between(
                np.asarray(step["_levels"], dtype=np.int64), int(step["_c"]), start, start + len(left)
            )
        return pd.DataFrame({key: left[key], count: left["_c"], "group": bins + 1})

    schema = T.StructType(
        [base.schema[key], T.StructField(count, T.LongType()), T.StructField("group", T.IntegerType())]
    )
    placed = (
        ranked.groupBy("_c", "_s").cogroup(plan.groupBy("_c", "_s")).applyInPandas(place, schema)
    )
    return materialise(placed, "groups")
