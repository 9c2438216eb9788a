"""Equi joins that hold when one key owns a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot when it has more than one part in HOT_PARTS of all rows, so
# there can be at most HOT_PARTS hot keys.
HOT_PARTS = 4096
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20


def attach_by_key(rows: DataFrame, table: DataFrame, key: str, count: str) -> DataFrame:
    """Left join of ``rows`` to a written per-key ``table`` that knows its counts.

    A table of proven small size is broadcast.  Beyond that only the hot keys
    are (at most ``HOT_PARTS``), so their rows are never shuffled; the other
    rows, none of whose keys is frequent, join by shuffle.  Keys compare null
    safe.
    """
    facts = table.agg(
        F.count("*").alias("keys"),
        F.coalesce(F.sum(F.length(F.col(key).cast("string")) + 64), F.lit(0)).alias("size"),
        F.coalesce(F.sum(count), F.lit(0)).alias("rows"),
    ).first()
    value = [c for c in table.columns if c not in (key, count)]
    keyed = table.select(F.col(key).alias("_k"), F.col(count).alias("_n"), *value)
    same = F.col(key).eqNullSafe(F.col("_k"))
    if facts["keys"] <= BROADCAST_ROWS and facts["size"] <= BROADCAST_BYTES:
        return rows.join(F.broadcast(keyed), same, "left").drop("_k", "_n")

    hot = F.col("_n") * HOT_PARTS > facts["rows"]
    hot_side, cold_side = keyed.filter(hot), keyed.filter(~hot)
    found = rows.join(F.broadcast(hot_side), same)
    others = rows.join(F.broadcast(hot_side.select("_k")), same, "left_anti").join(cold_side, same, "left")
    return found.unionByName(others).drop("_k", "_n")
