"""Writing partition sets and corrected manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_partitions(
    df: DataFrame, path: str, fmt: str = "parquet", keep_host: bool = True, mode: str = "errorifexists"
) -> None:
    """One folder ``group=N`` per group, in one pass over the rows.

    Rows are rebalanced by group: small groups share tasks, and a group larger
    than the advisory partition size is split over several tasks and files.
    """
    if fmt not in ("parquet", "csv"):
        raise ValueError(f"unsupported format {fmt!r}; use csv or parquet")
    rows = df if keep_host or "host" not in df.columns else df.drop("host")
    writer = rows.hint("rebalance", "group").write.mode(mode).partitionBy("group")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_corrected(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)
