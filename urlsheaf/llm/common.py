"""Shared pieces: input tables, scratch tables, whole texts, skew-safe lookups."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urlsheaf.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What separates words and is stripped from lines: space, tab to carriage return.
BLANK = "[\\x20\\x09-\\x0D]"
#: Rows of an Arrow batch that are turned into Python objects at a time.
SLICE = 256


#: Bytes of a batch that the JVM hands to Python: texts may be long, and buffers are held off the heap.
BATCH_BYTES = 4 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """``df`` itself; from now on the session hands Python batches of at most about ``BATCH_BYTES``."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """The text, a null one as the empty string."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else changed; ``lower`` does the same, faster, where all is ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, even where the optimiser moves the expression or where ``body``
    mentions it inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches with their texts as Python strings, so that few long texts are held at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            yield part, [t or "" for t in part.column(text).to_pylist()]


class Scratch:
    """Tables of one job below ``spark.checkpoint.dir``, each dropped as soon as nothing reads it."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: dict[str, str] = {}

    def keep(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """Write ``df`` and return a frame that reads it; an older table of that name stays until ``drop``."""
        path = scratch_path(self.spark, name)
        writer = df.write.partitionBy(by) if by else df.write
        writer.parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(conf).delete(path, True)


def whole_groups(
    batches: Iterator[pa.RecordBatch], key: str, limit: int | None
) -> Iterator[tuple[bool, pa.Table]]:
    """Cut a stream ordered by ``key`` (long) between its groups: (False, rows of whole groups), or (True, some rows of
    a group of more than ``limit`` rows).  No more than a group's ``limit`` rows and a batch are held."""
    held, hot = None, None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([held, rows]) if held is not None else rows
        held = None
        keys = rows.column(key).to_numpy()
        if hot is not None and keys.size:
            end = int(np.searchsorted(keys, hot, "right"))
            if end:
                yield True, rows.slice(0, end)
            rows, keys = rows.slice(end), keys[end:]
            hot = hot if not keys.size else None
        if not keys.size:
            continue
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut:
            yield False, rows.slice(0, cut)
        held = rows.slice(cut)
        if limit is not None and held.num_rows > limit:
            hot = int(keys[-1])
            yield True, held
            held = None
    if held is not None and held.num_rows:
        yield False, held
