"""Global order without a one-task window.

A running number over a whole table is built from two levels: rows are cut
into bounded chunks, the chunks are counted, and a row's number is its
chunk's offset plus its place inside the chunk.  For files a chunk is a fixed
stretch of row positions, so nothing has to be sorted; when no row was
filtered out of any chunk, the rows are not even shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from urlsheaf.functions.text import whole_quotient
from urlsheaf.session import materialise

CHUNK_ROWS = 1 << 20
#: Bytes of input for a range, and the size from which on an estimate only says that nothing is known.
CHUNK_BYTES = 128 << 20
UNKNOWN_BYTES = 1 << 60
# Values of the first four hexadecimal digits of a hash.
SAMPLE_RANGES = 1 << 16

_FILE, _POS, _CHUNK, _BASE = "_file", "_pos", "_chunk", "_base"


def _file_facts(df: DataFrame) -> set[str]:
    """What the scan below a frame can tell of a row's place, as its analysed plan says."""
    known = df._jdf.queryExecution().analyzed().metadataOutput()
    found: set[str] = set()
    for i in range(known.size()):
        if known.apply(i).name() == "_metadata":
            found |= set(known.apply(i).dataType().fieldNames())
    return found


def with_position(df: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Add file, row position in the file and position chunk.

    Parquet scans know the position.  Other files know the start of a split:
    their rows are numbered once, as they are read, and written.  Any other
    frame (a union, a join) is written once in the order of its partitions.
    """
    pos = F.col("_metadata.row_index")
    chunk = whole_quotient(F.col(_POS), F.lit(chunk_rows)).alias(_CHUNK)
    known = _file_facts(df)
    if "row_index" in known:
        placed = df.select("*", F.col("_metadata.file_path").alias(_FILE), pos.alias(_POS))
        return placed.select("*", chunk)
    number = F.monotonically_increasing_id()
    if {"file_path", "file_block_start"} <= known:
        start = F.lpad(F.col("_metadata.file_block_start").cast("string"), 20, "0")
        file = F.concat_ws("#", F.col("_metadata.file_path"), start)
    else:
        file = F.lpad(F.spark_partition_id().cast("string"), 10, "0")
    return materialise(df.select("*", file.alias(_FILE), number.alias(_POS)), "placed").select("*", chunk)


def without_position(df: DataFrame) -> DataFrame:
    return df.drop(_FILE, _POS, _CHUNK)


def _sum_before(value: str, window) -> Column:
    total = F.sum(value).over(window.rowsBetween(W.unboundedPreceding, -1))
    return F.coalesce(total, F.lit(0))


def prefix_sums(df: DataFrame, order_by: list[Column], value: str | None, out: str) -> DataFrame:
    """Exclusive running sum of ``value`` (row numbers when None) over all rows.

    Rows are range partitioned and written, so both passes see the same
    chunks, whose number follows from the number of rows.  ``order_by`` must
    be unique for the result to be reproducible;
    a unique tie breaker also lets a frequent first key spread over chunks.
    """
    return _running(df, order_by, value, out)[0]


def _input_bytes(df: DataFrame) -> int:
    """Bytes of the tables that a plan reads, as far as they are known."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(s for s in sizes if s < UNKNOWN_BYTES)


def in_ranges(df: DataFrame, order_by: list[Column], name: str) -> tuple[DataFrame, int]:
    """``df`` written in ranges, numbered by ``_chunk``, and the number of its rows.

    Nothing is counted beforehand: the size of what the plan reads gives the number of ranges, of about ``CHUNK_BYTES``
    each.  Rows are counted in the tasks that write them, so none is counted twice.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-_input_bytes(df) // CHUNK_BYTES))
    ranged = df.repartitionByRange(parts, *order_by).withColumn(_CHUNK, F.spark_partition_id())
    seen = Observation()
    written = materialise(ranged.observe(seen, F.count(F.lit(1)).alias("n")), name)
    return written, seen.get["n"]


def _running(df: DataFrame, order_by: list[Column], value: str | None, out: str) -> tuple[DataFrame, int]:
    """Running sums and the number of rows."""
    ranged, rows = in_ranges(df, order_by, "ranged")
    amount = F.lit(1) if value is None else F.col(value)
    sums = ranged.groupBy(_CHUNK).agg(F.sum(amount).alias("_n"))
    # one row per chunk
    offsets = sums.select(_CHUNK, _sum_before("_n", W.orderBy(_CHUNK)).alias(_BASE))
    inside = W.partitionBy(_CHUNK).orderBy(*order_by)
    if value is None:
        local = F.row_number().over(inside) - 1
    else:
        local = F.coalesce(F.sum(value).over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    summed = ranged.join(offsets, _CHUNK).withColumn(out, (F.col(_BASE) + local).cast("long"))
    return summed.drop(_CHUNK, _BASE), rows


def _position_cells(placed: DataFrame, *keys: str) -> DataFrame:
    """Row counts per chunk: a summary of one row per ``CHUNK_ROWS`` rows."""
    return materialise(
        placed.groupBy(*keys, _FILE, _CHUNK).agg(
            F.count("*").alias("_n"), F.min(_POS).alias("_lo"), F.max(_POS).alias("_hi")
        ),
        "cells",
    )


def indexed(df: DataFrame, out: str = "row_idx", order_by=None) -> tuple[DataFrame, int]:
    """``df`` with a 0-based global index, and the number of rows."""
    if order_by is not None:
        order = [F.col(c) if isinstance(c, str) else c for c in order_by]
        numbered, total = _running(df, order, None, out)
        return numbered, total
    placed = with_position(df)
    cells = _position_cells(placed)
    facts = cells.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("_hi") - F.col("_lo") + 1 - F.col("_n")), F.lit(0)).alias("gaps"),
    ).first()
    offsets = cells.select(
        _FILE, _CHUNK, "_lo", _sum_before("_n", W.orderBy(_FILE, _CHUNK)).alias(_BASE)
    )
    joined = placed.join(offsets, [_FILE, _CHUNK])
    if facts["gaps"] == 0:
        place = F.col(_POS) - F.col("_lo")
    else:
        place = F.row_number().over(W.partitionBy(_FILE, _CHUNK).orderBy(_POS)) - 1
    numbered = joined.withColumn(out, (F.col(_BASE) + place).cast("long")).drop("_lo", _BASE)
    return without_position(numbered), facts["rows"]


def row_index(df: DataFrame, order_by=None, out: str = "row_idx") -> DataFrame:
    """Global 0-based index in file order, or in the order of ``order_by``."""
    return indexed(df, out, order_by)[0]


def indexed_by_key(df: DataFrame, key: str, out: str = "row_idx") -> tuple[DataFrame, int]:
    """Index over (key, file position), nulls first, and the number of rows.

    A frequent key is spread over its position chunks; no task ever holds
    more than one chunk of one key.
    """
    # a struct is never null itself, so null keys join and share the shuffle of the rest
    placed = with_position(df).withColumn("_k", F.struct(F.col(key).alias("v")))
    cells = _position_cells(placed, "_k")
    totals = cells.groupBy("_k").agg(F.sum("_n").alias("_n"))
    key_base = prefix_sums(totals, [F.col("_k.v").asc_nulls_first()], "_n", "_key_base")
    in_key = W.partitionBy("_k").orderBy(_FILE, _CHUNK)
    bases = (
        cells.withColumn("_cell_base", _sum_before("_n", in_key))
        .join(key_base.select("_k", "_key_base"), "_k")
        .select("_k", _FILE, _CHUNK, (F.col("_key_base") + F.col("_cell_base")).alias(_BASE))
    )
    cell = ["_k", _FILE, _CHUNK]
    place = F.row_number().over(W.partitionBy(*cell).orderBy(_POS)) - 1
    numbered = placed.join(bases, cell).withColumn(out, (F.col(_BASE) + place).cast("long"))
    total = totals.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    return without_position(numbered).drop("_k", _BASE), total


def batch_index(df: DataFrame, size: int, idx: str = "row_idx", out: str = "batch_idx") -> DataFrame:
    """Batch number of an indexed row; the last batch may be short."""
    return df.withColumn(out, whole_quotient(F.col(idx), F.lit(size)))


def sample_n(df: DataFrame, n: int, key: list[str], seed: int = 0) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, uniform and reproducible.

    Rows are ordered by a hash of their key.  Counts of hash ranges tell the
    range that holds the last wanted row; ranges below it are taken whole, so
    only the rows of that one range, about ``rows / SAMPLE_RANGES``, are sorted.
    """
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed)))
    hashed = df.withColumn("_h", F.md5(text))
    ranged = hashed.withColumn("_r", F.conv(F.substring("_h", 1, 4), 16, 10).cast("int"))
    counts = ranged.groupBy("_r").agg(F.count("*").alias("_n"))
    # a window over at most SAMPLE_RANGES rows
    before = F.coalesce(F.sum("_n").over(W.orderBy("_r").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    last = counts.withColumn("_before", before).filter(F.col("_before") < n).agg(
        F.max("_r").alias("r"), F.max("_before").alias("taken")
    ).first()
    if last["r"] is None:
        return df.limit(0)
    whole = ranged.filter(F.col("_r") < last["r"])
    part = ranged.filter(F.col("_r") == last["r"]).orderBy("_h", *key).limit(n - last["taken"])
    return whole.unionByName(part).drop("_h", "_r")
