"""Reading manager performance logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urlsheaf.session import materialise

# The columns a performance log must have.
REQUIRED = ("timestamp", "workers_connected", "tasks_done", "tasks_failed", "bytes_received")
# Bytes of a file that is read as a whole; a larger one, or one that has to be unpacked, is read by line and may be split.
WHOLE = 4 << 20
PACKED = r"(?i)\.(gz|gzip|bz2|deflate|snappy|lz4|zst|zstd)$"
# Bytes that opening a file counts as where files are small: by Spark's 4 MB, a task would get 32 of them.
OPENING = 64 << 10


def _is_small():
    # of what is known when files are listed, so the others are not opened
    return (F.col("_metadata.file_size") <= WHOLE) & ~F.col("_metadata.file_name").rlike(PACKED)


def _small_logs(spark: SparkSession, path: str) -> DataFrame:
    """``file, lines`` of each small file that is not empty."""
    whole = spark.read.text([path], wholetext=True).where(_is_small() & (F.col("_metadata.file_size") > 0))
    text = F.regexp_replace("value", "^\ufeff", "")
    logs = whole.select(F.col("_metadata.file_path").alias("file"), F.split(text, "\r\n|\r|\n").alias("lines"))
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(OPENING))
    try:
        return materialise(logs, "small")
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", cost)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines of the other files, with their file and place in it.

    Rows of one split come in order, and splits are told apart by their
    start, so the pair orders the lines of a file however it was split.
    """
    return spark.read.text([path]).where(~_is_small()).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")
        ).alias("line_no"),
    )


def _with_places(headers: DataFrame) -> DataFrame:
    """``headers`` with the 1-based places of the required columns, 0 where there is none."""
    names = F.split(F.regexp_replace("header", r"^[#\s]+|\s+$", ""), r"\s+")
    return headers.select("*", *[F.array_position(names, c).cast("int").alias(f"_at_{c}") for c in REQUIRED])


def read_performance_log(spark: SparkSession, path: str) -> DataFrame:
    """``file, line_no`` and the required columns, located by each file's header.

    Logs may differ in layout: a line is cut by the header of its own file.  A
    log without a required column, or without a line below its header, is
    rejected.
    """
    # there may be a file for every few lines: each is opened once, and its lines stay with their header
    small = _with_places(_small_logs(spark, path).withColumn("header", F.get("lines", F.lit(0))))
    lines = materialise(_lines(spark, path), "lines")
    starts = lines.filter(F.col("line_no.block") == 0)
    headers = _with_places(starts.groupBy("file").agg(F.min_by("value", "line_no").alias("header")))
    headers = materialise(headers, "headers")
    told = small.drop("lines").unionByName(headers)
    if told.isEmpty():
        raise ValueError(f"no performance log at {path}")
    lacking = [F.when(F.col(f"_at_{c}") == 0, F.lit(c)) for c in REQUIRED]
    missing = told.select(F.concat_ws(", ", *lacking).alias("m")).filter("m <> ''").first()
    if missing:
        raise ValueError(f"missing required column(s) {missing['m']} in performance log")
    is_below = (F.col("value") != F.col("header")) & (F.trim("value") != "")
    below = lines.join(headers, "file").filter(is_below)
    # a file may hold most of the lines: only its name is joined
    bare = headers.join(below.select("file").distinct(), "file", "left_anti").select("file")
    some = F.exists("lines", lambda v: (v != F.col("header")) & (F.trim(v) != ""))
    bare = small.where(~some).select("file").unionByName(bare).first()
    if bare:
        raise ValueError(f"performance log without a line below its header: {bare['file']}")
    row = F.struct(F.lit(0).cast("long").alias("block"), F.col("_row").cast("long").alias("row"))
    of_small = small.select("*", F.posexplode("lines").alias("_row", "value")).filter(is_below).withColumn("line_no", row)
    fields = F.split(F.trim("value"), r"\s+")
    columns = [F.get(fields, F.col(f"_at_{c}") - 1).try_cast("long").alias(c) for c in REQUIRED]
    return of_small.select("file", "line_no", *columns).unionByName(below.select("file", "line_no", *columns))
