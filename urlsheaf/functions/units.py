"""Units, durations and timing text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from urlsheaf.functions.text import nonempty, whole_quotient

# Bytes per unit.  Both bases are in use and both are kept; the
# column names say which one applies.
BYTES_PER = {
    "kib": 1024.0,
    "mib": 1024.0**2,
    "gib": 1024.0**3,
    "tib": 1024.0**4,
    "mb": 1e6,
}
MB_PER_TB = 1024.0**2


def to_unit(size: Column, unit: str) -> Column:
    """Bytes in another unit, as double."""
    return size.cast("double") / F.lit(BYTES_PER[unit])


def human_duration(secs: Column, style: str = "words") -> Column:
    """``1h 2m 3s`` with leading zero units left out, or ``HH:MM:SS``."""
    whole = secs.cast("long")
    hours = whole_quotient(whole, F.lit(3600))
    minutes = whole_quotient(whole % 3600, F.lit(60))
    seconds = whole % 60
    if style == "clock":
        return F.format_string("%02d:%02d:%02d", hours, minutes, seconds)
    return (
        F.when(hours > 0, F.format_string("%dh %dm %ds", hours, minutes, seconds))
        .when(minutes > 0, F.format_string("%dm %ds", minutes, seconds))
        .otherwise(F.format_string("%ds", seconds))
    )


def parse_task_timing(output: Column) -> Column:
    """Struct ``download_sec, tar_sec`` read from a task's printed summary."""

    def seconds_after(title: str) -> Column:
        found = F.regexp_extract(output, title + r":\s+([\d.]+)s", 1)
        return nonempty(found).try_cast("double")

    return F.struct(
        seconds_after("Download time").alias("download_sec"),
        seconds_after("Tar creation time").alias("tar_sec"),
    )
