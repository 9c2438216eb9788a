"""Status codes, errors and retry rules."""

from __future__ import annotations

from http import HTTPStatus
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Phrases that mark a connection-level failure, statuses that
# mean "too many requests" or "took too long", and the outcome messages.
CONNECTION_PHRASES = (
    "connection reset by peer",
    "server disconnected",
    "connection refused",
    "cannot connect",
    "connection aborted",
    "broken pipe",
    "timeout",
    "timed out",
)
TOO_MANY_REQUESTS = 429
REQUEST_TIMEOUT = 408
TIMEOUT_TEXT = "Request Timeout"
INVALID_URL_TEXT = "Invalid or empty URL"
UNKNOWN_PHRASE = "Unknown"

PHRASES = {s.value: s.phrase for s in HTTPStatus}


def is_connection_error(error: Column) -> Column:
    """True when the message names a connection-level failure."""
    return F.coalesce(F.lower(error).rlike("|".join(CONNECTION_PHRASES)), F.lit(False))


def _pressure(status: Column) -> Column:
    hot = status.isin(TOO_MANY_REQUESTS, REQUEST_TIMEOUT) | (status >= 500)
    return F.coalesce(hot, F.lit(False))


def is_retryable(status: Column, error: Column) -> Column:
    """Worth another attempt: throttled, timed out, server side or no connection."""
    return _pressure(status) | is_connection_error(error)


def is_overload(status: Column, conn_error: Column) -> Column:
    """Counts as an error in telemetry; every other answer is a success."""
    return _pressure(status) | F.coalesce(conn_error, F.lit(False))


def status_phrase(status: Column) -> Column:
    """Standard phrase of a status code."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(PHRASES.items())])
    return F.coalesce(F.try_element_at(table, status.cast("int")), F.lit(UNKNOWN_PHRASE))


def status_error(status: Column, kind: Column, detail: Column, prefix: str = "HTTP {code}") -> Column:
    """Outcome message; null for status 200.

    ``kind`` is ``http``, ``timeout``, ``connection`` or anything else.
    ``prefix`` may be ``HTTP Error`` for the variant without the code.
    """
    head = F.concat(F.lit("HTTP "), status.cast("string")) if "{code}" in prefix else F.lit(prefix)
    answered = F.when(status != 200, F.concat(head, F.lit(": "), status_phrase(status)))
    text = F.coalesce(detail, F.lit(""))
    return (
        F.when(kind == "http", answered)
        .when(kind == "timeout", F.lit(TIMEOUT_TEXT))
        .when(kind == "connection", F.concat(F.lit("Connection Error: "), text))
        .otherwise(F.concat(F.lit("Error: "), text))
    )


def parse_retry_after(header: Column) -> Column:
    """Seconds; dates and other text give null."""
    number = F.trim(header).rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$")
    return F.when(number, F.trim(header).try_cast("double"))


def content_range_total(header: Column) -> Column:
    """Total size named by a Content-Range header."""
    return F.regexp_extract(header, r"/\s*(\d+)\s*$", 1).try_cast("long")
