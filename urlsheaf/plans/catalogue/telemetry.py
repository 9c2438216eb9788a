"""Interval metrics, signals, control and their streaming forms."""

from __future__ import annotations

import contextlib

from pyspark.sql import functions as F

from urlsheaf.operators import control, intervals, signals, sketches
from urlsheaf.plans.catalogue.inputs import INTERVAL, LOG, OUTCOMES, RTPROP_SECONDS, log_columns, outcome_rows, request_log, table
from urlsheaf.plans.catalogue.registry import query
from urlsheaf.session import materialise, scratch_path
from urlsheaf.streaming import control as stream_control
from urlsheaf.streaming import signals as live_signals
from urlsheaf.streaming import telemetry as live
from urlsheaf.streaming.progress import ProgressTotals

_AT = "CAST(epoch(interval_start) AS BIGINT) AS at"
_SECS = 21600.0
_BY_PRESSURE = "NOT (coalesce(status_code IN (429, 408) OR status_code >= 500, false) OR is_conn_error)"
_BY_STATUS = "coalesce(status_code BETWEEN 200 AND 399, false)"


def _sql_metrics(ok: str, least: int) -> str:
    """CTE ``metrics``: one row per host and interval."""
    sample = f"CASE WHEN {ok} AND ttfb > 0 THEN ttfb END"
    marks = ", ".join(
        f"CASE WHEN count({sample}) >= {least} THEN quantile_cont({sample}, {p}) END AS p{int(p * 100)}_raw"
        for p in (0.10, 0.50, 0.95)
    )
    return f"""metrics AS (
  SELECT host, time_bucket(INTERVAL '6 hours', ts) AS interval_start, count(*) AS total,
         count(*) FILTER ({ok}) AS n_success, count(*) FILTER (NOT ({ok})) AS n_errors, count({sample}) AS n_samples,
         CAST(coalesce(sum(bytes) FILTER ({ok}), 0) AS BIGINT) AS bytes,
         arg_max(retry_after, ts) FILTER (retry_after IS NOT NULL) AS retry_after,
         avg(bytes) FILTER (({ok}) AND bytes > 0) AS mean_file_size, {marks}
  FROM log GROUP BY 1, 2)"""


METRICS = f"{LOG}, {_sql_metrics(_BY_PRESSURE, 5)}"
_COUNTED = f"""SELECT host, {_AT}, total, n_success, n_errors, n_samples, bytes, n_errors > 0 AS has_overload,
  round(n_success / {_SECS}, 9) AS goodput_rps, round(bytes / {_SECS}, 9) AS goodput_bps, CAST({_SECS} AS DOUBLE) AS duration, retry_after,
  round(mean_file_size, 9) AS mean_file_size FROM metrics"""


def _at(df, *kept):
    return df.select("host", F.unix_seconds("interval_start").alias("at"), *kept)


def _r(name: str):
    return F.round(name, 9).alias(name)


def _single(name: str):
    """Single precision, where sums are taken in different orders."""
    return F.col(name).cast("float").alias(name)


def _counted(df):
    return _at(
        df, "total", "n_success", "n_errors", "n_samples", "bytes", "has_overload", _r("goodput_rps"), _r("goodput_bps"),
        "duration", "retry_after", _r("mean_file_size"),
    )


@query("interval_metrics", f"WITH {METRICS} {_COUNTED}")
def _(spark, sf):
    return _counted(intervals.interval_metrics(request_log(spark, sf), INTERVAL))


@query("interval_metrics_by_status", f"WITH {LOG}, {_sql_metrics(_BY_STATUS, 1)} {_COUNTED}")
def _(spark, sf):
    return _counted(intervals.interval_metrics(request_log(spark, sf), INTERVAL, intervals.BY_STATUS))


_MARKS = "round(p10_raw, 9) AS p10_raw, round(p50_raw, 9) AS p50_raw, round(p95_raw, 9) AS p95_raw"


@query("interval_percentiles", f"WITH {METRICS} SELECT host, {_AT}, n_samples, {_MARKS} FROM metrics WHERE n_samples > 0")
def _(spark, sf):
    marks = intervals.interval_percentiles(request_log(spark, sf), INTERVAL)
    return _at(marks, "n_samples", _r("p10_raw"), _r("p50_raw"), _r("p95_raw"))


@query(
    "interval_percentiles_any",
    f"WITH {LOG}, {_sql_metrics(_BY_STATUS, 1)} SELECT host, {_AT}, n_samples, {_MARKS} FROM metrics WHERE n_samples > 0",
)
def _(spark, sf):
    marks = intervals.interval_percentiles(request_log(spark, sf), INTERVAL, 1, intervals.BY_STATUS)
    return _at(marks, "n_samples", _r("p10_raw"), _r("p50_raw"), _r("p95_raw"))


def _snapshot(spark, sf):
    """Interval rows of the log, written, as several signals read them."""
    return materialise(intervals.interval_snapshot(request_log(spark, sf), INTERVAL), "snapshot")


def _sql_ema(source: str, cols: dict[str, str], alpha: float) -> str:
    """CTEs up to ``smooth(host, interval_start, ...)``."""
    step = ", ".join(
        f"CASE WHEN o.{c} IS NULL THEN s.{out} WHEN s.{out} IS NULL THEN o.{c} ELSE {alpha} * o.{c} + {1 - alpha} * s.{out} END"
        for c, out in cols.items()
    )
    first = ", ".join(f"CAST({c} AS DOUBLE) AS {out}" for c, out in cols.items())
    return f"""ordered AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY host ORDER BY interval_start) AS rn FROM {source}),
smooth AS (
  SELECT host, interval_start, rn, {first} FROM ordered WHERE rn = 1
  UNION ALL
  SELECT o.host, o.interval_start, o.rn, {step} FROM smooth s JOIN ordered o ON o.host = s.host AND o.rn = s.rn + 1)"""


_LATENCY = {"p10_raw": "p10", "p50_raw": "p50", "p95_raw": "p95"}


@query(
    "ema",
    f"""WITH RECURSIVE {METRICS}, {_sql_ema('metrics', _LATENCY, 0.3)}
SELECT host, {_AT}, CAST(p10 AS FLOAT) AS p10, CAST(p50 AS FLOAT) AS p50, CAST(p95 AS FLOAT) AS p95 FROM smooth""",
)
def _(spark, sf):
    return _at(signals.ema(_snapshot(spark, sf), _LATENCY), _single("p10"), _single("p50"), _single("p95"))


@query(
    "avg_size_ema",
    f"""WITH RECURSIVE {METRICS}, {_sql_ema('metrics', {'mean_file_size': 'avg_file_size'}, 0.1)}
SELECT host, {_AT}, CAST(avg_file_size AS FLOAT) AS avg_file_size FROM smooth""",
)
def _(spark, sf):
    return _at(signals.avg_size_ema(_snapshot(spark, sf)), _single("avg_file_size"))


_RTPROP = f"""lowest AS (
  SELECT *, CASE WHEN p10_raw IS NOT NULL THEN min(p10_raw) OVER (PARTITION BY host ORDER BY epoch(interval_start)
              RANGE BETWEEN {RTPROP_SECONDS} PRECEDING AND CURRENT ROW) END AS low FROM metrics),
latent AS (SELECT *, last_value(low IGNORE NULLS) OVER (PARTITION BY host ORDER BY interval_start
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rtprop FROM lowest)"""


def _latent(spark, sf):
    return signals.rtprop(_snapshot(spark, sf), RTPROP_SECONDS)


@query("rtprop", f"WITH {METRICS}, {_RTPROP} SELECT host, {_AT}, round(rtprop, 9) AS rtprop FROM latent")
def _(spark, sf):
    return _at(_latent(spark, sf), _r("rtprop"))


@query(
    "goodput_history",
    f"""WITH {METRICS} SELECT host, {_AT}, len(h) AS n, round(h[1], 9) AS oldest, round(h[-1], 9) AS newest FROM (
  SELECT host, interval_start, list(n_success / {_SECS}) OVER (PARTITION BY host ORDER BY interval_start
    ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS h FROM metrics)""",
)
def _(spark, sf):
    history = signals.goodput_history(_snapshot(spark, sf))
    ends = history.select("*", F.get("goodput_history", F.lit(0)).alias("oldest"), F.element_at("goodput_history", -1).alias("newest"))
    return _at(ends, F.size("goodput_history").cast("long").alias("n"), _r("oldest"), _r("newest"))


# Signal rows: raw percentiles stand for smoothed ones, counts give concurrency.
SIGNALS = f"""{METRICS}, {_RTPROP}, rows AS (
  SELECT host, interval_start, p50_raw AS p50, p95_raw AS p95, rtprop, n_errors AS concurrency, retry_after,
         n_success * 100.0 - 600 AS goodput_rps, mean_file_size AS avg_file_size FROM latent)"""


def _signal_rows(spark, sf):
    return _latent(spark, sf).select(
        "host",
        "interval_start",
        F.col("p50_raw").alias("p50"),
        F.col("p95_raw").alias("p95"),
        "rtprop",
        F.col("n_errors").alias("concurrency"),
        "retry_after",
        (F.col("n_success") * 100.0 - 600).alias("goodput_rps"),
        F.col("mean_file_size").alias("avg_file_size"),
    )


def _sql_slow(a: float, b: float) -> str:
    return f"(coalesce(p50 > rtprop * {a}, false) OR coalesce(p95 > rtprop * {b}, false))"


@query(
    "latency_degraded",
    f"""WITH {SIGNALS}, flagged AS (SELECT *, {_sql_slow(8, 30)} AS degraded FROM rows)
SELECT host, {_AT}, degraded, degraded AND NOT lag(degraded, 1, false) OVER (PARTITION BY host ORDER BY interval_start)
  AS degraded_start FROM flagged""",
)
def _(spark, sf):
    return _at(signals.latency_degraded(_signal_rows(spark, sf), 8, 30), "degraded", "degraded_start")


@query("latency_plateau", f"WITH {SIGNALS} SELECT host, {_AT}, {_sql_slow(3.0, 4.0)} AS latency_plateau FROM rows")
def _(spark, sf):
    return _at(signals.latency_plateau(_signal_rows(spark, sf)), "latency_plateau")


@query(
    "efficiency_plateau",
    f"""WITH {SIGNALS}, past AS (
  SELECT *, lag(goodput_rps, 2) OVER (PARTITION BY host ORDER BY interval_start) AS old FROM rows)
SELECT host, {_AT}, coalesce(old > 0 AND concurrency - 2 > 0 AND
  (goodput_rps - old) / 2 * (concurrency - 2) < old * 0.5, false) AS efficiency_plateau FROM past""",
)
def _(spark, sf):
    return _at(signals.efficiency_plateau(_signal_rows(spark, sf), 2), "efficiency_plateau")


@query(
    "cooldown",
    f"""WITH {SIGNALS} SELECT host, {_AT}, round(greatest(5 * coalesce(rtprop, 0.2), 2.0,
  CASE WHEN retry_after > 0 THEN retry_after ELSE 0 END), 9) AS cooldown FROM rows""",
)
def _(spark, sf):
    return _at(signals.cooldown(_signal_rows(spark, sf)), _r("cooldown"))


@query(
    "control_interval",
    f"""WITH {SIGNALS} SELECT host, {_AT}, round(greatest(8 * coalesce(rtprop, 0.2),
  CASE WHEN goodput_rps > 0 THEN 50 / goodput_rps ELSE 0.2 END, 0.2), 9) AS control_interval FROM rows""",
)
def _(spark, sf):
    return _at(signals.control_interval(_signal_rows(spark, sf)), _r("control_interval"))


_SQL_STREAKS = f"""WITH {SIGNALS}, flagged AS (
  SELECT *, goodput_rps >= 1 AND goodput_rps < concurrency / coalesce(rtprop, 0.2) * 0.5 AS low,
         goodput_rps >= 1 AND NOT goodput_rps < concurrency / coalesce(rtprop, 0.2) * 0.5 AS fine FROM rows),
islands AS (SELECT *, sum(CAST(fine AS INTEGER)) OVER (PARTITION BY host ORDER BY interval_start
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM flagged),
streaks AS (SELECT *, sum(CAST(low AS INTEGER)) OVER (PARTITION BY host, island ORDER BY interval_start
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS streak FROM islands)
SELECT host, {_AT}, CAST(streak AS BIGINT) AS streak, low AND streak % 2 = 0 AS revise_ceiling FROM streaks"""


@query("underperformance", _SQL_STREAKS)
def _(spark, sf):
    return _at(signals.underperformance(_signal_rows(spark, sf), runs=2), "streak", "revise_ceiling")


@query(
    "inferred_rate",
    f"""WITH {SIGNALS} SELECT host, {_AT}, round(concurrency / rtprop, 6) AS inferred_rps,
  round(concurrency / rtprop * avg_file_size, 4) AS inferred_bps FROM rows""",
)
def _(spark, sf):
    rates = signals.inferred_rate(_signal_rows(spark, sf))
    return _at(rates, F.round("inferred_rps", 6).alias("inferred_rps"), F.round("inferred_bps", 4).alias("inferred_bps"))


def _advice(df):
    return _at(df, "state", "concurrency", "ceiling", "reason", _r("rtprop"), _r("p50"), _r("p95"))


# The events leave hours between requests, so the policy runs on hours here.
HOURLY = control.Policy(
    rtprop_window=RTPROP_SECONDS, probe_period=86_400.0, probe_samples=20, init_samples=10, cooldown_floor=30_000.0,
    recut_floor=80_000.0,
)


def _calm(log):
    """The log without its overload, which would keep every host backing off."""
    late = F.dayofmonth("ts") % 10 == 9
    return log.withColumn("status_code", F.when(late, F.col("status_code")).otherwise(200)).withColumn(
        "is_conn_error", late & F.col("is_conn_error")
    )


@query("recommend_concurrency")
def _(spark, sf):
    rows = intervals.interval_snapshot(_calm(request_log(spark, sf)), INTERVAL)
    return _advice(control.recommend_concurrency(rows, HOURLY))


@contextlib.contextmanager
def state_store(spark):
    """Keyed state needs the RocksDB store; the setting is given back afterwards."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, stream_control.STATE_STORE)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _live_log(spark, sf):
    schema = table(spark, sf, "events").schema
    return log_columns(live.read_log_stream(spark, sf, schema, "events.parquet"))


_CLOSED = "interval_start + INTERVAL '6 hours' <= (SELECT max(ts) FROM log) - INTERVAL '1 minute'"


@query("stream_interval_metrics", f"WITH {METRICS} {_COUNTED} WHERE {_CLOSED}")
def _(spark, sf):
    return _counted(live.run_available(live.stream_interval_metrics(_live_log(spark, sf), INTERVAL)))


@query("stream_interval_percentiles", f"WITH {METRICS} SELECT host, {_AT}, n_samples, {_MARKS} FROM metrics WHERE {_CLOSED}")
def _(spark, sf):
    rows = live.run_available(live.stream_interval_metrics(_live_log(spark, sf), INTERVAL))
    return _at(rows, "n_samples", _r("p10_raw"), _r("p50_raw"), _r("p95_raw"))


@query("stream_concurrency")
def _(spark, sf):
    stream = live.stream_interval_metrics(_calm(_live_log(spark, sf)), INTERVAL)
    with state_store(spark):
        return _advice(live.run_available(stream_control.stream_concurrency(stream, HOURLY)))


def _streamed_signals(spark, sf, **settings):
    """Signals of the interval rows as a stream that reads a third of the time at a time."""
    rows = _snapshot(spark, sf).select(
        "host", "interval_start", "interval_end", "p10_raw", "p50_raw", "p95_raw", "mean_file_size",
        F.col("n_errors").alias("concurrency"), (F.col("n_success") * 100.0 - 600).alias("goodput_rps"),
    )
    folder = scratch_path(spark, "intervals")
    began, ended = rows.agg(F.min("interval_start"), F.max("interval_start")).first()
    for k in range(3):
        part = F.least(F.floor((F.unix_seconds("interval_start") - F.unix_seconds(F.lit(began))) * 3 / max(1, (ended - began).total_seconds())), F.lit(2))
        rows.filter(part == k).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    plan = live_signals.Signals(window_seconds=RTPROP_SECONDS, **settings)
    with state_store(spark):
        return live.run_available(live_signals.stream_signals(stream, plan))


@query(
    "stream_ema",
    f"""WITH RECURSIVE {METRICS}, {_sql_ema('metrics', _LATENCY, 0.3)}
SELECT host, {_AT}, CAST(p10 AS FLOAT) AS p10, CAST(p50 AS FLOAT) AS p50, CAST(p95 AS FLOAT) AS p95 FROM smooth""",
)
def _(spark, sf):
    return _at(_streamed_signals(spark, sf), _single("p10"), _single("p50"), _single("p95"))


@query("stream_rtprop", f"WITH {METRICS}, {_RTPROP} SELECT host, {_AT}, round(rtprop, 9) AS rtprop FROM latent")
def _(spark, sf):
    return _at(_streamed_signals(spark, sf), _r("rtprop"))


@query("stream_underperformance", _SQL_STREAKS)
def _(spark, sf):
    return _at(_streamed_signals(spark, sf, runs=2), "streak", "revise_ceiling")


# Sketches are merged from hours to the interval; a host's sketch tells ranks within its bound.
_SQL_RANKS = f"""WITH {METRICS} SELECT host, {_AT}, n_samples, true AS p10_close, true AS p50_close, true AS p95_close
FROM metrics WHERE n_samples >= 5"""


def _close(df, log):
    """Whether the true ranks of the sketched percentiles are as near as the bound says."""
    cells = df.filter("n_samples >= 5").select("host", "interval_start", "n_samples", *intervals.PERCENTILES)
    samples = intervals.hosted_samples(log, INTERVAL).select("host", F.col("window.start").alias("interval_start"), "sample")
    ranks = [F.avg((F.col("sample") <= F.col(n)).cast("double")).alias(f"_{n}") for n in intervals.PERCENTILES]
    met = samples.join(cells, ["host", "interval_start"]).groupBy("host", "interval_start", "n_samples").agg(*ranks)
    slack = sketches.rank_error() + 1.0 / F.col("n_samples")
    close = [(F.abs(F.col(f"_{n}") - p) <= slack).alias(f"{n[:3]}_close") for n, p in intervals.PERCENTILES.items()]
    return _at(met, "n_samples", *close)


@query("sketched_percentiles", _SQL_RANKS)
def _(spark, sf):
    log = materialise(request_log(spark, sf), "log")
    hourly = materialise(sketches.latency_sketches(log, "1 hour"), "sketches")
    merged = sketches.sketched_percentiles(sketches.coarser(hourly, INTERVAL), 5)
    return _close(merged, log)


@query("stream_sketched_percentiles", f"{_SQL_RANKS} AND {_CLOSED}")
def _(spark, sf):
    stream = intervals.streaming_snapshot(_live_log(spark, sf), INTERVAL, live.LATENESS, sketch_k=sketches.QUANTILE_K)
    return _close(live.run_available(stream), request_log(spark, sf))


_SQL_LATE = f"""WITH {LOG}, early AS (SELECT * FROM log WHERE ts <= (SELECT max(ts) - INTERVAL '5 days' FROM log)),
due AS (SELECT DISTINCT host, time_bucket(INTERVAL '6 hours', ts) AS w FROM early)
SELECT (SELECT count(*) FROM log) + 1 AS kept, (SELECT count(*) FROM due) AS dropped"""


@query("stream_late_rows", _SQL_LATE)
def _(spark, sf):
    """All rows, the latest again, and then one more for each host and interval of the past: those are late, as the
    watermark of a batch holds for the next but one."""
    folder = scratch_path(spark, "log")
    rows = materialise(request_log(spark, sf), "log")
    rows.coalesce(1).write.parquet(folder)
    rows.orderBy(F.desc("ts"), "host").limit(1).coalesce(1).write.mode("append").parquet(folder)
    old = rows.filter(F.col("ts") <= rows.agg(F.max("ts") - F.expr("INTERVAL 5 DAYS")).first()[0])
    due = old.withColumn("_w", F.window("ts", INTERVAL)).dropDuplicates(["host", "_w"]).select(rows.columns)
    due.coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    with ProgressTotals(spark) as totals:
        live.run_available(live.stream_interval_metrics(stream, INTERVAL))
        told = totals.table()
    return told.select((F.col("input_rows") - F.col("late_rows")).alias("kept"), F.col("late_rows").alias("dropped"))


@query(
    "stream_job_progress",
    f"""WITH {OUTCOMES} SELECT count(*) AS completed, count(*) FILTER (success) AS successful,
  count(*) FILTER (NOT success) AS failed, round(count(*) * 100.0 / 1000000, 6) AS progress_percent,
  round(count(*) FILTER (success) * 100.0 / count(*), 6) AS success_percent,
  round(sum(bytes_downloaded) / 1e6 / max(elapsed), 6) AS throughput_mbps FROM outcomes""",
)
def _(spark, sf):
    folder = scratch_path(spark, "outcomes")
    rows = outcome_rows(spark, sf)
    rows.write.parquet(folder)
    stream = live.read_log_stream(spark, folder, rows.schema)
    done = live.run_available(live.stream_job_progress(stream, 1_000_000), "complete")
    shares = ["progress_percent", "success_percent", "throughput_mbps"]
    return done.select("completed", "successful", "failed", *[F.round(c, 6).alias(c) for c in shares])
