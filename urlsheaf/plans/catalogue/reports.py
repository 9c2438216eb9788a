"""Outcome summaries, run reports, performance logs and task timings."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from urlsheaf.operators import outcomes, report
from urlsheaf.plans.catalogue.inputs import OUTCOMES, outcome_rows, table
from urlsheaf.plans.catalogue.registry import query
from urlsheaf.session import materialise, scratch_path
from urlsheaf.sinks.logs import write_logs
from urlsheaf.sinks.reports import overview_documents, write_overview, write_report
from urlsheaf.sources.logs import read_performance_log
from urlsheaf.sources.overviews import OVERVIEW, overview_columns, read_overviews

_FAIL = "count(*) FILTER (NOT success)"
_OK = "count(*) FILTER (success)"
_MB = "sum(bytes_downloaded) / 1e6"
_SUMMARY = f"""count(*) AS total_urls, {_OK} AS successful_downloads, {_FAIL} AS failed_downloads,
  round({_OK} * 100.0 / count(*), 2) AS success_rate_percent, round({_MB}, 3) AS downloaded_mb,
  round(CAST({{secs}} AS DOUBLE), 3) AS elapsed_sec, round({_MB} / {{secs}}, 3) AS avg_speed_mbps"""


@query("overview_summary", f"WITH {OUTCOMES} SELECT {_SUMMARY.format(secs='5025.5')} FROM outcomes")
def _(spark, sf):
    return outcomes.overview_summary(outcome_rows(spark, sf), elapsed=5025.5)


@query(
    "error_breakdown",
    f"WITH {OUTCOMES} SELECT coalesce(status_code, 0) AS status_code, error, count(*) AS n FROM outcomes WHERE NOT success GROUP BY 1, 2",
)
def _(spark, sf):
    counted = outcomes.error_breakdown(outcome_rows(spark, sf))
    return counted.withColumn("status_code", F.coalesce("status_code", F.lit(0)))


@query(
    "path_collisions",
    f"""WITH {OUTCOMES} SELECT file_path, count(DISTINCT row_key) AS n_keys FROM outcomes WHERE success
GROUP BY file_path HAVING count(DISTINCT row_key) > 1""",
)
def _(spark, sf):
    return outcomes.path_collisions(outcome_rows(spark, sf))


@query(
    "job_progress",
    f"""WITH {OUTCOMES} SELECT count(*) AS completed, {_OK} AS successful, {_FAIL} AS failed,
  round(count(*) * 100.0 / 1000000, 6) AS progress_percent, round({_OK} * 100.0 / count(*), 6) AS success_percent,
  round({_MB} / 321.5, 6) AS throughput_mbps FROM outcomes""",
)
def _(spark, sf):
    progress = outcomes.job_progress(outcome_rows(spark, sf), 1_000_000, 321.5)
    shares = ["progress_percent", "success_percent", "throughput_mbps"]
    return progress.select("completed", "successful", "failed", *[F.round(c, 6).alias(c) for c in shares])


_GROUPS = f"""per_group AS (SELECT "group", {_SUMMARY.format(secs='60.0')} FROM outcomes GROUP BY "group")"""


def _documents(spark, sf):
    return overview_documents(outcome_rows(spark, sf), {"url_column": "url"}, 60.0, "group")


def _overviews(spark, sf):
    doc = F.from_json("overview", OVERVIEW)
    parsed = _documents(spark, sf).select("group", doc.alias("doc"))
    return parsed.select(*overview_columns(F.col("group").cast("string"), F.col("doc")))


@query(
    "read_overviews",
    f"""WITH {OUTCOMES}, {_GROUPS} SELECT CAST("group" AS VARCHAR) AS partition_name, total_urls, successful_downloads,
  failed_downloads, success_rate_percent, downloaded_mb, elapsed_sec, avg_speed_mbps,
  coalesce(n_errors, 0) AS n_errors, coalesce(top_error, '') AS top_error
FROM per_group LEFT JOIN (
  SELECT "group", count(*) AS n_errors, arg_min(coalesce(error, ''), (-n, coalesce(status_code, -1))) AS top_error
  FROM (SELECT "group", status_code, error, count(*) AS n FROM outcomes WHERE NOT success GROUP BY ALL)
  GROUP BY "group") USING ("group")""",
)
def _(spark, sf):
    out = scratch_path(spark, "overviews")
    write_overview(_documents(spark, sf), out, "group")
    return read_overviews(spark, out).select(
        "partition_name",
        "total_urls",
        "successful_downloads",
        "failed_downloads",
        "success_rate_percent",
        "downloaded_mb",
        "elapsed_sec",
        "avg_speed_mbps",
        F.size("errors").cast("long").alias("n_errors"),
        F.coalesce(F.get("errors", F.lit(0))["error"], F.lit("")).alias("top_error"),
    )


@query(
    "run_totals",
    f"""WITH {OUTCOMES}, {_GROUPS} SELECT CAST(sum(total_urls) AS BIGINT) AS total_urls,
  CAST(sum(successful_downloads) AS BIGINT) AS successful_downloads,
  CAST(sum(failed_downloads) AS BIGINT) AS failed_downloads, round(sum(downloaded_mb), 3) AS downloaded_mb FROM per_group""",
)
def _(spark, sf):
    return report.run_totals(_overviews(spark, sf)).withColumn("downloaded_mb", F.round("downloaded_mb", 3))


@query(
    "run_errors",
    f"""WITH {OUTCOMES} SELECT coalesce(CAST(status_code AS VARCHAR), 'unknown') AS status_code, error, count(*) AS n
FROM outcomes WHERE NOT success GROUP BY 1, 2""",
)
def _(spark, sf):
    return report.run_errors(_overviews(spark, sf))


_SPREAD = """round(min(success_rate_percent), 2) AS success_rate_min, round(max(success_rate_percent), 2) AS success_rate_max,
  round(avg(success_rate_percent), 2) AS success_rate_avg, round(min(avg_speed_mbps), 2) AS throughput_mbps_min,
  round(max(avg_speed_mbps), 2) AS throughput_mbps_max, round(avg(avg_speed_mbps), 2) AS throughput_mbps_avg"""


@query(
    "partition_stats",
    f"WITH {OUTCOMES}, {_GROUPS} SELECT count(*) AS n_partitions, {_SPREAD} FROM per_group",
)
def _(spark, sf):
    return report.partition_stats(_overviews(spark, sf))


def performance_log(spark, sf, runs: int = 20):
    """Write one manager log per run, with its header line, and read them back."""
    events = table(spark, sf, "events").withColumn("run", F.col("user_id") % runs)
    stamp = F.unix_micros(F.col("ts").cast("timestamp"))
    fields = [stamp, F.col("value").cast("int"), F.lit(0), F.col("event_id"), F.get_json_object("props", "$.k"), F.col("event_id") * 1000]
    rows = events.select("run", stamp.alias("at"), F.concat_ws(" ", *[f.cast("string") for f in fields]).alias("value"))
    title = "# timestamp workers_connected workers_idle tasks_done tasks_failed bytes_received"
    heads = events.select("run").distinct().select("run", F.lit(-1).cast("long").alias("at"), F.lit(title).alias("value"))
    out = scratch_path(spark, "performance")
    if runs == 1:
        _write_long_logs(rows.unionByName(heads), [r["run"] for r in heads.select("run").collect()], out)
    else:
        laid = rows.unionByName(heads).repartition("run").sortWithinPartitions("run", "at")
        laid.select("run", "value").write.partitionBy("run").text(out)
    return read_performance_log(spark, f"{out}/run=*")


def _write_long_logs(lines, runs, out):
    """One file for each of a few runs: lines are sorted by many tasks, and one only hands them on."""
    laid = lines.orderBy("at").persist(StorageLevel.DISK_ONLY)
    laid.count()
    for run in runs:
        folder = "__HIVE_DEFAULT_PARTITION__" if run is None else run
        of_run = laid.filter(F.col("run").eqNullSafe(F.lit(run))).select("value")
        of_run.coalesce(1).write.text(f"{out}/run={folder}")
    laid.unpersist()




def _run():
    return F.regexp_extract("file", r"run=(\d+)", 1).cast("long").alias("run")


_PERF = """perf AS (
  SELECT user_id % {n} AS run, epoch_us(ts) AS ts, event_id, CAST(trunc(value) AS BIGINT) AS workers,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS failed FROM events)"""


@query(
    "read_performance_log",
    f"""WITH {_PERF.format(n=20)} SELECT run, ts AS timestamp, workers AS workers_connected, event_id AS tasks_done,
  failed AS tasks_failed, event_id * 1000 AS bytes_received FROM perf""",
)
def _(spark, sf):
    return performance_log(spark, sf).withColumn("run", _run()).drop("file", "line_no")


@query(
    "read_performance_log_layouts",
    """SELECT user_id AS run, epoch_us(ts) AS timestamp, CAST(trunc(value) AS BIGINT) AS workers_connected,
  event_id AS tasks_done, CAST(json_extract_string(props, '$.k') AS BIGINT) AS tasks_failed,
  event_id * 1000 AS bytes_received FROM events""",
)
def _(spark, sf):
    """One log per user, each with a layout of its own."""
    events = table(spark, sf, "events")
    stamp = F.unix_micros(F.col("ts").cast("timestamp"))
    names = ["workers_connected", "tasks_done", "tasks_failed", "bytes_received"]
    fields = [F.col("value").cast("int"), F.col("event_id"), F.get_json_object("props", "$.k"), F.col("event_id") * 1000]
    own = F.concat(F.lit("x"), F.col("user_id").cast("string"))
    title = F.concat(F.lit(f"# timestamp {' '.join(names[:2])} "), own, F.lit(f" {' '.join(names[2:])}"))
    value = F.concat_ws(" ", *[f.cast("string") for f in (stamp, *fields[:2], F.lit(0), *fields[2:])])
    rows = events.select("user_id", stamp.alias("at"), value.alias("value"))
    heads = events.select("user_id").distinct().select("user_id", F.lit(-1).cast("long").alias("at"), title.alias("value"))
    out = scratch_path(spark, "layouts")
    write_logs(rows.unionByName(heads), "user_id", "at", out)
    run = F.regexp_extract("file", r"user_id=(\d+)", 1).cast("long").alias("run")
    return read_performance_log(spark, f"{out}/*").withColumn("run", run).drop("file", "line_no")


_PERF_SUMS = """sums AS (
  SELECT run, min(ts) AS t0, max(ts) AS t1, max(workers) AS peak_workers, arg_max(event_id, ts) AS tasks_completed,
         arg_max(failed, ts) AS tasks_failed, arg_max(event_id, ts) * 1000 AS bytes_received FROM perf GROUP BY run),
runs AS (SELECT *, (t1 - t0) / 1e6 AS wall_sec, CAST(trunc((t1 - t0) / 1e6) AS BIGINT) AS s FROM sums)"""
_WALL = """CASE WHEN s >= 3600 THEN (s // 3600) || 'h ' || (s % 3600 // 60) || 'm ' || (s % 60) || 's'
  WHEN s >= 60 THEN (s // 60) || 'm ' || (s % 60) || 's' ELSE s || 's' END"""


@query(
    "performance_summary",
    f"""WITH {_PERF.format(n=20)}, {_PERF_SUMS} SELECT run, t0 AS start_us, t1 AS end_us, wall_sec, {_WALL} AS wall_human,
  tasks_completed, tasks_failed, peak_workers, bytes_received FROM runs""",
)
def _(spark, sf):
    sums = report.performance_summary(performance_log(spark, sf)).withColumn("run", _run())
    return sums.select(
        "run",
        F.unix_micros("run_start").alias("start_us"),
        F.unix_micros("run_end").alias("end_us"),
        "wall_sec",
        "wall_human",
        "tasks_completed",
        "tasks_failed",
        "peak_workers",
        "bytes_received",
    )


@query(
    "run_report",
    f"""WITH {OUTCOMES}, {_GROUPS}, {_PERF.format(n=1)}, {_PERF_SUMS}, totals AS (
  SELECT sum(total_urls) AS u, sum(successful_downloads) AS ok, sum(failed_downloads) AS bad, sum(downloaded_mb) AS mb
  FROM per_group), stats AS (SELECT count(*) AS n_partitions, {_SPREAD} FROM per_group)
SELECT strftime(make_timestamp(t0), '%Y-%m-%d %H:%M:%S') AS run_start,
  strftime(make_timestamp(t1), '%Y-%m-%d %H:%M:%S') AS run_end, round(wall_sec, 2) AS total_wall_time_sec,
  {_WALL} AS total_wall_time_human, tasks_completed, tasks_failed, peak_workers,
  round(bytes_received / 1099511627776.0, 2) AS "bytes_received_TB",
  CAST(u AS BIGINT) AS total_urls, CAST(ok AS BIGINT) AS successful_downloads, CAST(bad AS BIGINT) AS failed_downloads,
  round(ok * 100.0 / u, 2) AS success_rate_percent, round(mb / 1048576.0, 2) AS "total_downloaded_TB",
  round(mb / wall_sec, 2) AS "effective_throughput_MBps", n_partitions, success_rate_min, success_rate_max, success_rate_avg,
  throughput_mbps_min, throughput_mbps_max, throughput_mbps_avg, 'logs/run' AS run_directory, 'out' AS output_directory,
  strftime(make_timestamp(t0), '%Y-%m-%d') AS run_date, CAST(NULL AS VARCHAR) AS config_file,
  (SELECT string_agg(s || '|' || e || '|' || n, ';' ORDER BY n DESC, s, e) FROM (
     SELECT coalesce(CAST(status_code AS VARCHAR), 'unknown') AS s, coalesce(error, 'Unknown error') AS e, count(*) AS n
     FROM outcomes WHERE NOT success GROUP BY 1, 2)) AS errors
FROM runs, totals, stats""",
)
def _(spark, sf):
    views = _overviews(spark, sf)
    performance = report.performance_summary(performance_log(spark, sf, runs=1))
    views = materialise(views, "views")
    told = {"run_directory": "logs/run", "config_file": None, "output_directory": "out"}
    made = report.run_report(
        performance, report.run_totals(views), report.partition_stats(views), report.run_errors(views), told
    )
    path = scratch_path(spark, "report")
    write_report(made, path)
    back = spark.read.schema(made.schema).json(path)
    return back.select(
        "run_stats.*",
        "download_stats.*",
        F.col("partition_stats.count").alias("n_partitions"),
        *[F.col(f"partition_stats.success_rate.{k}").alias(f"success_rate_{k}") for k in ("min", "max", "avg")],
        *[F.col(f"partition_stats.throughput_MBps.{k}").alias(f"throughput_mbps_{k}") for k in ("min", "max", "avg")],
        "run_info.*",
        F.array_join(
            F.transform("error_breakdown", lambda e: F.concat_ws("|", e["status_code"], e["error"], e["count"].cast("string"))), ";"
        ).alias("errors"),
    )


def tasks(spark, sf):
    """Task metrics: one task per order line, times in microseconds."""
    submitted = F.unix_micros(F.col("l_shipdate").cast("timestamp"))
    start = submitted + (F.col("l_quantity") * 1_000_000).cast("long")
    end = start + F.col("l_linenumber").cast("long") * 100_000
    ok = F.col("l_returnflag") != "R"
    printed = F.concat(
        F.lit("Download time:         "), F.col("l_quantity").cast("string"), F.lit("s (85.0%)\nTar creation time:     "),
        F.col("l_discount").cast("string"), F.lit("s (15.0%)\n"),
    )
    return table(spark, sf, "lineitem").select(
        ((F.col("l_quantity") * 400_000).cast("long")).alias("time_workers_execute_last"),
        F.when(F.col("l_linestatus") == "F", start).otherwise(0).alias("time_when_commit_start"),
        end.alias("time_when_commit_end"),
        submitted.alias("time_when_submitted"),
        (end + 250_000).alias("time_when_done"),
        F.col("l_orderkey").alias("bytes_sent"),
        F.col("l_partkey").alias("bytes_received"),
        printed.alias("output"),
        ok.alias("successful"),
    )


_TASKS = """tasks AS (
  SELECT CAST(l_quantity * 400000 AS BIGINT) / 1e6 AS exec_sec, l_returnflag <> 'R' AS ok, l_quantity, l_discount,
         CASE WHEN l_linestatus = 'F' THEN l_linenumber / 10.0 ELSE 0 END AS output_sec,
         l_quantity + l_linenumber / 10.0 + 0.25 AS whole, epoch_us(l_shipdate) AS submitted, l_orderkey, l_partkey
  FROM lineitem),
times AS (SELECT *, greatest(0, whole - exec_sec - output_sec) AS input_sec FROM tasks),
sums AS (SELECT sum(exec_sec) AS e, sum(input_sec) AS i, sum(output_sec) AS o, sum(l_quantity) FILTER (ok) AS d,
                sum(l_discount) FILTER (ok) AS t, sum(l_partkey) AS r, sum(l_orderkey) AS s FROM times)"""


@query(
    "timing_breakdown",
    f"""WITH {_TASKS} SELECT round(e, 3) AS exec_sec, round(i, 3) AS input_sec, round(o, 3) AS output_sec,
  round(d, 3) AS download_sec, round(t, 3) AS tar_sec, CAST(r AS BIGINT) AS bytes_received, CAST(s AS BIGINT) AS bytes_sent,
  round(e + i + o, 3) AS measured_sec, round(e * 100 / (e + i + o), 6) AS exec_percent,
  round(i * 100 / (e + i + o), 6) AS input_percent, round(o * 100 / (e + i + o), 6) AS output_percent,
  round(d * 100 / (e + i + o), 6) AS download_percent, round(t * 100 / (e + i + o), 6) AS tar_percent FROM sums""",
)
def _(spark, sf):
    sums = report.timing_breakdown(tasks(spark, sf))
    digits = {"_sec": 3, "_percent": 6}
    shown = []
    for c in sums.columns:
        places = next((n for end, n in digits.items() if c.endswith(end)), None)
        shown.append(F.col(c) if places is None else F.round(c, places).alias(c))
    return sums.select(*shown)


@query(
    "task_tally",
    """SELECT count(*) AS completed, count(*) FILTER (l_returnflag = 'R') AS failed,
  count(*) FILTER (l_returnflag <> 'R') AS successful,
  round((max(epoch_us(l_shipdate) + CAST(l_quantity * 1000000 AS BIGINT) + l_linenumber * 100000 + 250000)
   - min(epoch_us(l_shipdate))) / 1e6, 3) AS elapsed_sec FROM lineitem""",
)
def _(spark, sf):
    return report.task_tally(tasks(spark, sf)).withColumn("elapsed_sec", F.round("elapsed_sec", 3))
