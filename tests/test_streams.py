"""Streamed signals against their batch forms, over restarts; progress of long streams; sketches; samples."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from urlsheaf.operators import intervals, sampling, signals, sketches
from urlsheaf.plans.catalogue.telemetry import state_store
from urlsheaf.streaming import telemetry as live
from urlsheaf.streaming.progress import ProgressTotals
from urlsheaf.streaming.signals import Signals, stream_signals

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
ROWS = (
    "host string, interval_start timestamp, interval_end timestamp, p10_raw double, p50_raw double, p95_raw double,"
    " goodput_rps double, concurrency long"
)
LOG = "host string, ts timestamp, status_code int, ttfb double, bytes long, is_conn_error boolean, retry_after double"


def interval_rows(hosts=4, n=60):
    random.seed(4)
    rows = []
    for h in range(hosts):
        for k in range(n):
            if random.random() < 0.15:
                continue
            at = START + timedelta(seconds=10 * k)
            low = None if random.random() < 0.2 else random.uniform(0.05, 1.0)
            rows.append((f"h{h}", at, at + timedelta(seconds=10), low, low and 2 * low, low and 3 * low, random.choice([0.0, 0.5, 2.0, 5.0, 40.0]), random.randrange(1, 9)))
    return rows


def batch_signals(df):
    made = signals.underperformance(signals.goodput_history(signals.rtprop(signals.ema(df, {"p10_raw": "p10", "p50_raw": "p50", "p95_raw": "p95"}))))
    return {(r["host"], r["interval_start"]): r for r in made.collect()}


def test_signals_over_batches_and_a_restart(spark, folder):
    rows = interval_rows()
    df = spark.createDataFrame(rows, ROWS)
    for k in range(6):  # a run for every two files, on the same state
        part = df.filter(F.col("interval_start").between(START + timedelta(seconds=100 * k), START + timedelta(seconds=100 * k + 99)))
        part.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        if k % 2:
            with state_store(spark):
                query = stream_signals(stream).writeStream.format("parquet").option("path", f"{folder}/out")
                query.option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(f"{folder}/out").collect()
    want = batch_signals(df)
    assert len(got) == len(want) == len(rows)
    for r in got:
        w = want[r["host"], r["interval_start"]]
        for name in ("p10", "p50", "p95", "rtprop"):
            assert r[name] == (None if w[name] is None else pytest.approx(w[name], rel=1e-9))
        assert r["goodput_history"] == w["goodput_history"]
        assert (r["streak"], r["revise_ceiling"]) == (w["streak"], w["revise_ceiling"])


def test_a_silent_host_is_forgotten(spark, folder):
    at = [START + timedelta(seconds=s) for s in (0, 10, 5000, 5010, 9000)]
    rows = [(h, t, t + timedelta(seconds=10), 0.1 + i, None, None, 2.0, 1) for i, t in enumerate(at) for h in ("a", "b") if h == "b" or i not in (1, 2, 3)]
    for i, t in enumerate(at):
        spark.createDataFrame([r for r in rows if r[1] == t], ROWS).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    with state_store(spark):
        got = live.run_available(stream_signals(stream, Signals(silence=timedelta(hours=1))))
    seen = {(r["host"], r["interval_start"].replace(tzinfo=timezone.utc)): r["p10"] for r in got.select("host", "interval_start", "p10").collect()}
    assert len(seen) == 7
    last = {h: p for (h, t), p in sorted(seen.items(), key=lambda x: x[0][1])}
    assert last["a"] == pytest.approx(4.1)  # began anew
    assert last["b"] < 4.0


def test_late_rows_of_a_long_stream(spark, folder):
    """More batches than a query remembers."""
    for k in range(110):
        late = START - timedelta(days=1)
        rows = [("h", START + timedelta(minutes=k), 200, 0.1, 1, False, None)] + [("h", late + timedelta(minutes=k), 200, 0.1, 1, False, None)] * (k >= 5)
        spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(f"{folder}/log")
    stream = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(f"{folder}/log")
    with ProgressTotals(spark, f"{folder}/progress", every=40) as totals:
        live.run_available(live.stream_interval_metrics(stream, "10 seconds", "10 seconds"))
        told = totals.table().first()
    assert told["late_rows"] == 105 and told["input_rows"] == 215 and told["batches"] >= 110
    kept = spark.read.parquet(f"{folder}/progress")
    assert kept.count() >= 3 and kept.agg(F.max("late_rows")).first()[0] == 105


def test_sketched_percentiles_are_close(spark):
    """Merged from small intervals, on a host with many samples: ranks within the bound."""
    log = spark.range(200_000).select(
        F.when(F.col("id") % 10 < 7, "hot").otherwise("cold").alias("host"),
        F.timestamp_seconds(F.col("id") % 3600 + 1_700_000_000).alias("ts"),
        F.lit(200).alias("status_code"),
        F.pow(F.rand(2), 3).alias("ttfb"),
        F.lit(1).cast("long").alias("bytes"),
        F.lit(False).alias("is_conn_error"),
        F.lit(None).cast("double").alias("retry_after"),
    ).cache()
    small = sketches.latency_sketches(log, "1 minute")
    merged = sketches.sketched_percentiles(sketches.coarser(sketches.coarser(small, "10 minutes"), "1 day"))
    got = {r["host"]: r for r in merged.collect()}
    for host, n in log.filter("ttfb > 0").groupBy("host").count().collect():
        assert got[host]["n_samples"] == n
        for name, p in intervals.PERCENTILES.items():
            below = log.filter((F.col("host") == host) & (F.col("ttfb") <= got[host][name])).count()
            assert abs(below / n - p) <= sketches.rank_error()
    limit = merged.select("host", sketches.sketched_rank("sketch", 0.125).alias("share")).collect()
    assert all(abs(r["share"] - 0.5) < 0.03 for r in limit)


def test_sketched_counts(spark):
    first = spark.range(60_000).select(F.concat(F.lit("http://h"), F.col("id") % 20_000, F.lit(".org/x"), "id").alias("url"), (F.col("id") % 2).cast("int").alias("group"))
    second = first.withColumn("url", F.replace("url", F.lit("http://h1"), F.lit("http://g1")))
    a, b = (sketches.host_sketches(d, "url") for d in (first, second))
    hosts = {r["group"]: r["n_hosts"] for r in sketches.estimated_hosts(sketches.merged_hosts(a, b)).collect()}
    both = first.unionByName(second).withColumn("host", F.regexp_extract("url", "//([^/]+)", 1))
    for group, n in both.groupBy("group").agg(F.count_distinct("host")).collect():
        assert abs(hosts[group] - n) <= 5 * sketches.distinct_error() * n
    shared = sketches.shared_hosts(a, spark.createDataFrame([(0, 0), (0, 1)], "a int, b int"))
    assert {(r["a"], r["b"]): round(r["n_shared"], -3) for r in shared.collect()} == {(0, 0): 10_000, (0, 1): 0}
    n = sketches.estimated_urls(sketches.url_sketch(first, "url"), sketches.url_sketch(second, "url")).first()[0]
    exact = both.agg(F.count_distinct("url")).first()[0]
    assert abs(n - exact) <= 5 * sketches.distinct_error() * exact


def test_sampled_totals_cover_the_truth(spark):
    """The interval holds the true total in about 95 of 100 seeded samples."""
    rows = spark.range(4000).select(
        "id", F.when(F.col("id") % 3 == 0, None).otherwise(F.concat(F.lit("h"), F.col("id") % 4)).alias("host"),
        (F.pmod(F.xxhash64("id"), F.lit(1000)) + 1).alias("kb"),
    ).cache()
    truth = rows.agg(F.sum("kb")).first()[0]
    hit, runs = 0, 40
    for seed in range(runs):
        sample = sampling.stratified_sample(rows, ["host"], ["id"], 40, seed)
        got = sampling.estimated_total(sampling.stratum_totals(sample, ["host"], "kb")).first()
        hit += got["low"] <= truth <= got["high"]
    assert hit >= 0.85 * runs
    whole = sampling.stratum_totals(sampling.stratified_sample(rows, ["host"], ["id"], 5000), ["host"], "kb")
    assert tuple(sampling.estimated_total(whole).first()) == (truth, 0.0, truth, truth)
    with pytest.raises(ValueError):
        sampling.stratified_sample(rows, ["host"], ["id"], 1)


def test_samples_merge(spark):
    rows = spark.range(900).select("id", F.when(F.col("id") % 5 > 0, F.col("id") % 3).alias("h"))
    parts = [sampling.stratified_sample(rows.filter(F.col("id") % 4 == k), ["h"], ["id"], 20, 7) for k in range(4)]
    merged = sampling.merged_samples(parts, ["h"], ["id"], 20).select("id", "h", "stratum_rows").collect()
    whole = sampling.stratified_sample(rows, ["h"], ["id"], 20, 7).select("id", "h", "stratum_rows").collect()
    assert len(whole) == 80 and sorted(map(str, merged)) == sorted(map(str, whole))
