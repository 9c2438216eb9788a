"""Interval metrics, signals and control against plain loops; streams against batch."""

import random
from collections import deque
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest

from urlsheaf.operators import control, intervals, signals
from urlsheaf.operators.control import BACKOFF, INIT, PROBE_BW, PROBE_RTT, STARTUP, Host, Policy, advance
from urlsheaf.streaming import control as stream_control
from urlsheaf.streaming import telemetry as live

START = datetime(2024, 5, 1, tzinfo=timezone.utc)
LOG = "host string, ts timestamp, status_code int, ttfb double, bytes long, is_conn_error boolean, retry_after double"


def make_log(n=2000, seed=1, hosts=4, seconds=300):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        host = "hot" if i % 3 == 0 else f"h{rng.randrange(hosts)}"
        status = rng.choice([200] * 30 + [404, 404, 429, 503, None])
        rows.append(
            (host, START + timedelta(seconds=rng.random() * seconds), status, rng.choice([None, 0.0] + [rng.random() ** 3] * 20),
             rng.choice([0, 10, 5000]), status is None, rng.choice([None, None, 1.5, 3.0]) if status == 429 else None)
        )
    return rows


def plain(rows, seconds=10, least=5):
    cells = {}
    for host, ts, status, ttfb, size, conn, wait in rows:
        at = int(ts.timestamp()) // seconds * seconds
        cell = cells.setdefault((host, at), {"ok": [], "bad": 0, "lat": [], "wait": []})
        if conn or status in (429, 408) or (status or 0) >= 500:
            cell["bad"] += 1
        else:
            cell["ok"].append(size)
            if ttfb:
                cell["lat"].append(ttfb)
        if wait is not None:
            cell["wait"].append((ts, wait))
    return {
        k: (len(c["ok"]) + c["bad"], len(c["ok"]), len(c["lat"]), sum(c["ok"]), max(c["wait"])[1] if c["wait"] else None,
            [float(np.percentile(c["lat"], p)) for p in (10, 50, 95)] if len(c["lat"]) >= least else [None] * 3)
        for k, c in cells.items()
    }


def by_cell(df):
    return {
        (r["host"], int(r["interval_start"].replace(tzinfo=timezone.utc).timestamp())): r
        for r in df.collect()
    }


def check_snapshot(got, want):
    assert set(got) == set(want)
    for key, (total, ok, n, size, wait, marks) in want.items():
        r = got[key]
        assert (r["total"], r["n_success"], r["n_samples"], r["bytes"], r["retry_after"]) == (total, ok, n, size, wait)
        assert r["has_overload"] == (ok < total) and r["goodput_rps"] == pytest.approx(ok / 10)
        for name, mark in zip(("p10_raw", "p50_raw", "p95_raw"), marks):
            assert r[name] == (None if mark is None else pytest.approx(mark, rel=1e-12))


@pytest.fixture(scope="module")
def log_rows():
    return make_log()


def test_snapshot(spark, log_rows):
    log = spark.createDataFrame(log_rows, LOG)
    check_snapshot(by_cell(intervals.interval_snapshot(log, "10 seconds")), plain(log_rows))


def test_percentile_example(spark):
    rows = [("h", START, 200, v, 1, False, None) for v in (1.0, 2.0, 3.0, 10.0)]
    log = spark.createDataFrame(rows, LOG)
    assert intervals.interval_percentiles(log, "10 seconds").first()["p95_raw"] is None
    got = intervals.interval_percentiles(log, "10 seconds", min_samples=1).first()
    assert got["p95_raw"] == pytest.approx(8.95)
    same = spark.createDataFrame(rows[:1] * 50, LOG)
    assert intervals.interval_percentiles(same, "10 seconds").first()["p50_raw"] == 1.0


def test_requests_without_a_host(spark):
    rows = [(None, START, 200, 0.1 * (i + 1), 1, False, None) for i in range(6)]
    got = intervals.interval_snapshot(spark.createDataFrame(rows, LOG), "10 seconds").collect()
    assert [(r["host"], r["total"]) for r in got] == [("unknown", 6)]
    assert got[0]["p50_raw"] == pytest.approx(0.35)


def test_success_by_status(spark):
    rows = [("h", START, s, 0.1, 1, False, None) for s in (200, 301, 404, 500)]
    got = intervals.interval_metrics(spark.createDataFrame(rows, LOG), "10 seconds", intervals.BY_STATUS).first()
    assert (got["n_success"], got["n_errors"]) == (2, 2)


def interval_rows(spark, hosts):
    """One row per host and 10-second interval from lists of column values."""
    rows = []
    for host, values in hosts.items():
        for i, v in enumerate(values):
            rows.append((host, START + timedelta(seconds=10 * i), START + timedelta(seconds=10 * i + 10), *v))
    return rows


@pytest.mark.parametrize("alpha", [0.3, 0.1, 0.9, 1.0])
def test_ema(spark, alpha):
    rng = random.Random(9)
    hosts = {
        h: [(None if i < lead or rng.random() < 0.3 else rng.random(),) for i in range(1300)]
        for h, lead in (("a", 0), ("b", 700), ("c", 2000))
    }
    df = spark.createDataFrame(interval_rows(spark, hosts), "host string, interval_start timestamp, interval_end timestamp, x double")
    got = signals.ema(df, {"x": "smooth"}, alpha).orderBy("host", "interval_start").collect()
    at = 0
    for host in sorted(hosts):
        value = None
        for (x,) in hosts[host]:
            if x is not None:
                value = x if value is None else alpha * x + (1 - alpha) * value
            assert got[at]["smooth"] == (None if value is None else pytest.approx(value, rel=1e-9))
            at += 1


def test_rtprop(spark):
    values = [(5.0,), (3.0,), (None,), (4.0,), (6.0,), (7.0,), (None,), (9.0,)]
    df = spark.createDataFrame(interval_rows(spark, {"h": values}), "host string, interval_start timestamp, interval_end timestamp, p10_raw double")
    got = [r["rtprop"] for r in signals.rtprop(df, 35).orderBy("interval_start").collect()]
    assert got == [5.0, 3.0, 3.0, 3.0, 3.0, 4.0, 4.0, 6.0]
    assert [r["rtprop"] for r in signals.rtprop(df, reset=True).orderBy("interval_start").collect()][2] == 3.0


def test_signals(spark):
    schema = "host string, interval_start timestamp, interval_end timestamp, p50 double, p95 double, rtprop double, goodput_rps double, concurrency int, retry_after double, avg_file_size double"
    values = [
        (0.1, 0.1, None, 10.0, 10, None, None),
        (0.1, 0.25, 0.1, 2.0, 10, 5.0, 100.0),
        (0.2, 0.1, 0.1, 0.5, 10, 0.0, 100.0),
        (None, None, 0.1, 3.0, 10, 1.0, 100.0),
        (0.1, 0.1, 0.1, 4.0, 10, None, 100.0),
        (0.1, 0.5, 1.0, 90.0, 10, None, 100.0),
    ]
    df = spark.createDataFrame(interval_rows(spark, {"h": values}), schema)

    def column(made, name):
        return [r[name] for r in made.orderBy("interval_start").collect()]

    slow = signals.latency_degraded(df)
    assert column(slow, "degraded") == [False, True, True, False, False, False]
    assert column(slow, "degraded_start") == [False, True, False, False, False, False]
    assert column(signals.latency_plateau(df), "latency_plateau") == [False] * 6
    assert column(signals.cooldown(df), "cooldown") == [2.0, 5.0, 2.0, 2.0, 2.0, 5.0]
    assert column(signals.control_interval(df), "control_interval") == [5.0, 25.0, 100.0, pytest.approx(50 / 3), 12.5, 8.0]
    under = signals.underperformance(df, runs=2)
    assert column(under, "streak") == [1, 2, 2, 3, 4, 0]
    assert column(under, "revise_ceiling") == [False, True, False, False, True, False]
    assert column(signals.inferred_rate(df), "inferred_bps") == [None] + [10_000.0] * 4 + [1000.0]
    assert column(signals.efficiency_plateau(df, 1), "efficiency_plateau") == [False, True, True, False, False, False]
    history = column(signals.goodput_history(df, 3), "goodput_history")
    assert history[-1] == [3.0, 4.0, 90.0] and history[0] == [10.0]


# --- control ---------------------------------------------------------------


def seen(total=100, n=60, overload=False, rps=50.0, wait=None, p=(0.1, 0.1, 0.1)):
    return {"total": total, "n_samples": n, "has_overload": overload, "goodput_rps": rps, "retry_after": wait,
            "p10_raw": p[0], "p50_raw": p[1], "p95_raw": p[2]}


def host(**state):
    h = Host.fresh(Policy())
    for k, v in state.items():
        setattr(h, k, v)
    return h


def test_init():
    h, p = Host.fresh(Policy()), Policy()
    assert (h.state, h.c) == (INIT, 4)
    assert advance(h, seen(n=60), 10, p) == "sampling"
    assert advance(h, seen(total=0, n=0, p=(None,) * 3), 20, p) == "idle"
    assert advance(h, seen(n=40), 30, p) == "sampled" and h.state == STARTUP and h.goodput == []
    h = Host.fresh(p)
    assert advance(h, seen(overload=True), 10, p) == "overload"
    assert (h.state, h.ceiling, h.c, h.cool_until) == (BACKOFF, 4, 4, 12.0)


def test_startup():
    p = Policy()
    h = host(state=STARTUP, c=4)
    advance(h, seen(), 10, p)
    assert h.c == 34
    advance(h, seen(overload=True, wait=60.0), 20, p)
    assert (h.state, h.ceiling, h.c, h.cool_until) == (BACKOFF, 17, 14, 80.0)
    h = host(state=STARTUP, c=100, rtprop=0.01, window=[[9, 0.01]])
    assert advance(h, seen(), 10, p) == "plateau"
    assert (h.state, h.ceiling, h.c, h.last_probe, h.since_probe) == (PROBE_BW, 100, 85, 10, 0)
    h = host(state=STARTUP, c=p.c_max)
    assert advance(h, seen(), 10, p) == "maximum" and h.c == 8500
    h = host(state=STARTUP, c=30, goodput=[40.0, 41.0, 42.0, 43.0, 44.0])
    assert advance(h, seen(rps=43.0), 10, Policy(plateau="derivative")) == "plateau"
    h = host(state=STARTUP, c=30, goodput=[40.0, 45.0, 50.0, 55.0, 60.0])
    assert advance(h, seen(rps=65.0), 10, Policy(plateau="derivative")) == "grow"


def test_probe_bw():
    p = Policy()
    base = {"state": PROBE_BW, "c": 85, "ceiling": 100, "operating": 85, "last_probe": 5.0}
    h = host(**base)
    assert advance(h, seen(rps=900.0), 10, p) == "grow" and h.c == 95
    h = host(**base | {"c": 120})
    advance(h, seen(rps=900.0), 10, p)
    assert (h.ceiling, h.operating, h.c) == (120, 102, 130)
    h = host(**base)
    advance(h, seen(overload=True), 10, p)
    assert (h.state, h.ceiling, h.c) == (BACKOFF, 50, 42)
    h = host(**base, rtprop=0.05, window=[[9, 0.05]])
    assert advance(h, seen(), 10, p) == "degraded" and h.c == 85
    h = host(**base, since_probe=50)
    assert advance(h, seen(n=60), 16, p) == "probe"
    assert (h.state, h.saved, h.c) == (PROBE_RTT, 85, 42)
    h = host(**base, since_probe=40)
    assert advance(h, seen(n=60), 16, p) == "grow"  # needs more than 100 samples
    h = host(**base, streak=4)
    assert advance(h, seen(rps=1.5), 10, p) == "revised"
    assert (h.ceiling, h.operating, h.c, h.streak) == (99, 84, 94, 0)
    h = host(**base, streak=4)
    advance(h, seen(rps=0.5), 10, p)
    assert h.streak == 4


def test_probe_rtt():
    p = Policy()
    h = host(state=PROBE_RTT, c=42, saved=85, ceiling=100, operating=85)
    h.rtprop, h.window = 0.05, [[1, 0.05]]
    assert advance(h, seen(), 10, p) == "settle" and h.rtprop == 0.05 and len(h.window) == 1
    steps = []
    for t in range(11, 30):
        reason = advance(h, seen(), t, p)
        steps.append(h.c)
        if reason == "restored":
            break
    assert steps[:3] == [63, 74, 79] and steps[-1] == 85
    assert (h.state, h.saved, h.restoring, h.since_probe) == (PROBE_BW, None, False, 0)
    assert len(h.window) > 1  # trusted after the first interval
    h = host(state=PROBE_RTT, c=42, saved=85, ceiling=100, restoring=True)
    advance(h, seen(overload=True), 10, p)
    assert (h.state, h.ceiling, h.c, h.saved, h.restoring) == (BACKOFF, 50, 42, 85, True)


def test_backoff():
    p = Policy()
    h = host(state=BACKOFF, c=40, ceiling=50, last_cut=10.0, cool_until=12.0)
    assert advance(h, seen(overload=True), 11, p) == "cooling" and h.c == 40
    assert advance(h, seen(overload=True), 13.5, p) == "overload"
    assert (h.c, h.ceiling, h.last_cut) == (20, 25, 13.5)
    assert advance(h, seen(), 15.5, p) == "recovered"
    assert (h.state, h.c, h.last_probe) == (PROBE_BW, 21, 15.5)
    h = host(state=BACKOFF, c=3, ceiling=3, cool_until=0.0)
    advance(h, seen(overload=True), 100, p)
    assert (h.c, h.ceiling) == (2, 2)


def test_variant_for_thread_pools():
    p = control.THREADED
    h = host(state=STARTUP, c=40)
    advance(h, seen(), 10, p)
    assert h.c == 50
    advance(h, seen(overload=True), 20, p)
    assert (h.ceiling, h.c) == (49, 41)
    h.c = 30
    advance(h, seen(), 60, p)
    assert (h.state, h.c) == (PROBE_BW, 30)
    h.c = 300
    advance(h, seen(rps=1e6), 61, p)
    assert h.c == 306


def test_advice_reaches_requests(spark):
    advice = spark.createDataFrame(
        [("a", START, 5), ("a", START + timedelta(seconds=10), 9)], "host string, interval_start timestamp, concurrency int"
    )
    wanted = spark.createDataFrame([("a",), ("b",)], "host string")
    got = control.with_host_caps(wanted, advice)
    assert sorted(tuple(r) for r in got.collect()) == [("a", 9), ("b", None)]


def test_rtprop_gate():
    p = Policy(rtprop_window=35, probe_period=1e9)
    h = host(state=PROBE_BW, ceiling=100, c=50, operating=50)
    lows, window, rtprop = [0.3, 0.2, 0.5, 0.4, 0.6, 0.6, 0.1, 0.2], deque(), None
    for i, low in enumerate(lows):
        now = 10.0 * (i + 1)
        while window and window[0][0] < now - 35:
            window.popleft()
        if rtprop is None or low < rtprop:
            window.append((now, low))
        rtprop = min(v for _, v in window) if window else rtprop
        advance(h, seen(p=(low, low, low)), now, p)
        assert h.state == PROBE_BW and h.rtprop == rtprop


def test_state_survives_storage():
    p, a = Policy(), Host.fresh(Policy())
    rng = random.Random(4)
    b = Host.fresh(p)
    for i in range(300):
        s = seen(n=rng.randrange(80), overload=rng.random() < 0.1, rps=rng.random() * 400, p=tuple(rng.random() for _ in range(3)))
        assert advance(a, s, 10.0 * i, p) == advance(b, s, 10.0 * i, p)
        b = Host.load(b.dump())
        assert a == b


def advice_rows(df):
    return sorted(tuple(r) for r in df.select("host", "interval_start", "state", "concurrency", "ceiling", "reason", "rtprop").collect())


def test_batch_control_equals_a_loop(spark, log_rows):
    p = Policy(init_samples=10, probe_samples=5, probe_period=20.0)
    rows = intervals.interval_snapshot(spark.createDataFrame(log_rows, LOG), "10 seconds")
    got = advice_rows(control.recommend_concurrency(rows, p))
    want, hosts = [], {}
    for r in rows.orderBy("interval_start").collect():
        h = hosts.setdefault(r["host"], Host.fresh(p))
        reason = advance(h, r.asDict(), r["interval_end"].replace(tzinfo=timezone.utc).timestamp(), p)
        want.append((r["host"], r["interval_start"], h.state, h.c, h.ceiling, reason, h.rtprop))
    assert got == sorted(want)
    assert {r[2] for r in got} >= {PROBE_BW, BACKOFF}


@pytest.fixture(scope="module")
def log_stream(spark, log_rows):
    """The log as files in time order, read one file per micro-batch."""
    import tempfile

    path = tempfile.mkdtemp(prefix="urlsheaf-log-")
    ordered = sorted(log_rows, key=lambda r: r[1])
    for i in range(0, len(ordered), 500):
        spark.createDataFrame(ordered[i : i + 500], LOG).coalesce(1).write.mode("append").parquet(path)
    return lambda: (
        spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(path)
    )


def closed(rows):
    last = max(r[1] for r in rows) - timedelta(minutes=1)
    return {k: v for k, v in plain(rows).items() if k[1] + 10 <= last.timestamp()}


def test_streamed_snapshot_equals_batch(spark, log_rows, log_stream):
    got = live.run_available(live.stream_interval_metrics(log_stream(), "10 seconds"))
    check_snapshot(by_cell(got), closed(log_rows))


def test_streamed_control_equals_batch(spark, log_rows, log_stream):
    p = Policy(init_samples=10, probe_samples=5, probe_period=20.0)
    snapshots = live.stream_interval_metrics(log_stream(), "10 seconds")
    got = advice_rows(live.run_available(stream_control.stream_concurrency(snapshots, p)))
    rows = intervals.interval_snapshot(spark.createDataFrame(log_rows, LOG), "10 seconds")
    batch = advice_rows(control.recommend_concurrency(rows, p))
    done = {(h, t) for h, t, *_ in got}
    assert len(got) > 50 and got == [r for r in batch if r[:2] in done]


def test_late_rows_are_dropped_and_counted(spark, folder):
    early = [("h", START + timedelta(seconds=i), 200, 0.1, 1, False, None) for i in range(5)]
    later = [("h", START + timedelta(seconds=600), 200, 0.1, 1, False, None)]
    path = f"{folder}/log"
    spark.createDataFrame(early + later, LOG).coalesce(1).write.parquet(path)
    stream = live.stream_interval_metrics(spark.readStream.schema(LOG).parquet(path), "10 seconds")
    options = {"checkpointLocation": f"{folder}/state", "path": f"{folder}/out"}

    def run():
        query = stream.writeStream.options(**options).format("parquet").trigger(availableNow=True).start()
        query.awaitTermination()
        return query

    assert live.late_rows(run()) == 0
    spark.createDataFrame(early[:3], LOG).coalesce(1).write.mode("append").parquet(path)
    assert live.late_rows(run()) > 0
    assert [r["total"] for r in spark.read.parquet(f"{folder}/out").collect()] == [5]


def test_streamed_progress(spark, folder):
    rows = spark.createDataFrame([(i % 4 > 0, 1000 * i, float(i)) for i in range(8)], "success boolean, bytes_downloaded long, elapsed double")
    rows.coalesce(1).write.parquet(f"{folder}/o")
    stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/o")
    got = live.run_available(live.stream_job_progress(stream, 16), "complete").first()
    assert (got["completed"], got["successful"], got["progress_percent"], got["success_percent"]) == (8, 6, 50.0, 75.0)
    assert got["throughput_mbps"] == pytest.approx(0.028 / 7)


def test_bounded_percentiles(spark, log_stream):
    got = live.run_available(intervals.streaming_snapshot(log_stream(), "10 seconds", accuracy=1000))
    assert got.filter("p50_raw is not null").count() > 0


def test_progress_of_an_empty_job(spark):
    from urlsheaf.operators.outcomes import job_progress, overview_summary

    empty = spark.createDataFrame([], "success boolean, bytes_downloaded long")
    assert tuple(job_progress(empty, 0, 0.0).first()) == (0, 0, 0, 0.0, 0.0, 0.0)
    assert tuple(overview_summary(empty).first()) == (0, 0, 0, 0.0, 0.0, 0.0, 0.0)
