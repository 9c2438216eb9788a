"""Fetching, retries, probing and sizes, with recorded and simulated answers."""

import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from urlsheaf.operators import fetch as fetching
from urlsheaf.operators import outcomes, probe
from urlsheaf.operators.requests import plan_requests, slice_by_host
from urlsheaf.operators.transport import HttpTransport, TableTransport
from urlsheaf.plans.collect import Job, collect_dataset, collect_outcomes, plan_only
from urlsheaf.sources.checkpoints import completed_batches, read_checkpoints

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def requests_for(spark, urls):
    rows = spark.createDataFrame([(str(i), u, "x") for i, u in enumerate(urls)], "row_key string, url string, label string")
    return plan_requests(rows, "url", label="label", out="out")


def recorded(spark, rows):
    schema = "url string, attempt int, status int, content binary, retry_after string"
    return TableTransport(spark.createDataFrame(rows, schema))


def test_fetch_outcomes(spark):
    answers = recorded(
        spark,
        [("u://h/ok", 1, 200, b"abc", None), ("u://h/empty", 1, 200, b"", None), ("u://h/busy", 1, 429, None, "7"),
         ("u://h/moved", 1, 301, b"m", None)],
    )
    urls = ["u://h/ok", "u://h/empty", "u://h/busy", "u://h/moved", "u://h/lost", " ", None]
    got = {r["url"]: r for r in fetching.fetch(requests_for(spark, urls), answers).collect()}
    assert (got["u://h/ok"]["success"], got["u://h/ok"]["bytes_downloaded"], got["u://h/ok"]["error"]) == (True, 3, None)
    assert (got["u://h/empty"]["success"], got["u://h/empty"]["bytes_downloaded"]) == (True, 0)
    assert (got["u://h/busy"]["error"], got["u://h/busy"]["retry_after"]) == ("HTTP 429: Too Many Requests", 7.0)
    assert got["u://h/moved"]["content"] is None and not got["u://h/moved"]["success"]
    assert (got["u://h/lost"]["status_code"], got["u://h/lost"]["error"]) == (None, "Connection Error: Cannot connect to host")
    for url in ("", None):
        assert (got[url]["error"], got[url]["file_path"]) == ("Invalid or empty URL", None)


def test_retry_until_nothing_is_left(spark, folder):
    rows = [("u://h/late", a, 200 if a == 3 else 503, b"z", None) for a in (1, 2, 3)]
    rows += [("u://h/never", a, 500, None, None) for a in (1, 2, 3)] + [("u://h/gone", 1, 404, None, None)]
    answers = recorded(spark, rows + [("u://h/ok", 1, 200, b"a", None)])
    wanted = requests_for(spark, ["u://h/late", "u://h/never", "u://h/gone", "u://h/ok"])
    got = fetching.fetch_with_retry(wanted, answers, work_dir=f"{folder}/w")
    seen = {r["url"]: (r["attempt"], r["success"]) for r in got.collect()}
    assert seen == {"u://h/late": (3, True), "u://h/never": (3, False), "u://h/gone": (1, False), "u://h/ok": (1, True)}
    # the same folder again: written attempts are read, nothing is fetched
    again = fetching.fetch_with_retry(wanted, recorded(spark, []), work_dir=f"{folder}/w")
    assert {r["url"]: (r["attempt"], r["success"]) for r in again.collect()} == seen


def test_upsert_and_last_attempt(spark):
    old = spark.createDataFrame([("a", 1, False), ("b", 1, True)], "row_key string, attempt int, success boolean")
    new = spark.createDataFrame([("a", 2, True), ("c", 2, False)], "row_key string, attempt int, success boolean")
    want = [("a", 2, True), ("b", 1, True), ("c", 2, False)]
    assert sorted(tuple(r) for r in outcomes.upsert_outcomes(old, new).collect()) == want
    assert sorted(tuple(r) for r in outcomes.last_attempts(old.unionByName(new)).collect()) == want


class Answer:
    def __init__(self, status, content=b"", headers=None):
        self.status_code, self.content, self.headers = status, content, headers or {}

    def __enter__(self):
        return self

    def __exit__(self, *_):
        pass


class Timeout(Exception):
    pass


class RequestException(Exception):
    pass


class Site:
    """Stands in for an HTTP client; opens no connection."""

    def get(self, url, timeout=None, stream=False, headers=None, allow_redirects=True):
        if "slow" in url:
            raise Timeout()
        if "down" in url:
            raise RequestException("Server disconnected")
        if "broken" in url:
            raise ValueError("odd")
        if headers and "Range" in headers:
            return Answer(206, headers={"Content-Range": "bytes 0-1023/4096"}) if "ranged" in url else Answer(404)
        if "busy" in url:
            return Answer(503, headers={"Retry-After": "4"})
        return Answer(404) if "gone" in url else Answer(200, url.encode())

    def head(self, url, timeout=None, allow_redirects=False):
        if "down" in url:
            raise RequestException("Server disconnected")
        if url.endswith(".png"):
            return Answer(200, headers={"Content-Length": "2048", "Content-Type": "image/png"})
        return Answer(404)


def test_http_outcomes(spark):
    urls = [f"http://h{i % 3}.org/{kind}/{i}" for i, kind in enumerate(["ok", "slow", "down", "broken", "busy", "gone"] * 20)]
    http = HttpTransport(session=Site, concurrency=8, rows_per_yield=16, rows_per_slice=10)
    got = fetching.fetch(requests_for(spark, urls + [""]), http).collect()
    assert len(got) == len(urls) + 1
    by_kind = {}
    for r in got:
        kind = r["url"].split("/")[3] if r["url"] else ""
        by_kind.setdefault(kind, set()).add((r["success"], r["status_code"], r["error"], r["retry_after"]))
        if kind == "ok":
            assert r["content"] == r["url"].encode() and r["ttfb"] >= 0 and r["ts"] is not None
    assert by_kind == {
        "ok": {(True, 200, None, None)},
        "slow": {(False, 408, "Request Timeout", None)},
        "down": {(False, None, "Connection Error: Server disconnected", None)},
        "broken": {(False, None, "Error: odd", None)},
        "busy": {(False, 503, "HTTP 503: Service Unavailable", 4.0)},
        "gone": {(False, 404, "HTTP 404: Not Found", None)},
        "": {(False, None, "Invalid or empty URL", None)},
    }


def test_host_caps_survive_retries(spark, folder):
    wanted = requests_for(spark, [f"http://h{i}.org/busy" for i in range(4)])
    capped = wanted.withColumn("host_cap", F.when(F.col("row_key") < "2", 1))
    got = fetching.fetch_with_retry(capped, HttpTransport(session=Site), 2, backoff=0.0)
    assert got.filter("attempt = 2 and status_code = 503").count() == 4
    assert got.filter("host_cap = 1").count() == 2


def test_slices_of_a_hot_host(spark):
    urls = [f"http://hot.org/{i}" for i in range(300)] + [f"http://h{i}.org/x" for i in range(20)]
    laid = slice_by_host(requests_for(spark, urls), rows_per_slice=40)
    assert laid.count() == len(urls)
    assert {r["host_slices"] for r in laid.filter("host = 'hot.org'").select("host_slices").collect()} == {8}
    placed = laid.filter("host = 'hot.org'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert placed > 1


def docs(spark, folder, urls):
    path = f"{folder}/docs"
    spark.createDataFrame([(u,) for u in urls], "url string").coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


PROBED = ["http://e/a.png", "http://e/b.gif", "http://e/c", "http://down/d.jpg", "http://e/f.PNG"]


def test_probe_over_http_and_table_agree(spark, folder):
    answers = [(u, 200) for u in ("http://e/a.png", "http://e/b.png", "http://e/c.png")]
    table = TableTransport(spark.createDataFrame(answers, "url string, status int"))
    df = docs(spark, folder, PROBED)
    for transport in (table, HttpTransport(session=Site)):
        got = probe.probe_extensions(df, "url", transport).orderBy("idx").collect()
        assert [(r["corrected_url"], r["extension"], r["status"]) for r in got] == [
            ("http://e/a.png", "png", "unchanged"),
            ("http://e/b.png", "png", "corrected"),
            ("http://e/c", None, "no_extension"),
            ("http://down/d.jpg", None, "not_found"),
            ("http://e/f.PNG", None, "not_found"),
        ]


def test_recorded_answers_are_not_read_for_every_few_batches(spark, folder, monkeypatch):
    df = docs(spark, folder, [f"http://e/{i}.jpg" for i in range(200)])
    table = TableTransport(df.filter("url < 'http://e/2'").withColumn("status", F.lit(200)))
    waves, once = [], probe._probe
    monkeypatch.setattr(probe, "_probe", lambda *a: waves.append(1) or once(*a))
    got = probe.probe_extensions(df, "url", table, batch_size=1)
    assert (len(waves), got.count(), got.filter("status = 'unchanged'").count()) == (1, 200, 112)
    waves.clear()
    probe.probe_extensions(df, "url", table, batch_size=1, batches_per_wave=100)
    assert len(waves) == 2


def test_probe_resumes(spark, folder):
    df = docs(spark, folder, [f"http://e/{i}.jpg" for i in range(10)])
    nothing = TableTransport(spark.createDataFrame([], "url string, status int"))
    everything = TableTransport(df.withColumn("status", F.lit(200)))
    target = f"{folder}/checkpoints"
    half = probe._probe(
        probe.batch_index(probe.row_index(df, out="idx"), 3, "idx").filter("batch_idx < 2"), everything, ["png"]
    )
    half.write.partitionBy("batch_idx").parquet(target)
    assert sorted(r[0] for r in completed_batches(spark, target).collect()) == [0, 1]
    with pytest.raises(ValueError, match="6 of 10"):
        read_checkpoints(spark, target, 10)
    got = probe.probe_extensions(df, "url", nothing, batch_size=3, checkpoint=target, batches_per_wave=1)
    assert [r["status"] for r in got.orderBy("idx").collect()] == ["unchanged"] * 6 + ["not_found"] * 4
    fixed = probe.apply_probe(probe.row_index(df, out="idx"), got, "url")
    assert fixed.columns == ["url"] and fixed.count() == 10


def test_sizes_over_http_and_table_agree(spark, folder):
    urls = ["http://e/a.png", "http://e/b.gif", "http://e/ranged/c", "http://down/d", None]
    df = docs(spark, folder, urls).withColumn("k", F.coalesce("url", F.lit("none")))
    table = TableTransport(
        spark.createDataFrame(
            [("http://e/a.png", 200, 2048, None, None), ("http://e/b.png", 200, 2048, None, None),
             ("http://e/ranged/c", 405, None, 206, "bytes 0-1023/4096")],
            "url string, status int, content_length long, range_status int, content_range string",
        )
    )
    for transport in (table, HttpTransport(session=Site)):
        sizes = probe.estimate_sizes(df, "url", transport, "k")
        got = {r["k"]: (r["candidate"], r["size_kb"], r["resolved"]) for r in sizes.collect()}
        assert got == {
            "http://e/a.png": ("http://e/a.png", 2.0, True),
            "http://e/b.gif": ("http://e/b.png", 2.0, True),
            "http://e/ranged/c": ("http://e/ranged/c", 4.0, True),
            "http://down/d": (None, 0.0, False),
        }
        whole = probe.size_summary(sizes, 5).first()
        assert (whole["n_unresolved"], whole["unresolved_percent"], whole["avg_kb_per_file"]) == (1, 20.0, 2.0)
        scaled = probe.size_summary(sizes, 8, sampled=True).first()
        assert (scaled["unresolved_percent"], scaled["est_total_mb"]) == (25.0, 16.0 / 1024)


def test_last_size_try_wants_an_image(spark):
    answers = spark.createDataFrame([("u://h/a", 200, 10, "text/html")], "url string, status int, content_length long, content_type string")
    rows = spark.createDataFrame([("1", ["u://h/x", "u://h/a"])], "k string, tries array<string>")
    assert TableTransport(answers).first_size(rows, "k", "tries").first()["size_bytes"] is None
    images = answers.withColumn("content_type", F.lit("image/png"))
    assert TableTransport(images).first_size(rows, "k", "tries").first()["size_bytes"] == 10


def test_collect_with_every_method(spark, folder):
    urls = [f"http://h{i % 3}.org/a/{i}.png" for i in range(30)]
    path = f"{folder}/manifest"
    spark.createDataFrame([(u, f"l{i % 2}") for i, u in enumerate(urls)], "url string, label string").coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)
    answers = TableTransport(df.select("url", F.lit(200).alias("status"), F.lit(b"x").alias("content")))
    for method in ("host", "simple", "label"):
        job = Job(label="label", groups=3, method=method)
        got = collect_outcomes(df, answers, job)
        assert got.filter("success").count() == 30
        assert {r[0] for r in got.select("group").distinct().collect()} == {1, 2, 3}
        planned = plan_only(df, job)
        assert planned.agg(F.sum("n_rows")).first()[0] == 30
    with pytest.raises(ValueError, match="unknown method"):
        plan_only(df, Job(method="other"))
    with pytest.raises(ValueError, match="label column"):
        plan_only(df, Job(method="label"))
    with pytest.raises(ValueError, match="no valid URLs"):
        collect_dataset(df.filter("url = ''"), answers, f"{folder}/none")
