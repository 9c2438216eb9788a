"""Restarts, caps of sliced hosts, failures by kind, and manifests that are no parquet scan."""

import glob
import json
import os
import shutil
import tarfile
import time

import pyarrow.fs as pafs
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from urlsheaf.operators import fetch as fetching
from urlsheaf.operators import ordering, pacing, partition
from urlsheaf.operators.outcomes import request_log
from urlsheaf.operators.queue import AnotherJobError
from urlsheaf.operators.requests import plan_requests, slice_by_host
from urlsheaf.operators.transport import TOO_LARGE, HttpTransport, TableTransport, _Asker, _pieces, failure_text
from urlsheaf.plans.collect import Job, _keeper, collect_dataset, collect_outcomes, plan_only
from urlsheaf.session import clear_scratch, materialise, scratch_path
from urlsheaf.sinks.filesystems import open_target, register_filesystem
from urlsheaf.sinks.samples import with_members
from urlsheaf.sinks.store import Store, store, sweep
from urlsheaf.sources.logs import read_performance_log
from urlsheaf.sources.manifest import read_manifest


def manifest_rows(spark, n=20):
    return spark.createDataFrame([(f"http://h{i % 3}.org/{i}.png", f"l{i % 2}") for i in range(n)], "url string, label string")


def answers(df):
    return TableTransport(df.select("url", F.lit(200).alias("status"), F.lit(b"x").alias("content")))


def keyed(df):
    return plan_requests(df.withColumn("row_key", F.regexp_extract("url", r"(\d+)\.png", 1)), "url", label="label")


class Counting:
    """Recorded answers, and how often each URL was asked for; breaks off when a slice beyond the limit comes."""

    retry_wait = keeps_layout = False

    def __init__(self, df, log, limit=None):
        self.known, self.log, self.limit, self.calls = answers(df), log, limit, 0

    def get(self, rows, attempt, timeout, by=None):
        if self.limit is not None and self.calls >= self.limit:
            raise InterruptedError("broken off")
        self.calls += 1
        self.log += [r["url"] for r in rows.select("url").collect()]
        return self.known.get(rows, attempt, timeout, by)


SLICES = {"rows_per_file": 3, "files_per_slice": 2}


def test_a_broken_attempt_goes_on_at_its_slice(spark, folder):
    df, log = manifest_rows(spark, 40), []
    wanted = keyed(df)
    with pytest.raises(StreamingQueryException):
        fetching.fetch_with_retry(wanted, Counting(df, log, 2), work_dir=f"{folder}/w", **SLICES)
    first = list(log)
    assert 0 < len(first) < 40
    # a slice whose write was not committed is made anew
    os.makedirs(f"{folder}/w/attempt=1/slices/slice=2")
    shutil.copy(glob.glob(f"{folder}/w/attempt=1/slices/slice=1/*.parquet")[0], f"{folder}/w/attempt=1/slices/slice=2")
    log.clear()
    got = fetching.fetch_with_retry(wanted, Counting(df, log), work_dir=f"{folder}/w", **SLICES)
    assert sorted(log) == sorted(set(r["url"] for r in df.collect()) - set(first))
    assert got.count() == 40 and got.select("row_key").distinct().count() == 40
    log.clear()
    again = fetching.fetch_with_retry(wanted, Counting(df, log), work_dir=f"{folder}/w", **SLICES)
    assert again.count() == 40 and not log


def test_a_folder_belongs_to_one_job(spark, folder):
    df = manifest_rows(spark)
    fetching.fetch_with_retry(keyed(df), answers(df), work_dir=f"{folder}/w")
    for rows, options in ((df.limit(19), {}), (df.withColumn("url", F.concat("url", F.lit("?"))), {}), (df, {"success_codes": (200, 301)})):
        with pytest.raises(AnotherJobError):
            fetching.fetch_with_retry(keyed(rows), answers(df), work_dir=f"{folder}/w", **options)
    shuffled = df.orderBy(F.rand(3)).repartition(7)
    assert fetching.fetch_with_retry(keyed(shuffled), answers(df), work_dir=f"{folder}/w").count() == 20


def test_nothing_to_ask_for(spark, folder):
    df = manifest_rows(spark)
    assert fetching.fetch_with_retry(keyed(df).limit(0), answers(df), work_dir=f"{folder}/w").count() == 0


@pytest.mark.parametrize("tar", [True, False])
def test_a_collection_goes_on_after_a_break(spark, folder, tar):
    """Broken off with archives written: the same call goes on, keeps what is committed, and the whole is right."""
    rows = manifest_rows(spark, 40)
    rows.coalesce(1).write.parquet(f"{folder}/in")
    df, log, job = spark.read.parquet(f"{folder}/in"), [], Job(label="label", groups=2)
    call = {"work_dir": f"{folder}/w", "tar": tar, **SLICES}
    with pytest.raises(StreamingQueryException):
        collect_dataset(df, Counting(df, log, 2), f"{folder}/out", job, **call)
    place = f"{folder}/out/{'shards' if tar else 'samples'}"
    assert not os.path.exists(f"{place}/_SUCCESS")
    with pytest.raises(FileExistsError):  # another job's output
        collect_dataset(df, Counting(df, log), f"{folder}/out", job, tar=tar)
    if tar:  # left by a task that was lost
        with open(f"{place}/output_partition_001_01_0009_0009_0001.tar.gz", "wb") as f:
            f.write(b"half an archive")
    first = list(log)
    got = collect_dataset(df, Counting(df, log), f"{folder}/out", job, **call)
    assert sorted(log) == sorted(r["url"] for r in rows.collect()) and log[: len(first)] == first
    assert got.filter("success").count() == 40
    told = spark.read.parquet(f"{place}/_manifest")
    assert told.count() == told.select("member").distinct().count() == 40
    if tar:
        held = {}
        for path in glob.glob(f"{place}/*.tar.gz"):
            with tarfile.open(path) as archive:
                held |= {m.name: archive.extractfile(m).read() for m in archive}
        assert {r["member"] for r in told.collect()} == {m for m in held if not m.endswith("overview.json")}
    else:
        assert all(os.path.exists(f"{place}/{r['member']}") for r in told.collect())
    collect_dataset(df, Counting(df, log), f"{folder}/out", job, **call)
    assert len(log) == 40 and spark.read.parquet(f"{place}/_manifest").count() == 40


def memory_of(folder):
    """Opens URIs of a made scheme below a folder."""

    def opened(uri):
        return pafs.SubTreeFileSystem(folder, pafs.LocalFileSystem()), uri.split("://", 1)[1]

    return opened


def test_any_registered_file_system_is_written(spark, folder):
    register_filesystem("made", memory_of(folder))
    try:
        rows = manifest_rows(spark).withColumn("row_key", F.regexp_extract("url", r"(\d+)\.png", 1)).withColumn("group", F.lit(1))
        got = fetching.fetch(plan_requests(rows, "url", label="label"), answers(rows))
        target = Store("made://bucket/shards", tar=True, compress=False, shard_bytes=5, inputs={})
        made = store(with_members(got, "").withColumn("shard", F.lit("s")).coalesce(1), target)
        made.write.parquet(f"{folder}/told")
        told = spark.read.parquet(f"{folder}/told")
        names = sorted(os.listdir(f"{folder}/bucket/shards"))
        assert names == [f"s_{k:04d}.tar" for k in range(1, 5)]  # cut by bytes
        assert {r["stored_in"] for r in told.collect()} == set(names)
        assert sweep(target, told.filter("stored_in <> 's_0002.tar'")) == 1
        assert len(os.listdir(f"{folder}/bucket/shards")) == 3
        store(with_members(got, "").withColumn("shard", F.lit(None).cast("string")), Store("made://flat")).count()
        assert len(os.listdir(f"{folder}/flat/l0")) == 10
    finally:
        register_filesystem("made", None)
    assert open_target("s3a://bucket/x?region=eu-west-1")[1] == open_target("s3://bucket/x?region=eu-west-1")[1] == "bucket/x"


def client():
    """A session that answers everything; made by a function, as workers don't see this module."""

    class Ok:
        status_code, headers, content = 200, {}, b"0123456789"

        def __enter__(self):
            return self

        def __exit__(self, *_):
            pass

    class Client:
        def get(self, url, **_):
            return Ok()

    return Client


def test_nothing_is_shuffled_above_content(spark, folder):
    df = manifest_rows(spark, 60)
    plans, Client = [], client()

    def keep(got, attempt, number, last):
        made = _keeper(HttpTransport(session=Client), Store(f"{folder}/shards", tar=True, inputs={}), "imagefolder")(got, attempt, number, last)
        plans.append(made._jdf.queryExecution().executedPlan().toString())
        return made

    wanted = keyed(df.withColumn("group", F.when(F.col("label") == "l0", 1).otherwise(2)))
    got = fetching.fetch_with_retry(wanted, HttpTransport(session=Client), by="group", keep=keep)
    assert got.filter("success").count() == 60 and "content" not in got.columns
    for plan in plans:
        above = plan[: plan.index("MapInPandas")]
        assert "MapInArrow" in above and "Exchange" not in above and "Sort" not in above
    archives = glob.glob(f"{folder}/shards/*.tar.gz")
    assert len(archives) <= 4
    # bodies are handed on by bytes, and one that is too long says so
    assert [len(p) for p in _pieces(iter([((), (b"x" * 10,))] * 7), 100, 25, 0)] == [3, 3, 1]
    asker = _Asker(HttpTransport(session=Client, max_body=5))
    assert asker.fetch("http://a/b", 3)[2] == TOO_LARGE


def test_shares_of_a_host_sum_to_its_cap(spark):
    urls = [f"http://hot.org/{i}" for i in range(500)] + [f"http://h{i}.org/x" for i in range(9)]
    rows = spark.createDataFrame([(str(i), u, u.split("/")[2]) for i, u in enumerate(urls)], "row_key string, url string, host string")
    for cap in (1, 3, 8, 50):
        laid = slice_by_host(rows, rows_per_slice=20, cap=cap)
        placed = laid.withColumn("part", F.spark_partition_id()).select("host", "host_slices", "slice_cap")
        hot = placed.filter("host = 'hot.org'").first()
        assert hot["host_slices"] == min(25, cap)
        slices = laid.filter("host = 'hot.org'").withColumn("s", F.pmod(F.xxhash64("row_key"), "host_slices"))
        assert slices.select("s", "slice_cap").distinct().agg(F.sum("slice_cap")).first()[0] == cap


def test_same_answer_recorded_twice(spark):
    df = manifest_rows(spark)
    twice = TableTransport(answers(df).answers.unionByName(answers(df).answers))
    assert fetching.fetch(plan_requests(df.withColumn("row_key", F.regexp_extract("url", r"(\d+)\.png", 1)), "url"), twice).count() == 20


def failing(*layers):
    error = None
    for kind, text in reversed(layers):
        made = type(kind, (Exception,), {})(text)
        made.__cause__ = error
        error = made
    return error


def test_failures_have_few_stable_texts():
    kinds = [
        [("ConnectionError", "HTTPConnectionPool(host='h{i}.org')"), ("NameResolutionError", "Failed to resolve 'h{i}.org'")],
        [("ConnectionError", "Max retries h{i}"), ("NewConnectionError", "<object at 0x{i}>: [Errno 111] Connection refused")],
        [("ConnectionError", "aborted {i}"), ("ProtocolError", "('Connection aborted.', ConnectionResetError(104, 'reset'))")],
        [("SSLError", "h{i}.org: certificate verify failed")],
    ]
    texts = [{failure_text(failing(*[(k, t.format(i=i)) for k, t in layers])) for i in range(50)} for layers in kinds]
    assert [len(t) for t in texts] == [1] * 4
    said = [t.pop() for t in texts]
    assert said == ["Cannot connect to host", "Connection refused", "Connection reset by peer", "Cannot connect to host"]


def test_a_slow_answer_holds_nobody_up():
    def call(row):
        time.sleep(1.0 if row % 100 == 0 else 0.005)
        return row

    began = time.monotonic()
    asker = _Asker(HttpTransport(session=object, concurrency=64))
    got = list(asker.answered(iter(range(1500)), call, lambda row: row % 40, lambda row: 8))
    assert sorted(r for r, _ in got) == list(range(1500)) and all(r == a for r, a in got)
    assert time.monotonic() - began < 4


def test_no_host_has_more_than_its_cap():
    busy, most = {}, {}

    def call(row):
        host = row % 3
        busy[host] = busy.get(host, 0) + 1
        most[host] = max(most.get(host, 0), busy[host])
        time.sleep(0.002)
        busy[host] -= 1
        return ()

    asker = _Asker(HttpTransport(session=object, concurrency=32, waiting=20))
    assert len(list(asker.answered(iter(range(300)), call, lambda r: r % 3, lambda r: 2))) == 300
    assert max(most.values()) <= 2


def test_existing_output_is_refused_before_any_request(spark, folder):
    class Untouched:
        retry_wait = False

        def get(self, *_):
            raise AssertionError("a request was sent")

    os.makedirs(f"{folder}/out/shards")
    with pytest.raises(FileExistsError):
        collect_dataset(manifest_rows(spark), Untouched(), f"{folder}/out")


@pytest.mark.parametrize("kind", ["csv", "xml", "union", "join"])
def test_any_manifest_is_collected(spark, folder, kind):
    df = manifest_rows(spark)
    if kind == "union":
        rows = df.limit(8).unionByName(df.subtract(df.limit(8)))
    elif kind == "join":
        rows = df.join(spark.createDataFrame([("l0", 1), ("l1", 2)], "label string, x int"), "label")
    else:
        path = f"{folder}/m.{kind}"
        options = {"header": True} if kind == "csv" else {"rowTag": "row", "rootTag": "rows"}
        df.repartition(3).write.format(kind).options(**options).save(path)
        rows = read_manifest(spark, path, schema="url string, label string")
    indexed = ordering.row_index(rows).select("row_idx").collect()
    assert sorted(r[0] for r in indexed) == list(range(20))
    for method in ("simple", "label"):
        job = Job(label="label", groups=3, method=method)
        got = collect_outcomes(rows, answers(df), job)
        assert got.filter("success").select("row_key").distinct().count() == 20
        assert plan_only(rows, job).agg(F.sum("n_rows")).first()[0] == 20


def test_csv_rows_keep_their_order(spark, folder):
    spark.range(3000).select(F.concat(F.lit("u"), "id").alias("url"), "id").coalesce(1).write.option("header", True).csv(f"{folder}/m.csv")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        rows = read_manifest(spark, f"{folder}/m.csv", schema="url string, id long")
        got = ordering.row_index(rows).filter("row_idx <> id").count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == 0


def test_null_labels_are_spread(spark, folder):
    rows = [(None if i % 10 < 6 else f"l{i % 4}", i) for i in range(1000)]
    spark.createDataFrame(rows, "label string, v int").coalesce(1).write.parquet(f"{folder}/m")
    split = partition.partition_by_label(spark.read.parquet(f"{folder}/m"), "label", 10)
    sizes = [r["n_rows"] for r in partition.rows_per_partition(split).collect()]
    assert len(sizes) == 10 and max(sizes) <= 200 and sum(sizes) == 1000


def test_pacing_follows_changing_delays(spark):
    rows = spark.createDataFrame([("h", 0.0, d, 1, i) for i, d in enumerate((1.0, 10.0, 1.0, 1.0))], "host string, at double, rtprop double, c int, i int")
    got = pacing.pace_requests(rows, "host", "at", "rtprop", "c", "i").orderBy("i").collect()
    assert [r["release"] for r in got] == [0.0, 10.0, 11.0, 12.0]


def test_samples_are_exact(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    for n in (0, 1, 700, 5000, 9000):
        got = [r[0] for r in ordering.sample_n(df, n, ["k"], seed=3).collect()]
        assert len(got) == len(set(got)) == min(n, 5000)
    assert set(r[0] for r in ordering.sample_n(df, 50, ["k"]).collect()) <= set(r[0] for r in ordering.sample_n(df, 90, ["k"]).collect())


def test_log_without_lines_is_rejected(spark, folder):
    os.makedirs(f"{folder}/logs")
    title = "# timestamp workers_connected tasks_done tasks_failed bytes_received\n"
    for name, body in (("a", title + "1 2 3 4 5\n"), ("b", title)):
        with open(f"{folder}/logs/{name}", "w") as f:
            f.write(body)
    with pytest.raises(ValueError, match="without a line"):
        read_performance_log(spark, f"{folder}/logs")


@pytest.mark.parametrize("tar, compress, suffix", [(True, True, ".tar.gz"), (True, False, ".tar"), (False, True, None)])
def test_overviews_name_the_file_there_is(spark, folder, tar, compress, suffix):
    df = manifest_rows(spark)
    out = f"{folder}/out"
    outcomes = collect_dataset(df, answers(df), out, Job(label="label", groups=2, compress=compress), tar=tar)
    for name in os.listdir(f"{out}/overviews"):
        if name.endswith(".json"):
            with open(f"{out}/overviews/{name}") as f:
                told = json.load(f)
            path = told["summary"].get("tar_path")
            assert (path is None) if suffix is None else os.path.exists(f"{out}/shards/{path}")
            assert told["script_inputs"]["max_attempts"] == 3
    log = request_log(outcomes)
    assert log.count() == 20 and log.filter("is_conn_error").count() == 0


def test_scratch_is_cleared(spark):
    rows = materialise(spark.range(5), "kept")
    path = scratch_path(spark, "x").rsplit("/", 1)[0]
    assert rows.count() == 5 and any(n.startswith("kept-") for n in os.listdir(path))
    clear_scratch(spark)
    assert not os.path.exists(path)
    assert materialise(spark.range(5), "kept").count() == 5
