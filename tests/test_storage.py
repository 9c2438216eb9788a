"""Readers and writers."""

import glob
import gzip
import io
import json
import os
import re
import tarfile
import zlib

import pytest
from pyspark.sql import functions as F

from urlsheaf.operators import fetch as fetching
from urlsheaf.operators import report
from urlsheaf.operators.requests import plan_requests
from urlsheaf.operators.transport import TableTransport
from urlsheaf.plans.catalogue.reports import _write_long_logs
from urlsheaf.plans.collect import Job, collect_dataset
from urlsheaf.sinks import partitions, samples
from urlsheaf.sinks.logs import write_logs
from urlsheaf.sinks.reports import overview_documents, write_overview, write_report
from urlsheaf.sources import logs
from urlsheaf.sources.archives import archive_members, read_members
from urlsheaf.sources.listing import list_outputs
from urlsheaf.sources.logs import read_performance_log
from urlsheaf.sources.manifest import infer_format, read_manifest, read_manifest_dir, read_partitions, require_columns
from urlsheaf.sources.overviews import read_overviews

ROWS = [(f"http://h{i % 3}.org/p/{i}.png", None if i % 4 == 0 else f"l {i % 2}") for i in range(20)]


def manifest(spark):
    return spark.createDataFrame([(str(i), *r) for i, r in enumerate(ROWS)], "row_key string, url string, label string")


def stored(spark, fmt="imagefolder", out="", group=None):
    df = manifest(spark)
    if group is not None:
        df = df.withColumn("group", group)
    answers = TableTransport(df.select("url", F.lit(200).alias("status"), F.col("url").cast("binary").alias("content")))
    return fetching.fetch(plan_requests(df, "url", label="label", out=out, fmt=fmt), answers)


def test_formats():
    names = {"a.parquet": "parquet", "a.csv": "csv", "a.txt": "csv", "a.xml": "xml"}
    assert {n: infer_format(n) for n in names} == names
    with pytest.raises(ValueError, match="cannot tell"):
        infer_format("a.bin")


def test_read_manifest(spark, folder):
    rows = spark.createDataFrame([("http://a/1", 1), ("http://a/2", 2)], "url string, n int").coalesce(1)
    rows.write.option("header", True).csv(f"{folder}/m.csv")
    rows.write.format("xml").option("rowTag", "row").save(f"{folder}/m.xml")
    rows.write.parquet(f"{folder}/m.parquet")
    for name in ("m.csv", "m.xml", "m.parquet"):
        got = read_manifest(spark, f"{folder}/{name}").orderBy("n").collect()
        assert [(r["url"], r["n"]) for r in got] == [("http://a/1", 1), ("http://a/2", 2)]
    with pytest.raises(FileNotFoundError):
        read_manifest(spark, f"{folder}/none.parquet")
    with pytest.raises(ValueError, match="unsupported"):
        read_manifest(spark, f"{folder}/m.csv", "excel")
    with pytest.raises(ValueError, match="available: url, n"):
        require_columns(rows, "label")


def test_read_manifest_dir_skips_broken_files(spark, folder):
    spark.createDataFrame([("a", 1)], "url string, n int").coalesce(1).write.parquet(f"{folder}/d")
    spark.createDataFrame([("b", "x")], "url string, label string").coalesce(1).write.mode("append").parquet(f"{folder}/d")
    with open(f"{folder}/d/broken.parquet", "wb") as f:
        f.write(b"not parquet at all")
    with open(f"{folder}/d/notes.txt", "w") as f:
        f.write("x")
    got = read_manifest_dir(spark, f"{folder}/d").select("url", "n", "label").collect()
    assert sorted(tuple(r) for r in got) == [("a", 1, None), ("b", None, "x")]


def test_partitions(spark, folder):
    df = manifest(spark).withColumn("host", F.lit("h")).withColumn("group", (F.col("row_key").cast("int") % 3 + 1))
    partitions.write_partitions(df, f"{folder}/p")
    assert sorted(os.path.basename(p) for p in glob.glob(f"{folder}/p/group=*")) == ["group=1", "group=2", "group=3"]
    assert all(len(glob.glob(f"{folder}/p/group={g}/*.parquet")) == 1 for g in (1, 2, 3))
    back = read_partitions(spark, f"{folder}/p")
    assert sorted(map(tuple, back.select(*df.columns).collect())) == sorted(map(tuple, df.collect()))
    partitions.write_partitions(df, f"{folder}/q", "csv", keep_host=False)
    assert "host" not in spark.read.option("header", True).csv(f"{folder}/q").columns
    with pytest.raises(Exception, match="(?i)exists"):
        partitions.write_partitions(df, f"{folder}/p")
    partitions.write_partitions(df.limit(1), f"{folder}/p", mode="overwrite")
    assert read_partitions(spark, f"{folder}/p").count() == 1
    with pytest.raises(ValueError, match="unsupported"):
        partitions.write_partitions(df, f"{folder}/r", "xml")


def test_a_hot_group_is_written_by_several_tasks(spark, folder):
    rows = spark.range(200_000, numPartitions=8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("url"))
    df = rows.withColumn("group", F.when(F.col("id") % 10 < 7, 1).otherwise((F.col("id") % 3 + 2).cast("int")))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "1m")
    try:
        partitions.write_partitions(df, f"{folder}/p")
    finally:
        spark.conf.unset(key)
    files = {g: len(glob.glob(f"{folder}/p/group={g}/*.parquet")) for g in (1, 2)}
    assert files[1] > 3
    assert read_partitions(spark, f"{folder}/p").count() == 200_000


def test_numbered_partition_files(spark, folder):
    for n in (1, 12):
        path = f"{folder}/set/partition_{n:03d}.parquet"
        spark.createDataFrame([(n,)], "n int").coalesce(1).write.parquet(path)
    got = read_partitions(spark, f"{folder}/set/*")
    assert sorted(tuple(r) for r in got.collect()) == [(1, 1), (12, 12)]


def tree(root):
    found = {}
    for folder, _, files in os.walk(root):
        if "_manifest" in folder:
            continue
        for name in files:
            if not name.endswith(".crc"):
                path = os.path.join(folder, name)
                with open(path, "rb") as f:
                    found[os.path.relpath(path, root)] = f.read()
    return found


def test_imagefolder(spark, folder):
    out = f"{folder}/images"
    samples.write_imagefolder(stored(spark, out=out), out)
    want = {
        f"{'output' if label is None else label.replace(' ', '_')}/{i + 1:08d}.png": url.encode()
        for i, (url, label) in enumerate(ROWS)
    }
    assert tree(out) == want | {"_SUCCESS": b""}
    with pytest.raises(FileExistsError):
        samples.write_imagefolder(stored(spark, out=out), out)
    samples.write_imagefolder(stored(spark, out=out).limit(2), f"file://{out}", mode="overwrite", layout_root=out)
    assert len(tree(out)) == 3


def test_webdataset(spark, folder):
    out = f"{folder}/flat"
    samples.write_webdataset(stored(spark, "webdataset"), out)
    files = tree(out)
    assert len(files) == 2 * len(ROWS) + 1
    assert json.loads(files["00000002.json"]) == {"key": "1", "url": ROWS[1][0], "class_name": "l_1"}
    assert json.loads(files["00000001.json"])["class_name"] == "output"


def test_paths_stay_inside(spark, folder):
    evil = stored(spark).limit(1).withColumn("file_path", F.lit("../../evil.png"))
    with pytest.raises(Exception, match="leaves the output folder"):
        samples.write_imagefolder(evil, f"{folder}/safe")
    assert not os.path.exists(f"{folder}/evil.png")


def members(path):
    with tarfile.open(path) as tar:
        return {m.name: tar.extractfile(m).read() for m in tar}


def test_tar_shards_split_a_hot_group(spark, folder):
    hot = F.when(F.col("row_key").cast("int") < 14, 1).otherwise(2)
    named = samples.shard_names(stored(spark, group=hot), rows_per_shard=5)
    shards = {r["shard"] for r in named.select("shard").distinct().collect()}
    assert "output_partition_002_0001" in shards and len([s for s in shards if "_001_" in s]) == 3
    for run in ("a", "b"):
        samples.write_tar_shards(named, f"{folder}/{run}", compress=run == "a")
    packed = {}
    for path in glob.glob(f"{folder}/a/*.tar.gz"):
        packed |= members(path)
    assert len(packed) == len(ROWS) and set(packed.values()) == {u.encode() for u, _ in ROWS}
    names = [m for m in members(sorted(glob.glob(f"{folder}/b/*.tar"))[0])]
    assert names == sorted(names)


def test_repeated_shards_are_identical(spark, folder):
    named = samples.shard_names(stored(spark, group=F.lit(1)))
    for run in ("a", "b"):
        samples.write_tar_shards(named, f"{folder}/{run}")
    assert tree(f"{folder}/a") == tree(f"{folder}/b")


def test_collected_dataset_reports_itself(spark, folder):
    path = f"{folder}/in"
    manifest(spark).drop("row_key").coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)
    half = df.withColumn("status", F.when(F.col("url").endswith("0.png"), 404).otherwise(200))
    answers = TableTransport(half.select("url", "status", F.lit(b"12345").alias("content")))
    collect_dataset(df, answers, f"{folder}/out", Job(label="label", groups=2))
    for where in (f"{folder}/out/shards/*.tar.gz", f"{folder}/out/overviews/*.json", f"{folder}/out/*/*"):
        views = read_overviews(spark, where)
        totals = report.run_totals(views).first()
        times = 2 if where.endswith("*/*") else 1
        assert (totals["total_urls"], totals["successful_downloads"]) == (20 * times, 18 * times)
        assert [tuple(r) for r in report.run_errors(views).collect()] == [("404", "HTTP 404: Not Found", 2 * times)]
    tails = [list(members(p))[-1] for p in glob.glob(f"{folder}/out/shards/*.tar.gz")]
    assert all(t.endswith("/overview.json") for t in tails)
    listed = [r["name"] for r in list_outputs(spark, f"{folder}/out/shards", "*.tar.gz").collect()]
    assert {n[:20] for n in listed} == {"output_partition_001", "output_partition_002"}
    assert all(re.fullmatch(r"output_partition_\d{3}_01_\d{4}_\d{4}_0001.tar.gz", n) for n in listed)
    held = {}
    for path in glob.glob(f"{folder}/out/shards/*.tar.gz"):
        held |= members(path)
    told = spark.read.parquet(f"{folder}/out/shards/_manifest").collect()
    assert len(told) == 18 and all(zlib.crc32(held[r["member"]]) == r["crc32"] for r in told)
    assert all(r["member"].split("/")[0] == r["stored_in"][: -len(".tar.gz")] for r in told)
    collect_dataset(df, answers, f"{folder}/flat", Job(label="label", groups=2, fmt="webdataset"), tar=False)
    assert len(glob.glob(f"{folder}/flat/samples/*.json")) == 18


def test_overviews_with_gaps(spark, folder):
    os.makedirs(f"{folder}/o")
    texts = {"a_overview.json": '{"summary": {"total_urls": 5}}', "b.json": "{broken", "c.json": '{"other": 1}'}
    for name, text in texts.items():
        with open(f"{folder}/o/{name}", "w") as f:
            f.write(text)
    with tarfile.open(f"{folder}/o/p.tar", "w") as tar:
        body = b'{"summary": {"total_urls": 2, "avg_speed_MBps": 1.5}, "error_breakdown": [{"count": 2}, {"status_code": 404, "error": "x"}]}'
        info = tarfile.TarInfo("p/overview.json")
        info.size = len(body)
        tar.addfile(info, io.BytesIO(body))
    with open(f"{folder}/o/q.tar", "wb") as f:
        f.write(b"no archive")
    got = {r["partition_name"]: r for r in read_overviews(spark, f"{folder}/o").collect()}
    assert sorted(got) == ["a", "p"]
    assert (got["a"]["total_urls"], got["a"]["downloaded_mb"], got["a"]["errors"]) == (5, 0.0, [])
    assert got["p"]["avg_speed_mbps"] == 1.5
    errors = report.run_errors(read_overviews(spark, f"{folder}/o")).collect()
    assert [tuple(r) for r in errors] == [("unknown", "Unknown error", 2), ("404", "x", 0)]


def pack(path, entries, mode="w"):
    with tarfile.open(path, mode) as tar:
        for name, body in entries:
            info = tarfile.TarInfo(name)
            if body is None:
                info.type = tarfile.DIRTYPE
            else:
                info.size = len(body)
            tar.addfile(info, io.BytesIO(body or b""))


class Counted(io.FileIO):
    """A file that counts the bytes it gives."""

    given = 0

    def read(self, n=-1):
        found = super().read(n)
        Counted.given += len(found)
        return found


def test_only_headers_of_an_archive_are_read(folder):
    large = os.urandom(3_000_000)
    pack(f"{folder}/a.tar", [("a", None), *[(f"a/{k}.bin", large) for k in range(5)], ("a/overview.json", b"{}"), ("a/last.bin", large)])
    whole = lambda seekable: Counted(f"{folder}/a.tar")
    for wanted, content, want in (
        (lambda n: True, False, [(f"a/{k}.bin", 3_000_000, None) for k in range(5)] + [("a/overview.json", 2, None), ("a/last.bin", 3_000_000, None)]),
        (lambda n: n.endswith("overview.json"), True, [("a/overview.json", 2, b"{}")]),
    ):
        Counted.given = 0
        assert list(archive_members(whole, "a.tar", wanted, content)) == want
        assert Counted.given < 20_000
    pack(f"{folder}/cut.tar", [("x/1", b"one"), ("x/2", large)])
    os.truncate(f"{folder}/cut.tar", 100_000)
    cut = lambda seekable: open(f"{folder}/cut.tar", "rb")
    assert list(archive_members(cut, "cut.tar", lambda n: True, True)) == [("x/1", 3, b"one")]


def test_archive_members(spark, folder):
    inner = io.BytesIO()
    with tarfile.open(fileobj=inner, mode="w") as tar:
        tar.addfile(tarfile.TarInfo("q/overview.json"))
    entries = [("p", None), ("p/1.png", b"1"), ("p/sub/overview.json", b"no"), ("p/in.tar", inner.getvalue()), ("p/overview.json", b'{"summary": {"total_urls": 3}}')]
    os.makedirs(f"{folder}/d/e")
    pack(f"{folder}/d/a.tar", entries)
    pack(f"{folder}/d/b.tar.gz", entries, "w:gz")
    with open(f"{folder}/d/c.tar", "wb") as f:
        f.write(b"no archive")
    with open(f"{folder}/d/x.json", "w") as f:
        f.write('{"summary": {"total_urls": 4}}')
    for place in (f"{folder}/d", f"file://{folder}/d", f"{folder}/d/*", f"{folder}/[d]/*.tar*"):
        got = read_members(spark, place).collect()
        assert sorted((r["path"][-5:], r["member"]) for r in got) == sorted((p, n) for p in ("a.tar", "ar.gz") for n, b in entries if b is not None)
        assert all(r["content"] is None for r in got)
    some = read_members(spark, f"{folder}/d", content=True).filter("member like '%.png'").select("content")
    assert [bytes(r[0]) for r in some.collect()] == [b"1", b"1"]
    assert "StringEndsWith" not in some._jdf.queryExecution().executedPlan().toString().split("BatchScan")[0]
    views = read_overviews(spark, f"{folder}/d").collect()
    assert sorted((r["partition_name"], r["total_urls"]) for r in views) == [("a", 3), ("b", 3), ("x", 4)]


LOG = """# timestamp workers_connected idle tasks_done tasks_failed bytes_received
1000000 3 0 0 0 0
4000000 9 0 5 1 100
9500000 2 0 8 2 1099511627776
"""


def test_performance_log(spark, folder):
    with open(f"{folder}/performance", "w") as f:
        f.write(LOG)
    sums = report.performance_summary(read_performance_log(spark, f"{folder}/performance")).first()
    assert (sums["wall_sec"], sums["wall_human"], sums["peak_workers"]) == (8.5, "8s", 9)
    assert (sums["tasks_completed"], sums["tasks_failed"], sums["bytes_received_tib"]) == (8, 2, 1.0)
    with open(f"{folder}/short", "w") as f:
        f.write("# timestamp workers_connected\n1 2\n")
    with pytest.raises(ValueError, match="tasks_done"):
        read_performance_log(spark, f"{folder}/short")
    os.makedirs(f"{folder}/many")
    with open(f"{folder}/many/a", "w") as f:
        f.write(LOG)
    with open(f"{folder}/many/b", "w") as f:
        f.write("# bytes_received tasks_failed tasks_done workers_connected timestamp\n7 1 2 4 3000000\n")
    both = report.performance_summary(read_performance_log(spark, f"{folder}/many")).orderBy("file").collect()
    assert [(r["tasks_completed"], r["peak_workers"], r["bytes_received"]) for r in both] == [(8, 9, 1099511627776), (2, 4, 7)]


def test_performance_logs_are_opened_once(spark, folder):
    for k in range(3):
        with open(f"{folder}/log{k}", "w") as f:
            f.write(LOG)
    got = read_performance_log(spark, f"{folder}/log*")
    assert not [f for f in got.inputFiles() if "/log" in f]
    assert {r[0].rsplit("/", 1)[1] for r in got.select("file").distinct().collect()} == {"log0", "log1", "log2"}
    with open(f"{folder}/log3", "w") as f:
        f.write(LOG.splitlines()[0] + "\n\n")
    with pytest.raises(ValueError, match="without a line below its header: .*log3"):
        read_performance_log(spark, f"{folder}/log*")


def test_small_logs_are_read_whole_and_large_ones_by_line(spark, folder, monkeypatch):
    """With the same rows, whatever ends the lines, and of each file once."""
    head, other = "# timestamp workers_connected tasks_done tasks_failed bytes_received", "bytes_received timestamp tasks_failed tasks_done workers_connected"
    bodies = {
        "a": f"{head}\n1 2 3 4 5\n\n  \n{head}\n6 7 8 9 x\n",
        "b": f"{other}\r\n1 2 3 4 5\r\n6 7 8\r\n",
        "c": f"\ufeff{head}\r1 2 3 4 5\r6 7 8 9 10",
        "d": "",
        "e": f"{head}\n" + "".join(f"{k} 1 2 3 4\n" for k in range(200)),
    }
    for name, body in bodies.items():
        with open(f"{folder}/log-{name}", "w", newline="", encoding="utf-8") as f:
            f.write(body)
    with gzip.open(f"{folder}/log-f.gz", "wt") as f:
        f.write(bodies["a"])
    rows = []
    for size in (4 << 20, 1000, -1):
        monkeypatch.setattr(logs, "WHOLE", size)
        kept = {r["file"].rsplit("/", 1)[1] for r in logs._lines(spark, f"{folder}/log*").collect()}
        assert kept == {4 << 20: {"log-f.gz"}, 1000: {"log-e", "log-f.gz"}, -1: {f"log-{k}" for k in "abce"} | {"log-f.gz"}}[size]
        # files are told apart as they are listed: the others are not opened
        small = spark.read.text(f"{folder}/log*", wholetext=True).where(logs._is_small() & (F.col("_metadata.file_size") > 0))
        assert (small.rdd.getNumPartitions() > 0) == (size > 0)
        got = logs.read_performance_log(spark, f"{folder}/log*").orderBy("file", "line_no").drop("line_no")
        rows.append([(r[0].rsplit("/", 1)[1], *r[1:]) for r in got.collect()])
    assert rows[0] == rows[1] == rows[2] and len(rows[0]) == 2 + 2 + 2 + 200 + 2
    assert rows[0][:4] == [("log-a", 1, 2, 3, 4, 5), ("log-a", 6, 7, 8, 9, None), ("log-b", 2, 5, 4, 3, 1), ("log-b", 7, None, None, 8, 6)]
    assert [r[1] for r in rows[0] if r[0] == "log-e"] == list(range(200))


def test_logs_are_written_side_by_side(spark, folder):
    """A file for each key and no folder, in order, however many batches a log comes in."""
    rows = [(k % 3 if k % 4 else None, k * 7 % 50, str(k) if k % 5 else None) for k in range(50)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        write_logs(spark.createDataFrame(rows, "run long, at long, value string"), "run", "at", f"{folder}/out")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    found = {}
    for at, _, names in os.walk(f"{folder}/out"):
        for name in names:
            assert os.path.dirname(at) == f"{folder}/out" and name not in found
            with open(f"{at}/{name}") as f:
                found[name] = f.read()
    want = {}
    for run, _, value in sorted(rows, key=lambda r: r[1]):
        name = f"run={'__HIVE_DEFAULT_PARTITION__' if run is None else run}"
        want[name] = want.get(name, "") + f"{value or ''}\n"
    assert found == want


def test_a_long_log_is_sorted_by_many_tasks_into_one_file(spark, folder):
    rows = spark.range(300, numPartitions=5).select(
        F.when(F.col("id") % 100 > 0, F.lit(0)).alias("run"), ((F.col("id") * 7) % 300).alias("at")
    )
    lines = rows.withColumn("value", F.col("at").cast("string"))
    tasks = []
    persist = type(lines).persist

    def seen(df, level):
        tasks.append(df.rdd.getNumPartitions())
        return persist(df, level)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(lines), "persist", seen)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            _write_long_logs(lines, [0, None], f"{folder}/out")
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tasks[0] > 1
    for name, n in (("0", 297), ("__HIVE_DEFAULT_PARTITION__", 3)):
        (file,) = glob.glob(f"{folder}/out/run={name}/*.txt")
        with open(file) as f:
            got = [int(line) for line in f]
        assert len(got) == n and got == sorted(got)


def test_golden_run_report(spark, folder):
    performance = spark.createDataFrame([("f", 0, 8_382_580_000, 20, 400, 0, 4_749_890_232_156)], "file string, a long, b long, w long, d long, x long, r long")
    log = performance.select(
        "file", F.posexplode(F.array("a", "b")).alias("line_no", "timestamp"), F.col("w").alias("workers_connected"),
        F.col("d").alias("tasks_done"), F.col("x").alias("tasks_failed"), F.col("r").alias("bytes_received"),
    )
    views = spark.createDataFrame(
        [("p", 39_883_200, 39_711_811, 171_389, 4_594_404.6, 1.0, 126.97, 99.57)],
        "partition_name string, total_urls long, successful_downloads long, failed_downloads long, downloaded_mb double,"
        " elapsed_sec double, avg_speed_mbps double, success_rate_percent double",
    )
    made = report.run_report(report.performance_summary(log), report.run_totals(views), report.partition_stats(views))
    write_report(made, f"{folder}/report")
    got = spark.read.json(f"{folder}/report").first()
    assert got["run_stats"]["total_wall_time_human"] == "2h 19m 42s"
    assert got["download_stats"]["success_rate_percent"] == 99.57
    assert got["download_stats"]["total_downloaded_TB"] == 4.38
    assert got["download_stats"]["effective_throughput_MBps"] == 548.09
    assert got["run_stats"]["bytes_received_TB"] == 4.32


def test_no_partitions_no_tasks(spark):
    views = spark.createDataFrame([], "success_rate_percent double, avg_speed_mbps double")
    assert tuple(report.partition_stats(views).first()) == (0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)


def test_task_times(spark):
    schema = (
        "time_workers_execute_last long, time_when_commit_start long, time_when_commit_end long, time_when_submitted long,"
        " time_when_done long, bytes_sent long, bytes_received long, output string, successful boolean"
    )
    rows = [
        (4_000_000, 1_000_000, 3_000_000, 1_000_000, 11_000_000, 5, 7, "Download time: 3.5s\nTar creation time: 0.5s", True),
        (9_000_000, 0, 3_000_000, 1_000_000, 2_000_000, 5, 7, "Download time: 9s", False),
    ]
    got = report.timing_breakdown(spark.createDataFrame(rows, schema)).first()
    assert (got["exec_sec"], got["output_sec"], got["input_sec"], got["download_sec"]) == (13.0, 2.0, 4.0, 3.5)
    tally = report.task_tally(spark.createDataFrame(rows, schema)).first()
    assert tuple(tally) == (2, 1, 1, 10.0)


def test_overview_documents(spark, folder):
    got = stored(spark, group=F.lit(1))
    docs = overview_documents(got, {"url_column": "url"}, 2.0, "group")
    doc = json.loads(docs.first()["overview"])
    assert doc["script_inputs"] == {"url_column": "url"} and doc["error_breakdown"] == []
    size = sum(len(u) for u, _ in ROWS)
    assert doc["summary"]["total_urls"] == 20 and doc["summary"]["downloaded_mb"] == round(size / 1e6, 3)
    write_overview(docs, f"{folder}/o", "group")
    assert os.path.exists(f"{folder}/o/1_overview.json")
