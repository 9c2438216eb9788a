"""Order, packing, partitioning, joins and pacing against plain loops."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from urlsheaf.operators import joins, manifest, ordering, pacing, packing, partition


def greedy(counts, n):
    """Group of each key, largest count first, ties by key, lightest bin first."""
    load, groups = [0] * n, {}
    for key, count in sorted(counts.items(), key=lambda kv: (-kv[1], kv[0] is not None, kv[0])):
        b = min(range(n), key=lambda j: (load[j], j))
        groups[key] = b + 1
        load[b] += count
    return groups


def counts_frame(spark, counts):
    return spark.createDataFrame(list(counts.items()), "k string, n long")


@pytest.mark.parametrize("seed", range(40))
def test_runs_equal_greedy(seed):
    rng = random.Random(seed)
    n = rng.randint(1, 7)
    items = sorted((rng.choice([1, 1, 1, 2, 3, rng.randint(1, 60)]) for _ in range(rng.randint(1, 80))), reverse=True)
    want = list(greedy({f"{i:03d}": c for i, c in enumerate(items)}, n).values())
    runs = [(c, items.count(c)) for c in sorted(set(items), reverse=True)]
    got = []
    for count, keys, bins, levels in packing.walk_runs(iter(runs), n):
        if bins is None:
            start = 0
            while start < keys:
                stop = min(keys, start + rng.randint(1, 9))
                bins = packing.bins_between(np.array(levels), count, start, stop)
                got += [int(b) + 1 for b in bins]
                start = stop
        else:
            got += [b + 1 for b in bins]
    assert got == want


@pytest.mark.parametrize("tied_limit", [packing.TIED_KEYS_PER_TASK, 0])
def test_greedy_pack(spark, monkeypatch, tied_limit):
    monkeypatch.setattr(packing, "TIED_KEYS_PER_TASK", tied_limit)
    monkeypatch.setattr(packing, "SLICE_KEYS", 7)
    rng = random.Random(5)
    counts = {f"h{i}": rng.choice([1, 1, 1, 2, 2, 40, 999]) for i in range(300)} | {None: 3}
    got = {r["k"]: r["group"] for r in packing.greedy_pack(counts_frame(spark, counts), "k", "n", 6).collect()}
    assert got == greedy(counts, 6)


def test_packing_example(spark):
    got = packing.greedy_pack(counts_frame(spark, {"a": 5, "b": 4, "c": 3}), "k", "n", 2)
    assert {r["k"]: r["group"] for r in got.collect()} == {"a": 1, "b": 2, "c": 2}
    assert packing.greedy_pack(got.filter("false"), "k", "n", 2).count() == 0
    with pytest.raises(ValueError):
        packing.greedy_pack(counts_frame(spark, {"a": 1}), "k", "n", 0)


def written(spark, folder, rows, schema, files=3):
    path = f"{folder}/in"
    spark.createDataFrame(rows, schema).repartition(files).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("condition", ["true", "v % 3 > 0", "v > 70"])
def test_row_index_follows_files(spark, folder, monkeypatch, condition):
    monkeypatch.setattr(ordering, "CHUNK_ROWS", 8)
    df = written(spark, folder, [(i,) for i in range(100)], "v int").filter(condition)
    placed = ordering.with_position(df).orderBy("_file", "_pos").select("v").collect()
    got = ordering.row_index(df).orderBy("row_idx").collect()
    assert [r["row_idx"] for r in got] == list(range(len(placed)))
    assert [r["v"] for r in got] == [r["v"] for r in placed]


def test_row_index_without_gaps_needs_no_shuffle(spark, folder):
    df = written(spark, folder, [(i,) for i in range(100)], "v int")
    plan = ordering.row_index(df)._jdf.queryExecution().toString()
    assert "Window [row_number" not in plan and "hashpartitioning" not in plan


def test_row_index_empty(spark, folder):
    df = written(spark, folder, [(1,)], "v int").filter("v > 5")
    assert ordering.row_index(df).count() == 0
    assert partition.partition_simple(df, 3).count() == 0


def test_prefix_sums_spread_a_hot_key(spark):
    rows = spark.createDataFrame([("hot" if i % 3 else f"k{i}", i, i % 5) for i in range(300)], "k string, t int, v int")
    got = ordering.prefix_sums(rows, [F.col("k"), F.col("t")], "v", "before").orderBy("k", "t").collect()
    total = 0
    for r in got:
        assert r["before"] == total
        total += r["v"]


@pytest.mark.parametrize("rows,n,sizes", [(10, 4, [3, 3, 2, 2]), (2, 4, [1, 1]), (7, 7, [1] * 7)])
def test_partition_simple(spark, folder, rows, n, sizes):
    df = written(spark, folder, [(i,) for i in range(rows)], "v int", 1)
    split = partition.partition_simple(df, n, ["v"])
    assert [r["n_rows"] for r in partition.rows_per_partition(split).orderBy("group").collect()] == sizes
    by_group = split.orderBy("v").collect()
    assert [r["group"] for r in by_group] == sorted(r["group"] for r in by_group)


def test_shuffled_partition_is_reproducible(spark, folder):
    df = written(spark, folder, [(i,) for i in range(50)], "v int")
    once, again, other = (
        [tuple(r) for r in partition.partition_simple(df, 4, shuffle_seed=s).orderBy("v").collect()] for s in (1, 1, 2)
    )
    assert once == again != other


def test_chunk_labels(spark, folder):
    rows = [("b" if i % 2 else ("a" if i % 3 else None), i) for i in range(20)]
    df = written(spark, folder, rows, "label string, v int", 1)
    got = partition.chunk_labels(df, "label", 3).collect()
    ordered = [r[0] for r in ordering.with_position(df).orderBy(F.col("label").asc_nulls_first(), "_pos").select("v").collect()]
    size = 7  # ceil(20 / 3)
    place = {v: i // size + 1 for i, v in enumerate(ordered)}
    for r in got:
        assert r["label_chunk"] == (None if r["label"] is None else f"{r['label']}_{place[r['v']]}")
    replaced = partition.chunk_labels(df, "label", 3, out="label")
    assert {r["label"] for r in replaced.collect()} == {r["label_chunk"] for r in got}


def test_partition_by_host_properties(spark, folder):
    rows = [(f"https://h{min(i % 17, i % 5)}.org/{i}",) for i in range(400)] + [(None,), ("",)]
    df = written(spark, folder, rows, "url string")
    split = partition.partition_by_host(df, "url", 5)
    assert split.count() == len(rows)
    assert split.groupBy("host").agg(F.countDistinct("group").alias("n")).filter("n <> 1").count() == 0
    assert split.filter("host = 'unknown'").count() == 2
    sizes = [r["n_rows"] for r in partition.rows_per_partition(split).collect()]
    biggest = split.groupBy("host").count().agg(F.max("count")).first()[0]
    best = max(biggest, -(-len(rows) // 5))
    assert max(sizes) <= best * 4 / 3 + 1


def test_partition_by_label_keeps_nulls(spark, folder):
    df = written(spark, folder, [("x" if i % 4 else None, i, 9) for i in range(40)], "label string, v int, group int")
    split = partition.partition_by_label(df, "label", 3)
    assert split.count() == 40 and split.filter("group is null").count() == 0
    with pytest.raises(ValueError, match="available: label"):
        partition.partition_by_label(df, "nope", 3)


@pytest.mark.parametrize("rows,parts", [(joins.BROADCAST_ROWS, joins.HOT_PARTS), (0, 4), (0, 1), (0, 10_000)])
def test_attach_by_key_strategies(spark, monkeypatch, rows, parts):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", rows)
    monkeypatch.setattr(joins, "HOT_PARTS", parts)
    data = [("hot" if i % 3 else (None if i % 2 else f"k{i % 11}"), i) for i in range(200)] + [("lost", -1)]
    left = spark.createDataFrame(data, "k string, v int")
    counts = left.filter("k <> 'lost' or k is null").groupBy("k").agg(F.count("*").alias("n_rows"))
    table = counts.withColumn("tag", F.coalesce("k", F.lit("null")))
    got = joins.attach_by_key(left, table, "k", "n_rows")
    assert got.columns == ["k", "v", "tag"]
    assert sorted((r["v"], r["tag"]) for r in got.collect()) == sorted(
        (v, None if k == "lost" else (k or "null")) for k, v in data
    )


def test_plan_parallelism(spark):
    hosts = spark.createDataFrame([("a",), ("b",), ("a",)], "host string")
    assert tuple(partition.plan_parallelism(hosts, 2000).first()) == (2, 4000)
    assert tuple(partition.plan_parallelism(hosts, 9000).first()) == (2, 10000)
    assert tuple(partition.plan_parallelism(hosts, 9000, 12).first()) == (2, 12)
    assert tuple(partition.plan_parallelism(hosts, 2000, 0).first()) == (2, 4000)


def test_clean_manifest(spark):
    df = spark.createDataFrame([(" a \t", 1), (" ", 2), (None, 3), ("b", 4)], "url string, v int")
    assert [tuple(r) for r in manifest.clean_manifest(df, "url").orderBy("v").collect()] == [("a", 1), ("b", 4)]
    with pytest.raises(ValueError, match="no valid URLs"):
        manifest.require_rows(manifest.clean_manifest(df.filter("v = 3"), "url"))


def test_sample(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    picked = [r["k"] for r in ordering.sample_n(df, 40, ["k"], 1).collect()]
    assert len(set(picked)) == 40
    assert sorted(picked) == sorted(r["k"] for r in ordering.sample_n(df.repartition(3), 40, ["k"], 1).collect())
    assert ordering.sample_n(df, 1000, ["k"]).count() == 500


def test_pacing_example(spark):
    rows = [("a", t, 1.0, 2, i) for i, t in enumerate([0.0, 0.1, 0.15, 5.0])]
    df = spark.createDataFrame(rows, "host string, at double, rtprop double, c int, id int")
    got = pacing.pace_requests(df, "host", "at", "rtprop", "c", "id").orderBy("id").collect()
    assert [r["release"] for r in got] == [0.0, 0.5, 1.0, 5.0]
    assert {r["rate"] for r in got} == {2.0}


def test_pacing_of_a_hot_host(spark):
    rng = random.Random(3)
    rows = []
    for i in range(900):
        host = "hot" if i % 3 else (f"h{i % 4}" if i % 4 else None)
        known = host != "h1"
        rows.append((host, rng.choice([0.0, rng.random() * 40]), 0.4 if known else None, 4, i))
    df = spark.createDataFrame(rows, "host string, at double, rtprop double, c int, id int")
    got = {r["id"]: r["release"] for r in pacing.pace_requests(df, "host", "at", "rtprop", "c", "id").collect()}
    previous = {}
    for host, at, rtprop, c, i in sorted(rows, key=lambda r: (r[0] or "", r[1], r[4])):
        delay = 0.01 if rtprop is None else rtprop / c
        previous[host] = at if host not in previous else max(at, previous[host] + delay)
        assert got[i] == pytest.approx(previous[host], abs=1e-9)
