"""Sources and sinks, checked by writing and reading back."""

from __future__ import annotations

from pyspark.sql import functions as F

from urlsheaf.functions import names
from urlsheaf.operators import fetch as fetching
from urlsheaf.operators import partition, probe
from urlsheaf.operators.manifest import with_host
from urlsheaf.operators.requests import plan_requests
from urlsheaf.plans import collect
from urlsheaf.plans.catalogue.fetching import PROBED, probed
from urlsheaf.plans.catalogue.inputs import (
    DOCS,
    GROUPS,
    MANIFEST,
    SQL_FINAL,
    docs,
    manifest,
    origin,
    requests,
    sql_file,
    sql_host,
    sql_pack,
    table,
)
from urlsheaf.plans.catalogue.registry import query
from urlsheaf.session import scratch_path
from urlsheaf.sinks import partitions, samples
from urlsheaf.sources.archives import read_members
from urlsheaf.sources.checkpoints import completed_batches, read_checkpoints
from urlsheaf.sources.listing import list_outputs
from urlsheaf.sources.manifest import read_manifest, read_manifest_dir, read_partitions
from urlsheaf.sources.overviews import read_overviews


@query("read_manifest", "SELECT page_id, url FROM pages")
def _(spark, sf):
    return read_manifest(spark, f"{sf}/pages.parquet").select("page_id", "url")


@query("read_manifest_csv", f"WITH {DOCS} SELECT doc_id, url, label FROM docs")
def _(spark, sf):
    path = scratch_path(spark, "manifest") + ".csv"
    docs(spark, sf).select("doc_id", "url", "label").write.option("header", True).csv(path)
    return read_manifest(spark, path, schema="doc_id bigint, url string, label string")


@query("read_manifest_xml", f"WITH {DOCS} SELECT doc_id, url, label FROM docs")
def _(spark, sf):
    path = scratch_path(spark, "manifest") + ".xml"
    rows = docs(spark, sf).select("doc_id", "url", "label")
    rows.write.format("xml").option("rowTag", "row").option("rootTag", "rows").save(path)
    return read_manifest(spark, path, schema="doc_id bigint, url string, label string")


@query(
    "read_manifest_dir",
    f"WITH {DOCS}, {MANIFEST} SELECT url, label, n_chars FROM docs UNION ALL SELECT url, label, -1 FROM manifest",
)
def _(spark, sf):
    path = scratch_path(spark, "manifests")
    docs(spark, sf).select("url", "label", "n_chars").write.parquet(path)
    manifest(spark, sf).select("label", "url").write.mode("append").parquet(path)
    merged = read_manifest_dir(spark, path)
    return merged.select("url", "label", F.coalesce("n_chars", F.lit(-1)).alias("n_chars"))


@query("read_partitions", 'SELECT doc_id, CAST(ntile(7) OVER (ORDER BY doc_id) AS INTEGER) AS "group" FROM documents')
def _(spark, sf):
    path = scratch_path(spark, "partitions")
    split = partition.partition_simple(table(spark, sf, "documents").select("doc_id"), 7)
    partitions.write_partitions(split, path)
    return read_partitions(spark, path)


_GROUPED = f"""hosted AS (SELECT page_id, url, label, {sql_host('url')} AS host FROM manifest),
counts AS (SELECT host, count(*) AS n_rows FROM hosted GROUP BY host), {sql_pack('counts', 'host', GROUPS)}"""


@query(
    "write_partitions",
    f"""WITH RECURSIVE {MANIFEST}, {_GROUPED}
SELECT page_id, url, label, host, "group" FROM hosted JOIN packed USING (host)""",
)
def _(spark, sf):
    path = scratch_path(spark, "partitions")
    split = partition.partition_by_host(manifest(spark, sf), "url", GROUPS)
    partitions.write_partitions(split, path, "csv")
    schema = "page_id bigint, url string, label string, host string, group int"
    return spark.read.schema(schema).option("header", True).csv(path)


def _stored(spark, sf, fmt):
    pages = manifest(spark, sf)
    wanted = plan_requests(pages, "url", "page_id", "label", "out", fmt)
    return fetching.fetch_with_retry(wanted, origin(spark, sf))


@query(
    "write_imagefolder",
    f"""WITH {MANIFEST}, {SQL_FINAL} SELECT replace(label, ' ', '_') || '/' || {sql_file('page_id', 'url')} AS path,
  bytes_downloaded AS length FROM final WHERE success""",
)
def _(spark, sf):
    out = scratch_path(spark, "folders")
    samples.write_imagefolder(_stored(spark, sf, names.IMAGEFOLDER), out, layout_root="out")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(out)
    path = F.regexp_extract("path", r"([^/]+/[^/]+)$", 1)
    return files.filter(~F.col("path").endswith("_SUCCESS")).select(path.alias("path"), "length")


@query(
    "write_webdataset",
    f"""WITH {MANIFEST}, {SQL_FINAL}, sides AS (SELECT regexp_replace({sql_file('page_id', 'url')}, '\\.[^.]*$', '') AS sample,
  CAST(page_id AS VARCHAR) AS key, url, label AS class_name FROM final WHERE success) SELECT * FROM sides""",
)
def _(spark, sf):
    out = scratch_path(spark, "flat")
    samples.write_webdataset(_stored(spark, sf, names.WEBDATASET), out, layout_root="out")
    sides = spark.read.schema("key string, url string, class_name string").json(f"{out}/*.json")
    sample = F.regexp_extract("_metadata.file_name", r"^(.+)\.json$", 1)
    return sides.select(sample.alias("sample"), "key", "url", "class_name")


@query(
    "write_tar_shards",
    f"""WITH RECURSIVE {MANIFEST}, {SQL_FINAL}, {_GROUPED} SELECT 'output_partition_' || lpad(CAST("group" AS VARCHAR), 3, '0')
  AS partition_name, count(*) AS total_urls, count(*) FILTER (success) AS successful_downloads,
  count(*) FILTER (NOT success) AS failed_downloads, round(sum(bytes_downloaded) / 1e6, 2) AS downloaded_mb
FROM final JOIN hosted USING (page_id) JOIN packed USING (host) GROUP BY "group" """,
)
def _(spark, sf):
    out = scratch_path(spark, "dataset")
    job = collect.Job(label="label", groups=GROUPS)
    collect.collect_dataset(manifest(spark, sf), origin(spark, sf), out, job)
    shards = read_overviews(spark, f"{out}/shards/*.tar.gz")
    # a group has archives of every slice and attempt
    return shards.groupBy(F.substring("partition_name", 1, 20).alias("partition_name")).agg(
        *[F.sum(c).alias(c) for c in ("total_urls", "successful_downloads", "failed_downloads")],
        F.round(F.sum("downloaded_mb"), 2).alias("downloaded_mb"),
    )


@query(
    "archive_members",
    f"""WITH RECURSIVE {MANIFEST}, {SQL_FINAL} SELECT replace(label, ' ', '_') || '/' || {sql_file('page_id', 'url')} AS member,
  bytes_downloaded AS size, sha256(html) AS sha256 FROM final JOIN (SELECT page_id, html FROM pages) USING (page_id) WHERE success""",
)
def _(spark, sf):
    """Names, sizes and contents of what a collection has put into its archives."""
    out = scratch_path(spark, "dataset")
    job = collect.Job(label="label", groups=GROUPS, shard_bytes=1 << 16)
    wanted = manifest(spark, sf)
    collect.collect_dataset(wanted, origin(spark, sf), out, job)
    packed = read_members(spark, f"{out}/shards/*.tar.gz", content=True).filter(~F.col("member").endswith("/overview.json"))
    return packed.select(
        F.regexp_replace("member", "^[^/]+/", "").alias("member"), "size", F.sha2("content", 256).alias("sha256")
    )


@query(
    "list_outputs",
    f"""WITH RECURSIVE {MANIFEST}, {_GROUPED}
SELECT DISTINCT 'output_partition_' || lpad(CAST("group" AS VARCHAR), 3, '0') || '_0001_0001.tar' AS name, true AS filled FROM packed""",
)
def _(spark, sf):
    out = scratch_path(spark, "shards")
    split = partition.partition_by_host(manifest(spark, sf), "url", GROUPS).select(
        F.col("page_id").cast("string").alias("row_key"), "group"
    )
    answered = requests(spark, sf).join(split, "row_key")
    got = fetching.fetch_with_retry(answered, origin(spark, sf))
    samples.write_tar_shards(samples.shard_names(got), out, compress=False, layout_root="out")
    listed = list_outputs(spark, out, "*.tar")
    return listed.select("name", (F.col("size_mib") > 0).alias("filled"))


@query("write_corrected", f"WITH {PROBED} SELECT doc_id, corrected_url AS url, label FROM docs JOIN probed ON idx = doc_id")
def _(spark, sf):
    path = scratch_path(spark, "corrected")
    rows = docs(spark, sf).select("doc_id", "url", "label").withColumn("idx", F.col("doc_id"))
    partitions.write_corrected(probe.apply_probe(rows, probed(spark, sf), "url"), path)
    return read_manifest(spark, path, "parquet")


@query("read_checkpoints", f"WITH {PROBED} SELECT idx, corrected_url, extension, status, idx // 256 AS batch_idx FROM probed")
def _(spark, sf):
    path = scratch_path(spark, "checkpoints")
    rows = probed(spark, sf, checkpoint=path)
    return read_checkpoints(spark, path, rows.count())


@query("probe_resumed", f"WITH {PROBED} SELECT idx, corrected_url, extension, status, idx // 256 AS batch_idx FROM probed")
def _(spark, sf):
    """An earlier run was broken off inside a batch, and never began others."""
    whole, path = scratch_path(spark, "whole"), scratch_path(spark, "checkpoints")
    probed(spark, sf, checkpoint=whole)
    part = F.when(F.col("batch_idx") % 2 == 0, F.col("idx") % 3 != 0).otherwise(F.col("batch_idx") % 3 == 0)
    spark.read.parquet(whole).filter(part).write.partitionBy("batch_idx").parquet(path)
    return probed(spark, sf, checkpoint=path)


@query("completed_batches", "SELECT DISTINCT doc_id // 256 AS batch_idx FROM documents")
def _(spark, sf):
    path = scratch_path(spark, "checkpoints")
    probed(spark, sf, checkpoint=path)
    return completed_batches(spark, path)


@query(
    "split_written_by_host",
    f"""WITH RECURSIVE {MANIFEST}, {_GROUPED} SELECT "group", count(*) AS n_rows, count(DISTINCT host) AS n_hosts
FROM hosted JOIN packed USING (host) GROUP BY 1""",
)
def _(spark, sf):
    path = scratch_path(spark, "partitions")
    partitions.write_partitions(partition.partition_by_host(manifest(spark, sf), "url", GROUPS), path, keep_host=False)
    back = with_host(read_partitions(spark, path), "url")
    return partition.rows_per_partition(back).join(partition.hosts_per_partition(back), "group")
