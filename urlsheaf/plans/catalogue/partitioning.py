"""Order, packing, partitioning and joins."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from urlsheaf.operators import manifest as manifests
from urlsheaf.operators import ordering, packing, pacing, partition, probe, sketches
from urlsheaf.operators.transport import first_working
from urlsheaf.plans import collect
from urlsheaf.plans.catalogue.inputs import (
    DOCS,
    GROUPS,
    HEAD,
    LINES,
    LINKS,
    LOG,
    MANIFEST,
    RAW_DOCS,
    docs,
    head_answers,
    lines,
    links,
    manifest,
    raw_docs,
    request_log,
    sql_host,
    sql_pack,
    table,
)
from urlsheaf.plans.catalogue.registry import query
from urlsheaf.functions.urls import repair_candidates
from urlsheaf.session import materialise

LARGE = 16
HOSTED = f"{LINES}, hosted AS (SELECT url, label, {sql_host('url')} AS host FROM lines)"
HOST_COUNTS = f"{HOSTED}, counts AS (SELECT host, count(*) AS n_rows FROM hosted GROUP BY host)"
PACKED = f"{HOST_COUNTS}, {sql_pack('counts', 'host', LARGE)}"
GROUPED = f'{PACKED}, grouped AS (SELECT url, host, "group" FROM hosted JOIN packed USING (host))'


def _hosted(spark, sf):
    return manifests.with_host(lines(spark, sf), "url")


@query("row_index", "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_idx FROM documents")
def _(spark, sf):
    return ordering.row_index(table(spark, sf, "documents").select("doc_id"))


@query(
    "row_index_ordered",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) - 1 AS row_idx
FROM lineitem""",
)
def _(spark, sf):
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    rows = table(spark, sf, "lineitem").select(*order)
    return ordering.row_index(rows, order).drop("l_extendedprice", "l_shipdate")


@query(
    "batch_index",
    "SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 64 AS batch_idx FROM documents",
)
def _(spark, sf):
    numbered = ordering.row_index(table(spark, sf, "documents").select("doc_id"))
    return ordering.batch_index(numbered, 64).select("doc_id", "batch_idx")


@query("host_counts", f"WITH {HOSTED} SELECT host, count(*) AS n_rows FROM hosted GROUP BY host")
def _(spark, sf):
    return partition.host_counts(_hosted(spark, sf))


@query("label_counts", "SELECT l_returnflag AS label, count(*) AS n_rows FROM lineitem GROUP BY 1")
def _(spark, sf):
    return partition.label_counts(lines(spark, sf), "label")


@query(
    "top_hosts",
    f"WITH {HOSTED} SELECT host, count(*) AS n_rows FROM hosted GROUP BY host ORDER BY n_rows DESC, host LIMIT 5",
)
def _(spark, sf):
    return partition.top_hosts(_hosted(spark, sf))


@query("distinct_hosts", f"WITH {LINKS} SELECT DISTINCT {sql_host('url')} AS host FROM links")
def _(spark, sf):
    return manifests.distinct_hosts(manifests.with_host(links(spark, sf), "url"))


@query(
    "plan_parallelism",
    f"""WITH {HOSTED} SELECT count(DISTINCT host) AS n_hosts, least(count(DISTINCT host) * 40, 10000) AS pool_size
FROM hosted""",
)
def _(spark, sf):
    return partition.plan_parallelism(_hosted(spark, sf), 40)


@query("greedy_pack", f'WITH RECURSIVE {PACKED} SELECT host, n_rows, "group" FROM packed')
def _(spark, sf):
    counts = _hosted(spark, sf).groupBy("host").agg(F.count("*").alias("n_rows"))
    return packing.greedy_pack(counts, "host", "n_rows", LARGE)


@query(
    "attach_host_group",
    f'WITH RECURSIVE {GROUPED} SELECT host, "group", count(*) AS n FROM grouped GROUP BY host, "group"',
)
def _(spark, sf):
    hosted = _hosted(spark, sf)
    groups = packing.greedy_pack(hosted.groupBy("host").agg(F.count("*").alias("n_rows")), "host", "n_rows", LARGE)
    return partition.attach_host_group(hosted, groups).groupBy("host", "group").agg(F.count("*").alias("n"))


@query("partition_by_host", f'WITH RECURSIVE {GROUPED} SELECT url, host, "group" FROM grouped')
def _(spark, sf):
    return partition.partition_by_host(lines(spark, sf), "url", LARGE).select("url", "host", "group")


@query(
    "partition_summary",
    f"""WITH RECURSIVE {MANIFEST}, hosted AS (SELECT {sql_host('url')} AS host FROM manifest),
counts AS (SELECT host, count(*) AS n_rows FROM hosted GROUP BY host), {sql_pack('counts', 'host', GROUPS)},
sizes AS (SELECT "group", sum(n_rows) AS n FROM packed GROUP BY 1)
SELECT count(*) AS n_groups, CAST(sum(n) AS BIGINT) AS n_rows, CAST(min(n) AS BIGINT) AS min_rows,
       CAST(max(n) AS BIGINT) AS max_rows, avg(n) AS mean_rows FROM sizes""",
)
def partition_summary(spark, sf):
    return partition.partition_summary(partition.partition_by_host(manifest(spark, sf), "url", GROUPS))


_SQL_SKETCHED = f"""all_urls AS (SELECT label AS "group", {sql_host('url')} AS host, url FROM manifest
  UNION ALL SELECT label, {sql_host('url')}, url FROM docs)"""


def _two_manifests(spark, sf):
    """Sketches of two manifests, stored; the rows of neither are read again."""
    both = (manifest(spark, sf).select("url", F.col("label").alias("group")), docs(spark, sf).select("url", F.col("label").alias("group")))
    return [materialise(sketches.host_sketches(m, "url"), "hosts") for m in both], both


@query("sketched_hosts", f'WITH {MANIFEST}, {DOCS}, {_SQL_SKETCHED} SELECT "group", count(DISTINCT host) AS n_hosts FROM all_urls GROUP BY 1')
def _(spark, sf):
    made, _ = _two_manifests(spark, sf)
    return sketches.estimated_hosts(sketches.merged_hosts(*made)).select("group", F.col("n_hosts").cast("long").alias("n_hosts"))


@query(
    "shared_hosts",
    f"""WITH {MANIFEST}, {DOCS}, {_SQL_SKETCHED}, held AS (SELECT DISTINCT "group", host FROM all_urls),
names AS (SELECT "group" AS a, lead("group") OVER (ORDER BY "group") AS b FROM (SELECT DISTINCT "group" FROM all_urls))
SELECT a, b, (SELECT count(*) FROM held x JOIN held y USING (host) WHERE x."group" = a AND y."group" = b) AS n_shared
FROM names WHERE b IS NOT NULL""",
)
def _(spark, sf):
    """Each group with the next one by name."""
    merged = materialise(sketches.merged_hosts(*_two_manifests(spark, sf)[0]), "merged")
    # one row per group
    pairs = merged.select(F.col("group").alias("a"), F.lead("group").over(Window.orderBy("group")).alias("b")).filter("b IS NOT NULL")
    return sketches.shared_hosts(merged, pairs).withColumn("n_shared", F.col("n_shared").cast("long"))


@query("sketched_urls", f"WITH {MANIFEST}, {DOCS}, {_SQL_SKETCHED} SELECT true AS close FROM (SELECT count(DISTINCT url) AS n FROM all_urls)")
def _(spark, sf):
    """Different URLs of both manifests, within five standard errors."""
    both = _two_manifests(spark, sf)[1]
    estimate = sketches.estimated_urls(*[sketches.url_sketch(m, "url") for m in both]).first()[0]
    exact = both[0].select("url").unionByName(both[1].select("url")).agg(F.count_distinct("url").alias("n"))
    return exact.select((F.abs(F.col("n") - estimate) <= 5 * sketches.distinct_error() * F.col("n") + 1).alias("close"))


@query(
    "hosts_per_partition",
    f'WITH RECURSIVE {GROUPED} SELECT "group", count(DISTINCT host) AS n_hosts FROM grouped GROUP BY 1',
)
def _(spark, sf):
    return partition.hosts_per_partition(partition.partition_by_host(lines(spark, sf), "url", LARGE))


@query(
    "plan_only",
    f"""WITH RECURSIVE {GROUPED} SELECT "group", count(*) AS n_rows, count(DISTINCT host) AS n_hosts,
  'output_partition_' || lpad(CAST("group" AS VARCHAR), 3, '0') AS target FROM grouped GROUP BY "group" """,
)
def _(spark, sf):
    return collect.plan_only(lines(spark, sf), collect.Job(groups=LARGE))


@query(
    "partition_simple",
    'SELECT doc_id, CAST(ntile(7) OVER (ORDER BY doc_id) AS INTEGER) AS "group" FROM documents',
)
def _(spark, sf):
    return partition.partition_simple(table(spark, sf, "documents").select("doc_id"), 7)


@query(
    "partition_simple_shuffled",
    """SELECT CAST(g AS INTEGER) AS "group", total // 7 + CASE WHEN g <= total % 7 THEN 1 ELSE 0 END AS n_rows
FROM (SELECT count(*) AS total FROM lineitem), generate_series(1, 7) AS s(g)""",
)
def _(spark, sf):
    return partition.rows_per_partition(partition.partition_simple(lines(spark, sf), 7, shuffle_seed=11))


_CHUNKED = """numbered AS (SELECT doc_id, source, row_number() OVER (ORDER BY source, doc_id) - 1 AS i,
  count(*) OVER () AS total FROM documents),
chunked AS (SELECT doc_id, source, source || '_' || (i // ((total + 5) // 6) + 1) AS label_chunk FROM numbered)"""


@query("chunk_labels", f"WITH {_CHUNKED} SELECT doc_id, source, label_chunk FROM chunked")
def _(spark, sf):
    return partition.chunk_labels(table(spark, sf, "documents").select("doc_id", "source"), "source", 6)


@query(
    "partition_by_label",
    f"""WITH RECURSIVE {_CHUNKED},
counts AS (SELECT label_chunk, count(*) AS n_rows FROM chunked GROUP BY 1), {sql_pack('counts', 'label_chunk', 6)}
SELECT doc_id, source, label_chunk, "group" FROM chunked JOIN packed USING (label_chunk)""",
)
def _(spark, sf):
    return partition.partition_by_label(table(spark, sf, "documents").select("doc_id", "source"), "source", 6)


@query(
    "attach_label_group",
    f"""WITH RECURSIVE counts AS (
  SELECT n_nationkey % 5 AS k, CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE 'label ' || n_nationkey % 5 END AS label,
         count(*) AS n_rows
  FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2),
ranked AS MATERIALIZED (SELECT label, n_rows, row_number() OVER (ORDER BY n_rows DESC, label NULLS FIRST) AS rn FROM counts),
pack AS (
  SELECT 0::BIGINT AS rn, CAST(NULL AS VARCHAR) AS label, 0::BIGINT AS bin, [0::BIGINT, 0::BIGINT] AS sums
  UNION ALL
  SELECT r.rn, r.label, CASE WHEN p.sums[2] < p.sums[1] THEN 2 ELSE 1 END,
         CASE WHEN p.sums[2] < p.sums[1] THEN [p.sums[1], p.sums[2] + r.n_rows] ELSE [p.sums[1] + r.n_rows, p.sums[2]] END
  FROM pack p JOIN ranked r ON r.rn = p.rn + 1)
SELECT s_suppkey, k.label, CAST(bin AS INTEGER) AS "group"
FROM (SELECT s_suppkey, CASE WHEN s_nationkey % 5 = 0 THEN NULL ELSE 'label ' || s_nationkey % 5 END AS label
      FROM supplier) k
JOIN pack ON pack.rn > 0 AND pack.label IS NOT DISTINCT FROM k.label""",
)
def _(spark, sf):
    kind = F.col("s_nationkey") % 5
    label = F.when(kind != 0, F.concat(F.lit("label "), kind.cast("string")))
    rows = table(spark, sf, "supplier").select("s_suppkey", label.alias("label"))
    groups = packing.greedy_pack(partition.label_counts(rows, "label"), "label", "n_rows", 2)
    return partition.attach_label_group(rows, groups, "label")


@query(
    "sample_n",
    f"""WITH {DOCS} SELECT doc_id, url FROM docs ORDER BY md5(doc_id || '|' || '5'), doc_id LIMIT 100""",
)
def _(spark, sf):
    return ordering.sample_n(docs(spark, sf).select("doc_id", "url"), 100, ["doc_id"], 5)


@query(
    "first_working",
    rf"""WITH {DOCS}, {HEAD}, parts AS (
  SELECT doc_id, url, regexp_extract(url, '^(.+)\.([\w\p{{L}}\p{{N}}_]+)$', 1) AS base,
         lower(regexp_extract(url, '^(.+)\.([\w\p{{L}}\p{{N}}_]+)$', 2)) AS ext FROM docs),
tries AS (SELECT doc_id, list_concat([url], [base || '.' || e FOR e IN ['jpeg', 'jpg', 'png', 'gif'] IF e <> ext]) AS urls FROM parts WHERE ext <> ''),
each AS (SELECT doc_id, urls, unnest(generate_series(1, len(urls))) AS i FROM tries),
hits AS (SELECT doc_id, i - 1 AS pos, urls[i] AS candidate FROM each JOIN head ON served = urls[i] WHERE status = 200)
SELECT doc_id, CAST(min(pos) AS INTEGER) AS pos, arg_min(candidate, pos) AS candidate FROM hits GROUP BY doc_id""",
)
def _(spark, sf):
    answers = head_answers(spark, sf).answers.select(F.col("url").alias("candidate"), (F.col("status") == 200).alias("ok"))
    tried = repair_candidates(docs(spark, sf), "url").join(answers, "candidate")
    return first_working(tried, "doc_id", "pos", "ok", "candidate")


@query(
    "pace_requests",
    f"""WITH {LOG}, spaced AS (
  SELECT event_id, host, epoch_us(ts) / 1e6 AS arrival,
         CASE host WHEN 'h0' THEN 0.01 WHEN 'h1' THEN 1200.0 / 4 ELSE 600.0 / 1 END AS delay FROM log),
numbered AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY arrival, event_id) - 1 AS i FROM spaced)
SELECT event_id, host, delay, round(i * delay + max(arrival - i * delay) OVER (
         PARTITION BY host ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 3) AS release,
       1 / delay AS rate FROM numbered""",
)
def _(spark, sf):
    host = F.col("host")
    rows = request_log(spark, sf).select(
        "event_id",
        "host",
        (F.unix_micros("ts") / 1e6).alias("arrival"),
        F.when(host == "h1", 1200.0).when(host != "h0", 600.0).alias("rtprop"),
        F.when(host == "h1", 4).otherwise(1).alias("c"),
    )
    paced = pacing.pace_requests(rows, "host", "arrival", "rtprop", "c", "event_id")
    return paced.select("event_id", "host", "delay", F.round("release", 3).alias("release"), "rate")


@query(
    "pace_requests_changing",
    f"""WITH RECURSIVE {LOG}, numbered AS MATERIALIZED (
  SELECT event_id, host, epoch_us(ts) // 1000000 AS arrival, (1 + event_id % 5) * 600.0 / 4 AS delay,
         row_number() OVER (PARTITION BY host ORDER BY epoch_us(ts) // 1000000, event_id) AS i FROM log),
paced AS (
  SELECT event_id, host, i, CAST(arrival AS DOUBLE) AS release FROM numbered WHERE i = 1
  UNION ALL
  SELECT n.event_id, n.host, n.i, greatest(CAST(n.arrival AS DOUBLE), p.release + n.delay)
  FROM paced p JOIN numbered n ON n.host = p.host AND n.i = p.i + 1)
SELECT event_id, host, release FROM paced""",
)
def _(spark, sf):
    rows = request_log(spark, sf).select(
        "event_id",
        "host",
        F.floor(F.unix_micros("ts") / 1e6).cast("double").alias("arrival"),
        ((1 + F.col("event_id") % 5) * 600.0).alias("rtprop"),
        F.lit(4).alias("c"),
    )
    paced = pacing.pace_requests(rows, "host", "arrival", "rtprop", "c", "event_id")
    return paced.select("event_id", "host", "release")


@query(
    "row_index_union",
    f"""WITH {DOCS}, {MANIFEST}, both_tables AS (SELECT url FROM docs UNION ALL SELECT url FROM manifest)
SELECT row_number() OVER () - 1 AS row_idx FROM both_tables""",
)
def _(spark, sf):
    both = manifests.concat_all(docs(spark, sf).select("url"), manifest(spark, sf).select("url"))
    return ordering.row_index(both).select("row_idx")


@query(
    "partition_simple_joined",
    """SELECT CAST(g AS INTEGER) AS "group", total // 7 + CASE WHEN g <= total % 7 THEN 1 ELSE 0 END AS n_rows
FROM (SELECT count(*) AS total FROM supplier JOIN nation ON s_nationkey = n_nationkey), generate_series(1, 7) AS s(g)""",
)
def _(spark, sf):
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    joined = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey").join(nation, "s_nationkey")
    return partition.rows_per_partition(partition.partition_simple(joined, 7))


@query(
    "preview",
    f"""WITH {MANIFEST} SELECT page_id, url, label, (SELECT count(*) FROM manifest) AS n_rows, 3 AS n_columns
FROM manifest ORDER BY page_id LIMIT 10""",
)
def _(spark, sf):
    return manifests.preview(manifest(spark, sf), 10, ["page_id"])


@query(
    "concat_all",
    f"""WITH {MANIFEST}, {DOCS}, {LINKS} SELECT url, label FROM manifest UNION ALL SELECT url, label FROM docs
UNION ALL SELECT url, NULL FROM links""",
)
def _(spark, sf):
    return manifests.concat_all(
        manifest(spark, sf).select("url", "label"), docs(spark, sf).select("url", "label"), links(spark, sf).select("url")
    )


@query(
    "pending_batches",
    """WITH numbered AS (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 64 AS batch_idx FROM documents)
SELECT batch_idx, doc_id FROM numbered WHERE batch_idx NOT IN (SELECT DISTINCT label FROM embeddings)""",
)
def _(spark, sf):
    numbered = ordering.row_index(table(spark, sf, "documents").select("doc_id"))
    batches = ordering.batch_index(numbered, 64).select("batch_idx", "doc_id")
    done = table(spark, sf, "embeddings").select(F.col("label").cast("long").alias("batch_idx")).distinct()
    return probe.pending_batches(batches, done)


@query(
    "sorted_manifest",
    f"""WITH {RAW_DOCS} SELECT doc_id, url, row_number() OVER (ORDER BY url NULLS FIRST, doc_id) - 1 AS row_idx
FROM raw_docs""",
)
def _(spark, sf):
    rows = raw_docs(spark, sf).select("doc_id", "url")
    return ordering.row_index(rows, [F.col("url").asc_nulls_first(), F.col("doc_id")])
