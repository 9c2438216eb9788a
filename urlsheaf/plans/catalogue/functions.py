"""Column functions over whole tables and whole texts."""

from __future__ import annotations

from http import HTTPStatus

from pyspark.sql import functions as F

from urlsheaf.functions import names, status, units, urls
from urlsheaf.operators import manifest as manifests
from urlsheaf.plans.catalogue.inputs import (
    DOCS,
    LINKS,
    LOG,
    MANIFEST,
    RAW_DOCS,
    docs,
    links,
    manifest,
    raw_docs,
    request_log,
    sql_ext,
    sql_file,
    sql_host,
    sql_last,
    sql_path,
    sql_suffix,
    table,
)
from urlsheaf.plans.catalogue.registry import query

BLANK = r"[\s\p{Z}]"


@query(
    "clean_manifest",
    f"""WITH {RAW_DOCS} SELECT doc_id, label, stripped AS url
FROM (SELECT doc_id, label, regexp_replace(url, '^{BLANK}+|{BLANK}+$', '', 'g') AS stripped FROM raw_docs)
WHERE stripped IS NOT NULL AND length(stripped) > 0""",
)
def _(spark, sf):
    return manifests.clean_manifest(raw_docs(spark, sf), "url").select("doc_id", "label", "url")


@query(
    "add_row_key",
    f"""WITH {RAW_DOCS} SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS VARCHAR) AS row_key
FROM raw_docs WHERE trim(replace(replace(url, chr(9), ''), chr(10), '')) <> ''""",
)
def _(spark, sf):
    cleaned = manifests.clean_manifest(raw_docs(spark, sf), "url")
    return manifests.add_row_key(cleaned).select("doc_id", "row_key")


@query("extract_host", f"WITH {LINKS} SELECT page_id, CAST(pos AS INTEGER) AS pos, {sql_host('url')} AS host FROM links")
def _(spark, sf):
    return links(spark, sf).select("page_id", "pos", urls.extract_host(F.col("url")).alias("host"))


@query(
    "naive_host",
    r"""SELECT page_id, lower(regexp_replace(regexp_replace(url, '^https?://', ''), '/.*', '')) AS host FROM pages""",
)
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.naive_host(F.col("url")).alias("host"))


@query(
    "extract_extension",
    f"""WITH {DOCS}, {MANIFEST}
SELECT url, {sql_ext('url')} AS ext FROM (SELECT url FROM docs UNION ALL SELECT url FROM manifest)""",
)
def _(spark, sf):
    both = docs(spark, sf).select("url").unionByName(manifest(spark, sf).select("url"))
    return both.select("url", urls.extract_extension(F.col("url")).alias("ext"))


@query(
    "sanitize_label",
    """SELECT doc_id, translate(replace(replace(text, chr(39), ''), chr(34), ''), ' /', '__') AS folder FROM documents""",
)
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", names.sanitize_label(F.col("text")).alias("folder"))


def _sql_safe(name: str) -> str:
    squeezed = rf"regexp_replace(regexp_replace({name}, '^{BLANK}+|{BLANK}+$', '', 'g'), '[^A-Za-z0-9.\-]+', '_', 'g')"
    bare = rf"regexp_replace({squeezed}, '^[._]+|[._]+$', '', 'g')"
    return f"left(coalesce(nullif({bare}, ''), 'file'), 180)"


@query("sanitize_filename", f"SELECT doc_id, {_sql_safe('text')} AS name FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", names.sanitize_filename(F.col("text")).alias("name"))


@query("sequential_name", f"WITH {DOCS} SELECT doc_id, {sql_file('doc_id', 'url')} AS name FROM docs")
def _(spark, sf):
    return docs(spark, sf).select("doc_id", names.sequential_name(F.col("doc_id"), F.col("url")).alias("name"))


def _sql_rendered(stem: str, url: str) -> str:
    last = f"regexp_extract({sql_path(url)}, '([^/]+)/*$', 1)"
    ext = rf"regexp_extract({last}, '^.+(\.[^.]+)$', 1)"
    safe = _sql_safe(stem)
    named = f"CASE WHEN {ext} <> '' AND NOT ends_with({safe}, {ext}) THEN {safe} || {ext} ELSE {safe} END"
    suffix = rf"regexp_extract({named}, '^.+(\.[^.]+)$', 1)"
    return f"CASE WHEN {suffix} = '' THEN ({named}) || '.jpg' ELSE {named} END"


_SEGMENTS = f"[s FOR s IN string_split({sql_path('url')}, '/') IF s <> '']"
_KEYED = "CAST(doc_id AS VARCHAR) || '_' || CASE WHEN len(segs) >= 2 THEN segs[-2] ELSE segs[-1] END"


@query(
    "render_name",
    f"""WITH {DOCS}, segments AS (SELECT doc_id, url, {_SEGMENTS} AS segs FROM docs)
SELECT doc_id, {_sql_rendered(_KEYED, 'url')} AS by_parent, {_sql_rendered('segs[-1]', 'url')} AS by_last,
       {_sql_rendered('CAST(doc_id AS VARCHAR)', 'url')} AS by_default,
       {_sql_rendered("segs[1] || '-' || segs[2]", 'url')} AS by_index
FROM segments""",
)
def _(spark, sf):
    url, key = F.col("url"), F.col("doc_id").cast("string")
    return docs(spark, sf).select(
        "doc_id",
        names.render_name("{key}_{segment_parent}", url, key).alias("by_parent"),
        names.render_name("{segment_last}", url, key).alias("by_last"),
        names.render_name("{segment[-2]}", url, key).alias("by_default"),
        names.render_name("{segment_first}-{segment[1]}", url, key).alias("by_index"),
    )


_STEM = f"left({sql_last(sql_path('url'))}, length({sql_last(sql_path('url'))}) - length({sql_suffix(sql_path('url'))}))"


@query(
    "url_name",
    f"""WITH {DOCS}, {MANIFEST}
SELECT url, {_STEM} || coalesce(nullif({sql_ext('url')}, ''), '.jpg') AS name,
       {_STEM} || coalesce(nullif({sql_ext('url')}, ''), '.png') AS name_png
FROM (SELECT url FROM docs UNION ALL SELECT url FROM manifest)""",
)
def _(spark, sf):
    both = docs(spark, sf).select("url").unionByName(manifest(spark, sf).select("url"))
    return both.select(
        "url", urls.url_name(F.col("url")).alias("name"), urls.url_name(F.col("url"), ".png").alias("name_png")
    )


@query(
    "output_path",
    f"""WITH {MANIFEST}
SELECT page_id, 'out/' || coalesce(nullif(label, ''), 'output') || '/' || page_id AS folder_path,
       'out/' || page_id AS flat_path FROM manifest""",
)
def _(spark, sf):
    label, file = F.nullif(F.col("label"), F.lit("")), F.col("page_id").cast("string")
    return manifest(spark, sf).select(
        "page_id",
        names.output_path("out", names.IMAGEFOLDER, label, file).alias("folder_path"),
        names.output_path("out", names.WEBDATASET, label, file).alias("flat_path"),
    )


_SHAPE = r"^(.+)\.([\w\p{L}\p{N}_]+)$"


@query(
    "split_url_ext",
    f"""WITH {DOCS} SELECT doc_id, nullif(regexp_extract(url, '{_SHAPE}', 1), '') AS base,
       lower(nullif(regexp_extract(url, '{_SHAPE}', 2), '')) AS ext FROM docs""",
)
def _(spark, sf):
    return docs(spark, sf).select("doc_id", urls.split_url_ext(F.col("url")).alias("p")).select("doc_id", "p.*")


_TRIES = "[base || '.' || e FOR e IN ['jpeg', 'jpg', 'png', 'gif'] IF e <> ext]"


@query(
    "repair_candidates",
    f"""WITH {DOCS}, parts AS (
  SELECT doc_id, url, regexp_extract(url, '{_SHAPE}', 1) AS base, lower(regexp_extract(url, '{_SHAPE}', 2)) AS ext
  FROM docs),
tries AS (SELECT doc_id, list_concat([url], {_TRIES}) AS urls
          FROM parts WHERE ext <> '')
SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, urls[i] AS candidate
FROM (SELECT doc_id, urls, unnest(generate_series(1, len(urls))) AS i FROM tries)""",
)
def _(spark, sf):
    return urls.repair_candidates(docs(spark, sf), "url").select("doc_id", "pos", "candidate")


_SIZE_TRIES = "['.JPG', '.jpeg', '.JPEG', '.jpg', '.png', '.gif', '.webp', '.tiff']"


@query(
    "size_candidates",
    rf"""WITH {MANIFEST}, parts AS (
  SELECT page_id, url, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS site, {sql_path('url')} AS path,
         regexp_extract(url, '^[^?#]*(\?[^#]*)', 1) AS q, regexp_extract(url, '(#.*)$', 1) AS frag
  FROM manifest),
tries AS (
  SELECT page_id, list_concat(list_concat([url], [site || regexp_replace(path, '\.[^.]*$', '') || s || q || frag
           FOR s IN {_SIZE_TRIES}]), [url]) AS urls
  FROM parts)
SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, urls[i] AS candidate
FROM (SELECT page_id, urls, unnest(generate_series(1, len(urls))) AS i FROM tries)""",
)
def _(spark, sf):
    return urls.size_candidates(manifest(spark, sf), "url").select("page_id", "pos", "candidate")


_MESSAGE = """CASE event_type WHEN 'error' THEN 'Cannot connect to host ' || user_id WHEN 'click' THEN 'Read timed out'
  WHEN 'view' THEN 'HTTP 404: Not Found' WHEN 'signup' THEN 'Broken Pipe' END"""
_RETRYABLE_TEXT = (
    "connection reset by peer|server disconnected|connection refused|cannot connect|connection aborted|broken pipe"
    "|timeout|timed out"
)


def _messages(spark, sf):
    kind = F.col("event_type")
    message = (
        F.when(kind == "error", F.concat(F.lit("Cannot connect to host "), F.col("user_id").cast("string")))
        .when(kind == "click", F.lit("Read timed out"))
        .when(kind == "view", F.lit("HTTP 404: Not Found"))
        .when(kind == "signup", F.lit("Broken Pipe"))
    )
    code = (F.col("value").cast("int") + 380).alias("status_code")
    return table(spark, sf, "events").select("event_id", message.alias("error"), code, "user_id", "value", "props")


_MESSAGES = f"""messages AS (SELECT event_id, {_MESSAGE} AS error, CAST(trunc(value) AS INTEGER) + 380 AS status_code,
  user_id, value, props FROM events)"""


@query(
    "is_connection_error",
    f"""WITH {_MESSAGES} SELECT event_id,
  coalesce(regexp_matches(lower(error), '{_RETRYABLE_TEXT}'), false) AS connection_error FROM messages""",
)
def _(spark, sf):
    flag = status.is_connection_error(F.col("error")).alias("connection_error")
    return _messages(spark, sf).select("event_id", flag)


@query(
    "is_retryable",
    f"""WITH {_MESSAGES} SELECT event_id, status_code IN (429, 408) OR status_code >= 500
  OR coalesce(regexp_matches(lower(error), '{_RETRYABLE_TEXT}'), false) AS retryable FROM messages""",
)
def _(spark, sf):
    flag = status.is_retryable(F.col("status_code"), F.col("error")).alias("retryable")
    return _messages(spark, sf).select("event_id", flag)


@query(
    "is_overload",
    f"""WITH {LOG} SELECT event_id, coalesce(status_code IN (429, 408) OR status_code >= 500, false) OR is_conn_error
  AS overload FROM log""",
)
def _(spark, sf):
    flag = status.is_overload(F.col("status_code"), F.col("is_conn_error")).alias("overload")
    return request_log(spark, sf).select("event_id", flag)


_PHRASES = ", ".join(f"({s.value}, '{s.phrase.replace(chr(39), chr(39) * 2)}')" for s in HTTPStatus)


@query(
    "status_error",
    f"""WITH {_MESSAGES}, phrases(code, phrase) AS (VALUES {_PHRASES})
SELECT event_id, CASE user_id % 4
  WHEN 0 THEN CASE WHEN status_code <> 200 THEN 'HTTP ' || status_code || ': ' || coalesce(phrase, 'Unknown') END
  WHEN 1 THEN 'Request Timeout' WHEN 2 THEN 'Connection Error: ' || coalesce(error, '')
  ELSE 'Error: ' || coalesce(error, '') END AS message
FROM messages LEFT JOIN phrases ON code = status_code""",
)
def _(spark, sf):
    kind = F.element_at(
        F.array(*[F.lit(k) for k in ("http", "timeout", "connection", "other")]), (F.col("user_id") % 4 + 1).cast("int")
    )
    message = status.status_error(F.col("status_code"), kind, F.col("error"))
    return _messages(spark, sf).select("event_id", message.alias("message"))


@query(
    "parse_retry_after",
    r"""SELECT event_id, CASE WHEN event_type = 'view' THEN NULL WHEN event_type = 'click' THEN NULL
  ELSE CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS seconds FROM events""",
)
def _(spark, sf):
    header = (
        F.when(F.col("event_type") == "view", F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss 'GMT'"))
        .when(F.col("event_type") == "click", F.lit("soon"))
        .otherwise(F.get_json_object("props", "$.k"))
    )
    return table(spark, sf, "events").select("event_id", status.parse_retry_after(header).alias("seconds"))


@query(
    "sample_metadata",
    f"""WITH {MANIFEST} SELECT page_id,
  CAST(to_json({{'key': CAST(page_id AS VARCHAR), 'url': url, 'class_name': label}}) AS VARCHAR) AS metadata
FROM manifest""",
)
def _(spark, sf):
    meta = names.sample_metadata(F.col("page_id").cast("string"), F.col("url"), F.col("label"))
    return manifest(spark, sf).select("page_id", meta.alias("metadata"))


@query(
    "human_duration",
    """WITH spans AS (SELECT event_id, CAST(trunc(value * 97) AS BIGINT) AS s FROM events)
SELECT event_id, CASE WHEN s >= 3600 THEN (s // 3600) || 'h ' || (s % 3600 // 60) || 'm ' || (s % 60) || 's'
  WHEN s >= 60 THEN (s // 60) || 'm ' || (s % 60) || 's' ELSE s || 's' END AS words,
  lpad(CAST(s // 3600 AS VARCHAR), 2, '0') || ':' || lpad(CAST(s % 3600 // 60 AS VARCHAR), 2, '0') || ':'
  || lpad(CAST(s % 60 AS VARCHAR), 2, '0') AS clock FROM spans""",
)
def _(spark, sf):
    secs = F.col("value") * 97
    return table(spark, sf, "events").select(
        "event_id",
        units.human_duration(secs).alias("words"),
        units.human_duration(secs, "clock").alias("clock"),
    )


@query(
    "to_unit",
    """SELECT doc_id, n_chars / 1024.0 AS kib, n_chars / 1048576.0 AS mib, n_chars / 1e6 AS mb,
  round(n_chars / 1099511627776.0, 15) AS tib FROM documents""",
)
def _(spark, sf):
    size = F.col("n_chars")
    return table(spark, sf, "documents").select(
        "doc_id",
        units.to_unit(size, "kib").alias("kib"),
        units.to_unit(size, "mib").alias("mib"),
        units.to_unit(size, "mb").alias("mb"),
        F.round(units.to_unit(size, "tib"), 15).alias("tib"),
    )


@query(
    "parse_task_timing",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS download_sec,
  CASE WHEN l_linestatus = 'F' THEN l_discount END AS tar_sec FROM lineitem""",
)
def _(spark, sf):
    def printed(title, seconds, wanted):
        return F.when(wanted, F.concat(F.lit(f"{title}:         "), seconds.cast("string"), F.lit("s (1.0%)\n")))

    output = F.concat_ws(
        "",
        F.lit("TIMING\n"),
        printed("Download time", F.col("l_quantity"), F.col("l_returnflag") != "R"),
        printed("Tar creation time", F.col("l_discount"), F.col("l_linestatus") == "F"),
    )
    return (
        table(spark, sf, "lineitem")
        .select("l_orderkey", "l_linenumber", units.parse_task_timing(output).alias("t"))
        .select("l_orderkey", "l_linenumber", "t.*")
    )


@query(
    "valid_url",
    f"WITH {RAW_DOCS} SELECT doc_id, coalesce(n_chars % 7 > 1, false) AS valid FROM raw_docs",
)
def _(spark, sf):
    return raw_docs(spark, sf).select("doc_id", urls.valid_url(F.col("url")).alias("valid"))


@query(
    "label_or_null",
    "SELECT vec_id, CASE WHEN label % 3 = 0 THEN NULL ELSE CAST(label AS VARCHAR) END AS label FROM embeddings",
)
def _(spark, sf):
    label = F.when(F.col("label") % 3 != 0, F.col("label"))
    return table(spark, sf, "embeddings").select("vec_id", names.label_or_null(label).alias("label"))
