"""URL filters with redirect equivalence.

A url is judged by the longest rule that fits its host and path.  Urls that lead to one another, by a redirect, a
canonical link or a refresh in the page, are aliases: connected components over those edges.  A url that no rule fits
takes its aliases' verdict: allowed if one of them is explicitly allowed, else blocked if one is blocked, else the
default.  A rule's own verdict always stands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urlsheaf.llm.common import Scratch, let, lower_ascii
from urlsheaf.llm.components import components

#: Rules that the registered query applies: host, path, verdict.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
DEFAULT = "allow"
#: Comments and scripts.  One that is never closed is matched to the end as well, so that no second one is looked for,
#: and its text is kept.
_HIDDEN = r"(?is)<!--(?:.*?-->|(.*)\z)|<script\b(?:.*?</script\s*>|(.*)\z)"
#: A tag; one that is never closed runs to the end and is left out afterwards.
_TAG = r"(?is)<(?:link|meta)\b[^>]*(?:>|\z)"
_CANONICAL = r"(?is)\brel\s*=\s*[\"']?canonical\b"
_HREF = r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
_REFRESH = r"(?is)\bhttp-equiv\s*=\s*[\"']?refresh\b"
_TARGET = r"(?is)\bcontent\s*=\s*[\"']?[^\"'>]*?\burl\s*=\s*([^\"'\s>]+)"


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty for null or no ``://``."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """What aliases are told apart by: host, path and query; scheme and fragment don't count.  Null without a host."""
    query = F.regexp_extract(url, "://[^?#]*(\\?[^#]*)", 1)
    return F.when(host_of(url) != "", F.concat(host_of(url), path_of(url), query))


def resolved(href: Column, url: Column) -> Column:
    """An absolute url for ``href`` in the page ``url``."""
    scheme = F.regexp_extract(url, "^([^:]*)://", 1)
    root = F.concat(scheme, F.lit("://"), F.regexp_extract(url, "://([^/?#]*)", 1))
    folder = F.regexp_extract(path_of(url), "^(.*/)", 1)
    return (
        F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(root, href))
        .otherwise(F.concat(root, F.when(folder == "", "/").otherwise(folder), href))
    )


def page_edges(pages: DataFrame) -> DataFrame:
    """``(a, b)``: pages' nodes and those their canonical links and refreshes lead to."""
    marked = pages.select("url", "html").where(F.col("html").rlike("(?i)canonical|http-equiv"))
    bare = F.regexp_replace("html", _HIDDEN, " $1$2")
    tags = marked.select("url", F.explode(F.regexp_extract_all(bare, F.lit(_TAG), F.lit(0))).alias("tag")).where(
        F.col("tag").endswith(">")
    )
    href = F.when(F.col("tag").rlike(_CANONICAL), F.regexp_extract("tag", _HREF, 1)).when(
        F.col("tag").rlike(_REFRESH), F.regexp_extract("tag", _TARGET, 1)
    )
    leads = tags.select("url", F.replace(href, F.lit("&amp;"), F.lit("&")).alias("href")).where("href <> ''")
    return leads.select(node_of(F.col("url")).alias("a"), node_of(resolved(F.col("href"), F.col("url"))).alias("b"))


def rule_table(spark: SparkSession, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``(host, path, rule, verdict)`` for those of the distinct ``urls (host, path)`` that a rule fits.

    A rule fits its host and all subdomains if the path starts with the rule's.  The longest rule wins; of equally long
    ones that with the longer host, then the smaller, block before allow.  A url meets only the rules of its own host
    and the domains above, and of those only the path lengths that are in use, so it costs a few equality joins
    however many rules there are.
    """
    rule = rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL").select(
        lower_ascii(F.col("host")).alias("domain"), F.col("path").alias("begun"), "verdict"
    )
    rule = rule.groupBy("domain", "begun").agg(F.max("verdict").alias("verdict"))
    lengths = rule.groupBy("domain").agg(F.collect_set(F.length("begun")).alias("lengths"))
    domains = let(
        F.split("host", "\\."),
        lambda parts: F.transform(
            F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), ".")
        ),
    )
    met = (
        urls.select("host", "path", F.explode(domains).alias("domain"))
        .join(lengths, "domain")
        .select("host", "path", "domain", F.explode("lengths").alias("length"))
        .where(F.col("length") <= F.length("path"))
        .withColumn("begun", F.left(F.col("path"), F.col("length")))
        .join(rule, ["domain", "begun"])
    )
    order = F.struct(
        -(F.length("domain") + F.length("begun")), -F.length("domain"), F.concat("domain", "begun").alias("rule"), "verdict"
    )
    best = met.groupBy("host", "path").agg(F.min(order).alias("best"))
    return best.select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))


def judge_urls(
    pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None, default: str = DEFAULT
) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` of every row of ``pages (page_id, url, html)``.

    ``redirects (source, target)`` adds edges between urls to those found in the pages.  A url that is null or holds no
    ``://`` has host and path empty, fits no rule, has no alias and gets the default.  Null html has no links.  Equal
    urls share a verdict; ids may be null or repeated.  Rules with a null part are left out.  Other columns are ignored.
    """
    scratch = Scratch(pages.sparkSession)
    edges = page_edges(pages)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(node_of(F.col("source")).alias("a"), node_of(F.col("target")).alias("b")))
    groups = scratch.keep(components(edges, scratch), "url-groups")

    # a node is a url without scheme, so it is judged like one; all members of a component are its nodes
    as_url = F.concat(F.lit("://"), F.col("node"))
    members = groups.select("component", host_of(as_url).alias("host"), path_of(as_url).alias("path"))
    own = pages.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    matched = scratch.keep(match_rules(own.unionByName(members.select("host", "path")).distinct(), rules), "url-rules")
    spread = (
        members.join(matched, ["host", "path"])
        .groupBy("component")
        .agg(F.min("verdict").alias("spread"))  # allow before block
        .join(groups, "component")
        .select("node", "spread")
    )
    told = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), node_of(F.col("url")).alias("node"))
    found = told.join(matched, ["host", "path"], "left").join(spread, "node", "left")
    return found.select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", "spread", F.lit(default)).alias("verdict")
    )


URLS_SQL = r"""
WITH RECURSIVE told AS (
  SELECT page_id, url, html,
         translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(coalesce(url, ''), '://[^?#]*(\?[^#]*)', 1) AS query
  FROM pages
), rules (host, path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'),
         ('org', '/fr/', 'allow')
), tags AS (
  SELECT url, host, path, query,
         unnest(regexp_extract_all(
           regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>', ' ', 'g'),
           '(?is)<(?:link|meta)\b[^>]*>')) AS tag
  FROM told WHERE regexp_matches(html, '(?i)canonical|http-equiv')
), leads AS (
  SELECT url, host, path, query, replace(CASE
    WHEN regexp_matches(tag, '(?is)\brel\s*=\s*["'']?canonical\b')
      THEN regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)
    WHEN regexp_matches(tag, '(?is)\bhttp-equiv\s*=\s*["'']?refresh\b')
      THEN regexp_extract(tag, '(?is)\bcontent\s*=\s*["'']?[^"''>]*?\burl\s*=\s*([^"''\s>]+)', 1)
    ELSE '' END, '&amp;', '&') AS href
  FROM tags
), targets AS (
  SELECT host || path || query AS a,
         CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN href
              WHEN starts_with(href, '//') THEN 'http:' || href
              WHEN starts_with(href, '/') THEN 'http://' || host || href
              ELSE 'http://' || host || CASE WHEN path = '' THEN '/' ELSE regexp_extract(path, '^(.*/)', 1) END || href
         END AS target
  FROM leads WHERE href <> '' AND host <> ''
), cut AS (
  SELECT a, translate(regexp_extract(target, '://([^/?#]*)', 1),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS h,
         regexp_extract(target, '://[^/?#]*([^?#]*)', 1) AS p, regexp_extract(target, '://[^?#]*(\?[^#]*)', 1) AS q
  FROM targets
), edges AS (
  SELECT a, h || p || q AS b FROM cut WHERE h <> ''
), both_ways AS (
  SELECT a, b FROM edges UNION SELECT b, a FROM edges
), reached (node, alias) AS (
  SELECT a, b FROM both_ways
  UNION
  SELECT r.node, e.b FROM reached r JOIN both_ways e ON e.a = r.alias
), distinct_urls AS (
  SELECT host, path FROM told
  UNION
  SELECT regexp_extract(alias, '^([^/?#]*)', 1), regexp_extract(alias, '^[^/?#]*([^?#]*)', 1) FROM reached
), fitting AS (
  SELECT u.host, u.path, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY u.host, u.path ORDER BY length(r.host || r.path) DESC, length(r.host) DESC,
                            r.host || r.path) AS place
  FROM distinct_urls u JOIN rules r
    ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
), spread AS (
  SELECT r.node, min(f.verdict) AS verdict
  FROM reached r JOIN fitting f
    ON f.place = 1 AND f.host = regexp_extract(r.alias, '^([^/?#]*)', 1)
       AND f.path = regexp_extract(r.alias, '^[^/?#]*([^?#]*)', 1)
  GROUP BY r.node
)
SELECT t.page_id, t.host, t.path, f.rule, coalesce(f.verdict, s.verdict, 'allow') AS verdict
FROM told t
LEFT JOIN fitting f ON f.place = 1 AND f.host = t.host AND f.path = t.path
LEFT JOIN spread s ON s.node = t.host || t.path || t.query
"""
