"""URL anatomy as Catalyst expressions.

The rules are those of generic URL splitting (scheme, authority, path, query,
fragment), which is more lenient than Java's strict URI parsing: odd but
fetchable URLs keep their host and extension.
"""

from __future__ import annotations

from urllib.parse import uses_params

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlsheaf.functions.text import bind, nonempty, strip

# Result for URLs without a host, default image suffixes, the
# suffixes tried when a size is looked up, and those tried in a repair.
UNKNOWN_HOST = "unknown"
DEFAULT_SUFFIX = ".jpg"
SIZE_SUFFIXES = (".JPG", ".jpeg", ".JPEG", ".jpg", ".png", ".gif", ".webp", ".tiff")
REPAIR_EXTENSIONS = ("jpeg", "jpg", "png", "gif")

_SCHEME = r"(?:[A-Za-z][A-Za-z0-9+.\-]*:)?"
_HEAD = rf"(?s)^{_SCHEME}(?://[^/?#]*)?"
_SUFFIX = r"(?s)^\.*[^.].*?(\.[^.]*)$"
# the same on a whole URL: of its path, and of all text before a query
_PATH_SUFFIX = rf"(?s)^(?:{_SCHEME})?+(?://[^/?#]*+)?+(?:[^?#]*/)?+\.*[^./?#][^/?#]*?(\.[^./?#]*)(?=[?#]|$)"
_TEXT_SUFFIX = r"(?s)^(?:[^?]*/)?+\.*[^./?][^/?]*?(\.[^./?]*)(?=\?|$)"
# square brackets only as a whole, bracketed address
_AUTHORITY = r"(?:[^/?#\[\]]*@)?\[[^/?#\[\]]*\](?::[^/?#\[\]]*)?|[^/?#\[\]]*"
# space and control characters, which URL splitting ignores at the start
_LEADING = "".join(map(chr, range(33)))


def _one_line(url: Column) -> Column:
    """URL splitting ignores leading blanks, and tabs and line breaks anywhere."""
    flat = F.ltrim(url, F.lit(_LEADING))
    broken = flat.contains("\t") | flat.contains("\r") | flat.contains("\n")
    return F.when(broken, F.translate(flat, "\t\r\n", "")).otherwise(flat)


def extract_host(url: Column) -> Column:
    """Authority in lower case, with user info and port; else ``unknown``."""
    flat = _one_line(strip(url))
    host = F.regexp_extract(flat, rf"^{_SCHEME}//({_AUTHORITY})(?=[/?#]|$)", 1)
    return F.coalesce(nonempty(F.lower(host)), F.lit(UNKNOWN_HOST))


def naive_host(url: Column) -> Column:
    """The cheaper normaliser used to size worker pools."""
    bare = F.regexp_replace(url, r"^https?://", "")
    return F.lower(F.regexp_replace(bare, r"/.*", ""))


def url_path(url: Column, drop_params: bool = False) -> Column:
    """Path part; ``drop_params`` also cuts ``;parameters`` of the last segment."""
    flat = _one_line(url)
    path = F.regexp_extract(flat, rf"{_HEAD}([^?#]*)", 1)
    if not drop_params:
        return path
    scheme = F.lower(F.regexp_extract(flat, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))
    return F.when(scheme.isin(*uses_params), F.regexp_replace(path, r";[^/]*$", "")).otherwise(path)


def _last_segment(path: Column) -> Column:
    return F.regexp_extract(path, r"(?s)([^/]*)$", 1)


def suffix_of(path: Column) -> Column:
    """File suffix with its dot, empty for none; leading dots are no suffix."""
    return F.regexp_extract(_last_segment(path), _SUFFIX, 1)


def extract_extension(url: Column) -> Column:
    """Suffix of the path, else of the URL before its query, else empty."""
    flat = _one_line(url)
    plain = F.regexp_extract(flat, _PATH_SUFFIX, 1)
    in_path = F.when(flat.contains(";"), suffix_of(url_path(url, drop_params=True))).otherwise(plain)
    return F.coalesce(nonempty(in_path), F.regexp_extract(url, _TEXT_SUFFIX, 1))


def url_name(url: Column, default_ext: str = DEFAULT_SUFFIX) -> Column:
    """File name taken from the URL: last path segment plus extension."""
    last = _last_segment(url_path(url, drop_params=True))
    stem = bind(last, lambda name: F.left(name, F.length(name) - F.length(F.regexp_extract(name, _SUFFIX, 1))))
    return F.concat(stem, F.coalesce(nonempty(extract_extension(url)), F.lit(default_ext)))


def split_url_ext(url: Column) -> Column:
    """Struct ``base, ext`` of a URL that ends in ``.word``; nulls otherwise."""
    pattern = r"(?U)^(.+)\.(\w+)$"
    return F.struct(
        nonempty(F.regexp_extract(url, pattern, 1)).alias("base"),
        F.lower(nonempty(F.regexp_extract(url, pattern, 2))).alias("ext"),
    )


def repair_urls(url: Column, exts=REPAIR_EXTENSIONS) -> Column:
    """Array of URLs to try in order: the URL, then its base with each suffix.

    Empty for a URL without an extension.
    """
    listed = F.array(*[F.lit(e) for e in exts])

    def tries(parts: Column) -> Column:
        others = F.filter(listed, lambda e: F.lower(e) != parts["ext"])
        return F.concat(F.array(url), F.transform(others, lambda e: F.concat(parts["base"], F.lit("."), e)))

    return bind(
        split_url_ext(url),
        lambda parts: F.when(parts["ext"].isNotNull(), tries(parts)).otherwise(F.array().cast("array<string>")),
    )


_SHAPE = r"(?s)^([A-Za-z][A-Za-z0-9+.\-]*:)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"


def size_urls(url: Column, suffixes=SIZE_SUFFIXES) -> Column:
    """Array of URLs tried for a size: as is, each suffix, then as is again.

    A suffix replaces everything after the path's last dot; query and fragment
    stay.
    """
    flat = _one_line(url)
    parts = F.struct(*[F.regexp_extract(flat, _SHAPE, i + 1).alias(p) for i, p in enumerate("snpqf")])
    listed = F.array(*[F.lit(s) for s in suffixes])

    def ends(p: Column) -> Column:
        base = F.regexp_replace(p["p"], r"(?s)\.[^.]*$", "")
        root = F.when((p["n"] != "") & ~p["p"].startswith("/"), F.lit("/")).otherwise(F.lit(""))
        query = F.when(p["q"] != "?", p["q"]).otherwise(F.lit(""))
        fragment = F.when(p["f"] != "#", p["f"]).otherwise(F.lit(""))
        return F.struct(
            F.concat(F.lower(p["s"]), p["n"], root, base).alias("head"), F.concat(query, fragment).alias("tail")
        )

    def tries(e: Column) -> Column:
        return F.transform(listed, lambda s: F.concat(e["head"], s, e["tail"]))

    return F.concat(F.array(url), bind(bind(parts, ends), tries), F.array(url))


def valid_url(url: Column) -> Column:
    """False for null and blank URLs."""
    return F.coalesce(strip(url) != "", F.lit(False))


def repair_candidates(df: DataFrame, url_col: str, exts=REPAIR_EXTENSIONS) -> DataFrame:
    """One row per URL to try: adds ``pos`` and ``candidate``."""
    return df.select("*", F.posexplode(repair_urls(F.col(url_col), exts)).alias("pos", "candidate"))


def size_candidates(df: DataFrame, url_col: str) -> DataFrame:
    """One row per URL to ask for a size: adds ``pos`` and ``candidate``."""
    return df.select("*", F.posexplode(size_urls(F.col(url_col))).alias("pos", "candidate"))
