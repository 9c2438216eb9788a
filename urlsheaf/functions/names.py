"""File and folder names as Catalyst expressions."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

from urlsheaf.functions.text import nonempty, strip
from urlsheaf.functions.urls import DEFAULT_SUFFIX, extract_extension, url_path

# Folder for rows without a label, for not-a-number labels, name
# for rows whose name is empty after cleaning, and the two layouts.
NO_LABEL = "output"
NAN_LABEL = "unknown"
EMPTY_NAME = "file"
MAX_NAME = 180
IMAGEFOLDER = "imagefolder"
WEBDATASET = "webdataset"


def label_or_null(label: Column) -> Column:
    """Label as text; null stays null."""
    return label.cast("string")


def sanitize_label(label: Column, floating: bool = False) -> Column:
    """Folder name for a label; ``floating`` marks columns that may hold NaN."""
    text = F.regexp_replace(label.cast("string"), "['\"]", "")
    name = F.when(label.isNull(), F.lit(NO_LABEL))
    if floating:
        name = name.when(F.isnan(label), F.lit(NAN_LABEL))
    return name.otherwise(F.translate(text, " /", "__"))


def sanitize_filename(name: Column, max_len: int = MAX_NAME) -> Column:
    """Keep letters, digits, dot, dash and underscore; squeeze the rest."""
    safe = F.regexp_replace(strip(name), r"[^A-Za-z0-9.\-]+", "_")
    bare = F.btrim(safe, F.lit("._"))
    return F.left(F.coalesce(nonempty(bare), F.lit(EMPTY_NAME)), F.lit(max_len))


def sequential_name(idx: Column, url: Column, default_ext: str = DEFAULT_SUFFIX) -> Column:
    """Eight-digit running number, counted from one, plus the URL's extension."""
    ext = F.coalesce(nonempty(extract_extension(url)), F.lit(default_ext))
    number = (idx.cast("long") + 1).cast("string")
    padded = F.when(F.length(number) < 8, F.lpad(number, 8, "0")).otherwise(number)
    return F.concat(padded, ext)


def _name_suffix(path: Column) -> Column:
    """Suffix of the last non-empty path segment; a lone trailing dot is none."""
    last = F.regexp_extract(path, r"(?s)([^/]+)/*$", 1)
    return F.regexp_extract(last, r"(?s)^.+(\.[^.]+)$", 1)


def _template_parts(pattern: str, fields: dict[str, Column], segments: Column) -> list[Column] | None:
    """Columns to concatenate; None if the template can never be filled in."""
    parts: list[Column] = []
    try:
        pieces = list(Formatter().parse(pattern))
    except ValueError:
        return None
    for text, field, spec, conversion in pieces:
        if text:
            parts.append(F.lit(text))
        if field is None:
            continue
        if spec or conversion not in (None, "s"):
            raise ValueError(f"format specifications are not supported in names: {pattern!r}")
        if field in fields:
            parts.append(fields[field])
        elif field.startswith("segment[") and field.endswith("]") and field[8:-1].isdigit():
            parts.append(F.get(segments, F.lit(int(field[8:-1]))))  # null past the end
        else:
            return None
    return parts


def render_name(pattern: str, url: Column, key: Column) -> Column:
    """Name from a template; rows it cannot be filled in for use their key.

    Tokens: ``segment_last``, ``segment_parent``, ``segment_first``,
    ``segment[i]`` counted from zero, ``segment``, ``ext`` and ``key``.
    """
    path = url_path(url)
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    ext = _name_suffix(path)
    safe_key = sanitize_filename(key)

    def or_empty(segment: Column) -> Column:
        return F.coalesce(segment, F.lit(""))

    last = F.try_element_at(segments, F.lit(-1))
    fields = {
        # a printed list, once its brackets, quotes and commas are made safe
        "segment": F.concat(F.lit("_"), F.array_join(segments, "_"), F.lit("_")),
        "segment_last": or_empty(last),
        "segment_parent": or_empty(F.coalesce(F.try_element_at(segments, F.lit(-2)), last)),
        "segment_first": or_empty(F.get(segments, F.lit(0))),
        "ext": ext,
        "key": safe_key,
    }
    parts = _template_parts(pattern, fields, segments)
    if parts is None:
        stem = safe_key
    elif not parts:
        stem = F.lit("")
    else:
        stem = F.coalesce(F.concat(*parts), safe_key)
    stem = sanitize_filename(stem)
    named = F.when((ext != "") & ~stem.endswith(ext), F.concat(stem, ext)).otherwise(stem)
    return F.when(_name_suffix(named) == "", F.concat(named, F.lit(DEFAULT_SUFFIX))).otherwise(named)


def output_path(out: str | Column, fmt: str, label: Column, file: Column) -> Column:
    """Class folder layout, or a flat one for ``webdataset``."""
    root = F.lit(out) if isinstance(out, str) else out
    if fmt == WEBDATASET:
        return F.concat_ws("/", root, file)
    return F.concat_ws("/", root, F.coalesce(label, F.lit(NO_LABEL)), file)


def sample_metadata(key: Column, url: Column, label: Column) -> Column:
    """JSON side file of a flat sample; a null label is left out."""
    return F.to_json(F.struct(key.alias("key"), url.alias("url"), label.alias("class_name")))
