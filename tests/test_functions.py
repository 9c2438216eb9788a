"""Column functions against the standard library, on odd and random input."""

import os
import random
import re
import string
from pathlib import PurePosixPath
from urllib.parse import urlparse, urlsplit, urlunsplit

import pytest
from pyspark.sql import functions as F

from urlsheaf.functions import names, status, units, urls
from urlsheaf.functions.text import strip

ODD_URLS = [
    "", "  ", "no scheme/a", "https://[bad", "https://bad]/x", "https://[::1]:80/a.png", "HTTP://U@Ex.COM:8080/q",
    "https://e.com", "https://e.com/", "https://e.com/25#x.y", "https://e.com/.hidden", "https://e.com/..a",
    "https://e.com/b.tar.gz?x=1", "https://e.com/a.jpg;v=1", "https://e.com/a;v/b.jpg", "//cdn.x/y.png", "ftp://h/a.b/c",
    "https://e.com/a.", "https://e.com/a.b/", "mailto:a@b.c", "https://e.com?x=/a.jpg", "https://e.com/é.JPG#t",
    " https://sp.com/x.gif \t", "https://e.com/a b.png", "x:y.z", "1a://h/p.q", "https://e.com/a.jpg?b=c.d/e.f", "?q.r", "#f.g",
    "https://e.com/a\tb.png", "a.b.c", "https://e.com/a/./b.png", "https://u:p@h:1/a?b#c",
]


def one_column(spark, values, column):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(column(F.col("v")).alias("r")).collect()]


def host_of(url):
    if url is None or not url.strip():
        return "unknown"
    try:
        return urlparse(url.strip()).netloc.lower() or "unknown"
    except ValueError:
        return "unknown"


def parts_of(url):
    base, ext = os.path.splitext(urlparse(url).path)
    return base, ext or os.path.splitext(url.split("?")[0])[1]


def test_host(spark):
    assert one_column(spark, ODD_URLS + [None], urls.extract_host) == [host_of(u) for u in ODD_URLS + [None]]


def test_extension_and_name(spark):
    fit = [u for u in ODD_URLS if "[bad" not in u and "bad]" not in u]
    assert one_column(spark, fit, urls.extract_extension) == [parts_of(u)[1] for u in fit]
    want = [parts_of(u)[0].split("/")[-1] + (parts_of(u)[1] or ".jpg") for u in fit]
    assert one_column(spark, fit, urls.url_name) == want


PIECES = ["http", "https", "ftp", ":", "//", "/", "a", "B9", ".", "..", "jpg", "?", "#", ";", "@", "é", "-", "_", "%20", "x.y", "\t"]


def test_random_urls(spark):
    rng = random.Random(11)
    made = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(13))) for _ in range(6000)]
    assert one_column(spark, made, urls.extract_host) == [host_of(u) for u in made]
    assert one_column(spark, made, urls.extract_extension) == [parts_of(u)[1] for u in made]


def test_naive_host(spark):
    made = ["https://A.com/x", "http://b.com", "ftp://c.com/x", "https://d.com?x=/y"]
    assert one_column(spark, made, urls.naive_host) == ["a.com", "b.com", "ftp:", "d.com?x="]


def test_split_and_repair(spark):
    got = one_column(spark, ["https://e.com/a.JPG", "https://e.com/a?x", "nothing", "https://e.com/x.png?y=1"], urls.repair_urls)
    assert got[0] == ["https://e.com/a.JPG", "https://e.com/a.jpeg", "https://e.com/a.png", "https://e.com/a.gif"]
    assert got[1] == []  # "com/a?x" is no word
    assert got[2] == [] and got[3] == []


def resized(url, ext):
    p = urlsplit(url)
    base = p.path.rsplit(".", 1)[0] if "." in p.path else p.path
    return urlunsplit((p.scheme, p.netloc, base + ext, p.query, p.fragment))


def test_size_candidates(spark):
    made = ["HTTPS://E.com/a.b/c.gif?x=1#t", "https://e.com", "https://e.com/a", "rel/a.png", "https://e.com/a.b/c"]
    for url, tried in zip(made, one_column(spark, made, urls.size_urls)):
        assert tried == [url] + [resized(url, e) for e in urls.SIZE_SUFFIXES] + [url]


def safe_name(name, limit=180):
    name = re.sub(r"[^A-Za-z0-9._-]+", "_", name.strip())
    return (re.sub(r"_+", "_", name).strip("._") or "file")[:limit]


def test_sanitize_filename(spark):
    rng = random.Random(12)
    letters = string.ascii_letters + "._-/ é\t'%" * 4
    made = ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(500)]
    made = made + ["x" * 200, "", "...", " a/b "]
    assert one_column(spark, made, names.sanitize_filename) == [safe_name(n) for n in made]


def rendered(pattern, url, key):
    path = urlsplit(url).path
    segments = [s for s in path.split("/") if s]
    ext = PurePosixPath(path).suffix
    last = segments[-1] if segments else ""
    tokens = {
        "segment": segments, "ext": ext, "key": safe_name(key), "segment_last": last,
        "segment_parent": segments[-2] if len(segments) > 1 else last, "segment_first": segments[0] if segments else "",
    }
    try:
        stem = pattern.format(**tokens)
    except Exception:
        stem = tokens["key"]
    stem = safe_name(stem)
    stem += ext if ext and not stem.endswith(ext) else ""
    return stem if PurePosixPath(stem).suffix else stem + ".jpg"


@pytest.mark.parametrize(
    "pattern",
    ["{segment[-2]}", "{segment_parent}", "{segment_last}", "{key}_{segment_first}", "{segment[1]}", "{nope}", "{", "img", "{segment}{ext}"],
)
def test_render_name(spark, pattern):
    made = ["https://e.com/photos/12/large.JPG?x=1", "https://e.com/one", "https://e.com/", "https://e.com/a/b.c/d/", "https://e.com/x/.h"]
    got = one_column(spark, made, lambda u: names.render_name(pattern, u, F.lit("k 7")))
    assert got == [rendered(pattern, u, "k 7") for u in made]


def test_render_name_refuses_formats():
    with pytest.raises(ValueError):
        names._template_parts("{key:>8}", {"key": None}, None)


def test_sequential_name(spark):
    rows = spark.createDataFrame([(0, "https://e.com/a.png"), (123456789, "https://e.com/x/a")], "i long, u string")
    got = [r[0] for r in rows.select(names.sequential_name(F.col("i"), F.col("u"))).collect()]
    assert got == ["00000001.png", "123456790.jpg"]


def test_labels_and_paths(spark):
    assert one_column(spark, [None, "O'Hara x/y", '"q"'], names.sanitize_label) == ["output", "OHara_x_y", "q"]
    floats = spark.createDataFrame([(float("nan"),), (None,), (1.5,)], "v double")
    assert [r[0] for r in floats.select(names.sanitize_label(F.col("v"), floating=True)).collect()] == ["unknown", "output", "1.5"]
    assert one_column(spark, ["a", None], lambda v: names.output_path("o", "imagefolder", v, F.lit("f"))) == ["o/a/f", "o/output/f"]
    assert one_column(spark, ["a", None], lambda v: names.output_path("o", "webdataset", v, F.lit("f"))) == ["o/f", "o/f"]
    assert one_column(spark, ["a", None], lambda v: names.output_path("o", "other", v, F.lit("f"))) == ["o/a/f", "o/output/f"]


def test_retry_rules(spark):
    rows = spark.createDataFrame(
        [(404, "HTTP 404"), (429, None), (408, None), (500, None), (None, "Connection Error: Cannot write to closing transport"),
         (None, "Connection Error: Server disconnected"), (None, "TIMED OUT")],
        "s int, e string",
    )
    got = [r[0] for r in rows.select(status.is_retryable(F.col("s"), F.col("e"))).collect()]
    assert got == [False, True, True, True, False, True, True]
    hot = [r[0] for r in rows.select(status.is_overload(F.col("s"), F.lit(None).cast("boolean"))).collect()]
    assert hot == [False, True, True, True, False, False, False]


def test_status_text(spark):
    rows = spark.createDataFrame(
        [(404, "http", None), (799, "http", None), (200, "http", None), (408, "timeout", None), (None, "connection", "x"), (None, "other", "y")],
        "s int, k string, d string",
    )
    got = [r[0] for r in rows.select(status.status_error(F.col("s"), F.col("k"), F.col("d"))).collect()]
    assert got == ["HTTP 404: Not Found", "HTTP 799: Unknown", None, "Request Timeout", "Connection Error: x", "Error: y"]


def test_headers(spark):
    values = ["3", " 1.5 ", "Wed, 21 Oct 2015 07:28:00 GMT", "", "1d", None, "1e2"]
    assert one_column(spark, values, status.parse_retry_after) == [3.0, 1.5, None, None, None, None, 100.0]
    ranges = ["bytes 0-1023/5000", "bytes 0-1023/*", None]
    assert one_column(spark, ranges, status.content_range_total) == [5000, None, None]


def test_durations(spark):
    assert one_column(spark, ["5025.5", "125", "59.9"], lambda v: units.human_duration(v.cast("double"))) == ["1h 23m 45s", "2m 5s", "59s"]
    assert one_column(spark, ["5025.5", "360000"], lambda v: units.human_duration(v.cast("double"), "clock")) == ["01:23:45", "100:00:00"]


def test_task_timing(spark):
    printed = ["x\nDownload time:         123.45s (85.0%)\nTar creation time:     20.00s (15.0%)", "Download time: 1.2.3s", "", None]
    got = [tuple(r) if r else r for r in one_column(spark, printed, units.parse_task_timing)]
    assert got == [(123.45, 20.0), (None, None), (None, None), (None, None)]


def test_strip_and_valid(spark):
    values = [" \t\n a \u00a0", "", " \u2003", None]
    assert one_column(spark, values, strip) == ["a", "", "", None]
    assert one_column(spark, values, urls.valid_url) == [True, False, False, False]


def test_sample_metadata(spark):
    rows = spark.createDataFrame([("k", "u", None), ("k", "u", "c")], "k string, u string, c string")
    got = [r[0] for r in rows.select(names.sample_metadata(F.col("k"), F.col("u"), F.col("c"))).collect()]
    assert got == ['{"key":"k","url":"u"}', '{"key":"k","url":"u","class_name":"c"}']
