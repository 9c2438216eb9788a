"""Every operator against a brute-force version, with the awkward rows: nulls, empty and very long texts, ties, repeated
rows, empty tables, extra columns with clashing names."""

import hashlib
import itertools
import math
import random
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from urlsheaf.llm import (
    common,
    components,
    decontaminate,
    embeddings,
    licences,
    lines,
    nearcopies,
    packing,
    passages,
    quality,
    queries,
    simhash,
    suffixes,
    toxicity,
    urls,
)

DATA = "/root/testdata/sf0.001"
SCHEMA = (
    "doc_id long, text string, score double, key long, h1 long, fp long, component_id long, _id long, _drops long,"
    " batch int, `a.b` int, n_chars long"
)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def text_rows():
    """Real texts with copies, near copies, shared lines, and the awkward rows."""
    texts = pq.read_table(f"{DATA}/documents.parquet", columns=["doc_id", "text"]).to_pylist()[:60]
    rows = [(r["doc_id"], r["text"]) for r in texts]
    base = rows[3][1]
    rows += [(100, base), (101, base.upper()), (102, base + " end"), (103, base[:50] + "?" + base[50:])]
    shared = "A line that more than five documents hold, word for word, in any case"
    rows += [(110 + k, f"{base[k * 9:k * 9 + 150]}\n  {shared.upper() if k % 2 else shared}\t\nlast {k}") for k in range(8)]
    rows += [(130, None), (131, ""), (132, " \n\t "), (133, "one"), (134, "Ünï \x1c cödé it's İstanbul ΣΑΣ e\u0301")]
    rows += [(140, "word " * 9000 + shared), (141, "".join(chr(97 + k % 23) for k in range(70_000)))]
    rows += [(None, base), (None, f"x\n{shared}"), rows[5], rows[5], (110, "the same id, another text\n" + shared)]
    rows += [(150, "Released under the MIT License. Licensed under CC BY-NC 4.0"), (151, "cc by cc by"), (152, "CC\u00a0BY")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return text_rows()


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0.5, 1, 2, 3, 4, 5, 6, 7, 8, 9) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return frame(spark, [])


def groups(n, pairs):
    own = list(range(n))

    def top(i):
        while own[i] != i:
            i = own[i]
        return i

    for a, b in pairs:
        a, b = top(a), top(b)
        own[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


# components


@pytest.mark.parametrize("kind", ["chain", "hub", "random", "none"])
def test_components(spark, kind):
    edges = {
        "chain": [(i, i + 1) for i in range(60)],
        "hub": [(500, i) for i in range(80)] + [(7, 600), (600, 7), (9, 9)],
        "random": [tuple(random.Random(4).sample(range(120), 2)) for _ in range(1)]
        + [(a * 7 % 120, a * 13 % 90 + a % 3) for a in range(70)],
        "none": [],
    }[kind]
    got = components.components(spark.createDataFrame(edges, "a long, b long"), common.Scratch(spark)).collect()
    want = groups(700, edges)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert sorted(map(tuple, got)) == sorted((x, want[x]) for x in linked)


# 1: packing


@settings(max_examples=150, deadline=None)
@given(
    st.text(st.characters(exclude_categories=["Cs"]), max_size=60)
    | st.text("aB'éİΣς .!\x1c\n\u0301\u00a09", max_size=40)
    | st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "a", "it's", "é", " ", "!"])).map("".join)
)
def test_encoder_equals_tokenizer(text):
    path = queries.vocabulary()
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(path)
    want = [*plain.encode(text, add_special_tokens=False).ids, packing.END]
    assert np.frombuffer(packing._encoder(path).ids(text), "<u4").tolist() == want


def test_encoder_keeps_words_that_recur(monkeypatch):
    """A worker holds few of the words that come once or are long, and no more than two generations of the others."""
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = packing.Encoder(path)
    plain = encoder.tokenizer

    def held(ids):
        return {**ids.before, **ids}

    def check(text):
        want = [*plain.encode(text, add_special_tokens=False).ids, packing.END]
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == want

    once = [f"{random.Random(k).randrange(1 << 40):x}" for k in range(2_000)]
    check(" ".join(once))
    assert len(held(encoder.words)) < 50 and len(held(encoder.parts)) < 1_000
    long = "ab1" * 100
    check(" ".join(["the The model's", long] * 3))
    assert {"the", "The", "model's"} <= held(encoder.words).keys() and long not in held(encoder.words)
    monkeypatch.setattr(packing, "CACHE", 100)
    check(" ".join(once + once))
    assert len(held(encoder.words)) <= 200 and len(held(encoder.parts)) <= 200


def check_packing(got, rows, capacity):
    encoder = packing._encoder(queries.vocabulary())
    want = Counter()
    total = 0
    for doc_id, text in rows:
        ids = np.frombuffer(encoder.ids(text or ""), "<u4")
        total += len(ids)
        for piece, at in enumerate(range(0, len(ids), capacity)):
            own = ids[at : at + capacity]
            want[(doc_id, piece, at, len(own), zlib.crc32(own.tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in by.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by), total


def test_packing(docs, rows):
    got = packing.pack_documents(docs, queries.vocabulary()).collect()
    n, total = check_packing(got, rows, 4096)
    assert n <= math.ceil(total / 4096) + 2


def test_packing_rounds(spark, rows):
    """Many small tasks: bins go up the tree and stay gapless."""
    random.seed(2)
    items = [(i, random.choice([5, 30, 60, 61, 99, 100, 101, 140, 200])) for i in range(4000)]
    found = spark.createDataFrame([(i, n, 0) for i, n in items], "item long, length long, bin long")
    got = packing.pack(found, common.Scratch(spark), capacity=200, spare=3, task_items=150).collect()
    assert len(got) == 4000
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in by.values():
        assert all(b == a + n for (a, n), (b, _) in zip(sorted(placed), sorted(placed)[1:]))
        assert min(placed)[0] == 0 and sum(n for _, n in placed) <= 200
    assert len(by) <= 1.03 * sum(n for _, n in items) / 200 + 2


def test_packing_of_items_over_half(spark):
    """No bin can take a second item: rounds stop instead of gathering all bins."""
    found = spark.range(900).select(F.col("id").alias("item"), F.lit(101).cast("long").alias("length"))
    got = packing.pack(found, common.Scratch(spark), capacity=200, spare=3, task_items=100)
    assert got.select("sequence_id").distinct().count() == 900


def test_packing_nothing(nothing):
    assert packing.pack_documents(nothing, public_tokenizers.path("word_bpe_49k.json")).count() == 0


# 2: urls

PAGES = [
    (0, "http://A.Example.com/de/x", None),
    (1, "https://b.example.com/y#z", '<link href="http://a.example.com/de/x" rel=canonical>'),
    (2, "http://c.example.com/y?q", '<LINK REL="Canonical" HREF="/other?a=1&amp;b=2">'),
    (3, "http://c.example.com/other?a=1&b=2", "<meta http-equiv=refresh content='0; url=//x.net/en/'>"),
    (4, "http://example.net/en/k", '<link rel="canonical" href="http://bad.net/k">'),
    (5, "http://free.com/k", '<meta http-equiv="refresh" content="5;URL=http://example.net/en/k">'),
    (6, "http://q.com/w", '<!-- <link rel=canonical href="http://bad.net/k"> --> canonical'),
    (7, None, "<link rel=canonical href='http://bad.net/k'>"),
    (8, "no scheme", None),
    (9, "x://", None),
    (10, "ftp://net?x", None),
    (11, "http://net/", None),
    (12, "http://xnet/", None),
    (13, "http://r.com/a/b", "<link rel=canonical href=c.net>"),
    (None, "http://sub.example.net/en/", None),
    (0, "http://A.Example.com/de/x", None),
    (14, "http://u@www.example.org:8/fr/é?u=://x/y", ""),
]


def plain_verdicts():
    def cut(url):
        m = re.search(r"://([^/?#]*)([^?#]*)(\?[^#]*)?", url or "", re.S)
        return (lower(m[1]), m[2], m[3] or "") if m else ("", "", "")

    def rule(host, path):
        fits = [
            (len(h + p), h + p, v)
            for h, p, v in urls.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        return max(fits)[1:] if fits else (None, None)

    leads = {1: "http://a.example.com/de/x", 2: "http://c.example.com/other?a=1&b=2", 3: "http://x.net/en/"}
    leads |= {4: "http://bad.net/k", 5: "http://example.net/en/k", 13: "http://r.com/a/c.net"}

    def node(url):
        host, path, query = cut(url)
        return (host, path, query) if host else None

    nodes = sorted({node(u) for _, u, _ in PAGES if node(u)} | {node(u) for u in leads.values()})
    pairs = [(nodes.index(node(PAGES[k][1])), nodes.index(node(u))) for k, u in leads.items()]
    own = groups(len(nodes), pairs)
    spread = {}
    for n, g in zip(nodes, own):
        spread.setdefault(g, set()).add(rule(n[0], n[1])[1])
    out = []
    for page_id, url, _ in PAGES:
        host, path, _ = cut(url)
        name, verdict = rule(host, path)
        if verdict is None:
            told = spread[own[nodes.index(node(url))]] if node(url) else set()
            verdict = "allow" if "allow" in told else "block" if "block" in told else urls.DEFAULT
        out.append((page_id, host, path, name, verdict))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_urls(spark):
    pages = spark.createDataFrame([(*p, 1, "x") for p in PAGES], "page_id long, url string, html string, host int, rule string")
    got = urls.judge_urls(pages, urls.rule_table(spark)).collect()
    assert ordered(map(tuple, got)) == ordered(plain_verdicts())


def test_urls_sql():
    connection = duckdb.connect()
    connection.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    connection.executemany("INSERT INTO pages VALUES (?, ?, ?)", PAGES)
    assert ordered(connection.execute(urls.URLS_SQL).fetchall()) == ordered(plain_verdicts())


def test_urls_redirects_and_many_rules(spark):
    pages = spark.createDataFrame([(k, f"http://h{k}.org/p/{k}", None) for k in range(30)], "page_id long, url string, html string")
    rules = spark.createDataFrame(
        [(f"h{k}.org", f"/p/{k}"[:n], "block") for k in (3, 7) for n in (1, 2, 4)] + [("h9.org", "/p", "allow"), (None, "/", "block")],
        "host string, path string, verdict string",
    )
    redirects = spark.createDataFrame([("http://h1.org/p/1", "http://h3.org/p/3"), ("http://h2.org/p/2", "https://h1.org/p/1"),
                                       ("http://h9.org/p/9", "http://h7.org/p/7"), ("http://h8.org/p/8", "http://h9.org/p/9")], "source string, target string")
    got = {r.page_id: (r.rule, r.verdict) for r in urls.judge_urls(pages, rules, redirects).collect()}
    assert got[3] == ("h3.org/p/3", "block") and got[7] == ("h7.org/p/7", "block")
    assert got[1] == got[2] == (None, "block")
    assert got[8] == (None, "allow") and got[9] == ("h9.org/p", "allow")
    assert sum(v == "block" for _, v in got.values()) == 4


def test_urls_nothing(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert urls.judge_urls(pages, urls.rule_table(spark)).count() == 0


# 3: passages


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=60) | st.lists(st.sampled_from([b"ab", b"aab", b"a", b"\x00"]), min_size=1, max_size=40).map(b"".join))
def test_suffix_array(data):
    s = np.frombuffer(data, np.uint8)
    sa = suffixes.suffix_array(s)
    assert sa.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
    plcp = suffixes.permuted_common_prefixes(s, sa)
    for a, b in zip(sa, sa[1:]):
        n = 0
        while max(a, b) + n < len(data) and data[a + n] == data[b + n]:
            n += 1
        assert plcp[b] == n


def plain_repeats(rows):
    """Rows in the order of the operator: id, then hash of the text."""
    encoded = [(passages._NO_ID if d is None else d, (t or "").encode()) for d, t in rows]
    seen, found = set(), {}
    for doc_id, data in sorted(set(encoded), key=lambda r: (r[0], passages._tie(r[1]))):
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - 99):
            w = data[i : i + 100]
            if w in seen:
                gone[i : i + 100] = True
            seen.add(w)
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        runs = int((gone & ~np.concatenate([[False], gone[:-1]])).sum())
        found[doc_id, data] = (len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return [(None if d == passages._NO_ID else d, *found[d, t]) for d, t in encoded]


def test_passages(docs, rows):
    assert ordered(map(tuple, passages.remove_repeats(docs).collect())) == ordered(plain_repeats(rows))


def test_passages_of_many_rows_without_id(spark):
    """Rows that share an id, or have none, are told apart by their whole text, however many there are."""
    random.seed(8)
    passages_here = ["".join(random.choices("abcdefgh ", k=130)) for _ in range(40)]
    made = []
    for k in range(1500):
        own = "".join(random.choices("stuvwxyz ", k=random.randrange(100, 160)))
        made.append((None if k % 2 else 7, random.choice(passages_here) + own if k % 3 else own))
    assert len({xxhash.xxh64_intdigest(t.encode(), 0) & 0x7FFF for _, t in made}) < len(made) - 10
    got = passages.remove_repeats(spark.createDataFrame(made, "doc_id long, text string")).collect()
    assert ordered(map(tuple, got)) == ordered(plain_repeats(made))


def test_passages_large_keys(spark, monkeypatch):
    """Windows of a key with many chunks are dealt by their own hashes; the result is the same."""
    random.seed(5)
    core = "".join(random.choices("abcdefgh ", k=105))
    made = [(k, "".join(random.choices("abcdefgh ", k=random.randrange(60))) + core[: random.randrange(98, 106)]
             + "".join(random.choices("xyz", k=random.randrange(50)))) for k in range(80)]
    keys = [(r[0], r[1]) for r in made]

    import pyarrow as pa

    def stages(limit):
        monkeypatch.setattr(passages, "KEY_CHUNKS", limit)
        cut = list(passages._cut(iter([pa.RecordBatch.from_pydict({"doc_id": [d for d, _ in keys], "text": [t for _, t in keys]})])))
        chunk = pa.Table.from_batches(cut).sort_by([(c, "ascending") for c in passages._CHUNK])
        met = pa.Table.from_batches(list(passages._met(iter(chunk.combine_chunks().to_batches(max_chunksize=7)))))
        spans = []
        wanted = met.filter(pa.compute.is_valid(met.column("chunk"))).to_pylist()
        texts = dict(keys)
        rows = [(w["key"], w["doc_id"], w["at"], texts[w["doc_id"]].encode()[(w["at"] >> 8) & 0xFFFFFFFFFF :][: (w["at"] & 255) + 99]) for w in wanted]
        rows.sort()
        table = pa.table({"key": [r[0] for r in rows], "doc_id": [r[1] for r in rows], "at": [r[2] for r in rows], "bytes": [r[3] for r in rows]})
        out = [b.to_pylist() for b in passages._sorted_shards(iter(table.combine_chunks().to_batches(max_chunksize=9)))]
        first = {}
        for r in itertools.chain(*out):
            if r["w1"] is None:
                spans.append((r["doc_id"], r["start"], r["stop"]))
            else:
                first.setdefault((r["w1"], r["w2"]), []).append((r["doc_id"], r["tie"], r["start"], r["stop"]))
        for places in first.values():
            spans += [(d, a, b) for d, _, a, b in sorted(places)[1:]]
        for w in met.filter(pa.compute.is_null(met.column("chunk"))).to_pylist():
            begun = (w["at"] >> 8) & 0xFFFFFFFFFF
            spans.append((w["doc_id"], begun, begun + (w["at"] & 255) + 99))
        by = {}
        for d, a, b in spans:
            by.setdefault(d, []).append((a, b))
        return {d: passages.merged(v) for d, v in by.items()}

    few, many = stages(3), stages(20_000)
    assert few == many
    want = {d: (n, r) for d, _, n, r, _ in plain_repeats(made) if n}
    assert {d: (sum(b - a for a, b in v), len(v)) for d, v in many.items()} == want


def test_passages_nothing(nothing):
    assert passages.remove_repeats(nothing).count() == 0


# 4: lines


def plain_lines(rows, min_docs=5, min_chars=40):
    strip = " \t\n\x0b\x0c\r"
    holders = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            key = lower(line.strip(strip))
            if len(key) >= min_chars and doc_id is not None:
                holders.setdefault(key, set()).add(doc_id)
    common_keys = {k: max(v) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for doc_id, text in rows:
        cut = (text or "").split("\n")
        kept = [x for x in cut if common_keys.get(lower(x.strip(strip)), doc_id) == doc_id or lower(x.strip(strip)) not in common_keys]
        out.append((doc_id, "\n".join(kept), len(cut), len(cut) - len(kept)))
    return out


def test_lines(docs, rows):
    got = lines.dedupe_lines(docs)
    assert set(docs.columns) <= set(got.columns)
    got = got.select("doc_id", "text", "n_lines", "n_dropped").collect()
    assert ordered(map(tuple, got)) == ordered(plain_lines(rows))
    assert sum(r.n_dropped for r in got) >= 8


def test_lines_any_batches(spark):
    """Runs that are compacted twice hold the same as one run."""
    made = [(d, f"{'a shared line that is long enough to count':<45}{d * 7 % n}") for d in range(40) for n in (3, 11, 39)]
    docs = spark.createDataFrame(made, "doc_id long, text string")
    runs = lines.LineRuns(spark)
    rows = lines.line_rows(docs, 40, 9).cache()
    for batch in range(9):
        runs.add(rows.where(F.col("batch") == batch))
    assert len(runs.runs) < 9
    want = rows.groupBy("h1", "h2").agg(F.countDistinct("doc_id").alias("n_docs"), F.max("doc_id").alias("last_doc"))
    assert ordered(map(tuple, runs.known().select("h1", "h2", "n_docs", "last_doc").collect())) == ordered(map(tuple, want.collect()))


def test_lines_nothing(nothing):
    assert lines.dedupe_lines(nothing).count() == 0


# 5: simhash


def plain_fingerprint(text, width=4):
    found = re.findall(r"[^\x20\x09-\x0d]+", lower(text or ""))
    if not found:
        return 0
    cut = [" ".join(found[i : i + width]) for i in range(max(1, len(found) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(c.encode(), 42) for c in cut]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs_of_id_and_fp):
    named = [(d, f) for d, f in pairs_of_id_and_fp if d is not None]
    links = [(i, j) for (i, (_, a)), (j, (_, b)) in itertools.combinations(enumerate(named), 2) if (a ^ b).bit_count() <= 4]
    own = groups(len(named), links)
    least = {}
    for g, (d, _) in zip(own, named):
        least[g] = min(d, least.get(g, d))
    by_fp = {f: least[g] for g, (_, f) in zip(own, named)}
    return [(d, f"{f:016x}", by_fp.get(f)) for d, f in pairs_of_id_and_fp]


def test_simhash(docs, rows):
    want = plain_components([(d, plain_fingerprint(t)) for d, t in rows])
    assert ordered(map(tuple, simhash.simhash_report(docs).collect())) == ordered(want)


@pytest.mark.parametrize("block", [12, 20_000])
def test_simhash_links(spark, block):
    """Chains and a dense group, also when buckets are cut into blocks."""
    random.seed(3)
    base = random.getrandbits(64)
    fps = {base}
    for k in range(60):
        fps.add(base ^ sum(1 << b for b in random.sample(range(64), random.randrange(1, 7))))
    at = random.getrandbits(64)
    for k in range(12):
        at ^= sum(1 << b for b in random.sample(range(64), random.choice([3, 4, 5])))
        fps.add(at)
    fps |= {random.getrandbits(64) for _ in range(100)}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    classes = spark.createDataFrame([(f,) for f in signed], "fp long")
    links = simhash.fingerprint_links(classes, common.Scratch(spark), block=block).collect()
    place = {f: i for i, f in enumerate(signed)}
    assert all((fps[place[r.a]] ^ fps[place[r.b]]).bit_count() <= 4 for r in links)
    want = [(i, j) for i, j in itertools.combinations(range(len(fps)), 2) if (fps[i] ^ fps[j]).bit_count() <= 4]
    assert groups(len(fps), [(place[r.a], place[r.b]) for r in links]) == groups(len(fps), want)


def test_simhash_keeps_one(docs, rows):
    want = {(d, c) for d, _, c in plain_components([(d, plain_fingerprint(t)) for d, t in rows])}
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    kept = Counter(r.doc_id for r in got.collect())
    assert kept == Counter(d for d, _ in rows if d is None or (d, d) in want)


def test_simhash_nothing(nothing):
    assert simhash.simhash_report(nothing).count() == 0


# 6 and 10: classifiers


def held_out_scores(spark, name, label, modulus, remainder):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.QUERIES[name](spark, sf).collect()}
    docs = pq.read_table(f"{sf}/documents.parquet", columns=["doc_id"]).column("doc_id").to_pylist()
    assert sorted(got) == docs or sorted(got) == sorted(docs)
    for d, r in got.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % modulus == remainder) and 0 <= r.score <= 1
    labels = pq.read_table(f"{sf}/labels.parquet").to_pylist()
    return [(got[x["doc_id"]], x[label]) for x in labels if got[x["doc_id"]].held_out]


def ranked(pairs):
    """Chance that a row of label 1 scores above one of label 0."""
    ones, zeros = [r.score for r, y in pairs if y], [r.score for r, y in pairs if not y]
    return sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros) / (len(ones) * len(zeros))


def test_quality_held_out(spark):
    pairs = held_out_scores(spark, "op10_quality_classifier", "quality", 5, 0)
    assert ranked(pairs) > 0.95
    assert sum(r.predicted == y for r, y in pairs) / len(pairs) > 0.9
    assert sum(r.predicted for r, y in pairs if y) / sum(y for _, y in pairs) > 0.97


def test_toxicity_held_out(spark):
    pairs = held_out_scores(spark, "op6_toxicity", "toxic", 3, 1)
    assert ranked(pairs) > 0.8
    assert sum(r.predicted == y for r, y in pairs) / len(pairs) > 0.92
    assert sum(r.predicted for r, y in pairs if not y) / sum(not y for _, y in pairs) < 0.02


def test_machine_learns_meetings():
    """Neither word is toxic alone, both together are: no additive weights can tell."""
    random.seed(1)
    made = []
    for k in range(600):
        a, b = random.random() < 0.5, random.random() < 0.5
        found = [t for t, on in ((11, a), (12, b)) if on] + [random.randrange(100, 140)]
        made.append((np.array(found + [k + 1000], np.uint32), int(a and b)))
    model = toxicity.fit(made)

    def score(*hashes):
        return toxicity.logistic(model.linear(np.array([model.index[t] for t in hashes if t in model.index], np.int64))[0])

    assert score(11, 12) > 0.7 and max(score(11), score(12), score()) < 0.5


def test_machine_learns_either_or():
    """Toxic if both words stand there or neither: each by itself tells nothing, so additive weights can't."""
    random.seed(2)
    made = []
    for k in range(4000):
        a, b = random.random() < 0.5, random.random() < 0.5
        found = [t for t, on in ((11, a), (12, b)) if on] + [random.randrange(100, 140) for _ in range(5)]
        made.append((np.array(sorted(found), np.uint32), int(a == b)))
    model = toxicity.fit(made[:3000])
    assert {11, 12} <= set(model.index)

    def right(found, label):
        known = np.array([model.index[t] for t in found.tolist() if t in model.index], np.int64)
        return (model.linear(known)[0] >= 0) == label

    assert sum(right(*row) for row in made[3000:]) > 900


def plain_machine(bias, weights, vectors, own):
    """Sum over all pairs, one by one."""
    total = bias + sum(weights[t] for t in own)
    return total + sum(float(vectors[a] @ vectors[b]) for a, b in itertools.combinations(own, 2))


def test_machine_equals_the_sum_over_pairs():
    random = np.random.default_rng(5)
    model = toxicity.Model(0.3, {k: k for k in range(30)}, random.normal(size=30), random.normal(size=(30, toxicity.FACTORS)))
    for n in (0, 1, 2, 17):
        own = random.choice(30, n, replace=False)
        assert model.linear(own)[0] == pytest.approx(plain_machine(model.bias, model.weights, model.vectors, own.tolist()))


@pytest.mark.parametrize("scored", [quality.score_quality, toxicity.score_toxicity])
def test_classifier_edges(spark, docs, nothing, rows, scored):
    labels = spark.createDataFrame(
        [(d, d % 2, d % 2) for d, _ in rows if d is not None] + [(None, 1, 1), (3, None, None), (4, 1, 1), (4, 1, 1), (9999, 0, 0)],
        "doc_id long, quality int, toxic int",
    )
    got = scored(docs, labels).collect()
    assert Counter(r.doc_id for r in got) == Counter(d for d, _ in rows)
    assert len({r.score for r in got if r.doc_id in (130, 131)}) == 1
    assert scored(nothing, labels).count() == 0
    assert {r.score for r in scored(docs, labels.limit(0)).collect()} == {0.5}


def test_quality_filter_keeps_columns(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.keep_good(docs, labels, 0.3)
    assert got.columns == docs.columns and got.count() == docs.count()
    assert quality.keep_good(docs, labels, 0.6).count() == 0


# 2: long pages


@pytest.mark.parametrize("part", ["<script x>", "<!-- ", "<link href=a ", "<meta ", "</script <script>"])
def test_unclosed_tags_cost_in_proportion(spark, part):
    rows = [(1, "http://a.net/x", f'<link rel="canonical" href="http://b.org/fr/y"> {part * 200_000}'), (2, "http://b.org/fr/y", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    began = time.monotonic()
    found = {r.page_id: r.verdict for r in urls.judge_urls(pages, urls.rule_table(spark)).collect()}
    assert found == {1: "block", 2: "allow"} and time.monotonic() - began < 60


# 7: licences


def plain_base(text):
    found = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text or ""))
    places = [
        (i, label)
        for phrase, label in licences.BASE.items()
        for i in range(len(found))
        if found[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places]
    return len(found), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_licences(docs, rows):
    got = licences.scan_licences(docs).collect()
    assert ordered(tuple(r)[:6] for r in got) == ordered((d, *plain_base(t)) for d, t in rows)
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    by = {r.doc_id: r for r in got}
    assert by[150].labels == "cc-by,cc-by-nc,mit" and by[151].n_base == 2 and by[152].n_base == 0


def plain_labels(text, templates, frequency, total):
    """Every start that puts one of a template's rarest words at its place, all words compared."""
    found = [w for w in licences.words(text) if w]
    labels, best = set(), 0.0
    for label, body, phrases in templates:
        own = [w for w in licences.words(body) if w]
        missing = int(0.2 * len(own) + 1e-9)
        rare = sorted(range(len(own)), key=lambda q: (-math.log((1 + total) / (1 + frequency.get(own[q], 0))), q))
        for q in rare[: missing + min(2, len(own) - missing)]:
            for start in (k - q for k, w in enumerate(found) if w == own[q]):
                near = sum(w in found[max(0, start + i - 2) : max(0, start + i + 3)] for i, w in enumerate(own))
                region = b" " + b" ".join(found[max(0, start - 2) : start + len(own) + 2]) + b" "
                if len(own) - near <= missing and all(b" " + p.encode() + b" " in region for p in phrases):
                    labels.add(label)
                    best = max(best, near / len(own))
    return labels, best


def test_licence_index_misses_nothing():
    random.seed(7)
    vocabulary = [f"w{k}" for k in range(40)]
    templates = []
    for k in range(25):
        body = random.choices(vocabulary, k=random.randrange(1, 25))
        at = random.randrange(len(body))
        templates.append((f"t{k}", " ".join(body), (" ".join(body[at : at + 2]),)))
    frequency = {w.encode(): random.randrange(100) for w in vocabulary}
    index, seen = licences.Index.of(templates, frequency, 100), 0
    for _ in range(300):
        words = random.choices(vocabulary, k=random.randrange(30))
        for _ in range(random.randrange(3)):
            body = random.choice(templates)[1].split()
            for _ in range(random.randrange(4)):
                at = random.randrange(len(body))
                body[at : at + random.randrange(2)] = random.choices(vocabulary, k=random.randrange(2))
                body = body or ["w1"]
            words += body + random.choices(vocabulary, k=random.randrange(9))
        want, best = plain_labels(" ".join(words), templates, frequency, 100)
        *_, labels, score = licences.scan(" ".join(words), index)
        assert set(filter(None, labels.split(","))) == want and abs(score - best) < 1e-12
        seen += len(want)
    assert seen > 100


def test_licences_cost_in_proportion():
    index = licences.Index.of(list(licences.TEMPLATES), {}, 10)
    for text in ("cc by " * 800_000, "permission is hereby granted " * 150_000, "license " * 600_000):
        began = time.process_time()
        licences.scan(text, index)
        assert time.process_time() - began < 30
    many = [(f"x{k}", f"licence number n{k} grants a{k} and b{k} to everyone", (f"n{k} grants",)) for k in range(1000)]
    texts = [r["text"] or "" for r in pq.read_table(f"{DATA}/documents.parquet", columns=["text"]).to_pylist()] * 10

    def seconds(rows):
        index = licences.Index.of(rows, {}, 10)
        return min(timed(lambda: [licences.scan(t, index) for t in texts]) for _ in range(3))

    assert seconds(many + list(licences.TEMPLATES)) < 2 * seconds(list(licences.TEMPLATES)) + 0.2


def timed(call):
    began = time.process_time()
    call()
    return time.process_time() - began


def test_licence_table(spark, docs):
    rows = [(label, text, list(phrases)) for label, text, phrases in licences.TEMPLATES] + [("none", None, None), ("none", "", [])]
    table = spark.createDataFrame(rows, "label string, text string, phrases array<string>")
    assert ordered(map(tuple, licences.scan_licences(docs, table).collect())) == ordered(map(tuple, licences.scan_licences(docs).collect()))


def test_licence_templates():
    """Each template is found with words before and behind, with one word more, and not without a key phrase."""
    index = licences.Index.of(list(licences.TEMPLATES), {}, 10)
    for label, text, phrases in licences.TEMPLATES:
        assert label in licences.scan(f"Some words, {text.upper()}; and others", index)[5].split(",")
        assert label in licences.scan(f"/* {text.replace(' ', ' * ')} */", index)[5].split(",")
        broken = text.replace(phrases[0], " ".join(reversed(phrases[0].split())))
        if not any(x == label and y != text for x, y, _ in licences.TEMPLATES) and label not in licences.BASE.values():
            assert label not in licences.scan(broken, index)[5].split(",")


def test_licences_nothing(nothing):
    assert licences.scan_licences(nothing).count() == 0


# 8: embeddings


def vector_rows():
    random = np.random.default_rng(8)
    made = []
    for k in range(40):
        base = random.normal(size=64)
        for j in range(8):
            made.append((base + random.normal(size=64) * random.choice([0.05, 0.3, 0.45])).astype(np.float32).tolist())
    rows = [(k, v) for k, v in enumerate(made)]
    rows += [(1000 + k, made[5]) for k in range(30)] + [(2000, [0.0] * 64), (2001, [1.0] * 63), (2002, [2.0] * 63)]
    rows += [(2003, None), (2004, []), (2005, [float("nan")] * 64), (2006, [float("inf")] + [0.0] * 63), (2007, [None] + [1.0] * 63)]
    rows += [(None, made[9]), (7, made[7]), (2008, [1.0, 0.0]), (2009, [1.0, 0.1]), (2010, [0.0, 1.0]), (2011, [-1.0, 0.0])]
    return rows


def plain_vectors(rows):
    def good(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    links = []
    for (i, (_, a)), (j, (_, b)) in itertools.combinations(enumerate(rows), 2):
        if good(a) and good(b) and len(a) == len(b):
            a, b = np.array(a), np.array(b)
            if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.9:
                links.append((i, j))
    return links


@pytest.mark.parametrize("block", [25, 2000])
def test_embeddings(spark, monkeypatch, block):
    rows = vector_rows()
    monkeypatch.setattr(embeddings.class_links, "__defaults__", (0.9, block))
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, cid string")
    got = embeddings.near_vectors(table).collect()
    assert Counter(r.vec_id for r in got) == Counter(d for d, _ in rows)
    links = plain_vectors(rows)
    want = Counter(k for pair in links for k in pair)
    wanted = Counter((rows[k][0], n) for k, n in want.items())
    found = Counter((r.vec_id, r.n_links) for r in got if r.n_links)
    assert sum(n for (_, n), c in found.items() for _ in range(c)) >= 0.97 * sum(want.values())
    assert all(r.n_links <= max(n for (d, n), _ in wanted.items() if d == r.vec_id) for r in got if r.n_links)
    own = groups(len(rows), links)
    named = {}
    for k, g in enumerate(own):
        if rows[k][0] is not None:
            named[g] = min(rows[k][0], named.get(g, rows[k][0]))
    right = {rows[k][0]: named[g] for k, g in enumerate(own) if rows[k][0] is not None}
    same = [r.component_id == right[r.vec_id] for r in got if r.vec_id is not None]
    assert sum(same) >= 0.97 * len(same)
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
    assert {r.n_links for r in got if r.vec_id in (2000, 2003, 2004, 2005, 2006, 2007)} == {0}


def test_doubles_of_any_size(spark):
    """Near-equal vectors link whatever their length is, as doubles as they are."""
    random = np.random.default_rng(3)
    rows = []
    for k, size in enumerate((1e-310, 1e-200, 1e-50, 1.0, 1e60, 1e300)):
        base = random.normal(size=16)
        rows += [(10 * k, (base * size).tolist()), (10 * k + 1, (base * size * (1 + 1e-3 * random.normal(size=16))).tolist())]
    rows += [(90, [0.0] * 16), (91, [float("nan")] + [1.0] * 15), (92, None), (93, [-0.0] * 16)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_vectors(table).collect()}
    assert got == {k: ((1, k // 10 * 10) if k < 90 else (0, k)) for k, _ in rows}


def test_embeddings_recall(spark):
    """Over a whole table: recall of links at least 0.9, none below the cosine."""
    rows = pq.read_table(f"{DATA}/embeddings.parquet").to_pylist()
    ids = np.array([r["vec_id"] for r in rows])
    x = np.array([r["embedding"] for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    n = (x @ x.T >= 0.9).sum(axis=1) - 1
    got = {r.vec_id: r.n_links for r in queries.QUERIES["op8_embedding_near_dedup"](spark, DATA).collect()}
    assert all(got[i] <= k for i, k in zip(ids.tolist(), n.tolist()))
    assert sum(got.values()) >= 0.9 * n.sum()


def test_filters_are_shared():
    """At the wanted cosine nearly all pairs share a filter; the lists hold just the exceeding directions."""
    tables, alpha = embeddings.code(64)
    random = np.random.default_rng(1)
    a = random.normal(size=(150, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = random.normal(size=(150, 64))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.9 * a + math.sqrt(0.19) * b / np.linalg.norm(b, axis=1, keepdims=True)
    left, right = embeddings.passed(a, tables, alpha), embeddings.passed(b, tables, alpha)
    assert sum(bool(set(x) & set(y)) for x, y in zip(left, right)) >= 0.92 * 150
    products = [(a[0] @ x)[:, None] + (a[0] @ y)[None, :] for x, y in tables]
    assert set(left[0]) == set(np.flatnonzero(np.concatenate(products).ravel() >= alpha))


# 9: decontamination


def plain_shingles(text):
    found = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text or ""))
    return [tuple(found[i : i + 5]) for i in range(len(found) - 4)]


def plain_leaks(rows, items):
    """Over all windows of all documents."""
    out = {}
    for doc_id, text in rows:
        s = plain_shingles(text)
        for item_id, item in items:
            own = plain_shingles(item)
            if not own or not s or not set(own) & set(s):
                continue
            counted = Counter(own)
            for start in range(max(1, len(s) - len(own) + 1)):
                window = Counter(s[start : start + len(own)])
                shared = sum((window & counted).values())
                alike = shared / (sum(window.values()) + len(own) - shared)
                if alike >= 0.8:
                    now = out.get((doc_id, item_id), (0, 0))
                    out[doc_id, item_id] = max(now, (alike, -start))
    return out


def leak_rows():
    random.seed(6)
    words = ["".join(random.choices("abcdefg", k=random.randrange(1, 4))) for _ in range(60)]

    def prose(n):
        return " ".join(random.choices(words, k=n))

    items = [(k, prose(n)) for k, n in enumerate([6, 14, 40, 40, 80, 150])] + [(6, "la la la la la la la la la"), (7, None), (8, "too few"), (9, "")]
    rows = []
    for k in range(60):
        item = items[k % 7][1].split()
        if k % 4 == 1 and len(item) > 20:
            item[random.randrange(len(item))] = "changed"
        if k % 4 == 2:
            item = item[1:]
        if k % 4 == 3:
            item.insert(random.randrange(len(item)), "inserted")
        rows.append((k, f"{prose(random.randrange(40))} {' '.join(item).upper()}; {prose(random.randrange(40))}"))
    rows += [(70, items[2][1][:-4]), (71, None), (72, ""), (73, "la " * 50), (74, prose(5000)), (75, prose(300) + " " + items[4][1])]
    rows += [(None, items[1][1]), rows[0], (0, prose(30))]
    return rows, items


def test_leaks(spark):
    rows, items = leak_rows()
    table = spark.createDataFrame([(*i, 1) for i in items + [items[2]]], "item_id long, text string, shingle int")
    got = decontaminate.find_leaks(frame(spark, rows), table).collect()
    found = {(r.doc_id, r.item_id): (r.similarity, -r.start_word) for r in got}
    assert len(found) == len(got)
    want = plain_leaks(rows, items)
    assert len(want) > 30
    assert set(found) == set(want)
    assert all(abs(found[k][0] - v[0]) < 1e-12 and found[k][1] == v[1] for k, v in want.items())
    kept = decontaminate.without_leaks(frame(spark, rows), table)
    assert Counter(r.doc_id for r in kept.collect()) == Counter(d for d, _ in rows if d not in {x for x, _ in want})


def check_leaks(spark, rows, items):
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.similarity, -r.start_word) for r in decontaminate.find_leaks(frame(spark, rows), table).collect()}
    want = plain_leaks(rows, items)
    assert set(got) == set(want)
    assert all(abs(got[k][0] - v[0]) < 1e-12 and got[k][1] == v[1] for k, v in want.items())
    return want


def letters(n):
    return [hashlib.md5(str((n, k)).encode()).hexdigest()[:8] for k in range(n)]


def test_leaks_in_another_order(spark):
    """Items whose parts stand in the other order, inside longer documents."""
    rows, items = [], []
    for size in (45, 55, 59, 100, 200):
        item = letters(size)
        items.append((size, " ".join(item)))
        for cut in (size // 8, 14, size // 2, size - 5):
            for around in (0, 7, 60):
                text = letters(1000 + around)[:around] + item[cut:] + item[:cut] + letters(2000 + around)[:around]
                rows.append((len(rows), " ".join(text)))
        parts = [item[: size // 3], item[size // 3 : size // 2], item[size // 2 :]]
        rows.append((len(rows), " ".join([*letters(77), *parts[2], *parts[0], *parts[1], *letters(78)])))
    assert len(check_leaks(spark, rows, items)) > 50


def test_leaks_of_short_documents(spark):
    """Documents that are an item without its beginning or end, down to a similarity of 0.8 and below."""
    rows, items = [], []
    for size in (20, 59, 100, 200):
        item = letters(size)
        items.append((size, " ".join(item)))
        for share in range(76, 91):
            left = size * share // 100
            rows += [(len(rows), " ".join(item[:left])), (len(rows) + 1, " ".join(item[-left:]))]
    assert len(check_leaks(spark, rows, items)) > 60


def test_leaks_nothing(spark, nothing, docs):
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.find_leaks(nothing, items).count() == 0
    assert decontaminate.find_leaks(docs, items.limit(0)).count() == 0
    assert decontaminate.without_leaks(docs, items.limit(0)).count() == docs.count()


# 3: seams of a hot key


@pytest.mark.parametrize("limit", [1, 2, 3, 4, 5])
def test_seams_of_a_hot_key(monkeypatch, limit):
    """Chunks of one key in any parts: a place is covered if its chunk stands at an earlier place, never by itself."""
    import pyarrow as pa

    monkeypatch.setattr(passages, "KEY_CHUNKS", limit)
    random.seed(limit)
    for _ in range(60):
        rows = sorted((7, random.randrange(3), random.randrange(4), 0, random.randrange(2)) for _ in range(random.randrange(1, 14)))
        size = random.randrange(1, 5)
        batches = [
            pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[k : k + size])], passages._CHUNK)
            for k in range(0, len(rows), size)
        ]
        covered = set()
        for made in passages._met(iter(batches)):
            covered |= {(d, a) for c, d, a in zip(*(made.column(n).to_pylist() for n in ("chunk", "doc_id", "at"))) if c is None}
        want = {(d, a) for _, c, d, _, a in rows if any(o[1] == c and (o[2], o[4]) < (d, a) for o in rows)}
        assert covered == want


# pipeline: near copies


def plain_set(text):
    found = re.findall(r"[^\x20\x09-\x0d]+", lower(text or ""))
    return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def plain_similar(rows, least=0.8):
    """Pairs of rows by similarity, and each id's group."""
    named = [r for r in rows if r[0] is not None]
    sets = [plain_set(t) for _, t in named]
    pairs = []
    for i, j in itertools.combinations(range(len(named)), 2):
        a, b = sets[i], sets[j]
        shared = len(a & b)
        if a == b or (shared and shared / (len(a) + len(b) - shared) >= least):
            pairs.append((i, j))
    own, best = groups(len(named), pairs), {}
    for g, (d, _) in zip(own, named):
        best[g] = min(d, best.get(g, d))
    return [(d, best[g]) for g, (d, _) in zip(own, named)]


def similar_rows():
    """Pairs around 0.8, few of which are within four bits, next to short texts, chains and a group of close copies."""
    random.seed(11)
    words = ["".join(random.choices("abcdefghij", k=random.randrange(2, 7))) for _ in range(3000)]
    rows = []
    for k in range(150):
        n = random.choice([30, 60, 120, 400])
        text = random.choices(words, k=n)
        copy = list(text)
        for at in range(n // 60 if k % 2 else n // 40):
            copy[random.randrange(n)] = "changed"
        if k % 3 == 0:
            copy += random.choices(words, k=n // 12)
        rows += [(2 * k, " ".join(text)), (2 * k + 1, " ".join(copy).upper())]
    chain = random.choices(words, k=300)
    for k in range(6):
        chain = chain[15:] + random.choices(words, k=15)
        rows.append((1000 + k, " ".join(chain)))
    base = random.choices(words, k=200)
    for k in range(60):
        copy = list(base)
        copy[random.randrange(200)] = f"w{k}"
        rows.append((2000 + k, "\t".join(copy)))
    return rows + [(3000, "one two"), (3001, "ONE  two"), (3002, "one"), (3003, None), (3004, " "), (None, "one two")]


@pytest.mark.parametrize("block", [12, 20_000])
def test_near_copies(spark, rows, block):
    """All groups of the brute force, with buckets cut into blocks too."""
    made = similar_rows()
    want = plain_similar(made)
    near = sum(d != c for d, c in want)
    assert near > 150
    assert ordered(map(tuple, nearcopies.similar_groups(frame(spark, made), block=block).collect())) == ordered(want)
    four_bits = {(d, c) for d, _, c in plain_components([(d, plain_fingerprint(t)) for d, t in made])}
    assert sum(d != c for d, c in four_bits if d is not None and d < 1000) < near / 3


def test_pipeline_keeps_one_near_copy(spark, docs, rows):
    import corpus_pipeline

    for made in (similar_rows(), rows):
        want = {d for d, c in plain_similar(made) if d == c}
        got = corpus_pipeline.one_of_each_group(spark, frame(spark, made), DATA)
        assert got.columns == docs.columns
        assert Counter(r.doc_id for r in got.collect()) == Counter(d for d, _ in made if d is None or d in want)


@pytest.mark.parametrize("size", [120, 240])
def test_near_copies_of_a_hot_passage(spark, monkeypatch, size):
    """Texts that share a passage and are not similar: what is written grows with the texts, not with their pairs."""
    random.seed(size)
    words = ["".join(random.choices("abcdefghij", k=6)) for _ in range(2000)]
    base = random.choices(words, k=200)
    made = []
    for k in range(size):
        copy = list(base)
        for _ in range(2 + k % 6):
            copy[random.randrange(200)] = f"w{random.randrange(40)}"
        made.append((k, " ".join(copy)))
    written, keep = {}, common.Scratch.keep

    def counted(self, df, name, by=None):
        kept = keep(self, df, name, by)
        written[name] = kept.count()
        return kept

    monkeypatch.setattr(common.Scratch, "keep", counted)
    got = nearcopies.similar_groups(frame(spark, made)).collect()
    assert ordered(map(tuple, got)) == ordered(plain_similar(made))
    assert 50 < len({r.component_id for r in got}) < size
    assert all(n <= 40 * size for n in written.values()), written


def test_shared_shingles():
    rng = np.random.default_rng(3)
    sets = [np.sort(rng.choice(9000, rng.integers(1, 6000), replace=False)) for _ in range(9)] + [np.array([9001])]
    got = nearcopies.shared_shingles(np.concatenate(sets), np.array([s.size for s in sets]))
    for i, j in itertools.permutations(range(len(sets)), 2):
        assert got[i, j] == np.intersect1d(sets[i], sets[j]).size


def test_rarest_shingles_of_similar_sets_meet():
    """Whatever the frequencies are."""
    rng = np.random.default_rng(5)
    for _ in range(300):
        both = np.unique(rng.integers(0, 1 << 62, rng.integers(4, 120), dtype=np.uint64))
        gone = rng.integers(0, both.size // 5 + 1)
        cut = rng.integers(0, gone + 1)
        a, b = both[cut:], both[: both.size - (gone - cut)]
        places = np.unique(rng.choice(both, both.size // 2) % np.uint64(nearcopies.PLACES)).astype(np.int64)
        frequent = np.stack([places, rng.integers(16, 99, places.size)], axis=1)
        if np.intersect1d(a, b).size / both.size >= 0.8:
            assert np.intersect1d(nearcopies.rarest(a, frequent, 0.8), nearcopies.rarest(b, frequent, 0.8)).size
    assert nearcopies.rarest(np.empty(0, np.uint64), np.empty((0, 2), np.int32), 0.8).size == 0


def test_every_text_counts_for_frequency(spark, rows):
    """However many there are, and however often a shingle comes."""
    want = Counter()
    for _, text in rows:
        want.update((nearcopies.shingle_set(text or "") % np.uint64(nearcopies.PLACES)).tolist())
    got = nearcopies.frequent_places(frame(spark, rows).repartition(5))
    assert got.tolist() == [list(x) for x in sorted(want.items())]
    assert got[:, 0].flags.c_contiguous  # or each lookup copies it
    many = spark.range(25_000).select(F.col("id").alias("doc_id"), F.lit("the same five words here").alias("text"))
    assert nearcopies.frequent_places(many)[:, 1].tolist() == [25_000]


def test_near_copies_nothing(nothing):
    assert nearcopies.similar_groups(nothing).count() == 0
    assert nearcopies.keep_one_similar(nothing).count() == 0


# pipeline


def test_pipeline(spark):
    import corpus_pipeline

    kept = queries.table(spark, DATA, "documents")
    columns = kept.columns
    before = [(r.doc_id, r.text) for r in kept.collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, DATA)
        assert kept.columns == columns
        kept = common.Scratch(spark).keep(kept, "test")
        after = [(r.doc_id, r.text) for r in kept.collect()]
        if name == "quality classifier":
            assert set(after) <= set(before)
            score = quality.score_quality(spark.createDataFrame(before, "doc_id long, text string"), queries.table(spark, DATA, "labels"))
            assert {d for d, _ in after} == {r.doc_id for r in score.collect() if r.score >= 0.3}
        if name == "line dedup":
            assert ordered(after) == ordered([r[:2] for r in plain_lines(before)])
        if name == "simhash near-dedup":
            want = {d for d, c in plain_similar(before) if d == c}
            assert ordered(after) == ordered([r for r in before if r[0] in want])
        if name == "benchmark decontamination":
            items = [(r.item_id, r.text) for r in queries.table(spark, DATA, "benchmark").collect()]
            leaks = {d for d, _ in plain_leaks(before, items)}
            assert ordered(after) == ordered([r for r in before if r[0] not in leaks])
        before = after
    packed = corpus_pipeline.run(spark, DATA).collect()
    check_packing(packed, before, 4096)
    assert [name for name, _ in corpus_pipeline.STAGES][-1] == "best-fit packing"


# all queries with an SQL twin


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_twin(spark, name):
    connection = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    got = queries.QUERIES[name](spark, DATA)
    want = connection.execute(queries.ORACLE[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert ordered(map(tuple, got.select(*columns).collect())) == ordered(want.fetchall())
