"""Chat windows, ranked search and periodic runs against brute-force versions and round trips, with the awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from urlsheaf.llm import chat, queries, runs, search

DATA = "/root/testdata/sf0.001"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


# chat formatting

MARK = "<|im_end|><|im_start|>assistant ok"


def cost(text):
    return chat.MARKUP + len(re.findall(chat.TOKEN, text))


def conversations():
    random.seed(5)
    rows = []
    for c in range(6):
        rows += [(c, 0, "system", "be kind " * c)] if c % 2 else []
        for t in range(1, random.choice([2, 9, 40])):
            rows.append((c, t, "assistant" if t % 2 else "user", " ".join(random.choices(["a", "bc", "déf", "?!"], k=random.randint(0, 30)))))
    rows += [(10, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(1, 900)]  # a third of all rows
    rows += [(10, 0, "system", "sys")]
    rows += [(11, 0, "user", None), (11, 1, "assistant", ""), (11, 2, None, "x"), (11, 3, "odd\nrole \\n <|", MARK)]
    rows += [(12, 0, "user", MARK), (12, 1, "assistant", MARK + "<\\|im_start|>\\<\\\\|"), (12, 2, "assistant", "<" * 50 + "|")]
    rows += [(13, 0, "user", "long " * 30_000), (13, 1, "assistant", "<|" * 20_000), (13, 2, "user", "?")]
    rows += [(14, 0, "system", "huge system " * 200), (14, 1, "user", "a"), (14, 2, "assistant", "b"), (14, 3, "assistant", "c")]
    rows += [(None, 0, "user", "no id"), (None, None, "assistant", "no turn"), (None, 1, "assistant", "x")]
    rows += [(15, 0, "user", "same")] * 3 + [(15, 1, "assistant", "again")] * 40  # repeated rows
    random.shuffle(rows)
    return rows


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


@pytest.fixture(scope="module")
def talks(spark):
    rows = [(*r, 1, 2, 3) for r in conversations()]
    return spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, window int, key int, part int")


def plain_windows(rows, budget, history):
    """Windows of one conversation's ordered turns: new turns, history, system."""
    turns = [(r or "", t or "", cost(t or "")) for r, t in rows]
    first = turns[0][2] if turns[0][0] == "system" else 0
    room = max(1, budget - first - history)
    begin = np.concatenate([[0], np.cumsum([c for *_, c in turns])]).tolist()
    out, filled, block = [], 0, -1
    for i, (_, _, c) in enumerate(turns):
        c = 0 if first and not i else c
        if begin[i] // (chat.BLOCK * budget) != block or filled + c > room:
            out.append([i])
            filled, block = 0, begin[i] // (chat.BLOCK * budget)
        else:
            out[-1].append(i)
        filled += c
    done = []
    for own in out:
        left = min(history, budget - first - sum(turns[i][2] for i in own if i or not first))
        old = [i for i in range(own[0]) if begin[own[0]] - begin[i] <= left and (i or not first)]
        done.append(([0] if first and own[0] else []) + old + own)
    return [(w, len(w) - len(own)) for w, own in zip(done, out)]


@pytest.mark.parametrize("budget, history", [(120, 30), (64, 0), (1024, 256)])
def test_windows(talks, budget, history):
    rows = conversations()
    made = chat.format_conversations(talks, budget, history).collect()
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: -1 if r[1] is None else r[1])
        want = plain_windows([r[2:] for r in own], budget, history)
        got = sorted((r for r in made if r.conv_id == conv), key=lambda r: r.window)
        assert [(r.n_turns, r.n_repeated) for r in got] == [(len(w), n) for w, n in want]
        for r, (w, n) in zip(got, want):
            parts = r.text.split(chat.START)[1:]
            assert len(parts) == len(w) and all(p.endswith(chat.END) for p in parts)
            assert r.text.count(chat.END) == len(w)
            said = [p[: -len(chat.END)].split("\n", 1)[1] for p in parts]
            said = [re.sub(r"<\\(\\*)\|", r"<\1|", t) for t in said]
            assert said == [own[i][3] or "" for i in w]
            assert r.tokens == sum(cost(t) for t in said)
            assert len(w) - n == 1 or r.tokens <= budget
            lost = [re.sub(r"<\\(\\*)\|", r"<\1|", r.text[s.start : s.start + s.length]) for s in r.loss]
            assert lost == [own[i][3] or "" for i in w[n:] if own[i][2] == "assistant"]


def test_read_back(talks):
    rows = conversations()
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(talks, 200, 50)).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, r in got.items():
        own = sorted((x for x in rows if x[0] == conv), key=lambda x: -1 if x[1] is None else x[1])
        lost = [x[3] or "" for x in own if x[2] == "assistant"]
        assert r.n_turns == len(own)
        assert r.turns_sha256 == digest(f"{x[2] or ''}\n{x[3] or ''}\n" for x in own)
        assert (r.loss_chars, r.loss_sha256) == (sum(map(len, lost)), digest(lost))


def test_no_conversations(talks):
    made = chat.format_conversations(talks.limit(0))
    assert made.count() == 0 and chat.read_back(made).count() == 0


@settings(max_examples=20, deadline=None)
@given(texts=st.lists(st.text(alphabet="<|\\im_start>end\nxé", max_size=40), min_size=1, max_size=20))
def test_escape_is_reversible(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    made = frame.select("t", chat.escape(F.col("t")).alias("e"), chat.escape_role(F.col("t")).alias("r"))
    for row in made.select("*", chat.unescape(F.col("e")).alias("u"), chat.unescape_role(F.col("r")).alias("v")).collect():
        assert row.u == row.t == row.v and "<|" not in row.e and "<" not in row.r and "\n" not in row.r


def test_chat_stays_in_the_jvm(spark):
    made = queries.QUERIES["op11_chat_formatting"](spark, DATA)
    plan = made._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ranked search


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text or ""))


def plain_search(docs, items, top):
    own = [(d, Counter(plain_terms(t))) for d, t in docs]
    total, length = sum(bool(c) for _, c in own), sum(c.total() for _, c in own)
    held = Counter(t for _, c in own for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in own:
            m = 75 + 25 * c.total() * total // max(1, length)
            score = sum(
                n * math.floor(1000 * math.log((2 * total + 2) / (2 * held[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t, n in Counter(plain_terms(text)).items()
                if t in c
            )
            scores.append((-score, d is None, d or 0, d)) if score > 0 else None
        out += [(item, k + 1, r[3], -r[0]) for k, r in enumerate(sorted(scores, key=lambda r: r[:3])[:top])]
    return sorted(out, key=str)


def search_rows():
    random.seed(8)
    words = [f"w{k}" for k in range(300)] + ["Ünï", "naïve", "x1", "日本"]
    docs = [(d, " ".join(random.choices(words, k=random.randint(1, 80)))) for d in range(120)]
    docs += [(200 + k, "hot copy of one text w1 w2 w3") for k in range(70)]  # a third
    docs += [(300, None), (301, ""), (302, "-- !"), (303, "w1 " * 30_000), (None, "w5 w6 hot"), docs[3], docs[3]]
    items = [(k, " ".join(random.choices(words, k=random.randint(1, 20)))) for k in range(9)]
    items += [(20, "HOT copy-of w1"), (21, "nowhere"), (22, None), (23, ""), (24, "w1"), (None, "w5 w5 w6"), items[0]]
    return docs, items


@pytest.mark.parametrize("top, coordinates", [(20, search.COORDINATES), (3, 16)])
def test_search(spark, top, coordinates):
    """The same where sketches are so small that everything collides."""
    docs, items = search_rows()
    held = spark.createDataFrame([(*r, 1, 2, 3) for r in docs], "doc_id long, text string, q int, h1 long, score long")
    asked = spark.createDataFrame([(*r, 1, 2) for r in items], "item_id long, text string, doc_id long, h1 int")
    got = search.search(held, asked, top, coordinates).collect()
    assert sorted(map(tuple, got), key=str) == plain_search(docs, items, top)


def test_search_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_ITEMS", 3)
    docs, items = search_rows()
    held = spark.createDataFrame(docs, "doc_id long, text string")
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, search.search(held, asked).collect()), key=str) == plain_search(docs, items, 20)


def test_search_of_nothing(spark):
    docs, items = search_rows()
    held, asked = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert search.search(held.limit(0), asked).count() == 0
    assert search.search(held, asked.limit(0)).count() == 0


def test_bounds_hold():
    """A coordinate's weight is that of all its terms, repeats included."""
    block = search.Block.of([b"a b c d", b"a a z"])
    block.weights = [7, 5, 3, 2, 11]
    for coordinates in (1 << 16, 2):
        at, weights = block.table(coordinates)
        assert weights.sum(axis=0).tolist() == [17, 25] and (at >= 0).sum() == len(weights) <= coordinates


# periodic runs


def plain_runs(words):
    out = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            size = i - start + q
            smaller = any(all(words[j] == words[j + p] for j in range(start, start + size - p)) for p in range(1, q))
            if size >= max(6, 4 * q) and not smaller:
                out.append((start, size, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_report(doc, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    found = plain_runs(words)
    gone = {i for start, size, q in found for i in range(start + q, start + size)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else (None, None, None)
    return (
        doc, len(found), *best, 1000 * best[1] // best[2] if found else None,
        digest(f"{a},{b},{c}\n" for a, b, c in found), digest([" ".join(w for i, w in enumerate(words) if i not in gone)]),
    )


def run_rows():
    random.seed(3)
    rows = []
    for d in range(60):
        words = []
        while len(words) < random.randint(1, 200):
            words += random.choices("abcdefgh"[: random.choice([1, 2, 8])], k=random.randint(1, 7)) * random.randint(1, 8)
        rows.append((d, random.choice([" ", "\n", "\t "]).join(words)))
    rows += [(100, None), (101, ""), (102, " \n"), (103, "one"), (104, "x " * 6), (105, "x " * 5), (106, "A a A a A a a")]
    rows += [(None, "q r " * 9), (107, "é é " * 8), rows[0], rows[0], (108, "y\x1cz y\x1cz " * 4)]
    rows += [(110 + k, "the same loop " * 7) for k in range(40)]
    return rows


@settings(max_examples=200, deadline=None)
@given(codes=st.lists(st.integers(0, 2), min_size=1, max_size=14))
def test_lyndon_lengths(codes):
    want = [
        max(l for l in range(1, len(codes) - i + 1) if all(codes[i : i + l] < codes[i + k : i + l] for k in range(1, l)))
        for i in range(len(codes))
    ]
    assert runs.lyndon_lengths(codes) == want


@settings(max_examples=100, deadline=None)
@given(texts=st.lists(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=5), st.integers(1, 7))), min_size=1, max_size=4))
def test_find_runs(texts):
    texts = [[x for root, times in t for x in root * times] for t in texts]
    flat = np.array([x for t in texts for x in t], np.int64)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    want, at = [], 0
    for t in texts:
        want += [(a + at, b, c) for a, b, c in plain_runs(t)]
        at += len(t)
    assert [tuple(r) for r in runs.find_runs(flat, owner).tolist()] == want


def test_runs_in_pieces(monkeypatch):
    monkeypatch.setattr(runs, "PIECE", 10)
    texts = [list("ab" * 9), list("c" * 30), list("xyz" * 5)]
    flat = np.array([ord(x) for t in texts for x in t], np.int64)
    owner = np.repeat(np.arange(3), [len(t) for t in texts])
    assert runs.find_runs(flat, owner).tolist() == [[0, 18, 2], [18, 30, 1], [48, 15, 3]]


def test_periodic_runs(spark):
    rows = run_rows()
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, runs int, start string")
    got = runs.periodic_runs(frame).drop("runs").collect()
    assert sorted(map(tuple, got), key=str) == sorted((plain_report(*r) for r in rows), key=str)
    assert runs.periodic_runs(frame.limit(0)).count() == 0


def test_a_long_loop(spark):
    frame = spark.createDataFrame([(1, "a b " * 200_000), (2, "c " * 300_000)], "doc_id long, text string")
    got = {r.doc_id: (r.n_runs, r.start, r.length, r.period) for r in runs.periodic_runs(frame).collect()}
    assert got == {1: (1, 0, 400_000, 2), 2: (1, 0, 300_000, 1)}


def plain_looped(doc, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc).encode())
    g, n = h // 10, len(words)
    if doc is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def test_query_of_runs(spark):
    docs = [(r.doc_id, r.text) for r in queries.table(spark, DATA, "documents").collect()]
    got = queries.QUERIES["op13_periodic_runs"](spark, DATA).collect()
    want = [plain_report(d, " ".join(plain_looped(d, t))) for d, t in docs]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    odd = [(None, "a b"), (7, None), (3, ""), *[(d, "u v w x y z") for d in range(300, 400)]]
    made = runs.looped(spark.createDataFrame(odd, "doc_id long, text string")).collect()
    assert [(r.doc_id, r.text.split()) for r in made] == [(d, plain_looped(d, t)) for d, t in odd]
