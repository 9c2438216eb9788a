"""Periodic runs of words: Baier's grouping gives Lyndon roots, common extensions make runs of them.

A run is a stretch of consecutive words with a smallest period q, at least ``EXPONENT`` periods and ``LEAST`` words long,
which neither neighbour extends.  Every run has, in the order of words or in the reverse order, a place where its period
is the longest Lyndon word that begins there.

1. *Segments.*  Inside a run every pair of neighbouring words stands at least ``EXPONENT - 1`` times, so a text is cut
   where a pair is rarer, again and again in what is left.  Pairs are counted by hash, and a collision only keeps more.
   No run crosses a cut, and none could go on over it: the pair there would be a repeated one.
2. *Grouping.*  The first phase of Baier's suffix sorter groups places by the longest Lyndon word that begins there:
   groups are taken from the largest down, and each is appended to the places it hangs below.  It is run for the words'
   order and for the reverse order; suffixes need not be sorted.
3. *Extension.*  Ranks of stretches of 1, 2, 4, ... words tell in a logarithmic number of steps how far two places agree,
   forwards and backwards, for all roots at a time.  Long enough ones are runs.

All of it works within a document, so documents are dealt out as they come and nothing is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlsheaf.llm.common import SLICE, let, small_batches, whole

#: A run has as many periods at least, and as many words.
EXPONENT = 4
LEAST = 6
#: Words whose runs are worked out together; a longer segment is a piece of its own.
PIECE = 200_000
#: Size of the table in which pairs are counted, and rounds of counting.
TABLE_BITS = 20
ROUNDS = 6

_OUT = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string,"
    " collapsed_sha256 string, runs array<struct<start: long, length: long, period: long>>"
)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def lyndon_lengths(codes: list[int]) -> list[int]:
    """Length of the longest Lyndon word that begins at each place, smaller codes first."""
    names = {x: k for k, x in enumerate(sorted(set(codes)))}
    group = [names[x] for x in codes]
    members: list[list[int]] = [[] for _ in names]
    for i, g in enumerate(group):
        members[g].append(i)
    size = [1] * len(names)
    # groups in ascending order, as a chain both ways
    below, above = [k - 1 for k in range(len(names))], [k + 1 for k in range(len(names))]
    done = bytearray(len(names))
    found, left = [0] * len(codes), [0] * len(codes)
    now = len(names) - 1
    while now >= 0:
        done[now] = 1
        hung: list[list[int]] = []
        last = -1
        for i in members[now]:
            if group[i] != now:
                continue
            found[i] = size[now]
            up = i - 1
            while up >= 0 and done[group[up]]:
                up = left[up]
            left[i] = up
            if up < 0:
                continue
            if up == last:
                hung[-1][1] += 1
            else:
                hung.append([up, 1])
                last = up
        # places of a group that take on this one's word equally often stay together, right above those that do not
        parts: dict[tuple[int, int], list[int]] = {}
        for up, times in hung:
            parts.setdefault((group[up], -times), []).append(up)
        for old, times in sorted(parts):
            places = parts[old, times]
            new, higher = len(size), above[old]
            size.append(size[old] - times * size[now])
            members.append(places)
            done.append(0)
            below.append(old)
            above.append(higher)
            above[old] = below[higher] = new
            for up in places:
                group[up] = new
        now = below[now]
    return found


class Extensions:
    """How far two places of a sequence agree."""

    def __init__(self, codes: np.ndarray, longest: int) -> None:
        """``codes`` from 0; no two places agree over more than ``longest`` words."""
        self.ranks = [codes.astype(np.int32)]
        while (1 << len(self.ranks)) <= longest:
            last, step = self.ranks[-1].astype(np.int64), 1 << (len(self.ranks) - 1)
            both = last[:-step] * (int(last.max()) + 1) + last[step:]
            self.ranks.append(np.unique(both, return_inverse=True)[1].astype(np.int32))

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that agree from ``a`` and from ``b`` on, ``a < b``."""
        far = np.zeros(a.size, np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            rank = self.ranks[k]
            at = np.flatnonzero(b + far < rank.size)
            at = at[rank[a[at] + far[at]] == rank[b[at] + far[at]]]
            far[at] += 1 << k
        return far

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that agree before ``a`` and before ``b``, ``a < b``."""
        far = np.zeros(a.size, np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            rank, step = self.ranks[k], 1 << k
            at = np.flatnonzero(a - far >= step)
            at = at[rank[a[at] - far[at] - step] == rank[b[at] - far[at] - step]]
            far[at] += step
        return far


def segments(words: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of ``words`` that may hold a run; ``owner`` tells texts apart."""
    places, own = np.arange(words.size), owner
    for turn in range(ROUNDS):
        if not places.size:
            break
        joined = np.zeros(places.size, bool)  # with the place after it
        joined[:-1] = (own[1:] == own[:-1]) & (places[1:] == places[:-1] + 1)
        at = np.flatnonzero(joined)
        key = own[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15 + 2 * turn)
        key = (key ^ words[places[at]].astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        key = (key ^ (key >> np.uint64(29)) ^ words[places[at + 1]].astype(np.uint64)) * np.uint64(0x94D049BB133111EB)
        key = (key >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        joined[at[np.bincount(key, minlength=1 << TABLE_BITS)[key] < EXPONENT - 1]] = False
        first = np.flatnonzero(np.concatenate([[True], ~joined[:-1]]))
        sizes = np.diff(np.append(first, places.size))
        use = np.repeat(sizes >= LEAST, sizes)
        before = places.size
        own = np.repeat(np.arange(first.size), sizes)[use]
        places = places[use]
        if places.size > 0.9 * before:
            break
    if not places.size:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    last = np.append(first[1:], places.size) - 1
    return places[first], places[last] + 1


def _piece_runs(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``(start, length, period)`` of the runs of some segments, a row each."""
    sizes = ends - starts
    codes, roots, begin = [], [[], []], []
    at = 0
    total = int(sizes.sum()) + starts.size
    flat = np.empty(total, np.int64)
    for k, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
        own = np.unique(words[a:b], return_inverse=True)[1]
        for reverse in (0, 1):
            roots[reverse] += lyndon_lengths((own.max() - own if reverse else own).tolist())
        flat[at : at + b - a] = words[a:b]
        begin.append(at)
        at += b - a + 1
    begin = np.array(begin)
    marks = begin + sizes  # behind every segment stands a word of its own
    flat[marks] = int(words.max()) + 1 + np.arange(marks.size)
    codes = np.unique(flat, return_inverse=True)[1]
    reach = Extensions(codes, int(sizes.max()))
    place = np.arange(int(sizes.sum())) + np.repeat(np.arange(sizes.size), sizes)
    found = []
    for own in roots:
        period = np.array(own, np.int64)
        back = reach.backward(place, place + period)
        length = back + period + reach.forward(place, place + period)
        use = length >= np.maximum(LEAST, EXPONENT * period)
        found.append(np.stack([(place - back)[use], length[use], period[use]], axis=1))
    rows = np.unique(np.concatenate(found), axis=0)
    segment = np.searchsorted(begin, rows[:, 0], "right") - 1
    rows[:, 0] += starts[segment] - begin[segment]
    return rows


def find_runs(words: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """``(start, length, period)`` of all runs, by start and period; ``owner`` (ascending) tells texts apart."""
    starts, ends = segments(words, owner)
    rows = [np.empty((0, 3), np.int64)]
    piece = np.cumsum(ends - starts) // PIECE
    for k in np.unique(piece):
        rows.append(_piece_runs(words, starts[piece == k], ends[piece == k]))
    found = np.concatenate(rows)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _greatest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The run of the greatest exact exponent; of equal ones the first."""
    best = runs[0]
    for run in runs[1:]:
        if run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Per row of ``docs (doc_id, text)``: ``n_runs``, the run of greatest ``length / period`` (``start``, ``length``,
    ``period``, ``exponent_milli``; ties: smallest start, then period; null without runs), ``runs_sha256`` of a line
    ``start,length,period`` for each run by start and period, ``collapsed_sha256`` of the words that no run holds beyond
    its first period, joined by blanks, and the ``runs`` themselves.

    Words are the stretches between blanks (space, tab to carriage return).  A null or empty text has no words and no
    runs.  Repeated rows and rows without id are rows like others; other columns are ignored.  Long texts are worked out
    as a whole.  An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                texts = [(t or b"").split() for t in part.column("text").cast(pa.binary()).to_pylist()]
                sizes = np.array([len(t) for t in texts])
                begin = np.concatenate([[0], np.cumsum(sizes)])
                flat = pa.array([w for t in texts for w in t], pa.binary()).dictionary_encode()
                found = find_runs(flat.indices.to_numpy().astype(np.int64), np.repeat(np.arange(sizes.size), sizes))
                doc = np.searchsorted(begin, found[:, 0], "right") - 1
                cut = np.searchsorted(doc, np.arange(sizes.size + 1))
                rows = []
                for k, words in enumerate(texts):
                    own = found[cut[k] : cut[k + 1]]
                    if not own.size:
                        kept = hashlib.sha256(b" ".join(words)).hexdigest()
                        rows.append((0, None, None, None, None, hashlib.sha256().hexdigest(), kept, []))
                        continue
                    own = own - np.array([begin[k], 0, 0])
                    gone = np.zeros(len(words) + 1, np.int64)
                    np.add.at(gone, own[:, 0] + own[:, 2], 1)
                    np.add.at(gone, own[:, 0] + own[:, 1], -1)
                    kept = [words[i] for i in np.flatnonzero(np.cumsum(gone)[:-1] == 0).tolist()]
                    runs = [tuple(r) for r in own.tolist()]
                    start, length, period = _greatest(runs)
                    told = "".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()
                    rows.append(
                        (
                            len(runs), start, length, period, 1000 * length // period, hashlib.sha256(told).hexdigest(),
                            hashlib.sha256(b" ".join(kept)).hexdigest(),
                            [dict(zip(("start", "length", "period"), r)) for r in runs],
                        )
                    )
                types = [*[pa.int64()] * 5, pa.string(), pa.string(), pa.list_(_RUN)]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                names = [c.split()[0] for c in _OUT.split(", ")[:8]] + ["runs"]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return small_batches(rows).mapInArrow(run, _OUT)


def looped(docs: DataFrame) -> DataFrame:
    """``docs (doc_id, text)`` with loops in a tenth of the texts.

    With h the CRC-32 of the decimal id and g = h div 10, a text of n words is changed if 10 divides h: every word i from
    a = g mod n on becomes word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8).  Rows without id are left alone.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def made(words: Column) -> Column:
        n = F.size(words)

        def word(i: Column) -> Column:
            a = g % n
            p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
            return F.element_at(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int") + 1)

        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), word), " ")).otherwise("")

    words = F.filter(F.split(whole("text"), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    return docs.select("doc_id", F.when(h % 10 == 0, let(words, made)).otherwise(whole("text")).alias("text"))
