"""Near copies by five-word similarity, found by wide SimHash fingerprints and the rarest shingles of each text.

Two texts are near copies if their sets of five-word shingles have a Jaccard index of at least 0.8.  At 0.8 about one
bit in 6.6 differs, so a fingerprint has ``WORDS`` times 64 bits; its segments have ``SEGMENT`` bits.  The rarest shingles
are the first fifth of a set in an order that is the same for all texts: two sets with that index share one of them,
whatever the order.  The order is by frequency in all texts, so what many texts hold comes last and is seldom among them.

1. Texts of equal shingle sets are one class.  Classes whose first 64 bits differ in at most four are linked by spanning
   forests, as in ``simhash``; links that the exact similarity confirms make groups, so hot groups cost what they hold.
2. A class is compared with one of those that lead the buckets of its whole segments: the one of the smallest group that
   is not its own.  Those that the exact similarity confirms join that group, in ``MERGES`` rounds, so a hot group is all
   but one before pairs are looked for, and has cost a pair for each member and round.
3. Classes of different groups that share a rare shingle, and are within ``RADIUS`` of the 128 bits that a row of the index
   carries, are candidates.  Buckets of few members yield pairs, and the exact similarity decides.  Larger ones yield their
   members: the shingle sets meet in blocks of ``CROWD`` members, every two of which are compared as a whole, and a block
   yields a spanning forest of its links, so that what is written grows with the members and not with their pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlsheaf.llm import simhash
from urlsheaf.llm.common import Scratch, small_batches, text_slices, whole_groups
from urlsheaf.llm.components import components

WIDTH = 5
SIMILARITY = 0.8
#: 64-bit words of a fingerprint, and bits of a segment (three in a word).
WORDS = 8
SEGMENT = 21
#: Of the 128 bits that are checked, about 19 differ at a similarity of 0.8 (standard deviation 4), 64 by chance (5.7).
RADIUS = 38
#: Rounds in which classes join the groups of those that lead their buckets; on a skewed table the first found 1,091 links,
#: the second 112, the third 9.
MERGES = 1
#: Places by which shingles are counted, and places whose counts are added up together.
PLACES = 1 << 20
_STRETCH = 1 << 12
#: Members of a bucket that yields pairs: beyond it, whole shingle sets are moved, for which pairs of a few are cheaper.
SMALL = 32
#: Members of a large bucket whose shingle sets one task compares with those of as many others.
CROWD = 512
#: Shingles whose presence is multiplied at a time.
_COLUMNS = 1 << 11
#: Classes whose keys are worked out at a time.
_PIECE = 1_000
_MIX = np.array([0x9E3779B97F4A7C15 * (2 * k + 1) & (1 << 64) - 1 for k in range(WORDS)], np.uint64)
_FP = [f"f{k}" for k in range(WORDS)]


def shingle_set(text: str, width: int = WIDTH) -> np.ndarray:
    """Sorted 64-bit hashes of the different shingles; a text of fewer words is one shingle, one without words none."""
    words = text.encode("utf-8", "surrogatepass").translate(simhash._LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    total, joined = max(1, len(words) - width + 1), b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    last = ends[min(width, len(words)) - 1 :].tolist()
    first = [0, *(ends[: total - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b]) for a, b in zip(first, last)), np.uint64, total))


def wide_fingerprint(shingles: np.ndarray) -> np.ndarray:
    """A bit is set if it is set in over half of the shingles' hashes, which are mixed anew for every word."""
    ones = np.zeros(64 * WORDS, np.int64)
    for at in range(0, shingles.size, 1 << 13):
        h = shingles[at : at + (1 << 13), None] + _MIX
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
        ones += np.unpackbits(h.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(ones * 2 > shingles.size, bitorder="little").view(np.uint64)


def _class(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes())


def frequent_places(docs: DataFrame) -> np.ndarray:
    """``(place, n)``, one a row, by place: places of shingles and how often the sets of all texts hold one of them.

    What meets in the driver are ``PLACES`` counts at most, however many texts there are.
    """

    def rows(counts: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for stretch, n in counts.items():
            yield pa.RecordBatch.from_arrays([pa.array([stretch], pa.int64()), pa.array([n.tobytes()])], ["stretch", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(PLACES, np.int64)
        for _, texts in text_slices(batches):
            sets = [shingle_set(t) for t in texts]
            if sets:
                at, times = np.unique(np.concatenate(sets) % np.uint64(PLACES), return_counts=True)
                n[at.astype(np.int64)] += times
        parts = n.reshape(-1, _STRETCH)
        yield from rows({k: parts[k] for k in np.flatnonzero(parts.any(axis=1)).tolist()})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for stretch, n in zip(batch.column("stretch").to_pylist(), batch.column("n")):
                more = np.frombuffer(n.as_buffer(), np.int64)
                sums[stretch] = sums[stretch] + more if stretch in sums else more.copy()
        yield from rows(sums)

    types = "stretch long, n binary"
    counted = small_batches(docs).select("text").mapInArrow(count, types).repartition("stretch").mapInArrow(add, types)
    total = np.zeros((PLACES // _STRETCH, _STRETCH), np.int64)
    for row in counted.collect():
        total[row["stretch"]] = np.frombuffer(row["n"], np.int64)
    total = total.ravel()
    at = np.flatnonzero(total)
    # each column in one piece, as every text looks places up
    places = np.stack([at, total[at]]).T
    return places.astype(np.int32) if total.max() < 1 << 31 else places


def rarest(shingles: np.ndarray, frequent: np.ndarray, least: float) -> np.ndarray:
    """So many of the rarest shingles that a set whose similarity is ``least`` or more shares one of them."""
    count = shingles.size - math.ceil(least * shingles.size - 1e-9) + 1 if shingles.size else 0
    n = np.zeros(shingles.size, np.int64)
    if len(frequent):
        places = (shingles % np.uint64(PLACES)).astype(frequent.dtype)
        at = np.minimum(np.searchsorted(frequent[:, 0], places), len(frequent) - 1)
        n = np.where(frequent[at, 0] == places, frequent[at, 1], 0)
    return shingles[np.lexsort((shingles, n))[:count]]


def sketches(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``(doc_id, c, n, f0, ..., rare)``: the class of a text, a hash of its shingle set, the set's size, its fingerprint
    and its rarest shingles."""
    frequent = frequent_places(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            sets = [shingle_set(t) for t in texts]
            own = np.array([_class(s) for s in sets], np.uint64).view(np.int64)
            size = np.array([s.size for s in sets], np.int64)
            fps = np.stack([wide_fingerprint(s) for s in sets]).view(np.int64)
            rare = [rarest(s, frequent, least).view(np.int64) for s in sets]
            columns = [part.column("doc_id"), pa.array(own), pa.array(size), *(pa.array(f) for f in fps.T.copy())]
            columns.append(pa.array(rare, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "c", "n", *_FP, "rare"])

    types = ", ".join(f"{f} long" for f in _FP)
    rows = small_batches(docs).select("doc_id", "text")
    return rows.mapInArrow(run, f"doc_id long, c long, n long, {types}, rare array<long>")


def segments(fps: np.ndarray) -> np.ndarray:
    """The segments of fingerprints (one a row)."""
    low = np.arange(0, 64 - SEGMENT + 1, SEGMENT, dtype=np.uint64)
    values = (fps[:, :, None] >> low) & np.uint64((1 << SEGMENT) - 1)
    return values.reshape(len(fps), -1).astype(np.int64)


def whole_segments(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of fingerprints (one a row), and the rows they belong to: segments as they are."""
    values = segments(fps)
    keys = values + (np.arange(values.shape[1]) << SEGMENT)
    return keys.ravel(), np.repeat(np.arange(len(fps)), values.shape[1])


_ROW = "key long, f0 long, f1 long, c long, g long"


def _indexer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _PIECE):
            part = batch.slice(at, _PIECE)
            fps = np.stack([part.column(f).to_numpy().view(np.uint64) for f in _FP], axis=1)
            keys, row = whole_segments(fps)
            columns = [keys, *(part.column(c).to_numpy()[row] for c in ("f0", "f1", "c", "g"))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "f0", "f1", "c", "g"])


def _leader_links(block: int):
    """For mapInArrow over index rows ordered by key: classes with the first and the last one of their bucket, of groups
    that differ.  A bucket of more than ``block`` rows is taken in pieces: here no pair has to be found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in whole_groups(batches, "key", block):
            keys, f0, f1, c, g = (group.column(x).to_numpy() for x in ("key", "f0", "f1", "c", "g"))
            f0, f1 = f0.view(np.uint64), f1.view(np.uint64)
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            sizes = np.diff(np.append(starts, keys.size))
            found = []
            for leader in (np.repeat(starts, sizes), np.repeat(starts + sizes - 1, sizes)):
                at = np.flatnonzero(g != g[leader])
                lead = leader[at]
                bits = np.bitwise_count(f0[at] ^ f0[lead]).astype(np.int64) + np.bitwise_count(f1[at] ^ f1[lead])
                at, lead = at[bits <= RADIUS], lead[bits <= RADIUS]
                found.append(np.stack([c[at], g[lead], c[lead]]))
            rows = np.concatenate(found, axis=1)
            rows = rows[:, np.lexsort(rows[::-1])]
            first = np.flatnonzero(np.concatenate([[True], rows[0, 1:] != rows[0, :-1]])) if rows.size else []
            if len(first):
                yield pa.RecordBatch.from_arrays([pa.array(r[first]) for r in rows], ["c", "lg", "lead"])

    return run


def leader_pairs(classes: DataFrame, block: int = simhash.BLOCK) -> DataFrame:
    """``(a, b)``: a class and one that leads a bucket of it, of different groups ``g``; at most one row for each class."""
    index = classes.select("c", "g", *_FP).mapInArrow(_indexer, _ROW)
    dealt = index.repartition("key").sortWithinPartitions("key", "c")
    led = dealt.mapInArrow(_leader_links(block), "c long, lg long, lead long")
    led = led.groupBy("c").agg(F.min(F.struct("lg", "lead")).alias("best"))
    return led.select(F.least("c", "best.lead").alias("a"), F.greatest("c", "best.lead").alias("b")).distinct()


def _candidates(least: float, block: int):
    """For mapInArrow over index rows ordered by key: pairs (key null) of small buckets; of others the members (b null)
    that have a pair, and all those of buckets over ``block``."""

    def out(key, a, b, g):
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (key, a, b, g)], ["key", "a", "b", "g"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for large, group in whole_groups(batches, "key", block):
            keys, f0, f1, c, g, n = (group.column(x).to_numpy() for x in ("key", "f0", "f1", "c", "g", "n"))
            if large:
                yield out(keys, c, [None] * keys.size, g)
                continue
            f0, f1 = f0.view(np.uint64), f1.view(np.uint64)

            def near(i, j):
                bits = np.bitwise_count(f0[i] ^ f0[j]).astype(np.int64) + np.bitwise_count(f1[i] ^ f1[j])
                sized = np.minimum(n[i], n[j]) >= least * np.maximum(n[i], n[j]) - 1e-9
                return (bits <= RADIUS) & (g[i] != g[j]) & sized

            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            sizes = np.diff(np.append(starts, keys.size))
            small = np.repeat(sizes <= SMALL, sizes)
            for step in range(1, min(SMALL, int(sizes.max()))):
                at = np.flatnonzero((keys[step:] == keys[:-step]) & small[step:])
                at = at[near(at, at + step)]
                if at.size:
                    a, b, none = c[at], c[at + step], [None] * at.size
                    yield out(none, np.minimum(a, b), np.maximum(a, b), none)
            for start, size in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
                wanted = np.zeros(keys.size, bool)
                for i in range(start, start + size - 1):
                    rest = np.arange(i + 1, start + size)
                    rest = rest[near(i, rest)]
                    wanted[rest] = True
                    wanted[i] |= rest.size > 0
                at = np.flatnonzero(wanted)
                if at.size:
                    # buckets of the same members have the same key, and are one
                    key = np.uint64(xxhash.xxh3_64_intdigest(np.sort(c[at]).tobytes())).astype(np.int64)
                    yield out(np.full(at.size, key), c[at], [None] * at.size, g[at])

    return run


def candidates(classes: DataFrame, least: float, block: int = simhash.BLOCK) -> DataFrame:
    """``(key, a, b, g)``: classes ``(a, b)`` of different groups that share a rare shingle and are within the radius, or,
    ``b`` being null, a class ``a`` of group ``g`` that is to be compared with the others of that ``key``."""
    index = classes.select(F.explode("rare").alias("key"), "f0", "f1", "c", "g", "n")
    dealt = index.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(_candidates(least, block), "key long, a long, b long, g long")


def shared_shingles(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many shingles every two sets share; ``values`` holds the sets one after the other."""
    held = np.repeat(np.arange(sizes.size), sizes)
    _, codes, times = np.unique(values, return_inverse=True, return_counts=True)
    held, codes = held[times[codes] > 1], codes[times[codes] > 1]
    codes = np.unique(codes, return_inverse=True)[1]
    order = np.argsort(codes, kind="stable")
    held, codes = held[order], codes[order]
    shared = np.zeros((sizes.size, sizes.size), np.float32)
    for at in range(0, int(codes[-1]) + 1 if codes.size else 0, _COLUMNS):
        a, b = np.searchsorted(codes, (at, at + _COLUMNS))
        here = np.zeros((sizes.size, _COLUMNS), np.float32)
        here[held[a:b], codes[a:b] - at] = 1
        shared += here @ here.T
    return shared.astype(np.float64)


def _crowd_links(least: float):
    """For mapInArrow over ``(key, c, g, shingles)`` ordered by key: links that connect what is similar in a bucket."""

    def links(c: np.ndarray, g: np.ndarray, shingles: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        sizes = shingles.value_lengths().to_numpy().astype(np.int64)
        shared = shared_shingles(shingles.flatten().to_numpy(), sizes)
        alike = shared / np.maximum(sizes[:, None] + sizes - shared, 1) >= least
        alike |= g[:, None] == g
        rest = np.arange(c.size)
        while rest.size > 1:
            reached, rest = [int(rest[0])], rest[1:]
            while reached and rest.size:
                here = reached.pop()
                found = rest[alike[here, rest]]
                reached.extend(found.tolist())
                rest = rest[~alike[here, rest]]
                found = found[g[found] != g[here]]
                if found.size:
                    yield np.minimum(c[found], c[here]), np.maximum(c[found], c[here])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in whole_groups(batches, "key", None):
            keys, c, g = (group.column(x).to_numpy() for x in ("key", "c", "g"))
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])).tolist()
            for a, b in zip(starts, [*starts[1:], keys.size]):
                shingles = pa.concat_arrays(group.column("shingles").slice(a, b - a).chunks)
                found = list(links(c[a:b], g[a:b], shingles))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], ["a", "b"])

    return run


def crowd_links(
    members: DataFrame, docs: DataFrame, classes: DataFrame, least: float, scratch: Scratch, crowd: int = CROWD
) -> DataFrame:
    """``(a, b)``: links that connect the similar ones of the ``members (key, c, g)`` of each key."""
    members = scratch.keep(members, "near-members")
    sets = shingle_sets(members.select("c").distinct(), docs, classes, scratch, "near-crowds")
    # of a bucket that is too large, every two blocks meet in a bucket of their own
    blocks = members.groupBy("key").agg(F.ceil(F.count("*") / crowd).cast("int").alias("n"))
    paired = (
        members.join(blocks, "key")
        .withColumn("own", F.pmod(F.xxhash64("c"), F.col("n")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
        .where("n = 1 OR own != other")
        .withColumn("key", F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")))
        .select("key", "c", "g")
    )
    met = paired.join(sets, "c").select("key", "c", "g", "shingles").repartition("key").sortWithinPartitions("key")
    links = scratch.keep(met.mapInArrow(_crowd_links(least), "a long, b long").distinct(), "near-crowd-links")
    scratch.drop("near-members", "near-crowds-sets")
    return links


def shingle_sets(asked: DataFrame, docs: DataFrame, classes: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``(c, shingles)`` of the classes ``asked (c)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            sets = [shingle_set(t) for t in texts]
            own = np.array([_class(s) for s in sets], np.uint64).view(np.int64)
            held = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(own), held], ["c", "shingles"])

    wanted = classes.join(asked, "c", "left_semi").select(F.col("rep").alias("_rep"))
    texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id") == F.col("_rep"), "left_semi")
    # another text of the same id has another class, and is not asked for; it does no harm
    return scratch.keep(texts.mapInArrow(run, "c long, shingles array<long>").dropDuplicates(["c"]), f"{name}-sets")


def confirmed(pairs: DataFrame, docs: DataFrame, classes: DataFrame, least: float, scratch: Scratch, name: str) -> DataFrame:
    """The ``pairs (a, b)`` of classes whose shingle sets are similar."""
    pairs = scratch.keep(pairs, f"{name}-asked")
    ends = pairs.select(F.col("a").alias("c")).unionByName(pairs.select(F.col("b").alias("c"))).distinct()
    sets = shingle_sets(ends, docs, classes, scratch, name)
    both = pairs.join(sets.select(F.col("c").alias("a"), F.col("shingles").alias("sa")), "a").join(
        sets.select(F.col("c").alias("b"), F.col("shingles").alias("sb")), "b"
    )
    shared = F.size(F.array_intersect("sa", "sb"))
    alike = shared / F.greatest(F.size("sa") + F.size("sb") - shared, F.lit(1))
    links = scratch.keep(both.where(alike >= least).select("a", "b"), f"{name}-links")
    scratch.drop(f"{name}-asked", f"{name}-sets")
    return links


def similar_groups(docs: DataFrame, least: float = SIMILARITY, block: int = simhash.BLOCK) -> DataFrame:
    """``(doc_id, component_id)`` of every row of ``docs`` with an id: the smallest doc_id that links reach.

    Texts are linked if their five-word similarity is at least ``least``; texts without words are alike.  Repeated rows
    appear as often as they come; other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession)
    rows = scratch.keep(sketches(docs.where("doc_id IS NOT NULL"), least), "near-sketches")
    first = [F.first(f).alias(f) for f in ("n", *_FP, "rare")]
    classes = scratch.keep(rows.groupBy("c").agg(F.min("doc_id").alias("rep"), *first), "near-classes")
    # close links first, a spanning forest of them
    prints = classes.groupBy(F.col("f0").alias("fp")).agg(F.min("c").alias("own"))
    close = simhash.fingerprint_links(prints.select("fp"), scratch, block=block)
    close = close.join(prints.select(F.col("fp").alias("a"), F.col("own").alias("ca")), "a").join(
        prints.select(F.col("fp").alias("b"), F.col("own").alias("cb")), "b"
    )
    equal = classes.join(prints, F.col("f0") == F.col("fp")).where("c != own").select(F.col("c").alias("a"), F.col("own").alias("b"))
    close = close.select(F.col("ca").alias("a"), F.col("cb").alias("b")).unionByName(equal).distinct()
    sure = confirmed(close, docs, classes, least, scratch, "near-close")

    def grouped(links: DataFrame, name: str, *columns: str) -> DataFrame:
        joined = classes.join(components(links, scratch), F.col("c") == F.col("node"), "left")
        return scratch.keep(joined.select("c", F.coalesce("component", "c").alias("g"), *columns), name)

    for turn in range(MERGES):
        now = grouped(sure, f"near-groups-{turn}", *_FP)
        led = confirmed(leader_pairs(now, block), docs, classes, least, scratch, f"near-led-{turn}")
        if led.isEmpty():
            break
        sure = sure.unionByName(led)
    merged = grouped(sure, "near-merged", "n", "f0", "f1", "rare")
    found = scratch.keep(candidates(merged, least, block), "near-pairs")
    pairs = found.where("b IS NOT NULL").select("a", "b").distinct()
    members = found.where("b IS NULL").select("key", F.col("a").alias("c"), "g").distinct()
    far = confirmed(pairs, docs, classes, least, scratch, "near-far").unionByName(
        crowd_links(members, docs, classes, least, scratch, min(block, CROWD))
    )
    whole = components(sure.unionByName(far), scratch)
    named = classes.join(whole, F.col("c") == F.col("node"), "left").select("c", "rep", F.coalesce("component", "c").alias("g"))
    named = scratch.keep(named, "near-named")
    ids = named.groupBy("g").agg(F.min("rep").alias("component_id"))
    scratch.drop("near-pairs", "near-merged", "near-crowd-links", "simhash-links", *(n for n in list(scratch.paths) if n.startswith("near-groups-")))
    return rows.join(named.join(ids, "g"), "c").select("doc_id", "component_id")


def keep_one_similar(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, all columns, that name their group of near copies.

    Of repeated rows with that id all stay, and so do rows without id, which no id can tell apart.
    """
    found = similar_groups(docs, least)
    first = found.where("doc_id = component_id").select(F.col("doc_id").alias("_id")).distinct()
    nobody = docs.sparkSession.range(1).select(F.lit(None).cast("long").alias("_id"))
    chosen = first.unionByName(nobody)
    return docs.join(chosen, docs["doc_id"].eqNullSafe(chosen["_id"]), "left_semi")
