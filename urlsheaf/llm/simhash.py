"""SimHash near-dedup by deletion-variant signatures.

Fingerprints that differ in at most four bits are cut into three segments: one segment then differs in at most one
bit.  Every distinct fingerprint is indexed under the 64 variants that leave out one bit of one segment; two
fingerprints within the radius share a variant, and those that do are verified over all 64 bits.

Equal fingerprints are one class before anything is indexed.  A bucket of the index yields a spanning forest of its
links, never its pairs.  A bucket of more than ``BLOCK`` members is not gathered: it is cut into blocks, and each pair
of blocks is a bucket of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlsheaf.llm.common import Scratch, UPPER, small_batches, text_slices, whole_groups
from urlsheaf.llm.components import components

RADIUS = 4
#: First bits of the segments; RADIUS // number of segments must be 1.
SEGMENTS = (0, 21, 42, 64)
SEED = 42
#: Members of a bucket that one task gathers.
BLOCK = 20_000
#: Members that are compared place by place rather than by walking from member to member.
SMALL = 16
_LOWER = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())
#: Shingle hashes whose bits are counted at a time.
_PIECE = 1 << 15


def fingerprint(text: str, width: int = 4) -> int:
    """A bit is set if it is set in over half the hashes of the text's shingles of ``width`` words, repeats included.

    A text of fewer words is one shingle; one without words has fingerprint 0.
    """
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    ones, total = np.zeros(64, np.int64), max(1, len(words) - width + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    last = ends[min(width, len(words)) - 1 :]
    first = np.concatenate([[0], ends[: total - 1] + 1])
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, _PIECE):
        spans = zip(first[at : at + _PIECE].tolist(), last[at : at + _PIECE].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(ones * 2 > total).tolist())


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """``(doc_id, fp)``, fp being the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            found = np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found)], ["doc_id", "fp"])

    return small_batches(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def variants(fp: Column) -> Column:
    """The 64 keys of a fingerprint: which bit is left out, and the other bits of its segment."""
    keys = []
    for low, high in zip(SEGMENTS, SEGMENTS[1:]):
        segment = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << (high - low)) - 1))
        for bit in range(high - low):
            keys.append(segment.bitwiseAND(F.lit(~(1 << bit))) + F.lit((low + bit) << 24))
    return F.array(*keys)


def forest(members: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the radius connects: pairs of places in ``members``.

    Each member that is reached is compared once with those that are not yet reached.
    """
    left, rest = [], np.arange(len(members))
    right = []
    while rest.size > 1:
        reached, rest = [int(rest[0])], rest[1:]
        while reached and rest.size:
            here = reached.pop()
            near = np.bitwise_count(members[rest] ^ members[here]) <= radius
            if near.any():
                found = rest[near]
                left.append(np.full(found.size, here))
                right.append(found)
                reached.extend(found.tolist())
                rest = rest[~near]
    none = np.empty(0, np.int64)
    return np.concatenate(left or [none]), np.concatenate(right or [none])


def _bucket_links(keys: np.ndarray, members: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside runs of equal keys, as pairs of places."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(starts, keys.size))
    small = np.repeat(sizes <= SMALL, sizes)
    left, right = [], []
    for step in range(1, min(SMALL, int(sizes.max()))):
        same = (keys[step:] == keys[:-step]) & small[step:]
        at = np.flatnonzero(same)
        near = np.bitwise_count(members[at] ^ members[at + step]) <= radius
        left.append(at[near])
        right.append(at[near] + step)
    for start, size in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
        a, b = forest(members[start : start + size], radius)
        left.append(a + start)
        right.append(b + start)
    none = np.empty(0, np.int64)
    return np.concatenate(left or [none]), np.concatenate(right or [none])


def _linker(radius: int, block: int | None):
    """For mapInArrow over (key, fp) ordered by key: links (key null), and members (b null) of buckets over ``block``."""

    def out(key, a, b):
        return pa.RecordBatch.from_arrays(
            [pa.array(key, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["key", "a", "b"]
        )

    def links(keys, members):
        if keys.size > 1:
            a, b = _bucket_links(keys, members.view(np.uint64), radius)
            if a.size:
                pairs = np.unique(np.stack([members[a], members[b]]), axis=1)
                yield out([None] * pairs.shape[1], pairs[0], pairs[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for large, group in whole_groups(batches, "key", block):
            keys, members = group.column("key").to_numpy(), group.column("fp").to_numpy()
            if large:
                yield out(keys, members, [None] * keys.size)
            else:
                yield from links(keys, members)

    return run


_LINK = "key long, a long, b long"


def _bucketed(rows: DataFrame, radius: int, block: int | None) -> DataFrame:
    return rows.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_linker(radius, block), _LINK)


def fingerprint_links(classes: DataFrame, scratch: Scratch, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """``(a, b)``: links between distinct fingerprints ``fp`` that connect all that the radius connects."""
    index = classes.select(F.explode(variants(F.col("fp"))).alias("key"), "fp")
    found = scratch.keep(_bucketed(index, radius, block), "simhash-links")
    # of a bucket that was too large, every two blocks meet in a bucket of their own
    large = found.where("b IS NULL").select("key", F.col("a").alias("fp"))
    blocks = large.groupBy("key").agg(F.ceil(F.count("*") / block).cast("int").alias("n"))
    own = F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")
    paired = (
        large.join(blocks, "key")
        .withColumn("own", own)
        .select("key", "own", "fp", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other"))
        .select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "fp")
    )
    more = _bucketed(paired, radius, None)
    return found.where("b IS NOT NULL").select("a", "b").unionByName(more.select("a", "b")).distinct()


def simhash_components(docs: DataFrame, width: int = 4, radius: int = RADIUS) -> DataFrame:
    """``(doc_id, fp, component_id)`` of every row of ``docs``.

    Fingerprints that differ in at most ``radius`` bits are linked, equal ones included; the component is named by the
    smallest doc_id that links reach.  A null or empty text, or one of blanks only, has fingerprint 0, which is linked
    like any other.  A row without id belongs to its fingerprint's component, without linking or naming it: null if no
    row with an id has that fingerprint.  Repeated rows appear as often as they come.  Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession)
    prints = scratch.keep(fingerprints(docs, width), "simhash-prints")
    named = prints.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("rep"))
    classes = scratch.keep(named, "simhash-classes")
    links = fingerprint_links(classes, scratch, radius)
    ends = links.join(classes.select(F.col("fp").alias("a"), F.col("rep").alias("ra")), "a").join(
        classes.select(F.col("fp").alias("b"), F.col("rep").alias("rb")), "b"
    )
    groups = components(ends.select(F.col("ra").alias("a"), F.col("rb").alias("b")), scratch)
    scratch.drop("simhash-links")
    known = classes.join(groups, classes.rep == groups.node, "left").select(
        "fp", F.coalesce("component", "rep").alias("component_id")
    )
    return prints.join(known, "fp", "left").select("doc_id", "fp", "component_id")


def simhash_report(docs: DataFrame) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, the fingerprint as 16 hexadecimal digits."""
    found = simhash_components(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, width: int = 4, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs``, all columns, that name their component.

    Of repeated rows with that id all stay, and so do rows without id, which no id can tell apart.
    """
    found = simhash_components(docs, width, radius)
    first = found.where("doc_id = component_id").select(F.col("doc_id").alias("_id")).distinct()
    nobody = docs.sparkSession.range(1).select(F.lit(None).cast("long").alias("_id"))
    chosen = first.unionByName(nobody)
    return docs.join(chosen, docs["doc_id"].eqNullSafe(chosen["_id"]), "left_semi")
