"""Embedding near-dedup by spherical-cap filters.

A filter is a random unit direction; a vector passes it if their product exceeds ``alpha``.  Directions are all
pairs of one random code word from each half of the dimensions, so the filters that a vector passes are list-decoded
from two short lists of products instead of being tried one by one.  Vectors that share a filter are compared.

The number of code words follows from geometry alone: two vectors of just the wanted cosine share ``SHARED`` filters on
average.  Vectors whose halves are of uneven length have more filters than others, so this is done for ``TABLES``
rotations of the space, each with its own filters.  Of links of just that cosine three in a hundred are missed, of
closer ones fewer; none of this depends on the number of vectors.  Equal vectors are one class before anything is
filtered.  A filter that more than ``BLOCK`` classes pass is cut into blocks of which every two
meet; what leaves a task are links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urlsheaf.llm.common import Scratch, let, small_batches, whole_groups
from urlsheaf.llm.components import components

COSINE = 0.9
#: Expected number of filters that two vectors of just that cosine share.
SHARED = 4.0
TABLES = 3
#: Share of a random vector's length that a passed direction has, in standard deviations.
REACH = 3.5
BLOCK = 2_000
#: Classes of a filter that are compared place by place rather than by a matrix.
SMALL = 16
_HASH = ["h1", "h2"]


def meeting_chance(dims: int, alpha: float, cosine: float) -> float:
    """Chance that a random direction exceeds ``alpha`` with both of two unit vectors of that cosine: the density of a
    random unit vector's projection on their plane, summed over a grid."""
    grid = np.linspace(-1, 1, 2001)
    a, b = np.meshgrid(grid, grid)
    inside = 1 - a * a - b * b
    density = np.where(inside > 0, np.maximum(inside, 1e-300) ** ((dims - 4) / 2), 0.0)
    both = (a >= alpha) & (cosine * a + math.sqrt(1 - cosine * cosine) * b >= alpha)
    return float(density[both].sum() / density.sum())


def code(dims: int, cosine: float = COSINE) -> tuple[list[list[np.ndarray]], float]:
    """For each rotation the directions of both halves' code words (columns), and the sum of products that a passed
    filter reaches."""
    if dims < 8:  # too few for a plane's projection to be rare: one filter that all vectors pass
        return [[np.zeros((dims, 1)), np.zeros((dims, 1))]], -1.0
    alpha = min(0.7, REACH / math.sqrt(dims))
    size = math.ceil(math.sqrt(SHARED / meeting_chance(dims, alpha, cosine)))
    random = np.random.default_rng(dims)
    tables = []
    for _ in range(TABLES):
        rotation = np.linalg.qr(random.normal(size=(dims, dims)))[0]
        halves = []
        for axes in (rotation[:, : dims // 2], rotation[:, dims // 2 :]):
            drawn = random.normal(size=(axes.shape[1], size))
            halves.append(axes @ (drawn / np.linalg.norm(drawn, axis=0) / math.sqrt(2)))
        tables.append(halves)
    return tables, alpha


def passed(vectors: np.ndarray, tables: list[list[np.ndarray]], alpha: float) -> list[np.ndarray]:
    """Of each unit vector the numbers of the filters it passes."""
    found: list[list[np.ndarray]] = [[] for _ in vectors]
    for table, (one, other) in enumerate(tables):
        size = one.shape[1]
        for own, a, b in zip(found, vectors @ one, vectors @ other):
            able = np.flatnonzero(a >= alpha - b.max())
            partners = np.flatnonzero(b >= alpha - a.max())
            i, j = np.nonzero(a[able][:, None] + b[partners][None, :] >= alpha)
            own.append((table * size + able[i]) * size + partners[j])
    return [np.concatenate(own) for own in found]


def _unit(column: pa.Array) -> np.ndarray:
    """Vectors of equal length as rows of doubles of length one."""
    rows = np.array(column.to_pylist(), float)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codes: dict[int, tuple] = {}
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            sizes = np.array([len(v) for v in part.column("vector").to_pylist()])
            for dims in np.unique(sizes).tolist():
                own = part.take(pa.array(np.flatnonzero(sizes == dims)))
                if dims not in codes:
                    codes[dims] = code(dims)
                found = passed(_unit(own.column("vector")), *codes[dims])
                counts = [len(f) for f in found]
                rows = own.take(pa.array(np.repeat(np.arange(own.num_rows), counts)))
                keys = np.concatenate([*found, np.empty(0, np.int64)]).astype(np.int64) + (dims << 40)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), rows.column("cid"), rows.column("vector")], ["key", "cid", "vector"]
                )


def _near(keys: np.ndarray, vectors: np.ndarray, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of different rows with equal keys, which stand together, whose product reaches ``cosine``."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(starts, keys.size))
    small = np.repeat(sizes <= SMALL, sizes)
    for step in range(1, min(SMALL, int(sizes.max()))):
        i = np.flatnonzero((keys[step:] == keys[:-step]) & small[step:])
        near = np.einsum("ij,ij->i", vectors[i], vectors[i + step]) >= cosine
        yield i[near], i[near] + step
    for start, size in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
        own = vectors[start : start + size]
        for at in range(0, size, 1024):
            i, j = np.nonzero(own[at : at + 1024] @ own.T >= cosine)
            later = j > i + at
            yield i[later] + at + start, j[later] + start


_ARROW = {"float": pa.list_(pa.float32()), "double": pa.list_(pa.float64())}


def _met(kind: str, key, a, b, vector=None) -> pa.RecordBatch:
    n = len(a)
    vector = vector if vector is not None else pa.nulls(n, _ARROW[kind])
    columns = [pa.array(c, pa.int64()) for c in (key, a, b)]
    return pa.RecordBatch.from_arrays([*columns, vector.cast(_ARROW[kind])], ["key", "a", "b", "vector"])


def _comparer(cosine: float, block: int | None, kind: str):
    """For mapInArrow over (key, cid, vector) ordered by key: links a < b, and members (b null) of groups over ``block``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for large, group in whole_groups(batches, "key", block):
            if large:
                for part in group.combine_chunks().to_batches():
                    yield _met(kind, part.column("key"), part.column("cid"), [None] * part.num_rows, part.column("vector"))
                continue
            keys, ids = group.column("key").to_numpy(), group.column("cid").to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            sizes = np.diff(np.append(starts, keys.size))
            several = np.flatnonzero(np.repeat(sizes > 1, sizes))
            if not several.size:
                continue
            dims = keys >> 40
            for size in np.unique(dims[several]).tolist():
                at = several[dims[several] == size]
                vectors = _unit(group.column("vector").take(pa.array(at)))
                for i, j in _near(keys[at], vectors, cosine):
                    a, b = ids[at[i]], ids[at[j]]
                    if a.size:
                        yield _met(kind, [None] * a.size, np.minimum(a, b), np.maximum(a, b))

    return run


def _kind(rows: DataFrame) -> str:
    return rows.schema["vector"].dataType.elementType.simpleString()


def _compared(rows: DataFrame, cosine: float, block: int | None) -> DataFrame:
    kind = _kind(rows)
    dealt = rows.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(_comparer(cosine, block, kind), f"key long, a long, b long, vector array<{kind}>")


def class_links(classes: DataFrame, scratch: Scratch, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """``(a, b)``, a < b: classes ``(cid, vector)`` whose cosine is at least ``cosine``, as far as they share a filter."""
    rows = small_batches(classes).select("cid", "vector").mapInArrow(
        _filtered, f"key long, cid long, vector array<{_kind(classes)}>"
    )
    found = scratch.keep(_compared(rows, cosine, block), "cap-links")
    large = found.where("b IS NULL").select("key", F.col("a").alias("cid"), "vector")
    counts = large.groupBy("key").agg(F.ceil(F.count("*") / block).cast("int").alias("n"))
    paired = (
        large.join(counts, "key")
        .withColumn("own", F.pmod(F.xxhash64("cid"), F.col("n")).cast("int"))
        .select("key", "own", "cid", "vector", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other"))
        .select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "cid", "vector")
    )
    more = _compared(paired, cosine, None)
    return found.where("b IS NOT NULL").select("a", "b").unionByName(more.select("a", "b")).distinct()


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row of ``vectors (vec_id, embedding)``.

    Rows are linked if the cosine of their vectors, in double precision, is at least ``cosine``; equal vectors always
    are.  ``n_links`` counts the other rows linked to a row; ``component_id`` is the smallest vec_id that links reach.
    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, and so do vectors of
    different lengths with each other.  Components of doubles are as good at any size: a vector is scaled by a power of
    two, which loses nothing, before it is measured.  A row without id links and is counted, but names no component.  Repeated rows
    are rows like others.  Other columns are ignored.  No vectors: no rows.
    """
    scratch = Scratch(vectors.sparkSession)
    wide = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.col("embedding").isNotNull() & finite & F.exists(wide, lambda x: x != 0)
    if isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType):
        vector = F.col("embedding")
    else:
        largest = F.array_max(F.transform(wide, F.abs))
        vector = let(F.pow(F.lit(2.0), F.floor(F.log2(largest))), lambda s: F.transform(wide, lambda x: x / s))
    hashes = [F.when(good, F.xxhash64("embedding")).alias("h1"), F.when(good, F.xxhash64(F.lit(1), "embedding")).alias("h2")]
    rows = vectors.select("vec_id", *hashes, "embedding")
    classes = (
        rows.where("h1 IS NOT NULL")
        .groupBy(*_HASH)
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first(vector).alias("vector"))
        .withColumn("cid", F.monotonically_increasing_id())
    )
    classes = scratch.keep(classes, "cap-classes")
    links = scratch.keep(class_links(classes, scratch, cosine), "cap-pairs")
    scratch.drop("cap-links")
    both = links.union(links.select("b", "a"))
    sizes = classes.select(F.col("cid").alias("b"), F.col("n").alias("n_b"))
    linked = both.join(sizes, "b").groupBy(F.col("a").alias("cid")).agg(F.sum("n_b").alias("near"))
    groups = components(links, scratch).select(F.col("node").alias("cid"), "component")
    known = classes.join(groups, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    names = known.groupBy("component").agg(F.min("rep").alias("component_id"))
    known = (
        known.join(names, "component")
        .join(linked, "cid", "left")
        .select(*_HASH, (F.col("n") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"), "component_id")
    )
    ids = vectors.select("vec_id", *hashes)
    found = ids.join(known, _HASH, "left")
    component = F.when(F.col("h1").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return found.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
