"""Suffix-array dedup: bytes covered by long strings that also start earlier.

Whole texts are far too large for one suffix array, so strings are dealt to shards by content, and exactly: the key of
a window of ``LENGTH`` bytes is its smallest hash of ``GRAM`` bytes, which depends on nothing but the window, so equal
windows have equal keys.  Consecutive windows of the same smallest hash form a chunk.

1. Documents are cut into chunks.  Of equal chunks a task sends on the first only, and reports the others as covered.
2. Chunks meet by key.  Again all but the first of equal chunks are covered; if a key has different chunks, their
   windows may still be equal in part, and their text is looked up.
3. Shards of whole keys are sorted by induced sorting.  Suffixes with ``LENGTH`` common letters, by permuted common
   prefixes, are equal windows; all but the first are covered.  A key with more than ``KEY_CHUNKS`` different chunks is
   never gathered: its windows are dealt on by their own hashes.
4. Covered stretches go back to their documents.

Texts travel twice, compressed, and only as far as the document they belong to.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlsheaf.llm.common import Scratch, small_batches, text_slices, whole_groups
from urlsheaf.llm.suffixes import permuted_common_prefixes, suffix_array

LENGTH = 100
GRAM = 32
#: Windows that share a smallest hash at most.
_SPAN = LENGTH - GRAM + 1
#: Bytes of a text whose hashes are worked out at a time.
STRETCH = 1 << 20
#: Chunks that a task compares with each other before it sends them on.
HELD_CHUNKS = 400_000
#: Different chunks of one key that may meet in a shard; bytes of a shard.
KEY_CHUNKS = 20_000
SHARD = 1 << 20
_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
#: In place of a null id: before all others.
_NO_ID = -(1 << 63)


def _gram_hashes(b: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each place on."""
    h = b.astype(np.uint64) + np.uint64(1)
    for k, mix in enumerate(_MIX):
        step = 1 << k
        left = h[:-step] * mix
        left ^= left >> np.uint64(29)
        left += h[step:]
        h = left
    h = h * _MIX[0]
    h ^= h >> np.uint64(32)
    return h * _MIX[1]


def chunks(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window of each chunk, and its key.  Texts of under ``LENGTH`` bytes have none."""
    b = np.frombuffer(text, np.uint8)
    firsts, lasts, keys = [], [], []
    for at in range(0, max(0, len(b) - LENGTH + 1), STRETCH):
        part = b[at : at + STRETCH + LENGTH - 1]
        h = _gram_hashes(part)
        # hash above, place below: of equal hashes the leftmost is the smallest
        packed = (h & ~np.uint64((1 << 24) - 1)) | np.arange(h.size, dtype=np.uint64)
        low, width = packed, 1
        while width * 2 <= _SPAN:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        low = np.minimum(low[: low.size - (_SPAN - width)], low[_SPAN - width :])
        place = (low & np.uint64((1 << 24) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        firsts.append(first + at)
        lasts.append(np.append(first[1:], place.size) - 1 + at)
        keys.append(h[place[first]])
    if not firsts:
        none = np.empty(0, np.int64)
        return none, none, none
    return np.concatenate(firsts), np.concatenate(lasts), np.concatenate(keys).view(np.int64)


#: Where something stands in a text: start, windows.
def _pack_at(first: np.ndarray, windows: np.ndarray) -> np.ndarray:
    return (first << 8) | windows


def _tie(text: bytes) -> int:
    """The text's hash as a signed long, which tells rows that share an id apart."""
    digest = xxhash.xxh64_intdigest(text, 0)
    return digest - (1 << 64) if digest >> 63 else digest


_CHUNK = ["key", "chunk", "doc_id", "tie", "at"]
_CHUNK_TYPE = "key long, chunk long, doc_id long, tie long, at long"


def _batch(*columns) -> pa.RecordBatch:
    """Chunks; a null ``chunk`` marks a covered one."""
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], _CHUNK)


def _first_of_each(key, chunk, doc, tie, at) -> Iterator[pa.RecordBatch]:
    """The first of equal chunks, and the others as covered, dealt by document."""
    order = np.lexsort((at, tie, doc, chunk, key))
    key, chunk, doc, tie, at = key[order], chunk[order], doc[order], tie[order], at[order]
    again = np.concatenate([[False], (key[1:] == key[:-1]) & (chunk[1:] == chunk[:-1])])
    new = ~again
    # a repeated row is the same place
    again[1:] &= (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1]) | (at[1:] != at[:-1])
    yield _batch(key[new], chunk[new], doc[new], tie[new], at[new])
    if again.any():
        none = [None] * int(again.sum())
        yield _batch(doc[again] * 0x9E3779B1 + tie[again], none, doc[again], tie[again], at[again])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to chunks."""
    held, count = [], 0
    for part, texts in text_slices(batches):
        for doc_id, text in zip(part.column("doc_id").to_pylist(), texts):
            data = text.encode("utf-8", "surrogatepass")
            first, last, key = chunks(data)
            if not first.size:
                continue
            spans = zip(first.tolist(), (last + LENGTH).tolist())
            chunk = np.array([xxhash.xxh3_64_intdigest(data[a:b]) for a, b in spans], np.uint64).view(np.int64)
            # documents without an id come first
            doc = np.full(first.size, _NO_ID if doc_id is None else doc_id)
            held.append((key, chunk, doc, np.full(first.size, _tie(data)), _pack_at(first, last - first + 1)))
            count += first.size
            if count >= HELD_CHUNKS:
                yield from _first_of_each(*map(np.concatenate, zip(*held)))
                held, count = [], 0
    if held:
        yield from _first_of_each(*map(np.concatenate, zip(*held)))


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks ordered by key, chunk and place: covered ones, and those whose key has different chunks."""
    previous, place = None, None  # last chunk of a key that comes in several parts, and where it stands
    for large, group in whole_groups(batches, "key", KEY_CHUNKS):
        key, doc, tie, at = (group.column(c).to_numpy() for c in ("key", "doc_id", "tie", "at"))
        covered = np.asarray(group.column("chunk").is_null())
        chunk = group.column("chunk").fill_null(0).to_numpy()
        again = np.zeros(key.size, bool)
        same_key = key[1:] == key[:-1]
        again[1:] = same_key & (chunk[1:] == chunk[:-1]) & ~covered[1:] & ~covered[:-1]
        if large and previous == (key[0], chunk[0]) and not covered[0]:
            again[0] = True
        new = ~(covered | again)
        # a repeated row is the same place, on this side of a seam and across it
        again[1:] &= (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1]) | (at[1:] != at[:-1])
        again[0] &= place != (doc[0], tie[0], at[0])
        previous = None if covered[-1] else (key[-1], chunk[-1])
        place = (doc[-1], tie[-1], at[-1])
        gone = covered | again
        if gone.any():
            yield _batch(key[gone], [None] * int(gone.sum()), doc[gone], tie[gone], at[gone])
        if large:
            mixed = new
        else:
            starts = np.flatnonzero(np.concatenate([[True], ~same_key]))
            different = np.add.reduceat(new.astype(np.int64), starts)
            mixed = new & np.repeat(different > 1, np.diff(np.append(starts, key.size)))
        if mixed.any():
            yield _batch(key[mixed], chunk[mixed], doc[mixed], tie[mixed], at[mixed])


def packed_texts(docs: DataFrame) -> DataFrame:
    """``(doc_id, tie, packed)``: texts compressed; the smallest number stands for a null id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for part, texts in text_slices(batches):
            data = [t.encode("utf-8", "surrogatepass") for t in texts]
            columns = [
                part.column("doc_id").fill_null(_NO_ID),
                pa.array([_tie(d) for d in data], pa.int64()),
                pa.array([squeeze.compress(d) for d in data], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "tie", "packed"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, tie long, packed binary")


def _unpacked(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def _with_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, tie, packed, key list, at list) to chunks with their bytes."""
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "tie", "packed", "keys", "ats")))
        for doc_id, tie, packed, keys, ats in rows:
            data = _unpacked(packed)
            cut = []
            for at in ats:
                first = at >> 8
                cut.append(data[first : first + (at & 255) + LENGTH - 1])
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in (keys, [doc_id] * len(ats), [tie] * len(ats), ats)), pa.array(cut, pa.binary())],
                ["key", "doc_id", "tie", "at", "bytes"],
            )


_COVERED = "w1 long, w2 long, doc_id long, tie long, start long, stop long"


def _covered(doc, tie, at, first, last, w1=None, w2=None) -> pa.RecordBatch:
    """Stretches of windows ``first`` to ``last`` inside chunks."""
    n = len(doc)
    begun = at >> 8
    none = pa.nulls(n, pa.int64())
    columns = [none if w1 is None else pa.array(w1), none if w2 is None else pa.array(w2)]
    columns += [pa.array(c) for c in (doc, tie, begun + first, begun + last + LENGTH)]
    return pa.RecordBatch.from_arrays(columns, ["w1", "w2", "doc_id", "tie", "start", "stop"])


def repeated_windows(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Windows, as (part, start in it), that equal an earlier one, by the parts' suffix array."""
    sizes = np.array([len(p) for p in parts])
    s = np.frombuffer(b"".join(parts), np.uint8)
    sa = suffix_array(s)
    plcp = permuted_common_prefixes(s, sa)
    ends = np.cumsum(sizes)
    part = np.repeat(np.arange(sizes.size), sizes)
    inside = np.arange(s.size) + LENGTH <= ends[part]
    run = np.cumsum(plcp[sa] < LENGTH)
    place, run = sa[inside[sa]], run[inside[sa]]
    order = np.lexsort((place, run))
    place, run = place[order], run[order]
    later = np.concatenate([[False], run[1:] == run[:-1]])
    found = np.sort(place[later])
    return part[found], found - (ends - sizes)[part[found]]


def _sorted_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks with bytes, ordered by key and place: covered stretches; windows with their hashes where a key is large."""
    held: list[pa.Table] = []
    size = 0

    def shard(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        part, start = repeated_windows(rows.column("bytes").to_pylist())
        if part.size:
            doc, tie, at = (rows.column(c).to_numpy() for c in ("doc_id", "tie", "at"))
            first = np.concatenate([[True], (part[1:] != part[:-1]) | (start[1:] != start[:-1] + 1)])
            last = np.append(first[1:], True)
            own = part[first]
            yield _covered(doc[own], tie[own], at[own], start[first], start[last])

    for large, group in whole_groups(batches, "key", KEY_CHUNKS):
        if "tie" not in group.column_names:  # ids are unique
            group = group.append_column("tie", pa.array(np.zeros(group.num_rows, np.int64)))
        if large:
            for doc, tie, at, data in zip(*(group.column(c).to_pylist() for c in ("doc_id", "tie", "at", "bytes"))):
                n = at & 255
                hashes = [divmod(xxhash.xxh3_128_intdigest(data[k : k + LENGTH]), 1 << 64) for k in range(n)]
                pair, k = np.array(hashes, np.uint64).view(np.int64), np.arange(n)
                yield _covered(np.full(n, doc), np.full(n, tie), np.full(n, at), k, k, pair[:, 0], pair[:, 1])
            continue
        keys, docs, ties, ats = (group.column(c).to_numpy() for c in ("key", "doc_id", "tie", "at"))
        once = np.ones(keys.size, bool)  # repeated rows bring the same place
        once[1:] = (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1]) | (ties[1:] != ties[:-1]) | (ats[1:] != ats[:-1])
        group, keys = group.filter(pa.array(once)), keys[once]
        # whole keys up to a shard's size
        lengths = np.cumsum((group.column("at").to_numpy() & 255) + LENGTH - 1)
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        begun = 0
        for end in [*starts[1:].tolist(), keys.size]:
            bytes_here = int(lengths[end - 1] - (lengths[begun - 1] if begun else 0))
            if size + bytes_here >= SHARD:
                yield from shard(pa.concat_tables([*held, group.slice(begun, end - begun)]))
                held, size, begun = [], 0, end
        if begun < keys.size:
            held.append(group.slice(begun))
            size += int(lengths[-1] - (lengths[begun - 1] if begun else 0))
    if held:
        yield from shard(pa.concat_tables(held))


def covered_stretches(docs: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """``(doc_id, tie, start, stop)``: bytes covered by a window that also starts earlier; stretches may overlap."""
    cut = small_batches(docs).select("doc_id", "text").mapInArrow(_cut, _CHUNK_TYPE)
    dealt = cut.repartition("key").sortWithinPartitions(*_CHUNK)
    met = scratch.keep(dealt.mapInArrow(_met, _CHUNK_TYPE), "passage-chunks")
    first = F.shiftright("at", 8)
    windows = F.col("at").bitwiseAND(F.lit(255))
    plain = met.where("chunk IS NULL").select(
        "doc_id", "tie", first.alias("start"), (first + windows + (LENGTH - 1)).alias("stop")
    )
    wanted = met.where("chunk IS NOT NULL").groupBy(F.col("doc_id").alias("d"), F.col("tie").alias("t")).agg(
        F.collect_list("key").alias("keys"), F.collect_list("at").alias("ats")
    )
    looked_up = texts.select("doc_id", "tie", "packed").join(
        wanted.hint("shuffle_hash"), (F.col("doc_id") == F.col("d")) & (F.col("tie") == F.col("t"))
    )
    shards = (
        looked_up.select("doc_id", "tie", "packed", "keys", "ats")
        .mapInArrow(_with_text, "key long, doc_id long, tie long, at long, bytes binary")
        .repartition("key")
        .sortWithinPartitions("key", "doc_id", "tie", "at")
        .mapInArrow(_sorted_shards, _COVERED)
    )
    shards = scratch.keep(shards, "passage-shards")
    hot = shards.where("w1 IS NOT NULL")
    place = F.struct("doc_id", "tie", "start")
    first_hot = hot.groupBy("w1", "w2").agg(F.min(place).alias("first"))
    later = hot.join(first_hot, ["w1", "w2"]).where(place != F.col("first"))
    spans = ["doc_id", "tie", "start", "stop"]
    return plain.unionByName(shards.where("w1 IS NULL").select(*spans)).unionByName(later.select(*spans))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of what the spans cover."""
    runs: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if runs and start <= runs[-1][1]:
            if stop > runs[-1][1]:
                runs[-1] = (runs[-1][0], stop)
        else:
            runs.append((start, stop))
    return runs


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = []
        for doc_id, packed, starts, stops in zip(*(c.to_pylist() for c in batch.columns)):
            data = _unpacked(packed)
            runs = merged(list(zip(starts, stops))) if starts else []
            kept, at = hashlib.sha256(), 0
            for start, stop in runs:
                kept.update(data[at:start])
                at = stop
            kept.update(data[at:])
            doc_id = None if doc_id == _NO_ID else doc_id
            made.append((doc_id, len(data), sum(b - a for a, b in runs), len(runs), kept.hexdigest()))
        types = (*[pa.int64()] * 4, pa.string())
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), types)], names)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` of every row of ``docs``.

    A text is its UTF-8 bytes, a null one is empty.  Every byte is removed that lies in a string of ``LENGTH`` bytes
    which also starts earlier: in a document of smaller id, or earlier in the same one.  Overlapping strings count, and
    strings are judged on the input.  A text of fewer bytes loses nothing.

    Rows without id come before all others.  Rows that share an id are documents of their own, ordered by a hash of
    their text; rows that are equal in id and text are one document, reported as often as they come.  Other columns are
    ignored.  An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    texts = packed_texts(docs)
    spans = covered_stretches(docs, texts, scratch).groupBy(F.col("doc_id").alias("d"), F.col("tie").alias("t")).agg(
        F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops")
    )
    spans = scratch.keep(spans, "passage-spans")
    scratch.drop("passage-chunks", "passage-shards")
    found = texts.join(
        spans.hint("shuffle_hash"), (F.col("doc_id") == F.col("d")) & (F.col("tie") == F.col("t")), "left"
    )
    return found.select("doc_id", "packed", "starts", "stops").mapInArrow(_kept, _RESULT)
