"""Ranked lexical search by hashed max-sketches.

1. *Sketches.*  A text's terms fall into ``COORDINATES`` by hash; a coordinate keeps the largest count of its terms.  A
   term's impact grows with its count, so the impact of the largest count bounds that of every term there.  Sketches are
   written once and know nothing of the queries.
2. *Bounds.*  Queries come in blocks.  A block's weights, summed by coordinate, times the impacts of a batch of sketches
   is one product of matrices: an upper bound of every score.  All numbers are whole and below 2^53, so they are exact.
3. *Rescoring.*  The documents of highest bound are scored exactly, which gives a threshold: the last score that still
   ranks.  Only documents whose bound reaches it are candidates.  They are scored by descending bound, a level at a time;
   every level raises the threshold, and it ends when no bound that is left reaches it.

Equal texts are scored once, and of each such group the smallest ids stay that can rank, so groups of copies cost what
they hold.  Counts of terms and documents are of the whole table.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urlsheaf.llm.common import SLICE, Scratch, small_batches, whole

TOP = 20
COORDINATES = 1 << 16
#: Queries of a block, and bytes of their texts; blocks are dealt by hash, so these are means.
BLOCK_ITEMS = 250
BLOCK_BYTES = 1 << 20
#: Sketches that are multiplied at a time.
ROWS = 256
#: Levels of bounds that are rescored one after the other.
LEVELS = 4
#: Most texts whose hashes are handed to all tasks (16 bytes each); beyond it they are joined by shuffling.
BROADCAST_TEXTS = 500_000

#: Bytes to terms: A-Z in lower case, other ASCII signs blank, the rest as it is.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_HASH = ["h1", "h2"]


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TERMS).split()


def _hashes(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


def _raw_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            yield part, part.column("text").cast(pa.binary()).to_pylist()


def sketches(docs: DataFrame, coordinates: int = COORDINATES) -> DataFrame:
    """``(doc_id, h1, h2, n, places, most)``: number of terms, coordinates that hold any, and their largest counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _raw_texts(batches):
            n, sizes, places, counts = [], [], [], []
            for text in texts:
                own = Counter(terms(text))
                n.append(own.total())
                sizes.append(len(own))
                places += map(zlib.crc32, own)
                counts += own.values()
            row = np.repeat(np.arange(len(texts)), sizes)
            key = row * coordinates + np.array(places, np.int64) % coordinates
            order = np.lexsort((np.array(counts, np.int64), key))
            key = key[order]
            last = np.flatnonzero(np.append(key[1:] != key[:-1], np.ones(min(1, key.size), bool)))
            ends = pa.array(np.searchsorted(key[last], np.arange(len(texts) + 1) * coordinates), pa.int32())
            lists = [
                pa.ListArray.from_arrays(ends, pa.array(values, pa.int32()))
                for values in (key[last] % coordinates, np.array(counts, np.int64)[order][last])
            ]
            columns = [*(part.column(c) for c in ("doc_id", *_HASH)), pa.array(n, pa.int64()), *lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *_HASH, "n", "places", "most"])

    return docs.mapInArrow(run, "doc_id long, h1 long, h2 long, n long, places array<int>, most array<int>")


@dataclass
class Block:
    """Queries (count of each term by its number in ``vocabulary``), and weights once documents are counted."""

    vocabulary: dict[bytes, int]
    queries: list[dict[int, int]]
    weights: list[int] | None = None

    @classmethod
    def of(cls, texts: list[bytes]) -> Block:
        vocabulary: dict[bytes, int] = {}
        queries = [
            {vocabulary.setdefault(t, len(vocabulary)): c for t, c in Counter(terms(text)).items()} for text in texts
        ]
        return cls(vocabulary, queries)

    def table(self, coordinates: int) -> tuple[np.ndarray, np.ndarray]:
        """Column of each coordinate (-1: no query asks for it), and weights by column and query."""
        own = {k: zlib.crc32(t) % coordinates for t, k in self.vocabulary.items()}
        used = sorted({*own.values()})
        at = np.full(coordinates, -1)
        at[used] = np.arange(len(used))
        out = np.zeros((len(used), len(self.queries)))
        for q, query in enumerate(self.queries):
            for k, count in query.items():
                out[at[own[k]], q] += count * self.weights[k]
        return at, out


def document_counts(docs: DataFrame, block: Block) -> DataFrame:
    """``(term, n)``: number of documents that hold a term of the block."""
    vocabulary = block.vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[int] = Counter()
        for _, texts in _raw_texts(batches):
            for text in texts:
                counts.update(vocabulary[t] for t in vocabulary.keys() & set(terms(text)))
        columns = [pa.array(list(c), pa.int64()) for c in (counts.keys(), counts.values())]
        yield pa.RecordBatch.from_arrays(columns, ["term", "n"])

    return docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


def _base(n: np.ndarray | int, total: int, length: int):
    return 75 + (25 * n * total) // max(1, length)


def _bounds(block: Block, total: int, length: int, least: np.ndarray | None, top: int, coordinates: int):
    """For mapInArrow over sketches: rows whose bound reaches ``least``; without it a task's ``top`` rows of each query."""
    at, weights = block.table(coordinates)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                places, most = part.column("places"), part.column("most")
                row = np.repeat(np.arange(part.num_rows), np.diff(places.offsets.to_numpy()))
                column = at[places.flatten().to_numpy()]
                use = column >= 0
                row, column = row[use], column[use]
                count = most.flatten().to_numpy().astype(np.int64)[use]
                base = _base(part.column("n").to_numpy(), total, length)[row]
                impacts = np.zeros((part.num_rows, len(weights)))
                impacts[row, column] = (1_000_000_000 * count) // (1000 * count + 12 * base)
                yield part, impacts @ weights

    names = ["q", "doc_id", *_HASH, "bound"]

    def rows(part, row, q, bound):
        own = [part.column(c).take(pa.array(row)) for c in ("doc_id", *_HASH)]
        return pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), *own, pa.array(bound.astype(np.int64))], names)

    def reaching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, bounds in products(batches):
            row, q = np.nonzero((bounds >= least) & (bounds > 0))
            yield rows(part, row, q, bounds[row, q])

    def highest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for part, bounds in products(batches):
            keep = min(top, part.num_rows)
            row = np.argpartition(-bounds, keep - 1, axis=0)[:keep]
            q = np.broadcast_to(np.arange(bounds.shape[1]), row.shape)
            new = rows(part, row.ravel(), q.ravel(), bounds[row, q].ravel())
            both = pa.Table.from_batches([new]) if held is None else pa.concat_tables([held, pa.Table.from_batches([new])])
            by, bound = both.column("q").to_numpy(), both.column("bound").to_numpy()
            order = np.lexsort((-bound, by))
            first = np.searchsorted(by[order], np.arange(bounds.shape[1]))
            place = np.arange(order.size) - first[by[order]]
            held = both.take(pa.array(order[(place < top) & (bound[order] > 0)]))
        if held is not None:
            yield from held.combine_chunks().to_batches()

    return highest if least is None else reaching


def _exact(block: Block, total: int, length: int):
    """For mapInArrow over texts with the queries asked of them: exact scores."""
    vocabulary, queries, weights = block.vocabulary, block.queries, block.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _raw_texts(batches):
            out = []
            for h1, h2, text, asked in zip(*(part.column(c).to_pylist() for c in _HASH), texts, part.column("qs").to_pylist()):
                words = terms(text)
                base = 12 * _base(len(words), total, length)
                impact = {
                    vocabulary[t]: (1_000_000_000 * c) // (1000 * c + base) for t, c in Counter(words).items() if t in vocabulary
                }
                for q in asked:
                    score = sum(c * weights[k] * impact[k] for k, c in queries[q].items() if k in impact)
                    out.append((q, h1, h2, score))
            columns = list(zip(*out)) or [()] * 4
            types = (pa.int32(), *[pa.int64()] * 3)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["q", *_HASH, "score"])

    return run


def _asked(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Different texts among ``docs (h1, h2, text)`` that ``pairs (q, h1, h2)`` ask for, with the list of queries."""
    wanted = pairs.groupBy(*_HASH).agg(F.sort_array(F.collect_set("q")).alias("qs"))
    hashes = pairs.select(*_HASH).distinct()
    few = hashes.count() <= BROADCAST_TEXTS
    found = docs.join(F.broadcast(hashes) if few else hashes, _HASH, "left_semi").dropDuplicates(_HASH)
    return found.join(wanted, _HASH)


def _thresholds(scores: DataFrame, rows: DataFrame, top: int, n: int) -> np.ndarray:
    """The ``top``-th best score of each query so far (1 where fewer documents are known)."""
    ranked = _ranked(scores, rows, top).where(F.col("rank") == top)
    out = np.ones(n, np.int64)
    for r in ranked.select("q", "score").collect():  # a row per query of a block
        out[r.q] = r.score
    return out


def _between(pairs: DataFrame, lower: np.ndarray, upper: np.ndarray) -> DataFrame:
    """The pairs whose bound lies below their query's ``upper`` and not below its ``lower``."""
    limits = [(q, int(a), int(b)) for q, (a, b) in enumerate(zip(lower, upper))]  # a row per query of a block
    limits = pairs.sparkSession.createDataFrame(limits, "q int, a long, b long")
    return pairs.join(F.broadcast(limits), "q").where("bound >= a AND bound < b")


def _ranked(scores: DataFrame, rows: DataFrame, top: int) -> DataFrame:
    """``(q, rank, doc_id, score)`` of the ``top`` best of ``rows (q, doc_id, h1, h2)``, of a text the smallest ids."""
    scored = rows.join(scores.where("score > 0"), ["q", *_HASH])
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    # in two steps, so that no task ranks all candidates of a query
    part = F.pmod(F.xxhash64("doc_id", *_HASH), F.lit(64))
    early = scored.withColumn("part", part).withColumn("place", F.row_number().over(Window.partitionBy("q", "part").orderBy(*order)))
    late = early.where(F.col("place") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(*order)))
    return late.where(F.col("rank") <= top).select("q", "rank", "doc_id", "score")


def _search_block(
    docs: DataFrame, index: DataFrame, block: Block, top: int, coordinates: int, scratch: Scratch, name: str
) -> DataFrame:
    """``(q, rank, doc_id, score)`` of a block of queries."""
    stats = index.where("n > 0").agg(F.count("*").alias("total"), F.sum("n").alias("length")).first()
    total, length = stats.total, stats.length or 0
    counted = {r.term: r.n for r in document_counts(docs, block).collect()}  # a row per term of the block
    block.weights = [
        math.floor(1000 * math.log((2 * total + 2) / (2 * counted.get(k, 0) + 1))) for k in range(len(block.vocabulary))
    ]
    schema = "q int, doc_id long, h1 long, h2 long, bound long"
    # documents of highest bound
    seeds = index.mapInArrow(_bounds(block, total, length, None, top, coordinates), schema)
    by_bound = [F.col("bound").desc(), F.col("doc_id").asc_nulls_last()]
    seeds = seeds.withColumn("place", F.row_number().over(Window.partitionBy("q").orderBy(*by_bound)))
    seeds = scratch.keep(seeds.where(F.col("place") <= top).drop("place"), f"{name}-seeds")
    exact = _exact(block, total, length)
    score_schema = "q int, h1 long, h2 long, score long"
    scores = scratch.keep(_asked(docs, seeds).mapInArrow(exact, score_schema), f"{name}-scores-0")
    least = _thresholds(scores, seeds, top, len(block.queries))
    # all that may rank; of equal texts the smallest ids
    reaching = index.mapInArrow(_bounds(block, total, length, least, top, coordinates), schema)
    copies = Window.partitionBy("q", *_HASH).orderBy(F.col("doc_id").asc_nulls_last())
    reaching = reaching.withColumn("place", F.row_number().over(copies)).where(F.col("place") <= top).drop("place")
    rows = scratch.keep(reaching, f"{name}-candidates")
    open_pairs = rows.select("q", *_HASH, "bound").distinct().join(scores.select("q", *_HASH), ["q", *_HASH], "left_anti")
    pairs = scratch.keep(open_pairs, f"{name}-pairs")
    texts = scratch.keep(_asked(docs, pairs).drop("qs"), f"{name}-texts")
    # levels of descending bounds, halfway to the threshold each, the last one to it
    highest = {r.q: r.bound for r in pairs.groupBy("q").agg(F.max("bound").alias("bound")).collect()}
    upper = np.array([highest.get(q, 0) + 1 for q in range(len(block.queries))], np.int64)
    level = 0
    while True:
        level += 1
        lower = least if level >= LEVELS else np.maximum(least, least + (upper - least) // 2)
        now = _between(pairs, lower, upper).select("q", *_HASH)
        made = scratch.keep(_asked(texts, now).mapInArrow(exact, score_schema), f"{name}-scores-{level}")
        scores = scores.unionByName(made)
        if level >= LEVELS:
            break
        least, upper = np.maximum(least, _thresholds(scores, rows, top, len(block.queries))), lower
        if _between(pairs, least, upper).isEmpty():
            break
    return scratch.keep(_ranked(scores, rows, top), f"{name}-found")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, coordinates: int = COORDINATES) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: for each row of ``items (item_id, text)`` its ``top`` best rows of ``docs
    (doc_id, text)`` with a score above 0, equal scores by ascending doc_id.

    A term is a longest stretch of ASCII letters, digits and characters beyond ASCII, A-Z in lower case.  Null and empty
    texts have no terms: such an item finds nothing, such a document is not found and does not count.  Repeated documents
    are documents of their own, repeated items are answered as often as they come, an item without id is answered under
    null; documents without id come after others of equal score.  Other columns are ignored.  Empty tables: no rows.
    """
    scratch = Scratch(docs.sparkSession)
    text = whole("text").cast("string")
    asked = items.select(F.col("item_id"), text.alias("text")).select("item_id", "text", *_hashes(F.col("text")))
    asked = scratch.keep(asked.where("text != ''"), "search-items")
    own = asked.dropDuplicates(_HASH)
    size = own.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    blocks = max(1, math.ceil(size.n / BLOCK_ITEMS), math.ceil((size.bytes or 0) / BLOCK_BYTES))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = small_batches(rows).select("doc_id", "text", *_hashes(F.col("text")))
    index = scratch.keep(sketches(rows, coordinates), "search-sketches")
    found = None
    for k in range(blocks):
        part = own.where(F.pmod(F.col("h1"), F.lit(blocks)) == k).select(*_HASH, "text").collect()  # bounded, see above
        part.sort(key=lambda r: (r.h1, r.h2))
        block = Block.of([r.text.encode() for r in part])
        if not block.vocabulary:
            continue
        answers = _search_block(rows, index, block, top, coordinates, scratch, f"search-{k}")
        names = docs.sparkSession.createDataFrame([(q, r.h1, r.h2) for q, r in enumerate(part)], "q int, h1 long, h2 long")
        answers = answers.join(F.broadcast(names), "q").drop("q")
        found = answers if found is None else found.unionByName(answers)
    if found is None:
        zero = F.lit(0).cast("long")
        return asked.select("item_id", F.lit(0).alias("rank"), zero.alias("doc_id"), zero.alias("score")).where(F.lit(False))
    return asked.select("item_id", *_HASH).join(found, _HASH).select("item_id", "rank", "doc_id", "score")


SEARCH_SQL = r"""
WITH tokens AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), tf AS (SELECT doc_id, term, count(*) AS tf FROM tokens GROUP BY ALL),
sizes AS (SELECT doc_id, count(*) AS n FROM tokens GROUP BY doc_id),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM sizes),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, total
), base AS (SELECT doc_id, 100 - 25 + (25 * n * docs) // words AS m FROM sizes, total),
scored AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN base USING (doc_id) GROUP BY ALL
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
