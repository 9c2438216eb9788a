"""Benchmark decontamination by SimHash over item-sized windows.  DataFrame functions only.

A window is as many consecutive words of a document as an item has.  Its weight vector counts each of its five-word
shingles; similarity is the weighted Jaccard index, the sum of smaller counts over the sum of larger ones.  A similar
window shares most of its shingles with the item, in whatever order, so windows are only cut where enough of an item's
shingles stand: every window that holds as many places of them as the similarity asks for.  They are fingerprinted over the counted shingles and looked up
by blocks: of ``RADIUS + 1`` blocks at least one is equal if at most ``RADIUS`` bits differ, so the index guarantees
all fingerprints within the radius.  What it finds is verified by the exact similarity.

A similarity of 0.8 is an angle at which 10 of 64 bits differ on average, 3 being the standard deviation; a radius of
20 loses about one borderline window in three thousand, and none that is nearly verbatim.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlsheaf.llm.common import Scratch, let, lower_ascii, whole

WIDTH = 5
SIMILARITY = 0.8
RADIUS = 20
BITS = 64
#: Most different item shingles that are broadcast (8 bytes each); beyond it the lookup shuffles.
BROADCAST_SHINGLES = 500_000
#: What stands between words.
GAPS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words(text: str | Column) -> Column:
    """Runs of letters and digits in lower case, any character beyond ASCII being a letter."""
    return F.filter(F.split(lower_ascii(whole(text)), GAPS), lambda w: w != "")


def shingles(text: str | Column, width: int = WIDTH) -> Column:
    """64-bit hashes of ``width`` consecutive words of a text; none if there are fewer words."""

    def made(hashed: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(hashed) - width + 1)
        return F.when(
            F.size(hashed) >= width,
            F.transform(places, lambda i: F.xxhash64(*(F.element_at(hashed, i + k) for k in range(width)))),
        ).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(words(text), lambda w: F.xxhash64(w)), made)


def numbered(found: Column) -> Column:
    """Hashes that differ for the first, second, ... occurrence of a shingle: as a set they count what a list counts."""
    again = F.transform(
        found, lambda x, i: F.xxhash64(x, F.size(F.filter(F.slice(found, 1, i), lambda y: y == x)))
    )
    plain = F.transform(found, lambda x: F.xxhash64(x, F.lit(0)))
    return F.when(F.size(F.array_distinct(found)) == F.size(found), plain).otherwise(again)


def simhash(found: Column) -> Column:
    """Bit b is set if it is set in over half the hashes, repeats included.  ``found`` must be a plain column."""

    def bit(b: int) -> Column:
        ones = F.aggregate(found, F.lit(0), lambda n, h: n + F.getbit(h, F.lit(b)).cast("int"))
        return F.when(ones * 2 > F.size(found), F.shiftleft(F.lit(1).cast("bigint"), b)).otherwise(
            F.lit(0).cast("bigint")
        )

    return functools.reduce(Column.bitwiseOR, map(bit, range(BITS)))


def blocks(fp: Column, radius: int = RADIUS) -> Column:
    """``radius + 1`` (block, its bits) pairs as one number each."""
    edges = [BITS * k // (radius + 1) for k in range(radius + 2)]
    made = [
        F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << (high - low)) - 1)) + F.lit(k << 32)
        for k, (low, high) in enumerate(zip(edges, edges[1:]))
    ]
    return F.array(*made)


def similarity(numbered_a: Column, numbered_b: Column) -> Column:
    shared = F.size(F.array_intersect(numbered_a, numbered_b))
    return shared / (F.size(numbered_a) + F.size(numbered_b) - shared)


def find_leaks(
    docs: DataFrame, items: DataFrame, least: float = SIMILARITY, radius: int = RADIUS, width: int = WIDTH
) -> DataFrame:
    """``(doc_id, item_id, start_word, n_words, similarity, n_bits)``: the best window of every leaked item.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are ignored.  Texts that are null or have
    fewer than ``width`` words hold and match nothing.  A document that is shorter than an item is one window.  Of
    equally similar windows the first is returned.  Repeated rows of a document, or of an item, count once; rows
    without doc_id are one document.  Items without id match like others, as one item.  No items or no documents: no
    rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    share = least / (1 + least)  # of the shingles of item and window together that must be shared
    item = scratch.keep(items.select("item_id", shingles("text", width).alias("shingles")), "leak-items")
    item = item.where(F.size("shingles") > 0).select(
        F.xxhash64("item_id", "shingles").alias("item_key"),
        "item_id",
        "shingles",
        (F.size("shingles") + width - 1).alias("n_words"),
        F.size("shingles").alias("n"),
        simhash(F.col("shingles")).alias("item_fp"),
    )
    item = scratch.keep(item.dropDuplicates(["item_key"]), "leak-index")
    posting = item.select("item_key", "n", "n_words", F.posexplode("shingles").alias("item_at", "shingle"))
    wanted = scratch.keep(posting.select("shingle").distinct(), "leak-shingles")
    if wanted.count() <= BROADCAST_SHINGLES:
        wanted = F.broadcast(wanted)

    text_hash = F.xxhash64("text").alias("text_hash")
    # an outer explode: the optimiser would test the list for being empty, and make it twice
    hits = (
        docs.select("doc_id", text_hash, shingles("text", width).alias("s"))
        .select("doc_id", "text_hash", F.size("s").alias("n_doc"), F.posexplode_outer("s").alias("at", "shingle"))
        .join(wanted, "shingle")
    )
    hits = scratch.keep(hits.distinct(), "leak-hits")
    doc = ["doc_id", "text_hash"]
    pairs = hits.join(posting, "shingle").select(*doc, "n_doc", "at", "item_at", "item_key", "n")
    enough = F.ceil((F.col("n") + F.least("n", "n_doc")) * F.lit(share) - F.lit(1e-9)).cast("int")
    pairs = scratch.keep(pairs, "leak-pairs")
    rich = (
        pairs.groupBy(*doc, "n_doc", "item_key", "n")
        .agg(F.array_sort(F.collect_set("at")).alias("p"))
        .select("*", enough.alias("enough"), F.least("n", "n_doc").alias("size"))
        .where(F.size("p") >= F.col("enough"))
    )

    def from_place(i: Column) -> Column:
        """Starts of windows whose first shared shingle is the i-th and that hold enough."""
        before = F.when(i > 1, F.element_at("p", F.greatest(i - 1, F.lit(1))) + 1).otherwise(0)
        low = F.greatest(F.element_at("p", i + F.col("enough") - 1) - F.col("size") + 1, before)
        high = F.least(F.element_at("p", i), F.col("n_doc") - F.col("size"))
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    first = F.sequence(F.lit(1), F.size("p") - F.col("enough") + 1)
    starts = rich.select(*doc, "item_key", "n", F.explode(F.flatten(F.transform(first, from_place))).alias("start"))
    cuts = starts.groupBy(F.col("doc_id").alias("d"), F.col("text_hash").alias("t")).agg(
        F.collect_list(F.struct("item_key", "n", "start")).alias("cuts")
    )
    cuts = scratch.keep(cuts, "leak-cuts")
    scratch.drop("leak-hits", "leak-pairs", "leak-shingles")

    # texts of documents without a candidate end at the join, the others are shingled again
    at = F.col("doc_id").eqNullSafe(F.col("d")) & (F.xxhash64("text") == F.col("t"))
    cut = docs.select("doc_id", "text").join(cuts.hint("shuffle_hash"), at)
    window = (
        cut.select("doc_id", shingles("text", width).alias("s"), "cuts")
        .select("doc_id", "s", F.explode("cuts").alias("c"))
        .select(
            "doc_id",
            "c.item_key",
            F.col("c.start").alias("start_word"),
            F.slice("s", F.col("c.start") + 1, F.col("c.n")).alias("window"),
        )
        .withColumn("fp", simhash(F.col("window")))
    )
    window = scratch.keep(window, "leak-windows")
    keyed = window.select("doc_id", "item_key", "start_word", "window", "fp", F.explode(blocks(F.col("fp"), radius)).alias("block"))
    index = item.select("item_key", "item_id", "n_words", "shingles", "item_fp", F.explode(blocks(F.col("item_fp"), radius)).alias("block"))
    n_bits = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    found = (
        keyed.join(index, ["item_key", "block"])
        .where(n_bits <= radius)
        .dropDuplicates(["doc_id", "item_key", "start_word", "fp"])
        .withColumn("_a", numbered(F.col("window")))
        .withColumn("_b", numbered(F.col("shingles")))
        .withColumn("similarity", similarity(F.col("_a"), F.col("_b")))
        .where(F.col("similarity") >= least)
    )
    best = F.struct(-F.col("similarity"), F.col("start_word"), n_bits.alias("n_bits"))
    return (
        found.groupBy("doc_id", "item_id", "n_words")
        .agg(F.min(best).alias("best"))
        .groupBy("doc_id", "item_id")
        .agg(F.min(F.struct("best", "n_words")).alias("b"))
        .select(
            "doc_id",
            "item_id",
            F.col("b.best.start_word").cast("long").alias("start_word"),
            F.col("b.n_words").cast("long").alias("n_words"),
            (-F.col("b.best.col1")).alias("similarity"),
            F.col("b.best.n_bits").cast("long").alias("n_bits"),
        )
    )


def without_leaks(docs: DataFrame, items: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, all columns, whose document holds no item.  Rows without doc_id are one document."""
    leaks = find_leaks(docs, items, least).select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(leaks, docs["doc_id"].eqNullSafe(leaks["_id"]), "left_anti")
