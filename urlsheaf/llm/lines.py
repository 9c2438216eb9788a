"""Line dedup: levelled sorted runs of line hashes.  DataFrame functions only.

A run is a table of (line key's 128-bit hash, number of documents that hold it, largest such doc_id), ordered by hash.
A new batch of documents is aggregated to its own keys; those are anti-joined and joined with the runs, and become a
run of level 0: keys no run holds with the batch's own counts, known keys with totals that supersede the older entry.
Four runs of a level are compacted to one of the next, in which a newer entry displaces the older ones by an anti join.
So a batch meets a few runs only, and every hash is rewritten a logarithmic number of times.

Keys are pre-aggregated before they are shuffled: a line that a third of the documents hold is one row per task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urlsheaf.llm.common import Scratch, let, lower_ascii, whole

#: Runs of one level that are compacted into one of the next.
FAN_IN = 4
#: Batches that a whole table is dealt into.
BATCHES = 4
_HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """A line without blanks at its ends, A-Z in lower case."""
    return lower_ascii(F.btrim(line, F.lit(" \t\n\x0b\x0c\r")))


def line_rows(docs: DataFrame, min_chars: int, batches: int) -> DataFrame:
    """``(batch, doc_id, text_hash, line_no, h1, h2)`` of every line whose key has ``min_chars`` code points."""
    lines = docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.posexplode(F.split(whole("text"), "\n")).alias("line_no", "line"),
    ).where(F.length("line") >= min_chars)
    keyed = lines.withColumn("key", line_key(F.col("line"))).where(F.length("key") >= min_chars)
    return keyed.select(
        F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int").alias("batch"),
        "doc_id",
        "text_hash",
        "line_no",
        F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit(1), "key").alias("h2"),
    )


@dataclass
class Run:
    name: str
    level: int
    rows: DataFrame


class LineRuns:
    """What is known of line keys, batch by batch."""

    def __init__(self, spark: SparkSession, scratch: Scratch | None = None) -> None:
        self.scratch = scratch or Scratch(spark)
        self.runs: list[Run] = []
        self.made = 0

    def _write(self, rows: DataFrame, level: int) -> Run:
        self.made += 1
        name = f"line-run-{self.made}"
        ordered = rows.repartitionByRange(*_HASH).sortWithinPartitions(*_HASH)
        return Run(name, level, self.scratch.keep(ordered, name))

    @staticmethod
    def _merged(newest_first: list[Run]) -> DataFrame:
        """One row per key: the newest."""
        view = newest_first[0].rows
        for run in newest_first[1:]:
            view = view.unionByName(run.rows.join(view.select(*_HASH), _HASH, "left_anti"))
        return view

    def known(self) -> DataFrame | None:
        """``(h1, h2, n_docs, last_doc)`` of all keys so far."""
        return self._merged(self.runs[::-1]) if self.runs else None

    def add(self, lines: DataFrame) -> None:
        """Take in a batch ``(doc_id, h1, h2)``.  A document's lines must all be in one batch."""
        own = lines.select("doc_id", *_HASH).distinct().groupBy(*_HASH).agg(
            F.count("doc_id").alias("n_docs"), F.max("doc_id").alias("last_doc")
        )
        known = self.known()
        if known is not None:
            own = self.scratch.keep(own, "line-batch")
            fresh = own.join(known.select(*_HASH), _HASH, "left_anti")
            older = known.select(*_HASH, F.col("n_docs").alias("n_old"), F.col("last_doc").alias("last_old"))
            grown = own.join(older, _HASH).select(
                *_HASH,
                (F.col("n_docs") + F.col("n_old")).alias("n_docs"),
                F.greatest("last_doc", "last_old").alias("last_doc"),
            )
            self.runs.append(self._write(fresh.unionByName(grown), 0))
            self.scratch.drop("line-batch")
        else:
            self.runs.append(self._write(own, 0))
        self.compact()

    def compact(self) -> None:
        """Merge the newest runs of a level while there are ``FAN_IN`` of them."""
        while len(last := self.runs[-FAN_IN:]) == FAN_IN and len({run.level for run in last}) == 1:
            merged = self._write(self._merged(last[::-1]), last[0].level + 1)
            self.scratch.drop(*(run.name for run in last))
            self.runs[-FAN_IN:] = [merged]


def dedupe_lines(docs: DataFrame, min_docs: int = 5, min_chars: int = 40, batches: int = BATCHES) -> DataFrame:
    """``docs`` with the lines dropped that many documents hold; adds ``n_lines`` and ``n_dropped`` (both long).

    A text is split at ``\\n``; a null or empty one is one empty line.  A line's key is the line without blanks at its
    ends, A-Z in lower case.  A key of at least ``min_chars`` code points that at least ``min_docs`` documents hold
    loses all its lines but those in the document of the largest id.  The other lines stay, joined by ``\\n``; a text
    that loses all lines becomes empty, a null text becomes empty as well.

    Rows of the same doc_id are one document when documents are counted, and each of them is treated by the same
    rules.  A row without id is no document that counts, and loses every line that is dropped elsewhere.  Other columns
    are handed on, but for those named like the two added.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    lines = scratch.keep(line_rows(docs, min_chars, batches), "lines", by="batch")
    runs = LineRuns(spark, scratch)
    for batch in range(batches):
        runs.add(lines.where(F.col("batch") == batch))
    common = runs.known().where(F.col("n_docs") >= min_docs).select(*_HASH, "last_doc")
    drops = (
        lines.join(common, _HASH)
        .where(F.col("doc_id").isNull() | (F.col("doc_id") != F.col("last_doc")))
        .groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
        .agg(F.sort_array(F.collect_set("line_no")).alias("_drops"))
    )
    drops = scratch.keep(drops, "line-drops")
    scratch.drop("lines", *(run.name for run in runs.runs))
    # the side with the texts is streamed: neither sorted nor held
    at = docs["doc_id"].eqNullSafe(drops["_id"]) & (F.xxhash64(docs["text"]) == drops["_hash"])
    joined = docs.join(drops.hint("shuffle_hash"), at, "left")
    text, places = whole(docs["text"]), drops["_drops"]
    dropped = places.isNotNull()
    return joined.select(
        *(docs[f"`{c}`"] for c in docs.columns if c not in ("text", "n_lines", "n_dropped")),
        F.when(dropped, without_lines(text, places)).otherwise(text).alias("text"),
        F.size(F.split(text, "\n")).cast("long").alias("n_lines"),
        F.when(dropped, F.size(places)).otherwise(0).cast("long").alias("n_dropped"),
    )


def without_lines(text: Column, drops: Column) -> Column:
    """The text without its lines at the ascending places ``drops``: the stretches between them, joined."""

    def between(lines: Column, bounds: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(bounds) - 1),
            lambda i: F.slice(
                lines, F.element_at(bounds, i) + 2, F.element_at(bounds, i + 1) - F.element_at(bounds, i) - 1
            ),
        )

    stretches = let(
        F.split(text, "\n"),
        lambda lines: let(
            F.concat(F.array(F.lit(-1)), drops, F.array(F.size(lines))), lambda bounds: between(lines, bounds)
        ),
    )
    return F.array_join(F.flatten(stretches), "\n")


def line_report(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, kept_sha256)`` of every row."""
    out = dedupe_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


LINES_SQL = """
WITH cut AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS line_no
  FROM documents
), keyed AS (
  SELECT doc_id, line, line_no,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM cut
), common AS (
  SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT k.doc_id, k.line, k.line_no, c.key IS NOT NULL AND k.doc_id <> c.last_doc AS gone
  FROM keyed k LEFT JOIN common c USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
