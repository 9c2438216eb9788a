"""Best-fit packing in rounds: local best fit, nearly full bins out, underfull bins on as items.

Documents are tokenised and cut into pieces of at most ``CAPACITY`` tokens.  Every task packs its own pieces, largest
first, each into the fullest bin that has room.  Bins with at most ``SPARE`` free tokens are done.  The others go up a
tree as items: an eighth of the tasks packs them in the next round, and so on until a round runs in one task, or no
longer lowers their number, as when all are over half full.  Neither the pieces nor their bins ever meet in one task;
a task of a round has a stated number of items.
"""

from __future__ import annotations

import functools
import math
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlsheaf.llm.common import Scratch, small_batches, text_slices

CAPACITY = 4096
END = 1
#: Free tokens of a bin that is not packed any further.
SPARE = 8
#: Pieces of a task in the first round, and the most items of a task in any other.
TASK_ITEMS = 50_000
#: Tasks of a round per task of the next.
FAN_IN = 8
#: A round must lower the number of underfull bins by this share for another one to follow.
PROGRESS = 0.02
#: Words, and parts of words, that a generation of a worker's cache holds.  The one before it is kept as well, so words
#: that recur stay, and no text makes it forget them all.
CACHE = 200_000
#: Longest word, in characters, that is kept, so that the cache is bounded in bytes as well.
LONGEST = 64
#: Places of a generation's marks of words that came once, a byte each.
MARKS = 1 << 20
#: Characters of a text that are split into words at a time.
STRETCH = 1 << 20

_GAP = re.compile("[ \t\n\r\x0b\x0c]")
#: Latin letters but the dotted capital I, whose lower case is two characters; words of them and ASCII signs, without
#: the apostrophe, which begins tokens like ``'s``.
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f"
_RUNS = re.compile(f"[{_LATIN}]+|[^{_LATIN}]+")
_PLAIN = re.compile(f"[!-&(-~{_LATIN}]+")
#: How byte-level vocabularies spell bytes: printable ones as they are, the others as the characters from 256 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTES = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
#: Blank for Python, not for the tokenizer.
_ODD = ("\x1c", "\x1d", "\x1e", "\x1f")


class _Ids(dict):
    """Word or part of a word: its ids as little-endian 32-bit numbers.

    Most different words come once and never again: a word is kept from the second time on.  A mark may be another
    word's, so some are kept the first time.
    """

    def __init__(self, make: Callable[[str], bytes]) -> None:
        super().__init__()
        self.make = make
        self.before: dict[str, bytes] = {}
        self.once = bytearray(MARKS)

    def __missing__(self, word: str) -> bytes:
        made = self.before.get(word)
        if made is None:
            made, mark = self.make(word), hash(word) % MARKS
            if len(word) > LONGEST or not self.once[mark]:
                self.once[mark] = 1
                return made
        if len(self) >= CACHE:
            self.before = dict(self)
            self.clear()
            self.once = bytearray(MARKS)
        self[word] = made
        return made


class Encoder:
    """Token ids of whole texts.

    The tokenizer never looks beyond white space, so a text's ids are those of its words one after the other, and words
    recur.  A word of Latin letters and ASCII signs is put together from its runs of either, as the tokenizer does.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # names of added tokens are those tokens, wherever they stand
        self.marks = {t.content: k for k, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.mark = re.compile("|".join(map(re.escape, sorted(self.marks, key=len, reverse=True)))) if self.marks else None
        self.parts = _Ids(self._part)
        self.words = _Ids(self._word)

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _part(self, part: str) -> bytes:
        if not part.isalpha():
            return self._encode(part)
        # a run of letters is one word of the model, in its spelling of bytes
        spelled = part if part.isascii() else part.encode().decode("latin-1").translate(_BYTES)
        ids = [t.id for t in self.model.tokenize(spelled)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str) -> bytes:
        if word.isascii():
            if word.isalpha():  # both caches hold one string where they can
                return self.parts[word if word.islower() else word.lower()]
            if word[:-1].isalpha():  # a letter or sign that ends it is a part of its own
                return self.parts[word[:-1].lower()] + self.parts[word[-1]]
        if not _PLAIN.fullmatch(word):
            return self._encode(word)
        return b"".join([self.parts[p.lower()] for p in _RUNS.findall(word)])

    def ids(self, text: str) -> bytes:
        """Ids of the text and the end of the document."""
        made, at = [], 0
        if self.mark is not None:
            for found in self.mark.finditer(text):
                self._add(text[at : found.start()], made)
                made.append(self.marks[found[0]].to_bytes(4, "little"))
                at = found.end()
        self._add(text[at:] if at else text, made)
        made.append(END.to_bytes(4, "little"))
        return b"".join(made)

    def _add(self, text: str, made: list[bytes]) -> None:
        """The ids of a text without added tokens, word by word."""
        at = 0
        while at < len(text):
            end = at + STRETCH
            if end < len(text):
                gap = _GAP.search(text, end)
                end = gap.start() if gap else len(text)
            part = text[at:end]
            found = _GAP.split(part) if any(c in part for c in _ODD) else part.split()
            made += map(self.words.__getitem__, found)
            at = end


@functools.cache
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``: whole documents, longer ones cut every ``capacity`` tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary)
        for part, texts in text_slices(batches):
            rows = []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), texts):
                ids = encoder.ids(text)
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    rows.append((doc_id, piece, at // 4, len(own) // 4, zlib.crc32(own)))
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), *[pa.int64()] * 3))],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return small_batches(docs).select("doc_id", "text").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, largest items first, each into the bin with the least room that is enough; and the
    bins' fill.  Bits of one number tell which rooms there are."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    fill: list[int] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            stack = by_room[room]
            own = stack.pop()
            if not stack:
                rooms ^= 1 << room
        else:
            own, room = len(fill), capacity
            fill.append(0)
        bins[i], offsets[i] = own, fill[own]
        fill[own] += length
        left = room - length
        if left:
            stack = by_room.setdefault(left, [])
            if not stack:
                rooms |= 1 << left
            stack.append(own)
    return bins, offsets, np.array(fill, np.int64)


def _packer(round_no: int, capacity: int):
    """For mapInArrow over (item..., length): the same rows with bin, offset and the bin's fill."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held = [b for b in batches if b.num_rows]
        if not held:
            return
        items = pa.Table.from_batches(held)
        bins, offsets, fill = best_fit(items.column("length").to_numpy(), capacity)
        base = (round_no << 56) + (TaskContext.get().partitionId() << 28)
        made = items.append_column("bin", pa.array(bins + base)).append_column("offset", pa.array(offsets))
        yield from made.append_column("fill", pa.array(fill[bins])).to_batches()

    return run


def _round(items: DataFrame, key: str, tasks: int, round_no: int, capacity: int) -> DataFrame:
    dealt = items.repartition(tasks, F.pmod(F.xxhash64(key), F.lit(tasks))).sortWithinPartitions(key)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)
    return dealt.mapInArrow(_packer(round_no, capacity), f"{columns}, bin long, offset long, fill long")


def pack(
    found: DataFrame, scratch: Scratch, capacity: int = CAPACITY, spare: int = SPARE, task_items: int = TASK_ITEMS
) -> DataFrame:
    """``found`` (any columns, a unique long ``item``, a ``length`` from 1 to ``capacity``) with ``sequence_id`` and
    ``offset``.  Items of a sequence lie without gap from 0 and have at most ``capacity`` together."""
    total = found.count()
    tasks = max(1, math.ceil(total / task_items))
    own = scratch.keep(_round(found.select("item", "length"), "item", tasks, 0, capacity), "pack-0")
    name, last, placed = "pack-0", own, None
    count, round_no = None, 0
    while tasks > 1:
        open_bins = last.where(F.col("fill") <= capacity - spare).select(
            F.col("bin").alias("item"), F.col("fill").alias("length")
        ).distinct()
        left = open_bins.count()
        if not left or (count is not None and left > (1 - PROGRESS) * count):
            break
        count, round_no = left, round_no + 1
        tasks = max(math.ceil(tasks / FAN_IN), math.ceil(left / task_items))
        last = scratch.keep(_round(open_bins, "item", tasks, round_no, capacity), f"pack-{round_no}")
        step = last.select(F.col("item").alias("from"), F.col("bin").alias("to"), F.col("offset").alias("by"))
        if placed is None:
            placed = step
        else:
            on = step.select(F.col("from").alias("to"), F.col("to").alias("next"), F.col("by").alias("more"))
            placed = placed.join(on, "to", "left").select(
                "from", F.coalesce("next", "to").alias("to"), (F.col("by") + F.coalesce("more", F.lit(0))).alias("by")
            )
        placed = scratch.keep(placed, f"pack-placed-{round_no}")
        if round_no > 1:
            scratch.drop(name, f"pack-placed-{round_no - 1}")
        name = f"pack-{round_no}"
    if placed is not None:
        merged = own.join(placed, own.bin == placed["from"], "left")
        own = merged.select(
            "item",
            F.coalesce("to", "bin").alias("sequence_id"),
            (F.col("offset") + F.coalesce("by", F.lit(0))).alias("offset"),
        )
    else:
        own = own.select("item", F.col("bin").alias("sequence_id"), "offset")
    return found.join(own, "item")


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` of every piece of every row of ``docs``.

    A null text counts as empty: one piece, the end id.  A row without id is packed like others.  Repeated rows are
    packed as often as they come.  Very long texts are split into words by stretches.  Other columns are ignored.  No
    documents: no rows.
    """
    scratch = Scratch(docs.sparkSession)
    made = pieces(docs, vocabulary, capacity).withColumn("item", F.monotonically_increasing_id())
    found = scratch.keep(made, "pack-pieces")
    return pack(found, scratch, capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
