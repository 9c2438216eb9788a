"""License scans by a positional rare-token index.

A template has a text and mandatory key phrases.  The index holds, for the rarest words of each template, by document
frequencies over the whole corpus, the places where they stand in it: as many that a text which has enough of the
template's words must have at least ``MEET`` of these.  A file looks up its words of highest IDF, those the index knows;
the postings are intersected by relative position, and where enough of a template's rare words meet, all its words are
compared and the key phrases verified.  A file costs what its rare words hit, however many templates there are.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlsheaf.llm.common import UPPER, small_batches, text_slices

#: Phrases whose every place is counted, and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Label, text and mandatory key phrases of the templates.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    (
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with"
        " the license you may obtain a copy of the license at",
        ("apache license", "except in compliance with the license"),
    ),
    (
        "gpl-3.0",
        "this work is licensed under the gnu general public license version 3",
        ("gnu general public license version 3",),
    ),
    (
        "gpl-2.0",
        "this work is licensed under the gnu general public license version 2",
        ("gnu general public license version 2",),
    ),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
        " public license as published by the free software foundation",
        ("free software", "gnu general public license"),
    ),
    (
        "lgpl",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser"
        " general public license as published by the free software foundation",
        ("gnu lesser general public license",),
    ),
    ("mit", "released under the mit license", ("mit license",)),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction",
        ("permission is hereby granted free of charge", "without restriction"),
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
        " granted",
        ("with or without fee is hereby granted",),
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that"
        " the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    (
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("mozilla public license",),
    ),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    (
        "cc-by",
        "this work is licensed under a creative commons attribution 4 0 international license",
        ("creative commons attribution",),
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("free and unencumbered software",),
    ),
)
#: Least share of a template's words that must stand at their relative places, and how many places one may be off.
LEAST_SHARE = 0.8
SLACK = 2
#: Rare words that must meet where a template may begin.
MEET = 2
#: Most bytes of template texts that are indexed.
TEMPLATE_BYTES = 16 << 20
_LOWER = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())
#: A-Z in lower case; what is neither letter nor digit, of ASCII, becomes a blank.
_WORDS = bytes(
    c if c >= 0x80 or chr(c).isdigit() or chr(c).isalpha() else 0x20 for c in (b[0] for b in (_LOWER[k : k + 1] for k in range(256)))
)


def words(text: str) -> list[bytes]:
    """Runs of letters and digits, any character beyond ASCII being a letter, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_WORDS).split(b" ")


@dataclass
class Template:
    label: str
    words: list[bytes]
    phrases: list[bytes]
    #: Words that may be missing, and rare words that must meet.
    missing: int
    meet: int


@dataclass
class Index:
    """``postings``: the templates, by number, and the places in them where a rare word stands."""

    templates: list[Template]
    postings: dict[bytes, list[tuple[int, int]]]

    @classmethod
    def of(cls, rows: list[tuple[str, str, tuple[str, ...]]], frequency: dict[bytes, int], total: int) -> Index:
        templates, postings = [], {}
        for label, text, phrases in rows:
            own = [w for w in words(text) if w]
            if not own:
                continue
            missing = int((1 - LEAST_SHARE) * len(own) + 1e-9)
            meet = min(MEET, len(own) - missing)
            rarity = [math.log((1 + total) / (1 + frequency.get(w, 0))) for w in own]
            rare = sorted(range(len(own)), key=lambda q: (-rarity[q], q))[: missing + meet]
            for q in rare:
                postings.setdefault(own[q], []).append((len(templates), q))
            joined = [b" ".join(w for w in words(p) if w) for p in phrases]
            templates.append(Template(label, own, joined, missing, meet))
        return cls(templates, postings)

    def starts(self, found: list[bytes]) -> dict[int, list[int]]:
        """Where templates may begin: places that put a rare word at its own, with enough others near theirs."""
        hits: dict[int, list[tuple[int, int]]] = {}
        for k, word in enumerate(found):
            for number, q in self.postings.get(word, ()):
                hits.setdefault(number, []).append((k - q, q))
        out = {}
        for number, own in hits.items():
            meet = self.templates[number].meet
            if len({q for _, q in own}) < meet:
                continue
            own.sort()
            # a window of places within the slack slides over the hits
            near: Counter[int] = Counter()
            first = last = 0
            good = []
            for start, _ in own:
                while last < len(own) and own[last][0] <= start + SLACK:
                    near[own[last][1]] += 1
                    last += 1
                while own[first][0] < start - SLACK:
                    near[own[first][1]] -= 1
                    if not near[own[first][1]]:
                        del near[own[first][1]]
                    first += 1
                if len(near) >= meet and (not good or good[-1] != start):
                    good.append(start)
            if good:
                out[number] = good
        return out


def document_frequencies(docs: DataFrame, known: frozenset[bytes]) -> tuple[dict[bytes, int], int]:
    """In how many documents each template word stands, over all documents, and how many there are.

    Tasks count first; the driver gets one row for each template word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for _, texts in text_slices(batches):
            for text in texts:
                counts[b""] += 1
                counts.update(known.intersection(words(text)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.decode() for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
        )

    rows = small_batches(docs).select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {r.word.encode(): r.n for r in rows}
    return found, found.pop(b"", 0)


def _share(found: list[bytes], start: int, template: Template) -> float:
    """The share of the template's words that stand near their places from ``start`` on, if that is enough and the key
    phrases stand there; else 0."""
    left = template.missing
    for q, word in enumerate(template.words):
        at = start + q
        if word not in found[max(0, at - SLACK) : max(0, at + SLACK + 1)]:
            left -= 1
            if left < 0:
                return 0.0
    n = len(template.words)
    region = b" " + b" ".join(found[max(0, start - SLACK) : start + n + SLACK]) + b" "
    if not all(b" " + p + b" " in region for p in template.phrases):
        return 0.0
    return (n - template.missing + left) / n


def scan(text: str, index: Index) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score of one text."""
    found = [w for w in words(text) if w]
    joined = b" " + b" ".join(found) + b" "
    n_base, first, last, base = 0, None, None, set()
    for phrase, label in BASE.items():
        sought = b" " + phrase.encode() + b" "
        at, word, counted = joined.find(sought), 0, 0
        while at >= 0:
            # blanks are counted from hit to hit
            word += joined.count(b" ", counted, at)
            counted = at
            n_base += 1
            base.add(label)
            first = word if first is None else min(first, word)
            last = word if last is None else max(last, word)
            at = joined.find(sought, at + 1)
    labels, score = set(base), 1.0 if base else 0.0
    for number, starts in index.starts(found).items():
        template = index.templates[number]
        share = 0.0
        for start in starts:
            share = max(share, _share(found, start, template))
            if share == 1.0:
                break
        if share:
            labels.add(template.label)
            score = max(score, share)
    return len(found), n_base, first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score


def scan_licences(docs: DataFrame, templates: tuple | DataFrame = TEMPLATES) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)`` of every row of ``docs``.

    Base labels are those of the base phrases that stand in a text; ``n_base`` counts all their places, first and last
    word are the smallest and largest start, null without one.  ``labels`` adds those of verified templates.  ``score``
    is 1 with a base phrase, else the best share of a verified template, else 0.

    ``templates`` are rows of label, text and key phrases, or a table ``(label, text, phrases)`` of at most
    ``TEMPLATE_BYTES``, as every task holds their index.  Templates without words are left out.  A null text counts as
    empty: no words, no labels (empty strings), score 0.  Rows are scanned one by one, so ids may be null or repeated;
    each counts as a document.  Very long texts cost in proportion.  Other columns are ignored.  No documents: no rows.
    """
    if isinstance(templates, DataFrame):
        size = templates.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
        if size > TEMPLATE_BYTES:
            raise ValueError(f"the templates have {size} bytes; at most {TEMPLATE_BYTES} can be indexed at a time")
        templates = [(r.label, r.text or "", tuple(r.phrases or ())) for r in templates.collect()]
    frequency, total = document_frequencies(docs, frozenset(w for _, text, _ in templates for w in words(text) if w))
    index = Index.of(list(templates), frequency, total)
    schema = pa.schema(
        [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64())]
        + [("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            columns = zip(*(scan(t, index) for t in texts))
            made = [pa.array(c, f.type) for c, f in zip(columns, schema)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *made], ["doc_id", *schema.names])

    return docs.select("doc_id", "text").mapInArrow(
        run,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string,"
        " score double",
    )
