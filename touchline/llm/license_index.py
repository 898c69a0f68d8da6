"""License scans with a positional rare-token index.

Licence phrases are templates of words. Document frequencies of their words
over all documents give IDF weights; every template is indexed under its
``ANCHORS`` rarest distinct words of each mandatory key phrase: word ->
(template, position). A file's words are looked up in that index; each hit
proposes a start (file position minus template position), and only starts that
all anchors of a key phrase agree on are kept (postings intersected by relative
position). There the mandatory key phrases are verified word by word. Every
place of a key phrase contains all its anchors, so no place is missed.

The score of a place is the IDF-weighted share of the template's words found at
their relative positions; a file's score is its best place's (0 without one).

Defined results: null text is empty; texts without words or licences have zero
counts, null places, empty labels and score 0; rows are never dropped or
merged; an empty table gives no rows (and equal IDF weights). Only the id and
text columns are read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import map_batches, text_bytes

ANCHORS = 2

# A-Z in lower case, bytes that no word holds to spaces
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    keys: tuple[str, ...]  # mandatory phrases, parts of ``text``
    base: bool = False


# The base phrases and labels of the task.
BASE = (
    Template("mit", "mit license", ("mit license",), True),
    Template("apache", "apache license", ("apache license",), True),
    Template("gpl", "general public license", ("general public license",), True),
)
#: Public licence notices.
MORE = (
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted free of charge",)),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license version 2 0",)),
    Template("gpl-2.0", "This work is licensed under the GNU General Public License, version 2", ("gnu general public license version 2",)),
    Template("gpl-3.0", "This work is licensed under the GNU General Public License, version 3", ("gnu general public license version 3",)),
    Template("lgpl", "licensed under the GNU Lesser General Public License", ("gnu lesser general public license",)),
    Template("mpl-2.0", "subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license v 2 0",)),
    Template("cc-by-4.0", "Licensed under CC BY 4.0", ("cc by 4 0",)),
    Template("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", ("cc by sa 4 0",)),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ("cc by nc 4 0",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted", ("redistribution and use in source and binary forms",)),
)
TEMPLATES = BASE + MORE


def word_counts(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, text: str = "text") -> tuple[int, dict[bytes, int]]:
    """Number of documents, and of those holding each template word. Only these
    sums (one for each template word) reach the driver."""
    vocabulary = sorted({w for t in templates for w in words_of(t.text.encode())})
    wanted = frozenset(vocabulary)

    def run(batch: pa.RecordBatch):
        counts: dict[bytes, int] = defaultdict(int)
        for raw in text_bytes(batch.column(0)):
            for w in wanted.intersection(words_of(raw)):
                counts[w] += 1
        rows = [(b"", batch.num_rows), *counts.items()]
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in rows], pa.binary()), pa.array([b for _, b in rows], pa.int64())], ["word", "n"])

    sums = map_batches(docs.select(F.col(text).cast("string").alias("text")), run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {bytes(r["word"]): r["n"] for r in sums.toLocalIterator()}
    return found.pop(b"", 0), {w: found.get(w, 0) for w in vocabulary}


class Index:
    def __init__(self, n_docs: int, counts: dict[bytes, int], templates: tuple[Template, ...] = TEMPLATES) -> None:
        self.idf = {w: math.log((n_docs + 1) / (n + 1)) + 1 for w, n in counts.items()}
        self.templates = templates
        self.words = [words_of(t.text.encode()) for t in templates]
        self.weight = [sum(self.idf[w] for w in ws) for ws in self.words]
        self.keys: list[list[tuple[int, list[bytes]]]] = []
        self.anchors: list[set[int]] = []
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for k, t in enumerate(templates):
            ws = self.words[k]
            keys, anchors = [], set()
            for phrase in t.keys:
                key = words_of(phrase.encode())
                at = next(i for i in range(len(ws)) if ws[i : i + len(key)] == key)
                keys.append((at, key))
                rare = sorted(range(len(key)), key=lambda i: (-self.idf[key[i]], i))
                anchors.update(at + i for i in rare[:ANCHORS])
            self.keys.append(keys)
            self.anchors.append(anchors)
            for i in anchors:
                self.postings[ws[i]].append((k, i))

    def places(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """(template, start, score) of every verified place; ``start`` is where
        the template's first key phrase stands."""
        postings = self.postings
        votes: dict[tuple[int, int], int] = defaultdict(int)
        if not postings.keys().isdisjoint(words):
            for p, w in enumerate(words):
                if w in postings:
                    for k, i in postings[w]:
                        votes[k, p - i] += 1
        found = []
        for (k, start), n in sorted(votes.items()):
            if n < len(self.anchors[k]):
                continue
            if all(start + at >= 0 and words[start + at : start + at + len(key)] == key for at, key in self.keys[k]):
                same = sum(self.idf[w] for i, w in enumerate(self.words[k]) if 0 <= start + i < len(words) and words[start + i] == w)
                found.append((k, start + self.keys[k][0][0], same / self.weight[k]))
        return found


def scan(docs: DataFrame, index: Index, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, places array<struct<label, start, score>>) of every row."""
    templates = index.templates
    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, places array<struct<label:string,start:bigint,score:double>>"
    place = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("score", pa.float64())]))

    def run(batch: pa.RecordBatch):
        rows = []
        for raw in text_bytes(batch.column(1)):
            words = words_of(raw)
            found = index.places(words)
            base = [start for k, start, _ in found if templates[k].base]
            rows.append(
                (
                    len(words),
                    len(base),
                    min(base, default=None),
                    max(base, default=None),
                    ",".join(sorted({templates[k].label for k, _, _ in found if templates[k].base})),
                    ",".join(sorted({templates[k].label for k, _, _ in found})),
                    min(1.0, max((s for _, _, s in found), default=0.0)),
                    [{"label": templates[k].label, "start": start, "score": s} for k, start, s in found],
                )
            )
        types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), place]
        columns = [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places"])

    return map_batches(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")), run, schema)
