"""Licence scan with a positional index of rare licence words.

Templates are short licence notices. Their words are weighted by the inverse document frequency that the whole scanned
corpus gives them. The index holds the positions of the rarest words of every template. A file looks up all of its
indexed words, so several notices in one file do not displace each other; each posting proposes a place of the template
in the file (file position minus template position), proposals are intersected by that relative place, and a proposal
holds if enough of the template's words stand there and one of its mandatory key phrases stands inside it. The base phrases are templates of their own: their rarest
word is always looked up, so that every place is found, and all their words are mandatory.

Words: A-Z lower-cased, runs of ASCII letters, digits and non-ASCII characters. A null text is an empty one and gets
zero counts, null places, empty labels and score 0. Repeated rows stay, each with its own result. Ties between words of
equal IDF go by the word. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.textops import ALNUM, LOWER, PrefixHash, Slice, documents, map_slices, per_row, words

# The base phrases with their labels.
BASE_PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Public notices (label, mandatory key phrases, text).
TEMPLATES = (
    ("mit", ("permission is hereby granted free of charge",),
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction"),
    ("apache", ("apache license", "apache org licenses"),
     "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("gpl", ("gnu general public license",),
     "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free "
     "software foundation"),
    ("lgpl", ("gnu lesser general public license",),
     "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by "
     "the free software foundation"),
    ("agpl", ("gnu affero general public license",),
     "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by "
     "the free software foundation"),
    ("bsd", ("redistribution and use in source and binary forms",),
     "redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met"),
    ("isc", ("permission to use copy modify",),
     "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", ("mozilla public license",),
     "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", ("creative commons attribution", "cc by"),
     "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc0", ("no copyright", "cc0"),
     "the person who associated a work with this deed has dedicated the work to the public domain cc0 no copyright"),
    ("unlicense", ("unencumbered software released into the public domain",),
     "this is free and unencumbered software released into the public domain"),
    ("boost", ("boost software license",),
     "distributed under the boost software license version 1 0"),
    ("zlib", ("provided as is without any express or implied warranty",),
     "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
)

INDEXED_WORDS = 8
LEAST_SHARE = 0.6

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
)


def split_words(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def hash_words(names: list[str]) -> np.ndarray:
    raw = [w.encode() for w in names]
    ends = np.cumsum([len(w) for w in raw], dtype=np.int64)
    return PrefixHash(np.frombuffer(b"".join(raw), np.uint8))(ends - [len(w) for w in raw], ends)


@dataclass
class Template:
    label: str
    ids: np.ndarray
    phrases: list[np.ndarray]


class Index:
    """Template words, their weights and the postings of the rare ones; bounded by the templates alone."""

    def __init__(self, templates=TEMPLATES, phrases=BASE_PHRASES):
        texts = [t for _, keys, text in templates for t in (text, *keys)] + [p for p, _ in phrases]
        self.names = sorted({w for t in texts for w in split_words(t)})
        number = {w: i for i, w in enumerate(self.names)}
        ids = lambda t: np.array([number[w] for w in split_words(t)], np.int32)
        self.templates = [Template(label, ids(text), [ids(k) for k in keys]) for label, keys, text in templates]
        self.longest = max((len(t.ids) for t in self.templates), default=0)
        self.least = np.array([min(3, len(t.ids)) for t in self.templates], np.int64)
        self.base = [(ids(p), label) for p, label in phrases]
        hashes = hash_words(self.names)
        self.order = np.argsort(hashes)
        self.sorted_hashes = hashes[self.order]
        self.weights = np.zeros(len(self.names))
        self.postings: dict[int, list[tuple[int, int]]] = {}

    def weigh(self, frequency: dict[str, int], total: int) -> Index:
        """Weights from document counts; ``frequency`` may lack words."""
        held = np.array([frequency.get(w, 0) for w in self.names])
        self.weights = np.log((1 + total) / (1 + held))
        for t, template in enumerate(self.templates):
            rare = sorted(set(template.ids.tolist()), key=lambda i: (-self.weights[i], i))[:INDEXED_WORDS]
            for at, i in enumerate(template.ids.tolist()):
                if i in rare:
                    self.postings.setdefault(i, []).append((t, at))
        return self

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for words of no template."""
        at = np.minimum(np.searchsorted(self.sorted_hashes, hashes), len(self.names) - 1)
        return np.where(self.sorted_hashes[at] == hashes, self.order[at], -1).astype(np.int32)

    def anchor(self, phrase: np.ndarray) -> int:
        """Place of the phrase's rarest word."""
        return int(np.argmax(self.weights[phrase]))


def phrase_places(ids: np.ndarray, rows: np.ndarray, phrase: np.ndarray, anchor: int) -> np.ndarray:
    """Starts of a phrase: look up its anchor word, then intersect the others by relative position."""
    at = np.flatnonzero(ids == phrase[anchor]) - anchor
    at = at[(at >= 0) & (at + len(phrase) <= len(ids))]
    for k, word in enumerate(phrase):
        at = at[ids[at + k] == word]
    return at[rows[at] == rows[at + len(phrase) - 1]]


def _contains(window: np.ndarray, phrase: np.ndarray) -> bool:
    return any(np.array_equal(window[i : i + len(phrase)], phrase) for i in np.flatnonzero(window == phrase[0]))


def file_labels(ids: np.ndarray, index: Index) -> dict[str, float]:
    """Labels of one file from its template matches, with the share of the template that stands there."""
    votes: list[np.ndarray] = []
    width = len(ids) + 2 * index.longest
    for i in np.unique(ids[ids >= 0]).tolist():
        if i in index.postings:
            at = np.flatnonzero(ids == i)
            votes += [t * width + at - own + index.longest for t, own in index.postings[i]]
    places, counts = np.unique(np.concatenate([np.zeros(0, np.int64), *votes]), return_counts=True)
    enough = counts >= index.least[places // width]
    found: dict[str, float] = {}
    for t, start in zip((places[enough] // width).tolist(), (places[enough] % width - index.longest).tolist(), strict=True):
        template = index.templates[t]
        first, last = max(start, 0), min(start + len(template.ids), len(ids))
        share = float(np.mean(np.isin(np.arange(first, last), first + np.flatnonzero(ids[first:last] == template.ids[first - start : last - start])))) if last > first else 0.0
        share *= (last - first) / len(template.ids)
        if share >= LEAST_SHARE and any(_contains(ids[first : last + len(p)], p) for p in template.phrases):
            found[template.label] = max(found.get(template.label, 0.0), share)
    return found


def _ids(part: Slice, index: Index) -> tuple[np.ndarray, np.ndarray]:
    part.data = LOWER[part.data]
    starts, ends = words(part, ALNUM)
    return index.find(PrefixHash(part.data)(starts, ends)), part.rows(starts)


def document_frequency(docs: DataFrame, index: Index) -> dict[str, int]:
    """In how many documents each template word stands; at most one row per template word and slice is shuffled."""

    def work(part: Slice) -> pa.RecordBatch:
        ids, rows = _ids(part, index)
        known = ids >= 0
        pairs = np.unique(rows[known].astype(np.int64) * len(index.names) + ids[known])
        count = np.bincount(pairs % len(index.names), minlength=len(index.names))
        some = np.flatnonzero(count)
        return pa.RecordBatch.from_pydict({"word": pa.array(some, pa.int32()), "docs": pa.array(count[some], pa.int64())})

    counted = map_slices(documents(docs, "text"), work, "word int, docs long").groupBy("word").agg(F.sum("docs").alias("docs"))
    return {index.names[r.word]: r.docs for r in counted.collect()}


def scan(docs: DataFrame, templates=TEMPLATES, phrases=BASE_PHRASES) -> DataFrame:
    """Base phrases, labels and score of every document."""
    index = Index(templates, phrases)
    index.weigh(document_frequency(docs, index), docs.count())
    indexed = np.zeros(len(index.names) + 1, bool)
    indexed[list(index.postings)] = True

    def work(part: Slice) -> pa.RecordBatch:
        n = len(part)
        ids, rows = _ids(part, index)
        n_base, first, last = np.zeros(n, np.int64), np.full(n, -1), np.full(n, -1)
        labels: list[dict[str, float]] = [{} for _ in range(n)]
        base: list[set[str]] = [set() for _ in range(n)]
        begin = np.searchsorted(rows, np.arange(n + 1))
        for phrase, label in index.base:
            at = phrase_places(ids, rows, phrase, index.anchor(phrase))
            own = rows[at]
            n_base += per_row(own, n)
            place = at - begin[own]
            for row, value in zip(own.tolist(), place.tolist(), strict=True):
                first[row] = value if first[row] < 0 else min(first[row], value)
                last[row] = max(last[row], value)
                base[row].add(label)
                labels[row][label] = 1.0
        rare = np.flatnonzero(indexed[ids])
        hits = per_row(rows[rare], n)
        for row in np.flatnonzero(hits >= 2).tolist():
            for label, share in file_labels(ids[begin[row] : begin[row + 1]], index).items():
                labels[row][label] = max(labels[row].get(label, 0.0), share)
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": part.column("doc_id"),
                "n_words": pa.array(np.diff(begin), pa.int64()),
                "n_base": pa.array(n_base),
                "first_word": pa.array(first, pa.int64(), mask=n_base == 0),
                "last_word": pa.array(last, pa.int64(), mask=n_base == 0),
                "base_labels": pa.array([",".join(sorted(b)) for b in base]),
                "labels": pa.array([",".join(sorted(found)) for found in labels]),
                "score": pa.array([max(found.values(), default=0.0) for found in labels]),
            }
        )

    return map_slices(documents(docs, "doc_id", "text"), work, SCHEMA)
