"""License scan: winnowed fingerprints pick candidates, banded alignment reports spans.

Templates and documents are sequences of normalised words (letters and digits,
lower case). Fingerprints are the hashes of ``GRAM`` words in a row; of every
``WINDOW`` consecutive ones the smallest is kept (winnowing), so any passage of
``GRAM + WINDOW - 1`` words that a document shares with a template has a common
fingerprint. A template of ``LONG`` words or more with at most a fifth of its words
edited still has that many equal words in a row. A shorter template has not; its
fingerprints are single words, as many as may be missing from a match and one more
(those that fewest templates hold), so every match holds one of them. Such a hit
counts only if enough words of the template lie around it. The templates'
fingerprints form an inverted index of a few thousand entries, which the tasks hold;
documents are fingerprinted in numpy, whole batches at a time, and only documents
with an entry in the index go on.

A hit gives a place in the document and a place in a template. Hits of a long template
whose distance (the diagonal) agrees within the band are one candidate region; every
diagonal of a short one is a region of its own. Each region is aligned with the
template inside a band around its diagonals (edit operations on words: equal,
replaced, left out, put in). The best local alignment gives the matched words, their
coverage of the template and the span in the document. A match needs a coverage of
0.8, and a short template at most a fifth of its words in edits. Of regions that
overlap, the one with more matched words stays.

Defined cases: a null or blank text has no match; texts of any length are read whole;
every occurrence is reported, so a document may have many rows or none; repeated rows
are reported as often as they occur; other columns pass. Coverage alone decides: a
notice of five words with one replaced, be it the licence's name, is a match of 0.8
(its ``edits`` tell; a greater ``least`` refuses it).
"""

from __future__ import annotations

import bisect
import math
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import fresh, table

#: Words of a fingerprint, and consecutive fingerprints of which the smallest is kept.
GRAM, WINDOW = 3, 2
#: Words from which a template is long: ceil(0.8 n / (0.2 n + 1)) is GRAM + WINDOW - 1 or more.
LONG = 16
#: Half the width of the alignment band, in words (for a short template half its length, so that two
#: occurrences in a row stay two), and the coverage from which a match counts.
BAND, COVERAGE = 6, 0.8
#: What an equal word weighs against an edit: a word beside an edited one still belongs to the match.
EQUAL = 5
#: Words that are fingerprinted together.
BLOCK_WORDS = 400_000

# Notices as their licences ask for them, or as they are commonly written.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-licensed": "Licensed under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
                "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
                "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
                "following conditions:",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                         "in compliance with the License. You may obtain a copy of the License at",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                  "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
                  "(at your option) any later version.",
    "BSD-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                  "that the following conditions are met:",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-4.0-text": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}

_WORD = regex.compile(r"[\p{L}\p{N}]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def fingerprints(word: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Places of the winnowed fingerprints and their hashes, as (places, hashes).

    ``word``: hashes of the words of several texts in a row; ``left``: words from
    each place to the end of its text.
    """
    n = len(word)
    if n < GRAM:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    gram = np.zeros(n, dtype=np.uint64)
    for i in range(GRAM):
        gram = gram * np.uint64(0x9E3779B97F4A7C15) + np.concatenate((word[i:], np.zeros(i, dtype=np.uint64)))
        gram ^= gram >> np.uint64(29)
    full = left >= GRAM
    worst = np.uint64(0xFFFFFFFFFFFFFFFF)
    gram = np.where(full, gram, worst)
    # the smallest of each window that lies in one text; a text with fewer fingerprints is one window
    padded = np.concatenate((gram, np.full(WINDOW, worst)))
    inside = [np.where(left >= GRAM + i, padded[i:i + n], worst) for i in range(WINDOW)]
    least = np.minimum.reduce(inside)
    first = np.concatenate(([True], left[1:] != left[:-1] - 1))
    window = full & ((left >= GRAM + WINDOW - 1) | first)
    keep = np.zeros(n + WINDOW, dtype=bool)
    for i in range(WINDOW):
        at = np.flatnonzero(window & (inside[i] == least) & (inside[i] != worst))
        keep[at + i] = True
    places = np.flatnonzero(keep[:n])
    return places, gram[places]


class Index:
    """Inverted index of the templates: hash -> (template, place); words of the short ones apart."""

    def __init__(self, templates: dict[str, str], least: float = COVERAGE):
        self.hashes, self.names, self.words, self.bands, self.entries = _Hashes(), list(templates), [], [], {}
        self.words = [words_of(t) for t in templates.values()]
        self.bands = [band_of(w) for w in self.words]
        self.need = [max(1, math.ceil(least * len(w) - 1e-9)) for w in self.words]
        # long only if the equal words of a match, cut into runs by its missing ones, leave a run with a kept fingerprint
        self.short = [bool(w) and (len(w) < LONG or n <= (len(w) - n + 1) * (GRAM + WINDOW - 2))
                      for w, n in zip(self.words, self.need)]
        # a short notice may have as many edits, put-in words included, as words may be missing; fewer never end a match
        self.rules = [(len(w) - n + 1, len(w) - n) if short else (EQUAL, None)
                      for w, n, short in zip(self.words, self.need, self.short)]
        held = Counter(x for w in self.words for x in set(w))
        self.rare: list[tuple[int, np.ndarray, list[tuple[int, np.uint64]]]] = []
        for k, w in enumerate(self.words):
            word = np.array([self.hashes[x] for x in w], dtype=np.uint64)
            if self.short[k]:
                # a match lacks at most len - need words, so it holds one of any len - need + 1 places
                places = sorted(range(len(w)), key=lambda i: (held[w[i]], -len(w[i]), i))[:len(w) - self.need[k] + 1]
                self.rare.append((k, np.unique(word), [(i, word[i]) for i in places]))
                continue
            # all fingerprints of a template, so that none is lost to another choice of the smallest
            places, hashes = self._all(word)
            for p, h in zip(places, hashes):
                self.entries.setdefault(int(h), []).append((k, int(p)))
        self.sorted = np.array(sorted(self.entries), dtype=np.uint64)
        self.vocabulary = np.unique(np.concatenate([h for _, h, _ in self.rare])) if self.rare else np.zeros(0, np.uint64)

    def rare_hits(self, word: np.ndarray):
        """(template, place in the template, places in ``word``) of the short templates' hits."""
        if not len(self.vocabulary) or not len(word):
            return
        at = np.minimum(np.searchsorted(self.vocabulary, word), len(self.vocabulary) - 1)
        seen = np.flatnonzero(self.vocabulary[at] == word)               # the few words that any short template holds
        value = word[seen]
        for k, vocabulary, places in self.rare:
            mine = seen[np.isin(value, vocabulary)]                      # places of the words of this template
            for i, h in places:
                hit = seen[value == h]
                low = np.searchsorted(mine, hit - i - self.bands[k])
                high = np.searchsorted(mine, hit - i + len(self.words[k]) + self.bands[k])
                hit = hit[high - low >= self.need[k]]
                if len(hit):
                    yield k, i, hit

    @staticmethod
    def _all(word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out_p, out_h = [], []
        for i in range(len(word) - GRAM + 1):
            _, h = fingerprints(word[i:i + GRAM], np.arange(GRAM, 0, -1))
            out_p.append(i)
            out_h.append(h[0])
        return np.array(out_p, dtype=np.int64), np.array(out_h, dtype=np.uint64)

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        """Which of ``hashes`` the index holds."""
        if not len(self.sorted):
            return np.zeros(len(hashes), dtype=bool)
        at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
        return self.sorted[at] == hashes


def align(doc: list[str], template: list[str], low: int, high: int, equal: int = EQUAL,
          most: int | None = None) -> tuple[int, int, int, int, int]:
    """Best local alignment of ``template`` with ``doc`` on diagonals low..high (place in doc - place in template).

    (score, matched words, first doc word, last doc word + 1, edits): +``equal`` for an
    equal word, -1 for a replaced, missing or additional one; ``most`` bounds the edits.
    """
    width = high - low + 1
    none = (0, 0, -1, -1, 0)
    row, best = [none] * width, none
    for j, t in enumerate(template):
        new = [none] * width
        for b in range(width):
            i = j + low + b
            if not 0 <= i < len(doc):
                continue
            score, matched, start, _, edits = row[b]                    # both advance
            cell = (score + equal, matched + 1, i if start < 0 else start, i + 1, edits) if doc[i] == t else (score - 1, matched, start, i + 1, edits + 1)
            if b + 1 < width and row[b + 1][0] - 1 > cell[0]:           # a template word is missing
                s = row[b + 1]
                cell = (s[0] - 1, s[1], s[2], s[3], s[4] + 1)
            if b and new[b - 1][0] - 1 > cell[0]:                       # an additional word in the document
                s = new[b - 1]
                cell = (s[0] - 1, s[1], s[2], i + 1, s[4] + 1)
            if cell[0] > 0:
                new[b] = cell
                if doc[i] == t and (most is None or cell[4] <= most) and (cell[0], cell[1]) > (best[0], best[1]):
                    best = cell
        row = new
    return best


def band_of(template: list[str]) -> int:
    return min(BAND, (len(template) - 1) // 2)


def regions(seeds: list[tuple[int, int]], bands: list[int]) -> list[tuple[int, int, int]]:
    """(template, lowest diagonal, highest diagonal) of hits (template, diagonal) that lie within a band of each other."""
    out = []
    for k, d in sorted(set(seeds)):
        if out and out[-1][0] == k and d - out[-1][1] <= bands[k]:
            out[-1] = (k, out[-1][1], d)
        else:
            out.append((k, d, d))
    return out


def matches(doc: list[str], seeds: list[tuple[int, int]], index: Index, least: float = COVERAGE) -> list[tuple]:
    """(first word, last word + 1, template, matched, edits) of a document, by place; of overlapping ones the best."""
    found = []
    alone = [(k, d, d) for k, d in set(seeds) if index.short[k]]
    for k, low, high in alone + regions([x for x in seeds if not index.short[x[0]]], index.bands):
        template, band = index.words[k], index.bands[k]
        from_word = max(0, low - band)
        part = doc[from_word:high + len(template) + band]
        _, matched, start, end, edits = align(part, template, low - band - from_word, high + band - from_word, *index.rules[k])
        if matched >= least * len(template):
            found.append((matched - edits, len(template), -k, from_word + start, from_word + end, matched, edits))
    taken: list[tuple[int, int]] = []
    out = []
    for _, _, k, start, end, matched, edits in sorted(found, key=lambda x: (-x[0], x[1], -x[2], x[3])):
        at = bisect.bisect_left(taken, (start, end))
        if (at and taken[at - 1][1] > start) or (at < len(taken) and taken[at][0] < end):
            continue
        taken.insert(at, (start, end))
        out.append((start, end, -k, matched, edits))
    return sorted(out)


def scan(docs: DataFrame, text_col: str = "text", keep_text: bool = True, templates: dict[str, str] | None = None,
         least: float = COVERAGE) -> DataFrame:
    """One row per match: the row of ``docs`` plus (license, span_start, span_end, matched_words, edits, coverage).

    Spans are code points, end exclusive; coverage is the share of the template's words that are matched.
    """
    known = dict(TEMPLATES if templates is None else templates)
    fields = [f for f in docs.schema.fields if keep_text or f.name != text_col]
    new = fresh(docs, "license", "span_start", "span_end", "matched_words", "edits", "coverage")
    kinds = [T.StringType(), T.LongType(), T.LongType(), T.LongType(), T.LongType(), T.DoubleType()]
    schema = T.StructType([*fields, *[T.StructField(n, t) for n, t in zip(new, kinds)]])

    def in_texts(texts: list[str], index: Index):
        """(number of the text, its matches) of a block of texts."""
        split = [words_of(t) for t in texts]
        counts = np.array([len(w) for w in split], dtype=np.int64)
        total = int(counts.sum())
        word = np.fromiter((index.hashes[w] for ws in split for w in ws), dtype=np.uint64, count=total)
        ends = np.cumsum(counts)
        places, hashes = fingerprints(word, np.repeat(ends, counts) - np.arange(total))
        hit = index.hits(hashes)
        seeds: dict[int, list[tuple[int, int]]] = {}
        def seed(at, k, place):
            d = int(np.searchsorted(ends, at, side="right"))
            seeds.setdefault(d, []).append((k, int(at) - int(ends[d] - counts[d]) - place))
        for p, h in zip(places[hit], hashes[hit]):
            for k, place in index.entries[int(h)]:
                seed(p, k, place)
        for k, place, found in index.rare_hits(word):
            for p in found:
                seed(p, k, place)
        for d in sorted(seeds):
            found = matches(split[d], seeds[d], index, least)
            if found:
                yield d, found

    def run(batches):
        index = Index(known, least)
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.schema.names.index(text_col)).to_pylist()]
            rows, out, begin = [], [], 0
            while begin < len(texts):
                stop, size = begin + 1, len(texts[begin])
                while stop < len(texts) and size + len(texts[stop]) <= 5 * BLOCK_WORDS:
                    size += len(texts[stop])
                    stop += 1
                for d, found in in_texts(texts[begin:stop], index):
                    text = texts[begin + d]
                    # lower case can be longer than the text: spans are taken from the text itself
                    spans = [m.span() for m in _WORD.finditer(text)]
                    if len(spans) != len(words_of(text)):
                        spans = _spans(text)
                    for start, end, k, matched, edits in found:
                        rows.append(begin + d)
                        out.append((index.names[k], spans[start][0], spans[end - 1][1], matched, edits, matched / len(index.words[k])))
                begin = stop
            kept = batch.take(pa.array(rows, pa.int64()))
            columns = list(zip(*out)) if out else [()] * len(new)
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([*[kept.column(kept.schema.names.index(f.name)) for f in fields],
                                              *[pa.array(c, t) for c, t in zip(columns, types)]], names=schema.names)
    return docs.mapInArrow(run, schema)


def _spans(text: str) -> list[tuple[int, int]]:
    """Spans in ``text`` of the words of its lower case, whose letters may be more than one character each."""
    origin = [i for i, c in enumerate(text) for _ in c.lower()]
    lower = "".join(c.lower() for c in text)
    return [(origin[m.start()], origin[m.end() - 1] + 1) for m in _WORD.finditer(lower)]


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
