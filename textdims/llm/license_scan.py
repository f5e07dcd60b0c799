"""License scans: an exact set-similarity join of license templates with blocks of text.

A template is the set of its different words.  The text blocks of a document are, for each
template, all runs of as many consecutive words as the template has (a shorter
document is one block); a block matches when it holds at least the share asked for
of the template's different words, wherever a text has been wrapped, cut or amended.
Licenses that share most of their words are all reported, each with its containment.

Words are ordered by how often they occur in all documents, rarest first.  If m words
are in the template and o of them are asked for, a block has to hold one of the
rarest m - o + 1: only blocks around those prefix words are looked at (prefix
filter).  A document of fewer than o words has no matching block (length filter).
With k prefix words in a block, at most m - o + k can be shared, counting all words behind
the prefix, and no more than there are words of the template in the block: blocks
that cannot reach o go (positional filter).  What is left is counted exactly, each word
once a block.

Templates and phrases are an argument, held by the driver like a list of patterns; they are
broadcast, and refused beyond ``TEMPLATE_BYTES``.  Documents are mapped twice (word
counts, join); only the counts of template words are added up, nothing of the
documents is shuffled.

Defined cases: a null text is empty and has no words; documents without words match nothing;
templates and phrases without words are refused; ids may be null or repeat, each row
is scanned; without templates only phrases are found; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, map_arrow

#: Share of a template's different words that a block has to hold; bytes of templates and phrases that may be broadcast.
CONTAINED, WHOLE = Fraction(8, 10), Fraction(1)
TEMPLATE_BYTES = 1 << 20

# Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Fixed values: (label, text, share asked for) of the notices that well-known licenses ask for, as published.
# One-line notices of different licenses share most of their words: all of them are asked for.
TEMPLATES = (
    ("apache", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
        You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0""", CONTAINED),
    ("apache", "Licensed under the Apache License, Version 2.0", WHOLE),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
        (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
        distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so""", CONTAINED),
    ("mit", "Released under the MIT License", WHOLE),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
        Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.""", CONTAINED),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by
        the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""", CONTAINED),
    ("lgpl", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as
        published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.""", CONTAINED),
    ("mpl", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this
        file, You can obtain one at http://mozilla.org/MPL/2.0/.""", CONTAINED),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the
        above copyright notice and this permission notice appear in all copies.""", CONTAINED),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License.", WHOLE),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", WHOLE),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or
        distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""", CONTAINED),
)

#: a-z, digits and all bytes beyond ASCII stay, A-Z fold, the rest separates.
_FOLD = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Template:
    """One template: its label, length in words, and its different words from the rarest on."""

    def __init__(self, label: str, numbers: list[int], counts: np.ndarray, contained: Fraction):
        self.label, self.length = label, len(numbers)
        self.words = np.array(sorted(set(numbers), key=lambda w: (counts[w], w)), np.int64)
        self.asked = max(1, math.ceil(contained * len(self.words)))
        self.behind = self.asked - 1  # words behind the prefix
        prefix = len(self.words) - self.behind
        self.rank = np.full(len(counts), len(self.words), np.int64)
        self.rank[self.words] = np.arange(len(self.words))
        self.prefix = prefix

    def blocks(self, places: np.ndarray, numbers: np.ndarray, n_words: int) -> list[tuple[int, int, int]]:
        """(start, end, words shared) of each run of matching blocks, merged; ``places`` hold a template's word, ``numbers`` which."""
        if n_words < self.asked:
            return []
        rank = self.rank[numbers]
        mine = rank < len(self.words)
        places, rank = places[mine], rank[mine]
        first = rank < self.prefix
        if not first.any() or len(places) < self.asked:
            return []
        # prefix and positional filter: changes of a block's counts while its start moves on
        last_start = max(0, n_words - self.length)
        low = np.maximum(0, places - self.length + 1)
        before = _last_before(places, rank)
        fresh = np.maximum(low, before + 1)  # from here on a block has not met this word yet
        high = np.minimum(places, last_start)
        lead, lead_at = _running(fresh[first], high[first])
        rest, rest_at = _running(low[~first], high[~first])
        edges = np.unique(np.r_[lead_at, rest_at, 0])
        k = _value(lead, lead_at, edges)
        could = k + np.minimum(self.behind, _value(rest, rest_at, edges))
        candidate = (k > 0) & (could >= self.asked) & (edges <= last_start)
        if not candidate.any():
            return []
        # verification: different words of the blocks, exactly
        shared, shared_at = _running(fresh, high)
        at = np.unique(np.r_[edges, shared_at])
        at = at[at <= last_start]
        within = candidate[np.searchsorted(edges, at, "right") - 1]
        n = np.where(within, _value(shared, shared_at, at), 0)
        good = np.flatnonzero(n >= self.asked)
        out = []
        ends = np.r_[at[1:], last_start + 1]
        size = min(self.length, n_words)
        for j in good:
            start, end, best = int(at[j]), int(ends[j]) - 1 + size, int(n[j])
            if out and start <= out[-1][1]:
                out[-1] = (out[-1][0], end, max(best, out[-1][2]))
            else:
                out.append((start, end, best))
        return out


def _last_before(places: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The place of the same word before each place; -1 for the first."""
    order = np.lexsort((places, rank))
    out = np.full(len(places), -1, np.int64)
    same = rank[order][1:] == rank[order][:-1]
    out[order[1:][same]] = places[order[:-1][same]]
    return out


def _running(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many of the ranges low..high hold a number, as (values, numbers from which they hold)."""
    ok = low <= high
    at = np.r_[low[ok], high[ok] + 1]
    step = np.r_[np.ones(int(ok.sum()), np.int64), -np.ones(int(ok.sum()), np.int64)]
    where, back = np.unique(at, return_inverse=True)
    return np.cumsum(np.bincount(back, step, len(where))).astype(np.int64) if len(where) else np.zeros(0, np.int64), where


def _value(values: np.ndarray, at: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    k = np.searchsorted(at, numbers, "right") - 1
    return np.where(k >= 0, values[np.maximum(k, 0)], 0) if len(values) else np.zeros(len(numbers), np.int64)


class Scanner:
    """Templates and phrases over one numbering of their words."""

    def __init__(self, templates: Sequence[tuple[str, str, Fraction]], phrases: dict[str, str]):
        if sum(len(label.encode()) + len(text.encode()) for label, text in [*phrases.items(), *(t[:2] for t in templates)]) > TEMPLATE_BYTES:
            raise ValueError(f"templates and phrases of more than {TEMPLATE_BYTES} bytes are not broadcast")
        self.number: dict[bytes, int] = {}
        self.sources = [(label, self._number(label, text), share) for label, text, share in templates]
        self.phrases = [(label, np.array(self._number(label, phrase), np.int64)) for phrase, label in phrases.items()]
        self.templates: list[Template] = []

    def _number(self, label: str, text: str) -> list[int]:
        numbers = [self.number.setdefault(w, len(self.number)) for w in words_of(text.encode())]
        if not numbers:
            raise ValueError(f"no words in the text of {label!r}")
        return numbers

    def order(self, counts: np.ndarray) -> None:
        """Order the templates' words by their counts in all documents (ties: by first appearance)."""
        self.templates = [Template(label, numbers, counts, share) for label, numbers, share in self.sources]

    def ids(self, words: list[bytes]) -> np.ndarray:
        get = self.number.get
        return np.fromiter([get(w, -1) for w in words], np.int64, len(words))

    def places(self, ids: np.ndarray) -> list[tuple[str, int]]:
        """(label, first word) of every place where a phrase's words stand."""
        out = []
        for label, phrase in self.phrases:
            m = len(ids) - len(phrase) + 1
            if m > 0:
                ok = ids[:m] == phrase[0]
                for k in range(1, len(phrase)):
                    ok &= ids[k : k + m] == phrase[k]
                out += [(label, int(p)) for p in np.flatnonzero(ok)]
        return sorted(out, key=lambda x: (x[1], x[0]))

    def blocks(self, ids: np.ndarray) -> list[tuple[str, int, int, float]]:
        """(label, start, end, containment) of the merged matching blocks."""
        at = np.flatnonzero(ids >= 0)
        return [(t.label, a, b, n / len(t.words)) for t in self.templates for a, b, n in t.blocks(at, ids[at], len(ids))]


def _word_counts(docs: DataFrame, held, kinds: int) -> np.ndarray:
    """Occurrences of each template word in all documents; tasks send sums."""

    def count(batches):
        scanner = held.value
        total = np.zeros(kinds + 1, np.int64)
        for batch in batches:
            for text in batch.column("text").cast(pa.binary()):
                total += np.bincount(scanner.ids(words_of(text.as_py())) + 1, minlength=kinds + 1)
        at = np.flatnonzero(total[1:])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[1:][at])], ["word", "n"])

    counts = np.zeros(kinds, np.int64)
    for r in map_arrow(docs.select("text"), count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[r["word"]] = r["n"]
    return counts


SCHEMA = "doc_id long, n_words long, places array<struct<label:string,start:bigint>>, blocks array<struct<label:string,start:bigint,end:bigint,containment:double>>"


def find_licenses(docs: DataFrame, templates: Sequence[tuple[str, str, Fraction]] = TEMPLATES, phrases: dict[str, str] = PHRASES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, places (label and first word of each phrase found), blocks (label, words [start, end) and best containment of merged matching blocks)."""
    rows = id_and_text(docs, id_col, text_col)
    context = docs.sparkSession.sparkContext
    scanner = Scanner(templates, phrases)
    scanner.order(_word_counts(rows, context.broadcast(scanner), len(scanner.number)))
    held = context.broadcast(scanner)
    place = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))
    block = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("containment", pa.float64())]))

    def find(batches):
        s = held.value
        for batch in batches:
            n_words, places, blocks = [], [], []
            for text in batch.column("text").cast(pa.binary()):
                ids = s.ids(words_of(text.as_py()))
                n_words.append(len(ids))
                places.append([{"label": x, "start": p} for x, p in s.places(ids)])
                blocks.append([{"label": x, "start": a, "end": b, "containment": c} for x, a, b, c in s.blocks(ids)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(places, place), pa.array(blocks, block)], ["doc_id", "n_words", "places", "blocks"])

    return map_arrow(rows, find, SCHEMA)


def label_digest(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score (best containment; a phrase counts as 1)."""
    labels = F.array_sort(F.array_distinct(F.col("places.label")))
    every = F.array_sort(F.array_distinct(F.concat(F.col("places.label"), F.col("blocks.label"))))
    best = F.coalesce(F.array_max("blocks.containment"), F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.start").alias("first_word"),
        F.array_max("places.start").alias("last_word"),
        F.array_join(labels, ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(best).alias("score"),
    )
