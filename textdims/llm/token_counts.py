"""Token counts by a map-side lookup in two tiers.

A text is cut before every single space that follows a non-space character;
byte-level word patterns never reach over such a place, so the token counts of the
cuts (pre-tokens, mostly) add up to that of the text.

Tier one is a table of the frequent pre-tokens of the corpus with their lengths in
tokens: each task counts what it reads in a bounded summary (space-saving
pruning), sends its most frequent ones, and the merged top ``TABLE`` of these
bounded summaries are encoded once and broadcast.  Tier two: what isn't in the
table is encoded in the task and remembered in a bounded cache of the worker.
Counts are exact whatever the table holds.  Pre-tokens of documents are never
shuffled, only the summaries are.

Defined cases: a null text is empty; an empty text has no tokens; special
strings in a text count as the library counts them; null ids and repeated rows are
counted like any other; columns other than id and text are not read.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import id_and_text, map_arrow

#: Rows of the broadcast table; what a task keeps and sends; length of a pre-token worth remembering.
TABLE, SUMMARY, SENT, LONGEST = 1 << 15, 1 << 16, 1 << 12, 48
#: Units remembered by a worker.
REMEMBERED = 200_000
#: A word with punctuation after it: two pre-tokens, whose counts add up (letters and signs that no pattern part joins).
_WORD_AND_SIGNS = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?$%&#*|]+)")

#: A space after white space doesn't start a unit.
_DOUBTFUL = re.compile(r"\s ")
_UNIT = re.compile(r"(?<=\S) ")


def units(text: str) -> list[str]:
    """The cuts of a text, each without the space it starts with (but the first, which has none)."""
    return _UNIT.split(text) if _DOUBTFUL.search(text) else text.split(" ")


def read_tokenizer(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        source = f.read()
    spec = json.loads(source)
    pre = spec.get("pre_tokenizer") or {}
    added = spec.get("added_tokens") or []
    if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
        raise ValueError("a byte-level tokenizer without normalizer and prefix space is needed")
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or " " in t["content"] for t in added):
        raise ValueError("special tokens that take in their surroundings are not supported")
    return source


def _load(source: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    t = Tokenizer.from_str(source)
    t.no_truncation()
    t.no_padding()
    return t


def frequent_units(docs: DataFrame, size: int = TABLE) -> list[str]:
    """The most frequent units (without their space) over all documents, by the tasks' bounded summaries."""

    def run(batches):
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                for at in range(0, len(text), 1 << 20):
                    seen.update(text[at : at + (1 << 20)].split(" "))
                    if len(seen) > 4 * SUMMARY:
                        least = heapq.nlargest(SUMMARY, seen.values())[-1]
                        seen = Counter({u: n - least for u, n in seen.items() if n > least})
        top = heapq.nlargest(SENT, ((n, u) for u, n in seen.items() if u and len(u) <= LONGEST and n > 1))
        yield pa.RecordBatch.from_arrays([pa.array([u for _, u in top], pa.string()), pa.array([n for n, _ in top], pa.int64())], ["unit", "n"])

    found = map_arrow(docs.select("text"), run, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "unit").limit(size)
    return [r["unit"] for r in found.collect()]


class UnitLengths(dict):
    """Tokens of each unit: starts as the broadcast table, grows by what the worker encodes, up to a bound."""

    def __init__(self, source: str, table: dict[str, int]):
        super().__init__(table)
        self.table, self.tokenizer, self.signs = table, _load(source), {}

    def __missing__(self, unit: str) -> int:
        parts = _WORD_AND_SIGNS.fullmatch(unit)
        if parts:
            signs = self.signs.get(parts[2])
            if signs is None:
                signs = self.length(parts[2])
                if len(self.signs) < 10_000 and len(parts[2]) <= LONGEST:
                    self.signs[parts[2]] = signs
            return self[parts[1]] + signs
        n = self.length(" " + unit)
        if len(unit) <= LONGEST:
            if len(self) >= REMEMBERED + len(self.table):
                self.clear()
                self.update(self.table)
            self[unit] = n
        return n

    def length(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def count(self, text: str) -> int:
        if not text:
            return 0
        first, *rest = units(text)
        return (self.length(first) if first else 0) + sum(map(self.__getitem__, rest))


#: One per worker process: (broadcast, lengths).
_LENGTHS: dict[int, UnitLengths] = {}


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", table_size: int = TABLE) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens of each whole text."""
    rows = id_and_text(docs, id_col, text_col)
    source = read_tokenizer(tokenizer_path)
    tokenizer, frequent = _load(source), frequent_units(rows, table_size)
    table = {u: len(e.ids) for u, e in zip(frequent, tokenizer.encode_batch([" " + u for u in frequent], add_special_tokens=False), strict=True)}
    held = docs.sparkSession.sparkContext.broadcast((source, table))

    def run(batches):
        key = hash((held.value[0], len(held.value[1]), tuple(list(held.value[1])[:50])))
        if key not in _LENGTHS:
            _LENGTHS.clear()
            _LENGTHS[key] = UnitLengths(*held.value)
        lengths = _LENGTHS[key]
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array([lengths.count(t) for t in texts], pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    sized = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    return map_arrow(sized, run, "doc_id long, n_bytes long, n_tokens long")
