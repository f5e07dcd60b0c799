"""Benchmark decontamination by a prefix-filtered set join on item-sized windows.

Every item is cut into windows of ten consecutive words (an item of fewer words
is one window).  A window is a set of three-word shingles (its whole word
sequence when it is shorter).  All shingles of the items are ordered by their
rarity in the documents, counted over every document.  A window can only occur
in a document that holds *all* its shingles, so the overlap asked for is the
whole set and the necessary prefix of a window is its one rarest shingle.
Documents are joined on prefix shingles only; the place of the shingle in the
window bounds where the window starts (positional bound) and the document has
to reach to its end (length bound); what is left is compared word by word.

The item side is a table of windows whose bytes are counted first; a window that many items
share is kept once, with the list of its items.  It is cut
into blocks of at most ``BLOCK_BYTES`` (a longer item into runs that overlap by a
window less one word); each block is broadcast and meets every
document twice (rarity, join).  With one block, the usual case, nothing of the documents' size is
shuffled; with several, documents are read twice for each, and the hits
of the blocks of a document are united by one shuffle of hit spans.

Defined cases: a null or empty text, and one without words, has no words and no
hits; items without words have no windows; repeated items with one id count
once; an empty item table marks nothing; repeated document ids keep a row each;
other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, id_and_text, map_arrow, text_key, without

WINDOW = 10
SHINGLE = 3
#: Bytes of item words that one broadcast block may hold.
BLOCK_BYTES = 8 << 20

#: Word characters: a-z, digits and all that is not ASCII; A-Z fold to a-z, all else separates.
_FOLD = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def windows_of(words: list[bytes], size: int = WINDOW) -> list[tuple[bytes, ...]]:
    if not words:
        return []
    return [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]


class ItemBlock:
    """Windows of some items as arrays: word numbers, shingles, and for each window its prefix shingle."""

    def __init__(self, items: list[tuple[str, bytes]], size: int = WINDOW, shingle: int = SHINGLE):
        self.names = sorted({i for i, _ in items})
        place = {name: k for k, name in enumerate(self.names)}
        self.number: dict[bytes, int] = {}
        seqs, starts, lengths, of, at = [], [], [], [], 0
        for name, text in items:
            words = words_of(text)
            n = len(words)
            if n:
                seqs.append(np.array([self.number.setdefault(w, len(self.number)) for w in words], np.int64))
                many = max(1, n - size + 1)
                starts.append(np.arange(at, at + many))
                lengths.append(np.full(many, min(n, size)))
                of.append(np.full(many, place[name]))
                at += n
        none = [np.zeros(0, np.int64)]
        self.seq = np.concatenate(seqs or none)
        start, length, item = (np.concatenate(x or none).astype(np.int64) for x in (starts, lengths, of))
        self._distinct(start, length, item)
        self.shingle = np.minimum(self.length, shingle)
        if (len(self.number) + 1) ** shingle >= 2**63:
            raise ValueError("a block has too many distinct words; lower block_bytes")
        #: Distinct shingles by length, as sorted codes, and the number of the first.
        self.codes: dict[int, np.ndarray] = {}
        self.first: dict[int, int] = {}
        known = 0
        for n in sorted(set(self.shingle.tolist())):
            w = np.flatnonzero(self.shingle == n)
            room = self.length[w] - n
            at_ = np.unique(np.concatenate([self.start[w[room >= k]] + k for k in range(int(room.max()) + 1)]))
            self.codes[n] = np.unique(shingle_codes(self.seq, at_, n, len(self.number)))
            self.first[n] = known
            known += len(self.codes[n])
        self.known = known

    def _distinct(self, start: np.ndarray, length: np.ndarray, item: np.ndarray) -> None:
        """Each different window once, with the items that have it."""
        starts, lengths, owners, known = [], [], [], 0
        for n in np.unique(length).tolist():
            w = np.flatnonzero(length == n)
            _, first, same = np.unique(sequence_ranks(self.seq, n)[start[w]], return_index=True, return_inverse=True)
            starts.append(start[w[first]])
            lengths.append(np.full(len(first), n))
            owners.append(np.unique((known + same) * len(self.names) + item[w]))
            known += len(first)
        none = [np.zeros(0, np.int64)]
        self.start, self.length, owners = (np.concatenate(x or none).astype(np.int64) for x in (starts, lengths, owners))
        many = max(1, len(self.names))
        self.items = owners % many
        self.items_from = np.searchsorted(owners // many, np.arange(known + 1))

    def items_of(self, windows: np.ndarray) -> list[str]:
        """Ids of the items that have one of the windows."""
        low, high = self.items_from[windows], self.items_from[windows + 1]
        many = high - low
        at = np.repeat(low - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(int(many.sum()))
        return [self.names[i] for i in np.unique(self.items[at])]

    def choose_prefixes(self, counts: np.ndarray) -> None:
        """The rarest shingle of each window (ties: the smaller number) and its first place in the window."""
        best = np.full(len(self.start), np.iinfo(np.int64).max)
        self.offset = np.zeros(len(self.start), np.int64)
        for n, codes in self.codes.items():
            w = np.flatnonzero(self.shingle == n)
            for k in range(int((self.length[w] - n).max()) + 1):
                v = w[self.length[w] - n >= k]
                number = self.first[n] + np.searchsorted(codes, shingle_codes(self.seq, self.start[v] + k, n, len(self.number)))
                key = counts[number] * (self.known + 1) + number
                less = key < best[v]
                best[v[less]], self.offset[v[less]] = key[less], k
        prefix = best % (self.known + 1)
        self.by_prefix = np.argsort(prefix, kind="stable")
        self.bounds = np.searchsorted(prefix[self.by_prefix], np.arange(self.known + 1))
        used = np.diff(self.bounds) > 0
        #: Only prefix shingles are looked up in the join.
        self.prefix_codes = {n: (c[used[self.first[n] : self.first[n] + len(c)]], self.first[n] + np.flatnonzero(used[self.first[n] : self.first[n] + len(c)])) for n, c in self.codes.items()}

    def found(self, ids: np.ndarray):
        """(number of each shingle, places) of all item shingles in a document."""
        for n, codes in self.codes.items():
            at, j = look_up(ids, codes, n, len(self.number))
            yield self.first[n] + j, at

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, list[str]]:
        """(words of the document inside an occurring window, ids of those windows' items)."""
        covered, items = np.zeros(len(ids) + 1, np.int64), []
        for n, (codes, numbers) in self.prefix_codes.items():
            at, j = look_up(ids, codes, n, len(self.number))
            if not len(at):
                continue
            low, high = self.bounds[numbers[j]], self.bounds[numbers[j] + 1]
            many = high - low
            at = np.repeat(at, many)
            w = self.by_prefix[np.repeat(low - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(len(at))]
            start = at - self.offset[w]
            ok = (start >= 0) & (start + self.length[w] <= len(ids))
            w, start = w[ok], start[ok]
            for k in range(int(self.length.max())):
                inside = k < self.length[w]
                same = ~inside
                same[inside] = ids[start[inside] + k] == self.seq[self.start[w[inside]] + k]
                w, start = w[same], start[same]
            np.add.at(covered, start, 1)
            np.add.at(covered, start + self.length[w], -1)
            if len(w):
                items += self.items_of(np.unique(w))
        return np.flatnonzero(np.cumsum(covered[:-1]) > 0), sorted(set(items))


def sequence_ranks(seq: np.ndarray, n: int) -> np.ndarray:
    """One exact number for the ``n`` words from each place of ``seq``: equal numbers, equal words; found by doubling."""

    def joined(a, b, gap):
        a, b = a[: len(b) - gap], b[gap:]
        return np.unique(a * (int(b.max()) + 1 if len(b) else 1) + b, return_inverse=True)[1]

    out, length, power, size = None, 0, seq, 1
    while True:
        if n & size:
            out, length = (power, size) if out is None else (joined(out, power, length), length + size)
        if length == n:
            return out
        power, size = joined(power, power, size), 2 * size


def shingle_codes(seq: np.ndarray, at: np.ndarray, n: int, vocabulary: int) -> np.ndarray:
    """One exact number for the ``n`` words from each place."""
    code = np.zeros(len(at), np.int64)
    for k in range(n):
        code = code * (vocabulary + 1) + seq[at + k]
    return code


def look_up(ids: np.ndarray, codes: np.ndarray, n: int, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, positions in ``codes``) of the shingles of a document; -1 in ``ids`` is a word that no item has."""
    m = len(ids) - n + 1
    none = np.zeros(0, np.int64)
    if m <= 0 or not len(codes):
        return none, none
    ok = ids[:m] >= 0
    for k in range(1, n):
        ok &= ids[k : k + m] >= 0
    at = np.flatnonzero(ok)
    code = shingle_codes(ids, at, n, vocabulary)
    j = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
    hit = codes[j] == code
    return at[hit], j[hit]


def _ids(words: list[bytes], number: dict[bytes, int]) -> np.ndarray:
    get = number.get
    return np.fromiter([get(w, -1) for w in words], np.int64, len(words))


def _texts(batch: pa.RecordBatch):
    for x in batch.column("text").cast(pa.binary()):
        yield x.as_py()


def _rarity(docs: DataFrame, block: ItemBlock) -> np.ndarray:
    """Occurrences of each item shingle in all documents; tasks send sums, the result is no larger than the block."""
    held = docs.sparkSession.sparkContext.broadcast(block)

    def count(batches):
        b = held.value
        total = np.zeros(b.known, np.int64)
        for batch in batches:
            for text in _texts(batch):
                for numbers, _ in b.found(_ids(words_of(text), b.number)):
                    np.add.at(total, numbers, 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["shingle", "n"])

    counts = np.zeros(block.known, np.int64)
    for r in map_arrow(docs.select("text"), count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[r["shingle"]] = r["n"]
    return counts


def _spans(at: np.ndarray) -> list[list[int]]:
    """Runs of consecutive places as [start, end)."""
    if not len(at):
        return []
    breaks = np.flatnonzero(np.diff(at) > 1)
    return [[int(a), int(b) + 1] for a, b in zip(at[np.r_[0, breaks + 1]], at[np.r_[breaks, len(at) - 1]], strict=True)]


SCHEMA = "row long, doc_id long, key long, n_words long, spans array<array<long>>, items array<string>"


def _join_block(docs: DataFrame, block: ItemBlock) -> DataFrame:
    block.choose_prefixes(_rarity(docs, block))
    held = docs.sparkSession.sparkContext.broadcast(block)

    def find(batches):
        b = held.value
        for batch in batches:
            n_words, spans, items = [], [], []
            for text in _texts(batch):
                words = words_of(text)
                n_words.append(len(words))
                at, of = b.hits(_ids(words, b.number))
                spans.append(_spans(at))
                items.append(of)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), batch.column("key"), pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(items, pa.list_(pa.string()))],
                ["row", "doc_id", "key", "n_words", "spans", "items"],
            )

    return map_arrow(docs, find, SCHEMA)


def item_runs(text: bytes, block_bytes: int, size: int = WINDOW):
    """The text, or, of a text over ``block_bytes``, runs of its words that share all but one word of a window with the next run."""
    if len(text) <= block_bytes:
        yield text
        return
    words = words_of(text)
    ends = np.cumsum([len(w) + 1 for w in words])
    start = 0
    while start < len(words):
        before = int(ends[start - 1]) if start else 0
        end = max(start + size, int(np.searchsorted(ends, before + block_bytes, "right")))
        yield b" ".join(words[start:end])
        if end >= len(words):
            return
        start = end - (size - 1)


def item_blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES):
    """The items in blocks of bounded bytes, one block in the driver at a time; a long item is in several."""
    block, size = [], 0
    for r in items.toLocalIterator():
        for text in item_runs(r["text"].encode(), block_bytes):
            if block and size + len(text) > block_bytes:
                yield block
                block, size = [], 0
            block.append((r["item"], text))
            size += len(text)
    yield block


def find_windows(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, key (hash of the text), n_words, spans (hit runs of words, [start, end)), items (ids of items with an occurring window)."""
    items = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string").alias("text")).filter(F.col("text").isNotNull())
    rows = id_and_text(docs, id_col, text_col).select(F.monotonically_increasing_id().alias("row"), "doc_id", text_key(F.col("text")).alias("key"), "text")
    several = (items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) > block_bytes
    if several:
        rows = cut(rows)  # so that a row keeps its number over the blocks
    out = None
    for block in item_blocks(items, block_bytes):
        found = _join_block(rows, ItemBlock(block))
        out = found if out is None else out.unionByName(found)
    if several:
        out = (
            out.groupBy("row", "doc_id", "key")
            .agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
            .withColumn("spans", F.expr(_MERGE))
        )
    return out.select("doc_id", "key", "n_words", "spans", "items")


#: Overlapping and touching runs united.
_MERGE = """aggregate(array_sort(spans), cast(array() as array<array<bigint>>), (done, s) ->
    case when size(done) > 0 and s[0] <= element_at(done, -1)[1]
         then concat(slice(done, 1, size(done) - 1), array(array(element_at(done, -1)[0], greatest(element_at(done, -1)[1], s[1]))))
         else concat(done, array(s)) end)"""


def hit_counts(found: DataFrame) -> DataFrame:
    """The digest columns of ``find_windows``."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns, without the documents that hold a window of an item."""
    return without(docs, find_windows(docs, items, id_col, text_col).filter(F.size("spans") > 0), id_col, text_col)
