"""BPE encoding by backtracking over longest matches, decoding by an offset table.

Encoding of a word: an Aho-Corasick automaton over the vocabulary gives the longest
token from each place on, a table the next shorter token that starts like it.  From the
left, the longest token is taken that is *compatible* with the token before it; when
none is, the last token is taken back and its end is never tried again.  Two tokens are
compatible if merging their symbols by rank gives just these two; that only
depends on the merges along the edge where they meet, and the answers make up the
pair table, filled as pairs turn up.  A sequence whose neighbours are all
compatible is the merge result, so the output is exact, and since every
place is given up at most once the time is linear in the word.

Decoding: token strings lie one after the other in one byte array; an offset
table gives their places, and the bytes of all tokens are gathered at once.

The tokenizer file (JSON with its normalizer, word pattern, vocabulary and merges)
is read on the driver and sent to the tasks, once for each; its size bounds
what is broadcast.  Documents are mapped without any shuffle.

Defined cases: a null text is empty; an empty text has no tokens and decodes to
an empty text; special strings in a text become their special tokens; null ids
and repeated rows are mapped like any other; columns other than id and text are
not read.
"""

from __future__ import annotations

import json
import re
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .common import id_and_text, map_arrow

#: The symbol for a byte that ends a word, where the tokenizer marks word ends.
_END = 0xE000
#: White space as the tokenizer's patterns see it (``str.split`` also splits at some control characters).
_SPACE = re.compile("[" + "".join(map(chr, (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))) + "]+")
_CONTROL = re.compile("[\x1c-\x1f]")
#: Byte-level characters of the bytes that aren't printable themselves, in order from U+0100.
_BYTE_LEVEL = {b: 0x100 + k for k, b in enumerate(b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF))}


# The normalizer and word pattern that the quick way in ChunkCache stands for.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_WORD_PATTERN = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


class PairTable:
    """Which tokens may stand side by side, decided by the merges; a symbol is a token without parts."""

    KEPT = 200_000

    def __init__(self, parts: dict[str, tuple[str, str]], rank: dict[str, int]):
        self.parts, self.rank = parts, rank
        self.merge_rank = {p: rank[t] for t, p in parts.items()}
        self.never = len(rank) + 1
        self.edges: tuple[dict, dict] = ({}, {})
        self.known: dict[tuple[str, str], bool] = {}
        self.known_before: dict[tuple[str, str], bool] = {}

    def edge(self, token: str, side: int) -> list[tuple[str, int]]:
        """Tokens along one edge of ``token`` from its outer symbol up, each with the rank of the merge that uses it up."""
        out = self.edges[side].get(token)
        if out is None:
            out, now = [(token, self.never)], token
            while now in self.parts:
                at, now = self.rank[now], self.parts[now][side]
                out.append((now, at))
            out.reverse()
            self.edges[side][token] = out
        return out

    def apart(self, a: str, b: str, until: int) -> bool:
        """Whether no merge of a rank below ``until`` joins the end of ``a`` with the start of ``b``."""
        right, left = self.edge(a, 1), self.edge(b, 0)
        i = j = 0
        while True:
            (x, x_used), (y, y_used) = right[i], left[j]
            r = self.merge_rank.get((x, y), self.never)
            # of equal pairs in a row the leftmost merges first
            if r < until and r < x_used and r <= y_used:
                return False
            if x_used == self.never and y_used == self.never:
                return True
            if x_used <= y_used:
                i += 1
            else:
                j += 1

    def compatible(self, a: str, b: str) -> bool:
        ok = self.known.get((a, b))
        if ok is None:
            ok = self.known_before.get((a, b))
            if ok is None:
                ok = self.apart(a, b, self.never)
            if len(self.known) >= self.KEPT:
                self.known, self.known_before = {}, self.known
            self.known[a, b] = ok
        return ok


class Vocabulary:
    """Automaton and pair table of one tokenizer file."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("ignore_merges") or model.get("byte_fallback"):
            raise ValueError("only plain BPE with or without word ends is supported")
        special = spec.get("added_tokens") or []
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or _SPACE.search(t["content"]) for t in special):
            raise ValueError("special tokens that take in their surroundings are not supported")
        self.suffix = model.get("end_of_word_suffix") or ""
        #: Whether text of plain letters and signs is normalized by lower-casing alone.
        self.lowers = json.dumps([spec.get("normalizer"), spec.get("pre_tokenizer")], sort_keys=True) == json.dumps([_NORMALIZER, _WORD_PATTERN], sort_keys=True)
        self.tokenizer = Tokenizer.from_str(source)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        parts = {self.symbols(a + b): (self.symbols(a), self.symbols(b)) for a, b in merges}
        if len(parts) != len(merges):
            raise ValueError("a token has more than one merge")
        self.pairs = PairTable(parts, {t: r for r, t in enumerate(parts)})
        self.id = {self.symbols(t): i for t, i in model["vocab"].items()}
        self.automaton = ahocorasick.Automaton()
        made: dict[str, bool] = {}
        for t in self.id:
            if len(t) == 1:
                made[t] = True
        for t, (a, b) in parts.items():  # by rank: the parts come first
            made[t] = made.get(a, False) and made.get(b, False) and self.pairs.apart(a, b, self.pairs.rank[t])
        for t, ok in made.items():
            if ok and t in self.id:
                self.automaton.add_word(t, t)
        self.automaton.make_automaton()
        self.shorter: dict[str, str | None] = {}
        self.special = {t["content"]: t["id"] for t in special}
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if special else None

    def symbols(self, token: str) -> str:
        """A token of the file with one character for each symbol."""
        if self.suffix and token.endswith(self.suffix) and len(token) > len(self.suffix):
            bare = token[: -len(self.suffix)]
            return bare[:-1] + chr(_END + ord(bare[-1]))
        return token

    def next_shorter(self, token: str) -> str | None:
        """The longest token that is a proper prefix of ``token``."""
        out = next((token[:n] for n in range(len(token) - 1, 0, -1) if token[:n] in self.automaton), None)
        self.shorter[token] = out
        return out

    def word(self, word: str) -> list[int]:
        """Token ids of one word of byte-level characters."""
        s = word[:-1] + chr(_END + ord(word[-1])) if self.suffix else word
        if s in self.id and s in self.automaton:
            return [self.id[s]]
        longest, known, compatible, shorter = self.automaton.iter_long, self.pairs.known, self.pairs.compatible, self.shorter
        # longest matches one after the other, as far as they are compatible
        taken: list[str] = []
        at, before = 0, None
        for _, token in longest(s):
            if before is not None and not (known[before, token] if (before, token) in known else compatible(before, token)):
                break
            taken.append(token)
            at += len(token)
            before = token
        size = len(s)
        if at == size:
            return [self.id[t] for t in taken]
        if not taken or not s.startswith(token, at):
            raise ValueError(f"no tokens for {word!r}")
        known = self.pairs.known
        given_up = set()
        token = shorter[token] if token in shorter else self.next_shorter(token)
        while True:
            while token is not None:
                end = at + len(token)
                if end not in given_up and (before is None or (known[before, token] if (before, token) in known else compatible(before, token))):
                    break
                token = shorter[token] if token in shorter else self.next_shorter(token)
            if token is None:
                if not taken:
                    raise ValueError(f"no tokens for {word!r}")
                given_up.add(at)
                token = taken.pop()
                at -= len(token)
                before = taken[-1] if taken else None
                token = shorter[token] if token in shorter else self.next_shorter(token)
            else:
                taken.append(token)
                at, before = end, token
                if at == size:
                    return [self.id[t] for t in taken]
                token = next(longest(s, at))[1]

    def chunk(self, chunk: str) -> tuple[int, ...]:
        """Token ids of text without white space."""
        out: list[int] = []
        for k, piece in enumerate(self.special_pattern.split(chunk) if self.special_pattern else [chunk]):
            if k % 2:
                out.append(self.special[piece])
            elif piece:
                if self.tokenizer.normalizer:
                    piece = self.tokenizer.normalizer.normalize_str(piece)
                for word, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(piece):
                    out += self.word(word)
        return tuple(out)

class OffsetTable:
    """Token strings in one byte array, each with a space after it, and where they start."""

    def __init__(self, source: str):
        spec = json.loads(source)
        strings = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec.get("added_tokens") or []}
        texts = [(strings[i] + " ").encode() if i in strings else b"" for i in range(max(strings, default=-1) + 1)]
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)

    def decode(self, ids: np.ndarray) -> str:
        """The token strings of ``ids``, joined by spaces."""
        out = []
        for at in range(0, len(ids), 1 << 18):
            part = ids[at : at + (1 << 18)]
            start, size = self.offsets[part], self.offsets[part + 1] - self.offsets[part]
            to = np.cumsum(size) - size
            out.append(self.bytes[np.repeat(start - to, size) + np.arange(int(size.sum()))].tobytes())
        return b"".join(out)[:-1].decode()


#: Letters and signs that normalization only lower-cases, and that the word pattern splits into two words.
_PLAIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?$%&#*|]*)")


class ChunkCache(dict):
    """Ids of chunks seen before, and of the words under them; each in two generations, of which the older one goes when the younger is full.  Long chunks are not kept."""

    KEPT, LONGEST = 150_000, 48

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.before: dict[str, tuple[int, ...]] = {}
        self.words: dict[str, tuple[int, ...]] = {}
        self.words_before: dict[str, tuple[int, ...]] = {}

    def word(self, word: str) -> tuple[int, ...]:
        out = self.words.get(word)
        if out is None:
            out = self.words_before.get(word)
            if out is None:
                out = tuple(self.vocabulary.word(word if word.isascii() else word.encode().decode("latin-1").translate(_BYTE_LEVEL)))
            if len(word) <= self.LONGEST:
                if len(self.words) >= self.KEPT:
                    self.words, self.words_before = {}, self.words
                self.words[word] = out
        return out

    def __missing__(self, chunk: str) -> tuple[int, ...]:
        out = self.before.get(chunk)
        if out is None:
            plain = _PLAIN.fullmatch(chunk) if self.vocabulary.lowers else None
            if plain:
                out = self.word(plain[1].lower())
                if plain[2]:
                    out += self.word(plain[2])
            else:
                out = self.vocabulary.chunk(chunk)
        if len(chunk) <= self.LONGEST:
            if len(self) >= self.KEPT:
                self.before = dict(self)
                self.clear()
            self[chunk] = out
        return out

    def ids(self, text: str) -> np.ndarray:
        chunks = [c for c in _SPACE.split(text) if c] if _CONTROL.search(text) else text.split()
        return np.fromiter(chain.from_iterable(map(self.__getitem__, chunks)), np.int32)


#: One per worker process and tokenizer file.
_CACHES: dict[int, ChunkCache] = {}


def _cache(source: str) -> ChunkCache:
    key = hash(source)
    if key not in _CACHES:
        _CACHES.clear()
        _CACHES[key] = ChunkCache(Vocabulary(source))
    return _CACHES[key]


def read_tokenizer(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        source = f.read()
    spec = json.loads(source)
    pre = json.dumps(spec.get("pre_tokenizer"))
    if '"Removed"' not in pre and "WhitespaceSplit" not in pre:
        raise ValueError("words must not hold white space")
    return source


def _lists(ids: list[np.ndarray]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(x) for x in ids])], pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids: the token ids of each whole text."""
    held = docs.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer_path))

    def run(batches):
        cache = _cache(held.value)
        for batch in batches:
            ids = [cache.ids(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _lists(ids)], ["doc_id", "ids"])

    return map_arrow(id_and_text(docs, id_col, text_col), run, "doc_id long, ids array<int>")


def encode_and_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids, decoded: ``decode(encode(docs))`` in one pass, with one Python worker for both."""
    held = docs.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer_path))

    def run(batches):
        cache, table = _cache(held.value), OffsetTable(held.value)
        for batch in batches:
            ids = [cache.ids(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _lists(ids), pa.array([table.decode(x) for x in ids], pa.string())], ["doc_id", "ids", "decoded"])

    return map_arrow(id_and_text(docs, id_col, text_col), run, "doc_id long, ids array<int>, decoded string")


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, ids, decoded: the token strings of ``ids``, joined by spaces as the library does without a decoder."""
    held = encoded.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer_path))

    def run(batches):
        table = OffsetTable(held.value)
        for batch in batches:
            ids = batch.column("ids")
            flat, at = ids.flatten().to_numpy(), np.r_[0, np.cumsum(np.array(ids.value_lengths().fill_null(0)))]
            texts = [table.decode(flat[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"])

    return map_arrow(encoded.select("doc_id", "ids"), run, "doc_id long, ids array<int>, decoded string")
