"""SimHash near-dedup with Golay-code fuzzy hashing.

Fingerprint: 64 bits, each set where more than half of the hashes of the
document's word shingles (repeats included) have it set.

Search: a fingerprint is cut into three segments of 22, 21 and 21 bits, each
padded with zeros to a word of the perfect binary Golay code (23, 12), whose
decoder maps *every* 23-bit word to the one codeword within three bits.  Two
fingerprints at most two bits apart have a midpoint at most one bit from either
(pigeonhole: a side has to change one bit of one segment at most), so the keys
of a fingerprint are the three codeword indices (36 bits) of itself and of its
64 one-bit neighbours.  Most of those decode alike: there are at most 16
different keys.  Fingerprints that share a key are joined and verified by the
number of differing bits.

A key that more than ``BUCKET`` different fingerprints share is not joined
pair by pair: its fingerprints are grouped by the midpoints themselves instead.
Sharing a midpoint is the same as being at most two bits apart, no
group can have more than 65 members, and one link from each member to the
least is enough for the components.  So no link is lost and no group's pairs
are written out.

Equal fingerprints are one vertex, however many documents have them.  Defined
cases: a null text is empty; a text without words has fingerprint zero and is
linked like any other; repeated rows each get a row; a null id is never the
smallest of a component unless all are null; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, id_and_text, map_arrow, one_of_repeats, text_key
from .components import components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: Up to so many different fingerprints under one key are compared pair by pair.
BUCKET = 64

# ---------------------------------------------------------------- fingerprint

#: A-Z to a-z; vertical tab and the like to a space. Other bytes stay.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else 32 if 9 <= b <= 13 else b for b in range(256))
#: Shingles hashed at a time.
_SLICE = 1 << 16


def words_of(text: bytes) -> list[bytes]:
    return [w for w in text.translate(_FOLD).split(b" ") if w]


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = words_of(text)
    if not words:
        return 0
    total, bits = max(1, len(words) - shingle + 1), np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, _SLICE):
        h = np.array([digest(b" ".join(words[i : i + shingle]), SEED) for i in range(at, min(total, at + _SLICE))], np.uint64)
        bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > total, bitorder="little").tobytes(), "little", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, key (hash of the text), fp (the 64 bits as a signed long)."""

    def run(batches):
        for batch in batches:
            fp = [fingerprint(x.as_py(), shingle) for x in batch.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(fp, pa.int64())], ["doc_id", "key", "fp"])

    return map_arrow(id_and_text(docs, id_col, text_col).withColumn("key", text_key(F.col("text"))), run, "doc_id long, key long, fp long")


# ---------------------------------------------------------------- Golay code

#: Generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 of the binary Golay code.
_GENERATOR = 0b110001110101


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words by the generator."""
    rest = words.astype(np.int64).copy()
    for bit in range(22, 10, -1):
        rest ^= np.where(rest >> bit & 1, _GENERATOR << (bit - 11), 0)
    return rest


def _error_table() -> np.ndarray:
    """The error of at most three bits that has each syndrome; the code is perfect, so each has just one."""
    bits = [0] + [1 << i for i in range(23)]
    errors = np.unique(np.array([x | y | z for x in bits for y in bits for z in bits], np.int64))
    table = np.zeros(1 << 11, np.int64)
    table[_syndromes(errors)] = errors
    return table


_ERRORS = _error_table()
#: Offset and width of the segments of a fingerprint.
SEGMENTS = ((0, 22), (22, 21), (43, 21))


def codeword_index(words: np.ndarray) -> np.ndarray:
    """12-bit index (the message bits) of the codeword nearest to each 23-bit word."""
    return (words ^ _ERRORS[_syndromes(words)]) >> 11


def golay_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, flipped bit) for each fingerprint and each of its 65 midpoints; bit 64 stands for none flipped."""
    fp = fp.astype(np.uint64)
    base, changed = [], []
    for at, width in SEGMENTS:
        seg = (fp >> np.uint64(at)).astype(np.int64) & ((1 << width) - 1)
        base.append(codeword_index(seg))
        changed.append(codeword_index(seg[:, None] ^ (1 << np.arange(width))[None, :]))
    own = base[0] << 24 | base[1] << 12 | base[2]
    shift = (24, 12, 0)
    parts = [(own & ~(0xFFF << shift[k]))[:, None] | changed[k] << shift[k] for k in range(3)]
    keys = np.concatenate([*parts, own[:, None]], axis=1)
    n = len(fp)
    return np.repeat(np.arange(n), 65), keys.ravel(), np.tile(np.arange(65), n)


def _key_rows(batches):
    for batch in batches:
        fp = batch.column("fp").to_numpy()
        for at in range(0, len(fp), 4096):
            part = fp[at : at + 4096]
            row, key, _ = golay_keys(part.view(np.uint64))
            pair = np.unique(np.stack([row, key]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pair[1]), pa.array(part[pair[0]])], ["key", "fp"])


def _midpoint_rows(batches):
    """Of (key, fp): the midpoints of fp that decode to key."""
    for batch in batches:
        want, fp = batch.column("key").to_numpy(), batch.column("fp").to_numpy()
        for at in range(0, len(fp), 4096):
            part = fp[at : at + 4096].view(np.uint64)
            row, key, bit = golay_keys(part)
            ok = key == want[at : at + 4096][row]
            flip = np.where(bit < 64, np.uint64(1) << np.minimum(bit, 63).astype(np.uint64), np.uint64(0))
            mid = part[row[ok]] ^ flip[ok]
            yield pa.RecordBatch.from_arrays([pa.array(mid.view(np.int64)), pa.array(part[row[ok]].view(np.int64))], ["mid", "fp"])


def links(distinct: DataFrame, bucket: int = BUCKET, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): links between different fingerprints that have the same components as all links of ``max_bits`` or fewer.

    ``distinct``: column fp, each value once.  Keys of at most ``bucket``
    fingerprints give every link; larger ones give each member's link to the least
    of each midpoint it shares.
    """
    if not 0 < max_bits <= 2:
        raise ValueError("the segments tolerate one or two differing bits")
    keys = cut(map_arrow(distinct.select("fp"), _key_rows, "key long, fp long"))
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = cut(keys.join(sizes, "key"))
    small = shared.filter(F.col("n") <= bucket).select("key", "fp")
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = small.withColumnRenamed("fp", "a").join(small.withColumnRenamed("fp", "b"), "key").filter((F.col("a") < F.col("b")) & (apart <= max_bits)).select("a", "b")
    hot = shared.filter(F.col("n") > bucket).select("key", "fp")
    if hot.isEmpty():
        return pairs.distinct()
    if max_bits == 2:
        mids = cut(map_arrow(hot, _midpoint_rows, "mid long, fp long").distinct())
        stars = mids.join(mids.groupBy("mid").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "mid").filter("fp <> b").select(F.col("fp").alias("a"), "b")
    else:
        # one bit apart: the other fingerprint is itself one of the midpoints
        mids = map_arrow(hot, _midpoint_rows, "mid long, fp long").distinct().filter("mid <> fp")
        stars = mids.join(distinct.select(F.col("fp").alias("mid")), "mid", "left_semi").select(F.col("fp").alias("a"), F.col("mid").alias("b"))
    return pairs.unionAll(stars).distinct()


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """doc_id, key, fp, component_id (smallest doc_id reachable over links, itself included)."""
    return _rooted_groups(docs, id_col, text_col, shingle, max_bits, bucket).drop("root")


def _rooted_groups(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int, bucket: int) -> DataFrame:
    """``near_groups`` with the root of the component: components can share their smallest doc_id."""
    rows = cut(fingerprints(docs, id_col, text_col, shingle))
    distinct = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(distinct, bucket, max_bits)).select(F.col("id").alias("fp"), "root")
    member = distinct.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = member.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = cut(member.join(least, "root").select("fp", "component_id", "root"))
    return rows.join(classes, "fp").select("doc_id", "key", "fp", "component_id", "root")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with all its columns, one row of each component: the smallest id, and any one of the rows that share it."""
    groups = cut(_rooted_groups(docs, id_col, text_col, shingle, max_bits, BUCKET))
    least = F.col("doc_id").eqNullSafe(F.col("component_id"))
    # of the texts that share the smallest id of a component, that of the least key
    firsts = groups.filter(least).groupBy("root", F.col("doc_id").alias("__id"), F.col("key").alias("__key")).agg(F.count(F.lit(1)).alias("n"))
    stays = firsts.groupBy("root").agg(F.min("__key").alias("stays"))
    firsts = firsts.join(stays, "root").withColumn("kept", F.col("__key") == F.col("stays")).filter("not kept or n > 1")
    later = groups.filter(~least).select(F.col("doc_id").alias("__id"), F.col("key").alias("__key")).distinct()
    rows = cut(firsts.select("__id", "__key", "kept").unionAll(later.withColumn("kept", F.lit(False))))

    def same(side):
        return docs[id_col].cast("long").eqNullSafe(side["__id"]) & (text_key(docs[text_col]) == side["__key"])

    gone, repeats = rows.select("__id", "__key"), rows.filter("kept").select("__id", "__key")
    rest = docs.join(gone, same(gone), "left_anti")
    if repeats.isEmpty():
        return rest
    return rest.unionAll(one_of_repeats(docs, repeats, same(repeats)))
