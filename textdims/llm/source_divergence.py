"""Divergence of the sources of a language, from bitmaps of terms by their counts.

Terms (runs of letters and of characters beyond ASCII, A-Z folded) are counted by
language and source; a language keeps the terms that at least ``LEAST_DOCS`` of its documents hold.
A group's share of a term is smoothed and scaled to ``SCALE`` in whole numbers, so
it depends on the group and the term's *count* alone.  Two groups' divergence is the
sum of (p - q)^2 / (p + q) over all kept terms, also those that one or both lack.

For every (group, count) the numbers of its terms are stored as a bitset.  For a pair of
groups, AND and popcount of the bitsets of two counts give how many terms have
just these counts in the two groups; each such cell adds its size times one value of
the formula.  Cells with a count of zero have no bitsets: they come from the complement.
With f0 = f at both zeros, the sum is

  sum over c of |c| f(c, 0) + sum over d of |d| f(0, d) + (V - |g| - |h|) f0     (margins)
  + sum over c, d of |c AND d| (f(c, d) - f(c, 0) - f(0, d) + f0)                  (joint cells)

Scale: texts are counted in the tasks (bounded tables), only counts are shuffled.
Bitsets are cut into blocks of at most ``BLOCK`` terms, of which only the words that are
not empty are stored; a block belongs to one range of terms.  Groups are dealt over
sets of about ``SET`` groups, and one task compares two sets over one block, so neither
a language with a third of the rows nor one with very many sources has to fit
into a task.  The pairs are the result itself.

Defined cases: a null text, language or source is an empty string; documents without
terms still make their group occur; repeated rows count as documents of
their own; a language without kept terms has divergence 0 everywhere; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, map_arrow

LEAST_DOCS, SCALE, TOP = 10, 1_000_000_000, 10
#: Terms of a block of bitsets; groups of a set; different (group, term) pairs that a task counts before it sends them.
BLOCK, SET, COUNTED = 8192, 32, 300_000

#: a-z and all bytes beyond ASCII stay, A-Z fold, the rest separates.
_FOLD = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))
_COUNTS = "lang string, source string, term string, n long, docs long"


def _plain(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)


def _groups(docs: DataFrame) -> DataFrame:
    return docs.select(_plain("lang"), _plain("source")).distinct()


def count_terms(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents that hold it)."""

    def run(batches):
        n: dict[tuple, Counter] = {}
        docs_: dict[tuple, Counter] = {}

        def flush():
            rows = [(g, t, c, docs_[g][t]) for g, terms in n.items() for t, c in terms.items()]
            n.clear()
            docs_.clear()
            terms = pa.array([r[1] for r in rows], pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0][0] for r in rows], pa.string()), pa.array([r[0][1] for r in rows], pa.string()), terms, pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int64())],
                ["lang", "source", "term", "n", "docs"],
            )

        for batch in batches:
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                terms = text.translate(_FOLD).split()
                if terms:
                    n.setdefault((lang, source), Counter()).update(terms)
                    docs_.setdefault((lang, source), Counter()).update(set(terms))
            if sum(map(len, n.values())) > COUNTED:
                yield flush()
        yield flush()

    rows = map_arrow(docs.select(_plain("lang"), _plain("source"), _plain("text")), run, _COUNTS)
    # dealt by term once: the sums here and the choice of kept terms need no other exchange; a term has a row for each task and source at most
    return rows.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """The rows of ``count_terms`` whose term is kept, with lang_n, its occurrences in the language."""
    same = Window.partitionBy("lang", "term")
    both = counts.withColumn("in_docs", F.sum("docs").over(same)).withColumn("lang_n", F.sum("n").over(same))
    return both.filter(F.col("in_docs") >= least_docs).select("lang", "source", "term", "n", "lang_n")


def share(n: str, total: str, kept: str) -> Column:
    """The smoothed share of a count, in whole numbers; exact for any size of the corpus."""
    return F.expr(f"1 + (cast({SCALE} as decimal(10,0)) * cast({n} + 2 as decimal(20,0))) div cast({total} + 2 * {kept} as decimal(20,0))")


def _f(p, q):
    """(p - q)^2 / (p + q), rounded down, of numbers or arrays."""
    return (p - q) * (p - q) // (p + q)


def group_sizes(docs: DataFrame, cells: DataFrame) -> DataFrame:
    """lang, source, total (occurrences of kept terms), lang_total, kept (terms of the language), sets, p0 (share of a term that the group lacks)."""
    languages = cells.groupBy("lang", "term").agg(F.max("lang_n").alias("lang_n")).groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = _groups(docs)
    sets = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / F.lit(SET)).cast("int").alias("sets"))
    rows = groups.join(totals, ["lang", "source"], "left").join(languages, "lang", "left").join(sets, "lang").fillna(0, ["total", "kept", "lang_total"])
    return rows.withColumn("p0", F.when(F.col("kept") > 0, share("0", "total", "kept")).otherwise(1))


def _bitsets(cells: DataFrame, block: int = BLOCK) -> DataFrame:
    """lang, source, block, p (share of each count), ends (end of each count's words), places, words (of 64 terms).

    ``cells`` (lang, source, term, p) are sorted by term; a block holds the terms of a
    language that follow each other in a partition.
    """
    ordered = cells.select("lang", "term", "source", "p").repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")

    def pack(lang, at, rows):
        """The bitsets of one block: ``rows`` are (source, p, term's place)."""
        sources, number = np.unique(np.array([r[0] for r in rows], object), return_inverse=True)
        p, place = np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64)
        order = np.lexsort((place, p, number))
        number, p, place = number[order], p[order], place[order]
        word, bit = place >> 6, np.uint64(1) << (place & 63).astype(np.uint64)
        new_group = np.r_[True, number[1:] != number[:-1]]
        new_level = new_group | np.r_[True, p[1:] != p[:-1]]
        new_word = new_level | np.r_[True, word[1:] != word[:-1]]
        starts = np.flatnonzero(new_word)
        words, places = np.bitwise_or.reduceat(bit, starts), word[starts]
        out = []
        bounds = np.r_[np.flatnonzero(new_group), len(p)]
        rank = np.cumsum(new_word) - 1
        for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            first, last = rank[a], rank[b - 1] + 1
            levels = a + np.flatnonzero(new_level[a:b])
            out.append((lang, sources[k], at, p[levels], np.r_[rank[levels[1:]], last] - first, places[first:last], words[first:last].view(np.int64)))
        return out

    def run(batches):
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << 32
        lang = term = None
        place, rows = -1, []
        for batch in batches:
            done = []
            for lang_, term_, source, p in zip(*[batch.column(c).to_pylist() for c in ("lang", "term", "source", "p")], strict=True):
                if lang_ != lang or term_ != term:
                    place += 1
                    if rows and (lang_ != lang or place == block):
                        done += pack(lang, at, rows)
                        at, rows = at + 1, []
                    if not rows:
                        place = 0
                    lang, term = lang_, term_
                rows.append((source, p, place))
            if done:
                yield _batch(done)
        yield _batch(pack(lang, at, rows) if rows else [])

    return map_arrow(ordered, run, "lang string, source string, block long, p array<long>, ends array<int>, places array<int>, words array<long>")


def _batch(rows) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64())]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["lang", "source", "block", "p", "ends", "places", "words"])


class Levels:
    """The bitsets of one group in one block."""

    def __init__(self, row: dict, width: int):
        self.p = np.array(row["p"], np.int64)
        self.p0, self.set, self.source = row["p0"], row["set"], row["source"]
        self.ends = np.array(row["ends"], np.int64)
        self.places = np.array(row["places"], np.int64)
        self.words = np.array(row["words"], np.int64).view(np.uint64)
        # one row for each word, one column for each count
        self.by_word = np.zeros((width, len(self.p)), np.uint64)
        self.by_word[self.places, np.repeat(np.arange(len(self.p)), np.diff(self.ends, prepend=0))] = self.words

    def joint(self, other: Levels, room: int = 1 << 21):
        """(count of this group, count of the other, terms that have both) of the cells that are not empty."""
        step = max(1, room // max(1, other.by_word.shape[1]))
        low = 0
        while low < len(self.p):
            begin = self.ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(self.ends, begin + step, "right")))
            end = self.ends[high - 1]
            bits = np.bitwise_count(other.by_word[self.places[begin:end]] & self.words[begin:end, None])
            starts = np.r_[begin, self.ends[low : high - 1]] - begin
            cells = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
            c, d = np.nonzero(cells)
            yield c + low, d, cells[c, d]
            low = high


def _compare(rows: list[dict], low: int, high: int, pair):
    """(source, other, value) of all pairs of two sets of groups."""
    for k, g in enumerate(rows):
        for h in rows[k + 1 :]:
            if {g.set, h.set} == {low, high}:
                yield g.source, h.source, pair(g, h)


def _joint_part(g: Levels, h: Levels) -> int:
    if len(g.words) > len(h.words):
        g, h = h, g
    total = 0
    zero = _f(g.p0, h.p0)
    for c, d, n in g.joint(h):
        p, q = g.p[c], h.p[d]
        total += int((n * (_f(p, q) - _f(p, h.p0) - _f(g.p0, q) + zero)).sum())
    return total


class Margins:
    """How many terms of a group have each share."""

    def __init__(self, row: dict):
        self.p, self.size = (np.array([x[c] for x in row["sizes"]], np.int64) for c in ("p", "size"))
        self.p0, self.set, self.source, self.kept = row["p0"], row["set"], row["source"], row["kept"]

    def part(self, other: Margins) -> int:
        own = int((self.size * _f(self.p, other.p0)).sum()) + int((other.size * _f(self.p0, other.p)).sum())
        return own + (self.kept - int(self.size.sum()) - int(other.size.sum())) * _f(self.p0, other.p0)


_PAIRS = "lang string, source string, other string, value long"


def _out(lang, pairs) -> pa.Table:
    pairs = list(pairs)
    return pa.table([pa.array([lang] * len(pairs), pa.string()), pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.string()), pa.array([p[2] for p in pairs], pa.int64())], ["lang", "source", "other", "value"])


def _joint_cells(data: pa.Table) -> pa.Table:
    rows = data.to_pylist()
    width = 1 + max(max(r["places"]) for r in rows)
    return _out(rows[0]["lang"], _compare([Levels(r, width) for r in rows], rows[0]["low"], rows[0]["high"], _joint_part))


def _margin_cells(data: pa.Table) -> pa.Table:
    rows = data.to_pylist()
    return _out(rows[0]["lang"], _compare([Margins(r) for r in rows], rows[0]["low"], rows[0]["high"], Margins.part))


def _meet(rows: DataFrame) -> DataFrame:
    """Each row once for every set of groups that its own set meets."""
    return rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("sets") - 1))).withColumn("low", F.least("set", "with")).withColumn("high", F.greatest("set", "with")).drop("with", "sets")


def pair_divergence(sizes: DataFrame, cells: DataFrame, block: int = BLOCK) -> DataFrame:
    """lang, source, other, value for every ordered pair of different sources of a language.

    ``sizes`` as of ``group_sizes``; ``cells`` (lang, source, term, p) with the share of each count.
    """
    groups = sizes.select("lang", "source", "p0", "kept", "sets", F.pmod(F.xxhash64("source"), F.col("sets")).cast("int").alias("set"))
    bitsets = cut(_bitsets(cells, block)).join(groups.drop("kept"), ["lang", "source"])
    joint = _meet(bitsets).groupBy("lang", "low", "high", "block").applyInArrow(_joint_cells, _PAIRS)
    by_share = cells.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("size")).groupBy("lang", "source").agg(F.collect_list(F.struct("p", "size")).alias("sizes"))
    none = F.array().cast("array<struct<p:bigint,size:bigint>>")
    margins = _meet(groups.join(by_share, ["lang", "source"], "left").withColumn("sizes", F.coalesce("sizes", none))).groupBy("lang", "low", "high").applyInArrow(_margin_cells, _PAIRS)
    # the order of two sources depends on the rows of a task: put the lesser name first before adding up
    sided = joint.unionByName(margins).select("lang", F.least("source", "other").alias("a"), F.greatest("source", "other").alias("b"), "value")
    total = sided.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("other")), F.struct(F.col("b").alias("source"), F.col("a").alias("other")))).alias("s")
    return total.select("lang", both, "value").select("lang", "s.source", "s.other", "value")


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, block: int = BLOCK) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank.

    Part pair: every other source of the language, the most different first.  Part term: the
    ``top`` kept terms that the source holds more of than its language does.
    """
    kept = cut(kept_terms(count_terms(docs), least_docs))
    sizes = cut(group_sizes(docs, kept))
    shared = kept.join(sizes, ["lang", "source"]).withColumn("p", share("n", "total", "kept")).withColumn("q", share("lang_n", "lang_total", "kept"))
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    over = shared.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))
    terms = over.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    pairs = pair_divergence(sizes, shared.select("lang", "source", "term", "p"), block).select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value")
    return pairs.withColumn("rank", F.row_number().over(best)).unionByName(terms)
