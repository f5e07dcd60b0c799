"""Conversation structure repair: the cheapest edits that make a conversation's turns alternate.

A turn has a *signature* of one character: the class of its role (system, user,
assistant, other) and its first fault (none, truncated, blank, duplicate).  A
conversation is the string of its turns' signatures.  Edits keep a turn, change its
role, delete it (a must for blank and duplicate turns) or insert an empty turn;
the roles left have to read system? (user assistant)+, or nothing at all.

All signature strings are read from their ends as one acyclic word graph: two
conversations share the node of every common suffix.  A node holds, for each state of the
role grammar, the cost to go and the first letter of the best audit; the rest
of that audit is the node's successor, so a suffix's audit is found once
and never copied.  The graph is built from reversed strings in sorted order: strings
with a common suffix follow each other, and only the nodes of the current string have
to be held.  Strings are range-partitioned for it, conversation id second, so that
a frequent string is spread over tasks; a suffix that lies across the bound of two
ranges is worked off once on each side.

Scale: only narrow rows (role, SHA-256 of the text, fault flags) are counted, sorted
and searched for duplicates; equal turns are counted before they are shuffled, a
conversation's order comes from a range sort that may cut it anywhere, and its
string is put together from runs of bounded length.  Texts are shuffled once, to
be written or digested in order: there a conversation is *streamed* through one
task and not held.  One digest of a conversation is a sequential function of its bytes, so
this last step is as long as the longest conversation.

Defined cases: null roles and texts are one space; a null turn number sorts first;
rows of one turn are ordered by role, then by the SHA-256 of their text; rows
equal in everything are duplicates of the first; rows without an id are one
conversation; roles of other initials can only be changed or deleted; a conversation
of which nothing is left has an empty audit; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BATCH_BYTES, cut, map_arrow

#: Costs of the edits; an undeleted truncated turn costs TRUNCATED more.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Signature characters by fault, each in the order of the role classes s, u, a, other.
GOOD, CUT_OFF, BLANK, DUPLICATE = "suao", "SUAO", "1234", "5678"
#: A piece of a conversation's string holds at most 2 ** PIECE rows.
PIECE = 13

WHITE = " \t\n\x0b\x0c\r"
#: States of the grammar: nothing yet, after a system turn, after a user's, after an assistant's; and the state that the next role but a first system turn leads to.
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = (USER, USER, ASSISTANT, USER)
_NEVER = 1 << 60


def _turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text without nulls in the last two, and the digest that orders equal turns."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"))


def _letter(kind: str) -> Column:
    """The signature character of a turn with a fault, by the initial of its role."""
    initial = F.substring("role", 1, 1)
    return F.when(initial == "s", kind[0]).when(initial == "u", kind[1]).when(initial == "a", kind[2]).otherwise(kind[3])


def signatures(conversations: DataFrame) -> DataFrame:
    """conv_id, signature (a character for each turn), low, high (turn numbers), turns (distinct numbers)."""
    body = F.rtrim(F.col("text"), F.lit(WHITE))
    ended = body.endswith(".") | body.endswith("!") | body.endswith("?")
    narrow = _turns(conversations).select("conv_id", "turn", "role", "digest", (body == "").alias("blank"), ended.alias("ended"))
    counted = narrow.groupBy("conv_id", "turn", "role", "digest", "blank", "ended").agg(F.count(F.lit(1)).cast("int").alias("copies"))
    order = ["conv_id", "turn", "role", "digest"]
    placed = cut(counted.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()))
    first = placed.filter(~F.col("blank")).groupBy("conv_id", "role", "digest").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("new"))
    again = F.repeat(_letter(DUPLICATE), F.col("copies") - 1)
    letters = (
        F.when(F.col("blank"), F.repeat(_letter(BLANK), F.col("copies")))
        .when(F.col("new").isNull(), F.repeat(_letter(DUPLICATE), F.col("copies")))
        .otherwise(F.concat(F.when(F.col("ended"), _letter(GOOD)).otherwise(_letter(CUT_OFF)), again))
    )
    pieces = (
        placed.join(first, "place", "left")
        .select("conv_id", "turn", "place", letters.alias("letters"))
        .groupBy("conv_id", F.shiftright("place", PIECE).alias("piece"))
        .agg(F.array_sort(F.collect_list(F.struct("place", "letters"))).alias("at"), F.min("turn").alias("low"), F.max("turn").alias("high"), F.size(F.collect_set("turn")).cast("long").alias("turns"))
        .select("conv_id", F.struct("piece", F.array_join("at.letters", "").alias("letters"), "low", "high", "turns").alias("piece"))
    )
    joined = pieces.groupBy("conv_id").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    # a turn number that ends one piece and starts the next counts once
    turns = F.transform("pieces", lambda p, k: p["turns"] - F.when(p["low"] == F.get("pieces", k - 1)["high"], 1).otherwise(0))
    return joined.select(
        "conv_id",
        F.array_join("pieces.letters", "").alias("signature"),
        F.array_min("pieces.low").alias("low"),
        F.array_max("pieces.high").alias("high"),
        F.aggregate(turns, F.lit(0).cast("long"), lambda n, t: n + t).alias("turns"),
    )


class SuffixGraph:
    """The nodes of the current string, from its end: costs to go and first letters by grammar state."""

    def __init__(self):
        self.string = ""
        self.costs = [(0, 2 * INSERT, INSERT, 0)]
        self.letters = [("", "I", "I", "")]

    def node(self, letter: str) -> None:
        """Add the node of one more turn before the current suffix."""
        after = self.costs[-1]
        role = GOOD.find(letter.lower())
        best = [(after[q] + DELETE, "D") for q in range(4)]
        if role >= 0:
            more = TRUNCATED if letter.isupper() else 0
            for q in range(4):
                to = FOLLOWS[q]
                if role + 1 == to:
                    best[q] = min(best[q], (after[to] + more, "K"))
                elif role == 0 and q == START:
                    best[q] = min(best[q], (after[SYSTEM] + more, "K"))
                best[q] = min(best[q], (after[to] + more + REROLE, "R"))
        user, assistant = best[USER], best[ASSISTANT]
        # two inserted turns in a row lead back to the same state, so one step is enough between these two
        best[USER] = min(user, (assistant[0] + INSERT, "I"))
        best[ASSISTANT] = min(assistant, (user[0] + INSERT, "I"))
        for q in (START, SYSTEM):
            best[q] = min(best[q], (best[USER][0] + INSERT, "I"))
        self.costs.append(tuple(c for c, _ in best))
        self.letters.append(tuple(x for _, x in best))

    def repair(self, string: str) -> tuple[int, str]:
        """(cost, audit) of a signature string given from its end."""
        kept = _common(self.string, string)
        del self.costs[kept + 1 :], self.letters[kept + 1 :]
        for letter in string[kept:]:
            self.node(letter)
        self.string = string
        out, at, q = [], len(string), START
        while edit := self.letters[at][q]:
            out.append(edit)
            if edit != "I":
                at -= 1
            if edit == "K" and q == START and string[at] in "sS":
                q = SYSTEM
            elif edit != "D":
                q = FOLLOWS[q]
        return self.costs[-1][START], "".join(out)


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def audits(signed: DataFrame) -> DataFrame:
    """``signatures``' rows with blank, duplicate, truncated, illegal, cost and audit."""
    strings = signed.select("*", F.reverse(F.translate("signature", BLANK + DUPLICATE, "X" * 8)).alias("string"))
    ordered = strings.repartitionByRange("string", "conv_id").sortWithinPartitions("string", "conv_id")
    roles = str.maketrans(CUT_OFF + BLANK + DUPLICATE, GOOD * 3)

    def run(batches):
        graph, known = SuffixGraph(), None
        for batch in batches:
            rows = []
            for signature, string in zip(batch.column("signature").to_pylist(), batch.column("string").to_pylist(), strict=True):
                if known is None or string != graph.string:
                    known = graph.repair(string)
                initials = signature.translate(roles)
                legal = sum(initials.count(pair) for pair in ("su", "ua", "au"))
                rows.append((sum(map(signature.count, BLANK)), sum(map(signature.count, DUPLICATE)), sum(map(signature.count, CUT_OFF)), max(0, len(initials) - 1) - legal, *known))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            kept = [batch.column(c) for c in ("conv_id", "signature", "low", "high", "turns")]
            made = [pa.array(c, pa.string() if k == 5 else pa.int64()) for k, c in enumerate(columns)]
            yield pa.RecordBatch.from_arrays(kept + made, ["conv_id", "signature", "low", "high", "turns", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])

    return map_arrow(ordered, run, "conv_id long, signature string, low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


class _Edits:
    """Reads off one audit while the turns go by."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _next(self, role: str | None = None) -> str:
        self.state = SYSTEM if role is not None and self.state == START and role[:1] == "s" else FOLLOWS[self.state]
        return role if role is not None else ("user" if self.state == USER else "assistant")

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._next(), ""

    def turn(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            yield self._next(role if edit == "K" else None), text


def _edited(conversations: DataFrame, plans: DataFrame, *more: str) -> DataFrame:
    """Turns and, before those of each conversation, its audit with the columns ``more``: dealt by conversation, in order."""
    turns = _turns(conversations).select("conv_id", F.lit(True).alias("is_turn"), "turn", "role", "digest", "text", *[F.lit(None).cast(plans.schema[c].dataType).alias(c) for c in more])
    heads = plans.select(F.col("conv_id").cast("long").alias("conv_id"), F.lit(False).alias("is_turn"), *[F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("digest", "binary"))], F.col("audit").alias("text"), *more)
    return turns.unionByName(heads).repartition("conv_id").sortWithinPartitions("conv_id", "is_turn", "turn", "role", "digest").drop("turn", "digest")


def repaired(conversations: DataFrame, plans: DataFrame) -> DataFrame:
    """conv_id, place (from 0), role, text: the turns after the edits of ``plans`` (conv_id, audit)."""

    def run(batches):
        conv, edits, place = None, _Edits(""), 0
        ids, places, roles, texts, size = [], [], [], [], 0

        def put(turns):
            nonlocal place, size
            for role, text in turns:
                ids.append(conv)
                places.append(place)
                roles.append(role)
                texts.append(text)
                place, size = place + 1, size + len(text)

        def flush():
            nonlocal size
            out = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(places, pa.int64()), pa.array(roles, pa.string()), pa.array(texts, pa.string())], ["conv_id", "place", "role", "text"])
            ids.clear(), places.clear(), roles.clear(), texts.clear()
            size = 0
            return out

        for batch in batches:
            for row_id, is_turn, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "is_turn", "role", "text")], strict=True):
                if is_turn:
                    put(edits.turn(role, text))
                else:
                    put(edits.inserted())
                    conv, edits, place = row_id, _Edits(text), 0
                if size > BATCH_BYTES:
                    yield flush()
        put(edits.inserted())
        yield flush()

    return map_arrow(_edited(conversations, plans), run, "conv_id long, place long, role string, text string")


def digests(conversations: DataFrame, plans: DataFrame, *more: str) -> DataFrame:
    """conv_id, ``more`` columns of ``plans``, audit, repaired_sha256: the repaired ``role:text`` lines joined by line feeds."""
    frame = _edited(conversations, plans, *more)
    names = ["conv_id", *more, "audit", "repaired_sha256"]
    types = [pa.int64(), *[_arrow(plans.schema[c].dataType) for c in more], pa.string(), pa.string()]

    def run(batches):
        head, edits, digest, empty = None, _Edits(""), hashlib.sha256(), True
        done: list[tuple] = []

        def put(turns):
            nonlocal empty
            for role, text in turns:
                digest.update((role if empty else "\n" + role).encode())
                digest.update(b":")
                digest.update(text.encode())
                empty = False

        def finish():
            if head is not None:
                put(edits.inserted())
                done.append((*head, edits.audit, digest.hexdigest()))

        def flush():
            columns = list(zip(*done, strict=True)) if done else [()] * len(names)
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("is_turn", "role", "text", "conv_id", *more)]
            for is_turn, role, text, *other in zip(*columns, strict=True):
                if is_turn:
                    put(edits.turn(role, text))
                else:
                    finish()
                    head, edits, digest, empty = tuple(other), _Edits(text), hashlib.sha256(), True
            yield flush()
        finish()
        yield flush()

    fields = ", ".join(f"`{c}` {plans.schema[c].dataType.simpleString()}" for c in more)
    return map_arrow(frame, run, f"conv_id long, {fields + ', ' if fields else ''}audit string, repaired_sha256 string")


def _arrow(kind) -> pa.DataType:
    return {"bigint": pa.int64(), "string": pa.string()}[kind.simpleString()]


def repair(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps (missing turn numbers), blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    gaps = F.when(F.col("low").isNull(), F.lit(0)).otherwise(F.col("high") - F.col("low") + 1 - F.col("turns")).cast("long")
    plans = audits(signatures(conversations)).withColumn("gaps", gaps)
    return digests(conversations, plans, "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
