import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from textdims.llm import conversation_repair as c

WHITE = " \t\n\x0b\x0c\r"


def legal(initials: str) -> bool:
    body = initials[1:] if initials[:1] == "s" else initials
    return initials == "" or (body != "" and body == "ua" * (len(body) // 2))


def brute(turns):
    """(counts, cost, audit, digest) of one conversation's (turn, role, text), over every edit string."""
    turns = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in turns]
    turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.sha256(t[2].encode()).digest()))
    faults, seen = [], set()
    for _, role, text in turns:
        body = text.rstrip(WHITE)
        faults.append("b" if not body else "d" if (role, text) in seen else "" if body[-1] in ".!?" else "t")
        seen.add((role, text))
    best = None
    for inserts in range(3):
        for letters in itertools.product("DKR", repeat=len(turns)):
            for at in itertools.combinations_with_replacement(range(len(turns) + 1), inserts):
                cost, out, audit = 5 * inserts, [], ""
                for k in range(len(turns) + 1):
                    for _ in range(at.count(k)):
                        audit += "I"
                        out.append(None)
                    if k < len(turns):
                        x, (_, role, text) = letters[k], turns[k]
                        audit += x
                        if x == "D":
                            cost += 2
                        else:
                            cost += (x == "R") + 5 * (faults[k] == "t") + (10**6 if faults[k] in "bd" and faults[k] else 0)
                            out.append((role if x == "K" else None, text))
                start = 1 if out and out[0] and (out[0][0] or "")[:1] == "s" else 0
                full = [("" if y is None else y[1], ["user", "assistant"][(k - start) % 2] if y is None or y[0] is None else y[0]) for k, y in enumerate(out)]
                if cost < 10**6 and legal("".join(r[:1] or "-" for _, r in full)):
                    text = "\n".join(f"{r}:{x}" for x, r in full)
                    best = min(best, (cost, audit, text)) if best else (cost, audit, text)
    initials = [r[:1] for _, r, _ in turns]
    numbers = [t for t, _, _ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    return (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, best[0], best[1], hashlib.sha256(best[2].encode()).hexdigest())


def table(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("place", "letters", "audit", "is_turn", "digest", "copies", "low"):
        df = df.withColumn(name, F.lit("x"))
    return df


def check(spark, rows):
    by: dict = {}
    for i, *turn in rows:
        by.setdefault(i, []).append(tuple(turn))
    want = sorted([(i, *brute(t)) for i, t in by.items()], key=str)
    got = c.repair(table(spark, rows)).select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()
    assert sorted([tuple(r) for r in got], key=str) == want


def made(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        for _ in range(rng.randrange(1, 6)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "User", None])
            text = rng.choice(["Fine.", "Fine.", "Why?", "cut off", "ends here! \n", "", " \t", None, "é…", "other.", "more!"])
            rows.append((None if i == 0 else i, rng.choice([None, 0, 1, 2, 3, 7]), role, text))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_every_edit_string(spark, seed):
    check(spark, made(seed, 40))


def test_plain_cases(spark):
    check(spark, [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi!"), (1, 2, "assistant", "Hello.")])
    check(spark, [(2, 0, "system", "Alone.")])
    check(spark, [(3, 5, "user", "Same."), (3, 5, "user", "Same."), (3, 9, "assistant", "Yes.")])
    check(spark, [(4, None, None, None)])


def test_empty_table(spark):
    assert c.repair(table(spark, [])).count() == 0


def test_one_node_for_a_common_suffix():
    graph = c.SuffixGraph()
    made_nodes = []
    node = graph.node
    graph.node = lambda letter: (made_nodes.append(letter), node(letter))
    strings = sorted(["auaus", "auau", "auXu", "auaus", "a"])
    for s in strings:
        graph.repair(s)
    assert len(made_nodes) == len({s[:k] for s in strings for k in range(1, len(s) + 1)})


def test_pieces_and_long_conversations(spark, monkeypatch):
    """A conversation of many pieces, one over several partitions, and a very long text."""
    monkeypatch.setattr(c, "PIECE", 3)
    rows = [(1, k // 2, ["user", "assistant"][k % 2], f"Turn {k}.") for k in range(400)] + [(2, 0, "user", "x" * 300_000 + "."), (2, 1, "assistant", "Ok.")]
    got = {r["conv_id"]: r for r in c.repair(table(spark, rows)).collect()}
    assert (got[1]["gaps"], got[1]["duplicate"], len(got[1]["audit"])) == (0, 0, 400)
    assert got[1]["cost"] <= 400 and (got[2]["cost"], got[2]["audit"]) == (0, "KK")


def test_repaired_rows(spark):
    df = table(spark, [(1, 0, "user", "Hi."), (1, 1, "tool", "Out."), (2, 0, "assistant", "Yes."), (2, 1, "user", "No.")])
    plans = c.audits(c.signatures(df))
    got = sorted(tuple(r) for r in c.repaired(df, plans).collect())
    assert got == [(1, 0, "user", "Hi."), (1, 1, "assistant", "Out."), (2, 0, "user", "Yes."), (2, 1, "assistant", "No.")]


def test_query_with_nulls_against_sql(spark, tmp_path):
    """The damaged table with null ids, turns, roles and texts, and conversations that lose every row."""
    import duckdb

    from textdims.llm.queries import ORACLES, QUERIES

    rows = [r for r in made(3, 60)] + [(1000 + k, k % 3, "user", f"Only row {k}.") for k in range(60)] + [(None, None, None, None), (None, 4, "user", "Late.")]
    # one row for each turn: the order of several is not the contract's
    rows = list({(r[0], r[1]): r for r in rows}.values())
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    want = con.execute(ORACLES["op12_conversation_repair"])
    names = [d[0] for d in want.description]
    got = QUERIES["op12_conversation_repair"](spark, str(tmp_path)).select(*names).collect()
    want = want.fetchall()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert len(got) == len({r[0] for r in rows}) and any(r["audit"] == "" for r in got)
