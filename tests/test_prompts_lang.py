"""Completion job (P3/P4) semantics and language identification (P2) sanity."""

from pyspark.sql import functions as F

from textdims.operators import lang as LG
from textdims.operators import prompts as PR
from textdims.sources import tables

from .conftest import SF_SMALL


def test_batch_complete_isolates_failures(spark):
    df = spark.createDataFrame([(1, "s", "ok"), (2, "s", "empty"), (3, "s", "boom"), (4, "s", "flaky")], "id long, system string, user string")
    calls = {}

    def completer(system, user):
        calls[user] = calls.get(user, 0) + 1
        if user == "empty":
            return "  "
        if user == "boom":
            raise RuntimeError("server error")
        if user == "flaky" and calls[user] < 3:
            raise TimeoutError("slow")
        return f"re:{user}"

    out = {r.id: r for r in PR.batch_complete(df, completer, max_attempts=4, sleep=lambda s: None).collect()}
    assert (out[1].response, out[1].error, out[1].attempts) == ("re:ok", None, 1)
    assert out[2].response is None and "empty" in out[2].error and out[2].attempts == 4
    assert out[3].response is None and "server error" in out[3].error and out[3].attempts == 4
    assert (out[4].response, out[4].attempts) == ("re:flaky", 3)


def test_backoff_delay_bounds():
    for attempt in range(5):
        d = PR.backoff_delay(attempt, base=2.0)
        assert 0.8 * 2.0 * 2**attempt <= d <= 1.2 * 2.0 * 2**attempt
    assert PR.backoff_delay(10, base=1.0, cap=60, jitter=None) == 60


def test_pending_and_split_prompt(spark):
    posts = spark.createDataFrame([("p1", 50), ("p2", None)], "post_id string, selftext_word_count long")
    built = PR.build_prompt(PR.attach_length(posts, posts.filter("selftext_word_count IS NOT NULL")), "generic")
    ok, bad = PR.split_prompts(built)
    assert bad.count() == 0
    rows = {r.post_id: r for r in ok.collect()}
    assert rows["p1"].system == PR.SYSTEM_PROMPT.strip()
    assert "- Length: 40–60 words." in rows["p1"].user and "- Length: 120–500 words." in rows["p2"].user
    done = spark.createDataFrame([("p1",)], "post_id string")
    assert [r.post_id for r in PR.pending(posts, done, "post_id").collect()] == ["p2"]


def test_language_detection_accuracy(spark):
    p = tables.posts(spark, SF_SMALL)
    half = F.col("id") % 2 == 0
    d = LG.train_and_detect(p, "id", "selftext", "language", train=half).filter(~half).join(p.select("id", F.col("language").alias("truth")), "id")
    acc = d.filter(F.col("truth") == F.col("language")).count() / d.count()
    assert acc > 0.9


def test_guided_prompt_has_its_own_task(spark):
    row = spark.createDataFrame([("p1", "- Length: 10–20 words.\n", "A SUMMARY.")], "post_id string, length_line string, summary string")
    text = PR.build_prompt(row, "guided").first()["prompt"]
    assert text == (
        "SYSTEM PROMPT:\nYou are a member of a loneliness-related subreddit on Reddit where people write self-disclosure posts about loneliness.\n\n"
        "USER PROMPT:\nRead the summary below.\n\nTASK:\n\nYour task is to write a post based ONLY on the summary provided below.\n"
        "- Do not acknowledge this prompt; respond straightaway.\n- Do not include a title line.\n- Write only the body of the post.\n"
        "- Write in English.\n- Do not invent information beyond what is in the summary.\n- Length: 10–20 words.\n\nA SUMMARY.\n"
    )


def test_language_by_broadcast_and_by_join_agree(spark, monkeypatch):
    from textdims.functions.text import char_wb_ngrams

    rows = [(1, "the cat sat on the mat", "en"), (2, "der hund und die katze", "de"), (3, "the dog", "en"), (4, "ein hund a b", "de"), (5, None, "en"), (6, "   ", None), (7, "zzzz qqq 文x", None), (8, "", "de")]
    df = spark.createDataFrame(rows, "id long, text string, lang string")
    for text in (r[1] for r in rows if r[1]):
        got = sorted(LG._gram(c) for c in LG.gram_codes(" ".join(text.lower().split())).tolist())
        want = spark.createDataFrame([(text,)], "t string").select(char_wb_ngrams("t", 3, 3).alias("g")).first()["g"]
        assert got == sorted(want) and [LG._gram(LG._code(g)) for g in got] == got
    first = sorted(tuple(r) for r in LG.train_and_detect(df).collect())
    monkeypatch.setattr(LG, "PROFILE_ROWS", 0)
    monkeypatch.setattr(LG, "COUNTED", 0)
    assert sorted(tuple(r) for r in LG.train_and_detect(df).collect()) == first
    assert dict(first)[1] == "en" and dict(first)[2] == "de" and dict(first)[5] == dict(first)[6] == dict(first)[8] == "unknown"
    assert LG.train_and_detect(df.filter("id > 4")).filter("language <> 'unknown'").count() == 0


def test_complete_job_is_taken_up_after_a_failure(spark, tmp_path):
    """A job that dies after some parts: the next run asks only for the rest; errors are asked again."""
    import pytest

    from textdims.session import path_exists

    rows = [(i, "s", f"u{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "id long, system string, user string")
    out = str(tmp_path / "job")
    made = []
    real = PR.batch_complete

    def dies(part, fn, **kw):
        made.append(1)
        if len(made) > 3:
            raise RuntimeError("driver lost")
        return real(part, fn, **kw)

    PR.batch_complete = dies
    try:
        with pytest.raises(RuntimeError):
            PR.complete_job(df, lambda s, u: u.upper(), out, parts=6, sleep=lambda s: None)
    finally:
        PR.batch_complete = real
    assert path_exists(spark, out)
    first = {r.id for r in spark.read.parquet(f"{out}/runs").collect()}
    assert 0 < len(first) < 40

    def second(system, user):
        if user == "u7":
            raise ValueError("no")
        return user.upper() + "!"

    got = {r.id: r for r in PR.complete_job(df, second, out, parts=6, max_attempts=2, sleep=lambda s: None).collect()}
    assert len(got) == 40 and all(got[i].response == (f"U{i}" if i in first else f"U{i}!") for i in got if i != 7 or i in first)
    if 7 not in first:
        assert (got[7].response, got[7].error, got[7].attempts) == (None, "ValueError: no", 2)
        third = {r.id: r for r in PR.complete_job(df, lambda s, u: "done", out, sleep=lambda s: None).collect()}
        assert third[7].response == "done" and third[7].error is None and third[7].runs == 2 and third[7].attempts == 3
        assert sum(r.response == "done" for r in third.values()) == 1


def test_complete_job_test_mode(spark, tmp_path):
    df = spark.createDataFrame([(i, "s", "u") for i in range(9)], "id long, system string, user string")
    assert sorted(r.id for r in PR.complete_job(df, lambda s, u: "x", str(tmp_path / "j"), first=4).collect()) == [0, 1, 2, 3]
