"""Prompt tables and the per-row completion job.

Prompts are built with column expressions keyed by post id (never by a
counter).  ``batch_complete`` runs a user-supplied completer over Arrow
batches (``mapInPandas``) with isolated per-row failures, retries with
exponential back-off and jitter; the completer is an argument, so the
library ships no network client.  ``complete_job`` is a whole job of it that
can be run again: finished rows are committed part by part, and the next run
asks for what is missing only.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as H

# ---------------------------------------------------------------------------
# Fixed values (prompt texts of the method)
# ---------------------------------------------------------------------------
SYSTEM_PROMPT = (
    "You are a member of a loneliness-related subreddit on Reddit where people write self-disclosure posts about loneliness.\n"
)
USER_PROMPT = (
    "\n"
    "TASK:\n\n"
    "Your task is to write a self-disclosure post about loneliness.\n"
    "- Do not acknowledge this prompt; respond straightaway.\n"
    "- Do not include a title line.\n"
    "- Write only the body of the post.\n"
    "- Write in English.\n"
)
GUIDED_PROMPT = (
    "Read the summary below.\n\n"
    "TASK:\n\n"
    "Your task is to write a post based ONLY on the summary provided below.\n"
    "- Do not acknowledge this prompt; respond straightaway.\n"
    "- Do not include a title line.\n"
    "- Write only the body of the post.\n"
    "- Write in English.\n"
    "- Do not invent information beyond what is in the summary.\n"
)
CONSTRAINTS_BLOCK = "Constraints (must follow):\n- Avoid generic motivational or uplifting endings.\n"


def attach_length(texts: DataFrame, posts: DataFrame, key: str = "post_id", wc_col: str = "selftext_word_count") -> DataFrame:
    """Left join on the post id; the length line falls back to the default band."""
    p = posts.select(F.col(key), F.col(wc_col).alias("_wc"))
    return texts.join(p, key, "left").withColumn("length_line", H.length_line(F.col("_wc"))).drop("_wc")


def attach_summary(texts: DataFrame, summaries: DataFrame, key: str = "post_id", col: str = "summary") -> DataFrame:
    """Inner join; a missing or empty summary drops the row."""
    return texts.join(summaries.select(key, col), key, "inner").filter(F.col(col).isNotNull() & (F.col(col) != ""))


def build_prompt(df: DataFrame, kind: str = "generic", summary_col: str = "summary",
                 system: str = SYSTEM_PROMPT, user: str | None = None) -> DataFrame:
    """H7: full prompt text: system + task of the kind + length line + constraints (generic) or summary (guided)."""
    user = user or (USER_PROMPT if kind == "generic" else GUIDED_PROMPT)
    tail = F.lit(CONSTRAINTS_BLOCK) if kind == "generic" else F.col(summary_col)
    prompt = F.concat(
        F.lit(f"SYSTEM PROMPT:\n{system}\n"), F.lit(f"USER PROMPT:\n{user}"), F.col("length_line"), F.lit("\n"), tail, F.lit("\n")
    )
    return df.withColumn("prompt", prompt)


def split_prompts(df: DataFrame, col: str = "prompt") -> tuple[DataFrame, DataFrame]:
    """H8: (valid rows with system/user blocks, rejected rows)."""
    s, u = H.split_prompt(F.col(col))
    x = df.withColumn("system", s).withColumn("user", u)
    ok = F.col("system").isNotNull() & F.col("user").isNotNull()
    return x.filter(ok), x.filter(~ok)


def rename_by_index(texts: DataFrame, index: DataFrame, key: str = "hash") -> tuple[DataFrame, DataFrame]:
    """Inner join key -> text name; unmatched keys reported (left anti)."""
    return texts.join(index, key, "inner"), texts.join(index, key, "left_anti")


def label_variables(df: DataFrame, index: DataFrame, var_col: str = "var") -> DataFrame:
    """C4: var id -> word (left join on the bounded vocabulary), falling back to the id."""
    return df.join(index.select(F.col("var").alias(var_col), "lemma"), var_col, "left").withColumn(
        "word", F.coalesce("lemma", var_col)
    ).drop("lemma")


def pending(inputs: DataFrame, outputs: DataFrame, key: str = "id") -> DataFrame:
    """Inputs without an output yet (left anti)."""
    return inputs.join(outputs.select(key), key, "left_anti")


def sample_first(df: DataFrame, n: int, key: str = "id") -> DataFrame:
    """First n inputs by key (test mode); n must be > 0."""
    if n <= 0:
        raise ValueError("n must be > 0")
    return df.orderBy(key).limit(n)


def backoff_delay(attempt: int, base: float = 2.0, cap: float | None = None, jitter: tuple[float, float] | None = (0.8, 1.2)) -> float:
    """Base * 2**attempt seconds (capped), scaled by a random factor in ``jitter``."""
    d = base * (2**attempt)
    if cap is not None:
        d = min(cap, d)
    if jitter:
        d *= random.uniform(*jitter)
    return d


def batch_complete(df: DataFrame, fn: Callable[[str, str], str], key: str = "id", system_col: str = "system", user_col: str = "user",
                   workers: int | None = None, max_attempts: int = 5, base_delay: float = 2.0, sleep=time.sleep) -> DataFrame:
    """One isolated request per row -> (id, response, error, attempts).

    Empty output counts as a failure; failures are recorded per row, never
    fatal.  ``workers`` sets the parallelism (``repartition(workers)``): the
    completer is user code, mostly a call to a service that allows so many
    requests at a time; without it every input partition is a worker.
    """
    src = df.select(F.col(key).alias("id"), F.col(system_col).alias("system"), F.col(user_col).alias("user"))
    if workers:
        src = src.repartition(workers)

    def run(batches):
        for pdf in batches:
            out = []
            for rid, s, u in zip(pdf["id"], pdf["system"], pdf["user"]):
                resp, err, n = None, None, 0
                for attempt in range(max_attempts):
                    n = attempt + 1
                    try:
                        r = fn(s, u)
                        if not r or not str(r).strip():
                            raise ValueError("empty response")
                        resp, err = str(r), None
                        break
                    except Exception as e:  # noqa: BLE001 - recorded per row
                        err = f"{type(e).__name__}: {e}"
                        if attempt + 1 < max_attempts:
                            sleep(backoff_delay(attempt, base_delay))
                out.append((rid, resp, err, n))
            yield pd.DataFrame(out, columns=["id", "response", "error", "attempts"])

    id_type = dict(src.dtypes)["id"]
    return src.mapInPandas(run, f"id {id_type}, response string, error string, attempts int")


def complete_job(inputs: DataFrame, fn: Callable[[str, str], str], out_dir: str, key: str = "id", first: int | None = None, requests: int = 4,
                 parts: int = 8, **options) -> DataFrame:
    """P3 + P4 + C5 + A17: complete the inputs that have no response in ``out_dir`` yet; returns ``job_outcomes``.

    The inputs left are dealt over ``parts`` by key; each part is written, and with that
    committed, before the next one starts, so a failure costs one part at most.  At
    most ``requests`` rows are asked for at a time.  ``first`` is the test mode: the first inputs by key.
    """
    from ..session import materialize, path_exists

    spark = inputs.sparkSession
    rows = inputs if first is None else sample_first(inputs, first, key)
    run = 0
    if path_exists(spark, f"{out_dir}/runs"):
        done = spark.read.parquet(f"{out_dir}/runs")
        run = (done.agg(F.max("run")).first()[0] or 0) + 1
        rows = pending(rows, done.filter(F.col("response").isNotNull()).select(F.col("id").alias(key)), key)
    left = materialize(rows.withColumn("_part", F.pmod(F.xxhash64(key), F.lit(parts))), "job-inputs")
    for k in range(parts):
        part = batch_complete(left.filter(F.col("_part") == k), fn, key=key, workers=requests, **options)
        part.write.mode("overwrite").parquet(f"{out_dir}/runs/run={run}/part={k}")
    return job_outcomes(spark, out_dir)


def job_outcomes(spark, out_dir: str) -> DataFrame:
    """(id, response, error, attempts, runs) of a job so far: a response once there is one, else the last error; attempts of all runs."""
    rows = spark.read.parquet(f"{out_dir}/runs")
    best = F.max_by(F.struct("response", "error"), F.struct(F.col("response").isNotNull(), "run")).alias("best")
    out = rows.groupBy("id").agg(best, F.sum("attempts").cast("int").alias("attempts"), F.count(F.lit(1)).cast("int").alias("runs"))
    return out.select("id", "best.response", "best.error", "attempts", "runs")
