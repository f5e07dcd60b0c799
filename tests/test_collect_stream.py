"""Collector-side operators, modeled on the reference's offline collect test, plus stream = batch."""

import gzip
import json
import os
import tempfile

from pyspark.sql import functions as F

from textdims.operators import clean as C
from textdims.operators import listing as L
from textdims.sources import files as FI
from textdims.streaming import collect as ST


def test_collect_rows_and_provenance(spark):
    sub = spark.createDataFrame([("s1", "testsr", 1000.0, "user1", "title1", "text1", 10, 1, "u", "/r/testsr/s1", None, None)],
                                ST.RAW_SUBMISSION_SCHEMA)
    com = spark.createDataFrame([("c1", "t3_s1", "t3_s1", "testsr", 1100, "user2", "body", 1, "/r/testsr/c1")],
                                "id string, link_id string, parent_id string, subreddit string, created_utc long, author string, body string, score long, permalink string")
    s = L.normalize_submission(sub).collect()[0]
    c = L.normalize_comment(com).collect()[0]
    assert (s.id, s.created_utc, s.author, s.over_18, s.permalink) == ("s1", 1000, "user1", False, "https://reddit.com/r/testsr/s1")
    assert c.link_id == "s1" and c.parent_id == "t3_s1"
    base = tempfile.mkdtemp(prefix="textdims-test-", dir="/tmp")
    n_posts = FI.append_rows(L.normalize_submission(sub), f"{base}/run/posts")
    n_comments = FI.append_rows(L.normalize_comment(com), f"{base}/run/comments")
    assert (n_posts, n_comments) == (1, 1)
    prov = FI.run_provenance(spark, "2024-01-01T00:00:00+00:00", {"subreddits": ["testsr"], "listing": "new"}, {"posts": n_posts, "comments": n_comments})
    FI.export_ndjson(prov, f"{base}/prov")
    files = [f for f in os.listdir(f"{base}/prov") if f.endswith(".json")]
    recs = [json.loads(line) for f in files for line in open(f"{base}/prov/{f}") if line.strip()]
    assert len(recs) == 1 and recs[0]["counts"] == {"posts": 1, "comments": 1}
    assert recs[0]["params"]["subreddits"] == ["testsr"]


def test_append_heterogeneous_rows(spark):
    base = tempfile.mkdtemp(prefix="textdims-test-", dir="/tmp")
    n = FI.append_rows(spark.createDataFrame([(1, None), (None, "two")], "a long, b string"), f"{base}/x")
    assert n == 2
    back = spark.read.json(f"{base}/x").orderBy("a").collect()
    assert {(r.a, r.b) for r in back} == {(1, None), (None, "two")}


def test_stream_equals_batch(spark):
    base = tempfile.mkdtemp(prefix="textdims-test-", dir="/tmp")
    rows = [(str(i), "sr", 1000.0 + i, None, "", ("word " * (5 + i)).strip(), 0, 0, "", f"/p/{i}", None, None) for i in range(12)]
    raw = spark.createDataFrame(rows, ST.RAW_SUBMISSION_SCHEMA)
    raw.repartition(3).write.json(f"{base}/in/a")
    raw.write.json(f"{base}/in/b")  # replay
    stream = spark.readStream.schema(ST.RAW_SUBMISSION_SCHEMA).option("recursiveFileLookup", "true").json(f"{base}/in")
    q = ST.stream_first_seen(stream).select("id").writeStream.format("memory").queryName("first_seen_t").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted(r.id for r in spark.sql("SELECT id FROM first_seen_t").collect())
    batch = sorted(r.id for r in ST.stream_first_seen(raw).select("id").distinct().collect())
    assert got == batch == sorted(str(i) for i in range(5, 12))
    q2 = ST.stream_collect(spark, f"{base}/in", f"{base}/out", f"{base}/ck", max_files_per_trigger=2)
    q2.awaitTermination()
    assert spark.read.parquet(f"{base}/out/rows").count() == 24
    rc = ST.run_counts(f"{base}/out", spark).orderBy("batch_id").collect()
    assert rc[-1].running_rows == 24


def test_file_readers(spark):
    base = tempfile.mkdtemp(prefix="textdims-test-", dir="/tmp")
    os.makedirs(f"{base}/corpus/human")
    os.makedirs(f"{base}/corpus/generic_gpt")
    open(f"{base}/corpus/human/t001_human.txt", "w").write("Hello there.\nSecond line")
    open(f"{base}/corpus/generic_gpt/t001_gpt.txt", "w").write("Model text")
    c = {(r.folder, r.name): r.text for r in FI.read_corpus(spark, f"{base}/corpus").collect()}
    assert c == {("human", "t001_human.txt"): "Hello there.\nSecond line", ("generic_gpt", "t001_gpt.txt"): "Model text"}
    os.makedirs(f"{base}/tagged")
    open(f"{base}/tagged/a.txt", "w").write("The\tDT\tthe\ncats\tNNS\tcat\nshort\nx\ty\tz\textra\n")
    toks, rej = FI.read_tagged(spark, f"{base}/tagged")
    assert [(r.word, r.tag, r.lemma) for r in toks.collect()] == [("The", "DT", "the"), ("cats", "NNS", "cat")]
    assert rej.count() == 1
    loose, _ = FI.read_tagged(spark, f"{base}/tagged", strict=False)
    assert loose.count() == 3
    open(f"{base}/ids.txt", "w").write("t000001 human/t001_human.txt\n\nt000002 gpt/a b.txt\n")
    m = {r.id: r.name for r in FI.read_id_map(spark, f"{base}/ids.txt").collect()}
    assert m == {"t000001": "human/t001_human.txt", "t000002": "gpt/a b.txt"}
    open(f"{base}/m.txt", "w").write("t000001 human human human 1 0\nt000002 generic gpt ai 0\n")
    mx = FI.read_matrix(spark, f"{base}/m.txt", 2).orderBy("filename").collect()
    assert (mx[0].v000001, mx[0].v000002, mx[1].v000001, mx[1].v000002) == (1, 0, 0, None)
    kw = spark.createDataFrame([("b",), (" a ",), ("b",), ("",)], "lemma string")
    FI.write_keywords(kw.selectExpr("trim(lemma) AS lemma").filter("lemma <> ''"), f"{base}/kw")
    assert [r.lemma for r in FI.read_keywords(spark, f"{base}/kw").collect()] == ["a", "b"]
    FI.export_results(kw, f"{base}/res")
    assert spark.read.option("header", "true").option("sep", "\t").csv(f"{base}/res").count() == 4
    FI.export_texts(spark.createDataFrame([("p1", None, "human")], "post_id string, selftext string, folder string"), f"{base}/tx", partition_col="folder")
    t = spark.read.parquet(f"{base}/tx").collect()[0]
    assert (t.name, t.text, t.folder) == ("p1_extracted", "", "human")


def test_replayed_batch_leaves_no_row_twice(spark):
    base = tempfile.mkdtemp(prefix="textdims-test-", dir="/tmp")
    write = ST.batch_writer(base)
    first, second = spark.range(0, 5).select(F.col("id").cast("string").alias("id")), spark.range(5, 9).select(F.col("id").cast("string").alias("id"))
    write(first, 0)
    write(second, 1)
    write(second, 1)  # the batch that failed after its rows were written
    rows = spark.read.parquet(f"{base}/rows")
    assert rows.count() == rows.select("id").distinct().count() == 9
    assert [(r.batch_id, r.rows, r.running_rows) for r in ST.run_counts(base, spark).orderBy("batch_id").collect()] == [(0, 5, 5), (1, 4, 9)]


def test_names_with_spaces_and_tagged_white_space(spark):
    base = tempfile.mkdtemp(prefix="textdims test-", dir="/tmp")
    os.makedirs(f"{base}/a b")
    open(f"{base}/a b/c+d %41.txt", "w").write("text")
    assert [(r.folder, r.name, r.text) for r in FI.read_corpus(spark, base).collect()] == [("a b", "c+d %41.txt", "text")]
    assert [r.folder for r in FI.read_corpus(spark, f"file://{base}/").collect()] == ["a b"]
    os.makedirs(f"{base}/tagged")
    open(f"{base}/tagged/t.txt", "w").write("w\tNN\t\n\tx\tNN\ty\t\n")
    toks, rejects = FI.read_tagged(spark, f"{base}/tagged")
    assert [(r.word, r.tag, r.lemma) for r in toks.collect()] == [("x", "NN", "y")] and rejects.count() == 0


def test_first_in_file_and_line_order_stays(spark):
    base = tempfile.mkdtemp(prefix="textdims-test-", dir="/tmp")
    for run, rows in (("run_a", [("z", "same"), ("y", "other"), ("x", "same")]), ("run_b", [("a", "same"), ("b", "new")])):
        os.makedirs(f"{base}/{run}")
        with open(f"{base}/{run}/{FI.SUBMISSIONS_FILE}", "w") as f:
            f.writelines(json.dumps({"id": i, "selftext": t}) + "\n" for i, t in rows)
    posts = FI.read_posts(spark, base)
    assert sorted(r.id for r in C.exact_dedup(posts, "selftext", FI.FILE_ORDER).collect()) == ["b", "y", "z"]


def test_first_seen_is_never_late(spark):
    """Posts spread over more than the delay, newest files first, each file replayed at once and all of them at the end."""
    base = tempfile.mkdtemp(prefix="textdims-test-", dir="/tmp")
    os.makedirs(f"{base}/in")
    files = [range(k * 10, k * 10 + 10) for k in (3, 3, 2, 1, 1, 0, 3, 2, 1, 0)]
    for at, ids in enumerate(files):
        with open(f"{base}/in/{at}.json", "w") as f:
            f.writelines(json.dumps({"id": str(i), "created_utc": 1.7e9 + i * 86400, "selftext": "word " * 12}) + "\n" for i in ids)
        os.utime(f"{base}/in/{at}.json", (1.7e9 + at, 1.7e9 + at))
    stream = spark.readStream.schema(ST.RAW_SUBMISSION_SCHEMA).option("maxFilesPerTrigger", 1).json(f"{base}/in")
    s = ST.stream_first_seen(stream, dedup_watermark="1 hour").select("id")
    s.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ckpt").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    assert sorted(int(r.id) for r in spark.read.parquet(f"{base}/out").collect()) == list(range(40))


def test_corpus_files_are_bounded(spark, tmp_path, monkeypatch):
    """A folder of many texts lies in many files, none with more than a small part of it."""
    from textdims.plans import q_io

    sf = str(tmp_path / "sf")
    rows = [(i, "word " * 100, "en" if i % 3 else "de") for i in range(600)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("source", F.lit("s")).write.parquet(f"{sf}/documents.parquet")
    monkeypatch.setattr(FI, "CORPUS_FILE_BYTES", 20_000, raising=False)
    monkeypatch.setattr(q_io, "_scratch", lambda spark, name: str(tmp_path / name))
    got = {(r.folder, r.n_texts, r.n_chars) for r in q_io.q_corpus_roundtrip(spark, sf).collect()}
    assert got == {("human", 400, 200_000), ("generic_gpt", 200, 100_000)}
    files = (tmp_path / "corpus dir/texts").rglob("part-*")
    sizes = [len(gzip.decompress(p.read_bytes()) if p.suffix == ".gz" else p.read_bytes()) for p in files]
    assert sum(sizes) >= 600_000 and max(sizes) <= 40_000


def _posts(spark, rows):
    return spark.createDataFrame([(i, "sr", 1000.0, None, "", t, 0, 0, "", f"/p/{i}", None, None) for i, t in rows], ST.RAW_SUBMISSION_SCHEMA)


def test_first_texts_by_file_and_line_in_both_arrivals(spark):
    """Equal texts in two files, read in either order with a restart between: the first by file and line stays."""
    long = "ten words are needed here so that posts are kept " + "x"
    a = [("a1", long + "1"), ("a2", long + "2"), ("a3", long + "1"), ("a4", "short"), ("a5", None), ("a6", "  ")]
    b = [("b1", long + "2"), ("b2", long + "3"), ("b3", long + "3"), ("b4", long + "1")]
    for order in ("ab", "ba"):
        base = tempfile.mkdtemp(prefix="textdims-test-", dir="/tmp")
        for name in order:
            _posts(spark, dict(a=a, b=b)[name]).coalesce(1).write.json(f"{base}/in/{name}")
            ST.run_collection(spark, f"{base}/in", f"{base}/out", f"{base}/collect", {})
            ST.stream_first_texts(spark, f"{base}/out", f"{base}/first").awaitTermination()
        got = sorted(r.id for r in ST.first_texts(spark, f"{base}/out").collect())
        batch = ST.collected(spark, f"{base}/out").filter("id not in ('a4', 'a5', 'a6')")
        want = sorted(r.id for r in C.exact_dedup(batch, "selftext", FI.FILE_ORDER).collect())
        assert got == want == ["a1", "a2", "b2"]


def test_cancelled_run_is_taken_up(spark):
    base = tempfile.mkdtemp(prefix="textdims-test-", dir="/tmp")
    _posts(spark, [(str(i), f"text {i}") for i in range(12)]).repartition(4).write.json(f"{base}/in")
    said, asked = [], []

    def stop():
        asked.append(1)
        return len(asked) > 2

    first = ST.run_collection(spark, f"{base}/in", f"{base}/out", f"{base}/ck", {"listing": "new", "subreddits": ["sr"]}, stop, said.append, max_files_per_trigger=1)
    assert len(first) == 2 and ST.collected(spark, f"{base}/out").count() == sum(first.values()) < 12
    rest = ST.run_collection(spark, f"{base}/in", f"{base}/out", f"{base}/ck", {"listing": "new"}, lambda: False, said.append, max_files_per_trigger=1)
    assert sum(first.values()) + sum(rest.values()) == 12
    assert sorted(int(r.id) for r in ST.collected(spark, f"{base}/out").collect()) == list(range(12))
    records = ST.run_records(spark, f"{base}/out").orderBy("started_at").collect()
    assert [r.cancelled for r in records] == [True, False]
    assert [r.counts.posts for r in records] == [sum(first.values()), sum(rest.values())]
    assert records[0].params.listing == "new" and all(r.finished_at >= r.started_at for r in records)
    assert said[-1] == "Collection finished." and "Collection cancelled." in said


def test_a_failing_run_is_no_cancelled_one(spark):
    import pytest
    from pyspark.errors import StreamingQueryException

    base = tempfile.mkdtemp(prefix="textdims-test-", dir="/tmp")
    _posts(spark, [("1", "t")]).write.json(f"{base}/in")

    def broken():
        raise RuntimeError("flag unreadable")

    with pytest.raises(StreamingQueryException):
        ST.run_collection(spark, f"{base}/in", f"{base}/out", f"{base}/ck", {}, broken)


def test_append_again_after_a_failed_task(spark):
    """A job whose task fails halfway, run again under its name: every row once, and other jobs' rows stay."""
    import pytest

    base = tempfile.mkdtemp(prefix="textdims-test-", dir="/tmp")
    rows = spark.range(0, 40, 1, 4)
    FI.append_rows(rows.withColumn("job", F.lit("earlier")), f"{base}/x", "earlier job")
    broken = rows.withColumn("job", F.when(F.col("id") == 35, F.raise_error(F.lit("lost"))).otherwise(F.lit("later")))
    with pytest.raises(Exception, match="lost"):
        FI.append_rows(broken, f"{base}/x", "later")
    for _ in range(2):
        assert FI.append_rows(rows.withColumn("job", F.lit("later")), f"{base}/x", "later") == 40
    back = spark.read.option("recursiveFileLookup", "true").json(f"{base}/x")
    assert back.groupBy("job").agg(F.count("id"), F.count_distinct("id")).orderBy("job").collect() == [("earlier", 40, 40), ("later", 40, 40)]


def test_export_tables_with_manifest(spark):
    base = tempfile.mkdtemp(prefix="textdims-test-", dir="/tmp")
    m = FI.export_tables({"one": spark.createDataFrame([(1, "a\tb")], "x int, y string"), "none": spark.createDataFrame([], "z double")}, base)
    assert sorted((r.name, r.columns, r.rows) for r in m.collect()) == [("none", ["z"], 0), ("one", ["x", "y"], 1)]
    back = spark.read.option("header", "true").option("sep", "\t").csv(f"{base}/one").collect()
    assert [tuple(r) for r in back] == [("1", "a\tb")]


def test_corpus_pieces(spark, tmp_path):
    """Many small files in few splits, a large one cut at line ends, bytes that are no UTF-8 left out."""
    for k in range(60):
        d = tmp_path / f"folder{k % 3}"
        d.mkdir(exist_ok=True)
        (d / f"t {k}.txt").write_text(f"file {k}\nline two é\n", encoding="utf-8")
    (tmp_path / "folder0" / "odd.txt").write_bytes(b"good \xff\xfe bytes\r\nlast")
    (tmp_path / "folder0" / "empty.txt").write_bytes(b"")
    long = "\n".join(f"line {i} " + "x" * (i % 90) for i in range(6000))
    (tmp_path / "folder1" / "long.txt").write_text(long)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(40_000))
    spark.conf.set("spark.sql.files.openCostInBytes", "400")
    try:
        df = FI.read_corpus_pieces(spark, str(tmp_path), piece_bytes=9_000)
        assert df.rdd.getNumPartitions() < 25
        rows = df.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    by: dict = {}
    for r in sorted(rows, key=lambda r: (r.name, r.block, r.piece)):
        by.setdefault(r.name, []).append(r)
    assert "\n".join(r.text for r in by["long.txt"]) == long
    assert len(by["long.txt"]) > 30 and max(len(r.text) for r in by["long.txt"]) <= 9_100
    assert by["odd.txt"][0].text == "good  bytes\nlast" and by["odd.txt"][0].folder == "folder0"
    assert all(by[f"t {k}.txt"][0].text == f"file {k}\nline two é" and len(by[f"t {k}.txt"]) == 1 for k in range(60))
