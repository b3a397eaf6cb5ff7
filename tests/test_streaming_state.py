"""Budget, seen keys, raw batches and sinks across micro-batches and replays."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ratelens.sinks import tables as sink
from ratelens.sources import landed
from ratelens.streaming import dedup_job, pipeline as sp

DAY = dt.datetime(2024, 5, 1, 8)


def candidates(batch):
    return batch.select("article_id", F.to_date("published").alias("run_day"), F.col("published").alias("queued_at"),
                        F.lit(0).alias("prio"))


def test_budget_of_a_day_holds_over_batches(spark, tmp_path):
    root = str(tmp_path / "budget")
    write = sp.budget_writer(root, candidates, budget=15)
    rows = [(f"a{i:03d}", DAY + dt.timedelta(minutes=i, days=i % 2)) for i in range(80)]
    frames = [spark.createDataFrame(rows[i:i + 20], "article_id string, published timestamp") for i in range(0, 80, 20)]
    frames.insert(2, frames[0].limit(0))                        # an empty batch
    for k, frame in enumerate(frames):
        write(frame, k)
        write(frame, k)                                         # a replay
    out = spark.read.parquet(f"{root}/rows")
    done = {r.run_day: r.n for r in out.where("processed").groupBy("run_day").agg(F.count("*").alias("n")).collect()}
    assert done == {dt.date(2024, 5, 1): 15, dt.date(2024, 5, 2): 15} and out.count() == 80
    calls = spark.read.parquet(f"{root}/calls")
    assert calls.agg(F.sum("calls_used")).first()[0] == 30
    assert calls.where("batch = 2").count() == 0
    # an earlier batch replayed late rewrites the same rows
    before = {tuple(r) for r in out.collect()}
    write(frames[1], 1)
    assert {tuple(r) for r in spark.read.parquet(f"{root}/rows").collect()} == before


def test_seen_keys_are_read_by_prefix(spark, tmp_path):
    root = str(tmp_path / "seen")
    write = dedup_job.exact_dedup_writer(root, "url", ["published", "article_id"], ["url", "article_id"])
    first = [(f"u{i}", f"x{i}", i) for i in range(400)] + [("u7", "early", -1), (None, "none", 0)]
    schema = "url string, article_id string, published int"
    write(spark.createDataFrame(first, schema), 0)
    second = spark.createDataFrame([("u7", "late", 9), ("new", "b", 2), ("new", "a", 1)], schema)
    for _ in range(2):
        write(second, 1)
    out = {r.url: r.article_id for r in spark.read.parquet(f"{root}/out").collect()}
    assert len(out) == 401 and out["u7"] == "early" and out["new"] == "a"
    seen = dedup_job.seen_by_earlier(second, root, "url", 1)
    every = len(spark.read.parquet(f"{root}/seen").inputFiles())
    assert 0 < seen.select(F.input_file_name().alias("f")).distinct().count() <= 2 < every


def test_raw_stream_feeds_two_sinks_once(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    (raw / "articles_1.json").write_text('{"url":"u1","title":"t"}\n{"url":"u2","title":"t"}\n[1, 2\n{"title":"no url"}\n')
    (raw / "articles_2.json").write_text("{not json\n")
    write = sp.raw_writer(out)

    def twice(batch, batch_id):
        write(batch, batch_id)
        write(batch, batch_id)
    sp.run_foreach_batch(landed.stream_raw_batches(spark, str(raw)), twice, str(tmp_path / "c"))
    good = spark.read.parquet(f"{out}/articles").collect()
    dead = spark.read.json(f"{out}/dead_letters").collect()
    assert sorted(r.url for r in good) == ["u1", "u2"] and all(r.landed_file.endswith("articles_1.json") for r in good)
    assert sorted((r.error, r.landed_file[-15:]) for r in dead) == [
        ("article without url", "articles_1.json"), ("not a JSON article", "articles_1.json"),
        ("not a JSON article", "articles_2.json")]


def test_dead_letters_and_months_of_a_retried_run(spark, tmp_path):
    rows = spark.createDataFrame([("a", dt.datetime(2024, 1, 5)), ("b", dt.datetime(2024, 2, 5))], "id string, published timestamp")
    for run in ("1", "1", "2"):
        sink.write_month_partitioned(rows, str(tmp_path / "months"), run)
        sink.write_dead_letter(rows.select("id"), str(tmp_path / "dead"), run)
    assert spark.read.parquet(str(tmp_path / "months")).count() == 4
    assert spark.read.json(str(tmp_path / "dead")).count() == 4
    table = spark.read.parquet(str(tmp_path / "months")).withColumn("day", F.to_date("published"))
    january = table.where("published_month = '2024-01'")
    assert january.select(F.input_file_name()).distinct().count() == 2


def test_retention_reads_kept_partitions_only(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.range(40).select("id", F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day")) \
        .write.partitionBy("day").parquet(path)
    kept = sink.kept_partitions(spark.read.parquet(path), "day", 9)
    assert kept.count() == 10 and kept.select(F.input_file_name()).distinct().count() == 10
    assert sink.kept_partitions(spark.read.parquet(path).limit(0), "day", 9).count() == 0


@pytest.mark.parametrize("kind", ["rss", "atom"])
def test_feed_files(spark, tmp_path, kind):
    p = tmp_path / f"{kind}.xml"
    if kind == "rss":
        p.write_text("""<?xml version="1.0"?><rss xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>Feed</title>
<item><title><![CDATA[ A & B ]]></title><link> http://a/1 </link><dc:date>2024-01-02</dc:date><description>d</description></item>
<item><title>broken</link></item><item>
<title>third</title><link>http://a/3</link><pubDate/><published>2024-01-04</published><summary/><description>x</description></item>
<item><title>no link</title></item></channel></rss>""")
    else:
        p.write_text("""<feed xmlns="http://www.w3.org/2005/Atom"><title>Feed</title><entry><title>A &amp; B</title>
<link rel="self" href="http://self"/><link rel="alternate" href="http://a/1"/><updated>2024-01-02</updated>
<content type="html">d</content></entry><entry><title>broken</entry><entry><title>third</title><link href="http://a/3"/>
<published>2024-01-04</published><updated>2024-01-09</updated><summary>x</summary></entry><entry><title>no link</title></entry></feed>""")
    rows = landed.read_feed_items(spark, str(p), "S", "c").collect()
    good = sorted((r.url, r.title, r.published, r.raw_text) for r in rows if r._corrupt_record is None)
    assert good == [("http://a/1", "A & B", "2024-01-02", "d"), ("http://a/3", "third", "2024-01-04", "x")]
    assert sum(r._corrupt_record is not None and "broken" in r._corrupt_record for r in rows) == 1 and len(rows) == 3


def test_article_run_stops_between_tables_and_replays(spark, tmp_path):
    from ratelens.operators import tagging as tg
    from ratelens.streaming import article_job as aj
    root = str(tmp_path / "run")
    when = "Tue, 02 Jan 2024 10:00:00 +0000"
    rows = [(f"http://a/{i}", f"t{i}", when, f"s{i % 2}", "news", f"central bank hikes rates {i}; copper falls")
            for i in range(20)]
    rows += [rows[0], (None, "no url", when, "s", "news", "x"), ("http://a/99", "t", "bad date", "s", "news", "... !")]
    frame = spark.createDataFrame(rows, "url string, title string, published string, source string, category string, raw_text string")
    countries = spark.createDataFrame([("N01",)], "country_code string")

    def job(stop=None):
        return aj.article_writer(root, lambda d: tg.lexicon_tagger(d, "raw_text", ["copper"], "article_id"), countries,
                                 ["copper"], budget=12, stop_after=stop)

    def counts():
        tables = {"fact_article": None, "dead_letter": None, "queue": aj.QUEUED, "calls": aj.CALLS, "seen": aj.SEEN,
                  "bridge_article_sector": None}
        return {t: aj.committed(spark, root, t, s).count() for t, s in tables.items()}
    for stop in ("sliced", "fact_article", "queue", "seen"):
        with pytest.raises(RuntimeError):
            job(stop)(frame, 0)
        if stop == "seen":
            assert set(counts().values()) == {0}                    # nothing of it is seen
    job()(frame, 0)
    first = counts()
    # the undated article has no run day, so it takes a budget of its own
    assert first == {"fact_article": 12, "dead_letter": 1, "queue": 8, "calls": first["calls"], "seen": 21,
                     "bridge_article_sector": 12}
    job()(frame, 0)                                                 # a replay of a committed batch
    assert counts() == first
    with pytest.raises(RuntimeError):
        job("dim_source")(frame, 1)
    assert counts() == first
    job()(frame, 1)                                                 # all seen, the day's budget spent: the backlog stays
    assert counts()["fact_article"] == 12 and counts()["seen"] == 21
    assert aj.committed(spark, root, "queue", aj.QUEUED).where("batch = 1").count() == 8


def test_article_run_moves_texts_once(spark, tmp_path):
    from ratelens.operators import queue as qu
    from ratelens.operators import tagging as tg
    from ratelens.operators.topk import first_per_group
    from ratelens.streaming import article_job as aj
    root = str(tmp_path / "run")
    rows = [(f"http://a/{i}", "t", "Tue, 02 Jan 2024 10:00:00 +0000", "s", "news", f"central bank hikes rates {i}") for i in range(9)]
    frame = spark.createDataFrame(rows, "url string, title string, published string, source string, category string, raw_text string")
    countries = spark.createDataFrame([("N01",)], "country_code string")
    run = aj.article_writer(root, lambda d: tg.lexicon_tagger(d, "raw_text", ["copper"], "article_id"), countries, ["copper"], budget=4)
    run(frame, 0)
    run(frame, 1)
    # what was seen is not staged again, the slice is decided without texts, the queue keeps them
    assert spark.read.parquet(f"{root}/arrived/batch=1").count() == 0
    assert "raw_text" not in spark.read.parquet(f"{root}/sliced/batch=0").columns
    left = aj.committed(spark, root, "queue", aj.QUEUED).where("batch = 1").collect()
    assert len(left) == 5 and {r.raw_text for r in left} <= {r[5] for r in rows}
    # candidates are marked without a shuffle of theirs
    cands = spark.range(5000).selectExpr("cast(id as string) article_id", "date '2024-01-02' run_day", "0 prio", "id queued_at")
    plan = qu.budget_slice(cands, budget=3)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # rows alike in the order: the first by the other values
    ties = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 6, "0")], "k int, o int, v string").repartition(3)
    assert first_per_group(ties, ["k"], ["o"], ["v"]).collect() == [(1, "a")]


def test_classifier_reports_every_test_row(spark):
    from ratelens.operators import models as md
    rows = [(i, float(i % 7), float(i % 3) if i % 5 else None, int(i % 7 > 3)) for i in range(60)]
    frame = spark.createDataFrame(rows, "id int, a double, b double, rise int")
    out = md.direction_classifier(frame.where("id < 40"), frame.where("id >= 40"), ["a", "b"], "rise").collect()
    assert len(out) == 20 and {r.id for r in out if r.prediction is None} == {40, 45, 50, 55}
