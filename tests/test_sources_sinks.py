"""Landed-format readers (S02-S06, S08), upsert (K01), snapshots, retention,
salted top-k and the budget slice, with hand-made golden inputs."""

from __future__ import annotations

import json
from datetime import date

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from ratelens.operators import queue as qu
from ratelens.operators import series as se
from ratelens.operators.topk import top_k_per_group
from ratelens.sinks import tables as sink
from ratelens.sources import landed


def test_sdmx_csv(spark, tmp_path):
    p = tmp_path / "cbpol.csv"
    p.write_text("FREQ,REF_AREA,TIME_PERIOD,OBS_VALUE\nM,CL,2020-01,1.75\nM,CL,2020-02,\n"
                 "M,CL,2020-03,0.5\n")
    rows = landed.read_sdmx_csv(spark, str(p), "CL").orderBy("month").collect()
    assert [(r.month, r.value) for r in rows] == [(date(2020, 1, 1), 1.75), (date(2020, 3, 1), 0.5)]
    assert {r.country_code for r in rows} == {"CL"}


def test_wdi_json(spark, tmp_path):
    p = tmp_path / "wdi.json"
    p.write_text(json.dumps([{"page": 1}, [{"date": "2021", "value": 2.5},
                                           {"date": "2020", "value": None},
                                           {"date": "2019", "value": 1.0}]]))
    rows = landed.read_wdi_json(spark, str(p), "AU").orderBy("year").collect()
    assert [(r.year, r.value) for r in rows] == [(2019, 1.0), (2021, 2.5)]


def test_fred_json_sentinel_and_month_collapse(spark, tmp_path):
    p = tmp_path / "fred.json"
    p.write_text(json.dumps({"observations": [
        {"date": "2024-01-02", "value": "4.1"}, {"date": "2024-01-31", "value": "4.3"},
        {"date": "2024-02-01", "value": "."}, {"date": "2024-02-15", "value": "4.0"}]}))
    daily = landed.read_fred_json(spark, str(p))
    assert daily.count() == 3
    monthly = se.last_per_month(daily.withColumn("k", F.lit(1)), ["k"], "ts", "value")
    got = {r.month: r.value for r in monthly.collect()}
    assert got == {date(2024, 1, 1): 4.3, date(2024, 2, 1): 4.0}


def test_sheet_unpivot_skips_unmapped(spark):
    sheet = spark.createDataFrame([("1960M01", 1.0, None), ("1960M02", 2.0, 3.0), (None, 9.0, 9.0)],
                                  "period string, Copper double, Nickel double")
    out = landed.sheet_to_long(sheet, {"copper": "Copper", "nickel": "Nickel", "cobalt": "Cobalt"})
    got = sorted((r.sector_id, r.date_key, r.price_index) for r in out.collect())
    assert got == [("copper", "1960-01", 1.0), ("copper", "1960-02", 2.0), ("nickel", "1960-02", 3.0)]


def test_price_sheet_banner_lines(spark, tmp_path):
    p = tmp_path / "sheet.csv"
    p.write_text("World Bank prices\n(nominal)\n\nunits,$/mt,$/mt\n,Copper,Nickel\n"
                 "1960M01,679.0,1631.0\n1960M02,681.5,\n")
    sheet = landed.read_price_sheet(spark, str(p), ["period", "Copper", "Nickel"])
    out = landed.sheet_to_long(sheet, {"copper": "Copper", "nickel": "Nickel"})
    got = sorted((r.sector_id, r.date_key, r.price_index) for r in out.collect())
    assert got == [("copper", "1960-01", 679.0), ("copper", "1960-02", 681.5),
                   ("nickel", "1960-01", 1631.0)]


def test_rss_items(spark, tmp_path):
    p = tmp_path / "feed.xml"
    p.write_text("""<rss><channel>
<item><title>  Rate hike  </title><link>http://a/1</link><pubDate>Tue, 02 Jan 2024 10:00:00 +0000</pubDate>
<description>desc one</description></item>
<item><title>No link</title><description>x</description></item>
<item><title>Second</title><link>http://a/2</link><updated>2024-01-03T00:00:00</updated>
<summary>sum two</summary></item>
</channel></rss>""")
    rows = landed.read_rss_items(spark, str(p), "Feed A", "central_bank").orderBy("url").collect()
    assert [r.url for r in rows] == ["http://a/1", "http://a/2"]
    assert rows[0].title == "Rate hike" and rows[0].raw_text == "desc one"
    assert rows[1].published == "2024-01-03T00:00:00" and rows[1].raw_text == "sum two"


def test_raw_batches_corrupt_record(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "articles_1.json").write_text(json.dumps([
        {"url": "u1", "title": "t", "published": "", "source": "S", "category": "c", "raw_text": "x"}]))
    (raw / "articles_2.json").write_text("{not json")
    df = landed.read_raw_batches(spark, str(raw)).cache()
    assert df.where(F.col("_corrupt_record").isNotNull()).count() == 1
    assert df.where(F.col("url") == "u1").count() == 1


def test_upsert_idempotent_dedup_and_key_only(spark):
    target = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, v double")
    inc = spark.createDataFrame([("b", 5.0), ("b", 7.0), ("c", 3.0)], "k string, v double")
    once = sink.upsert(target, inc, ["k"])
    twice = sink.upsert(once, inc, ["k"])
    a = sorted(map(tuple, once.collect()))
    assert a == sorted(map(tuple, twice.collect()))
    assert a == [("a", 1.0), ("b", 7.0), ("c", 3.0)]  # deterministic pick among duplicates
    bridge = spark.createDataFrame([("x", "CL")], "article_id string, country_code string")
    new = spark.createDataFrame([("x", "CL"), ("x", "PE")], "article_id string, country_code string")
    assert sink.upsert(bridge, new, ["article_id", "country_code"]).count() == 2
    assert sink.upsert(target, inc.limit(0), ["k"]).count() == 2


def test_snapshot_never_overwrites(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0)], "k string, v double")
    p1 = sink.write_snapshot(df, str(tmp_path))
    p2 = sink.write_snapshot(df, str(tmp_path))
    assert p1 != p2 and spark.read.parquet(p1).count() == 1


def test_salted_topk_equals_plain_ranking_with_hot_key(spark):
    rng = np.random.default_rng(1)
    keys = np.where(rng.random(3000) < 0.4, "hot", rng.choice(["a", "b", "c"], 3000))
    df = spark.createDataFrame([(str(k), int(i), float(v)) for i, (k, v) in
                                enumerate(zip(keys, rng.normal(size=3000)))], "g string, id long, v double")
    order = [F.col("v").desc(), F.col("id").asc()]
    salted = top_k_per_group(df, ["g"], order, 7, unique="id", salt_buckets=8)
    w = Window.partitionBy("g").orderBy(*order)
    plain = df.withColumn("rank", F.row_number().over(w)).where("rank <= 7")
    assert sorted(map(tuple, salted.select("g", "id", "rank").collect())) == \
        sorted(map(tuple, plain.select("g", "id", "rank").collect()))


def test_budget_slice_respects_used_calls(spark):
    c = spark.createDataFrame(
        [(f"a{i}", "u", date(2024, 1, 1 + i % 2), i, 0) for i in range(40)],
        "article_id string, source_url string, run_day date, queued_at int, prio int")
    used = spark.createDataFrame([("2024-01-01", 10)], "date_key string, calls_used int")
    out = qu.budget_slice(c, used, budget=15)
    per = {r.run_day: r.n for r in out.where("processed").groupBy("run_day")
           .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert per == {date(2024, 1, 1): 5, date(2024, 1, 2): 15}
    first = out.where("processed and run_day = '2024-01-01'").agg(F.max("queued_at")).first()[0]
    assert first == 8  # FIFO: the five oldest of that day (0, 2, 4, 6, 8)


def test_retention_keeps_recent(spark):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (2, "2024-01-25 00:00:00"),
                                (3, "2024-01-30 00:00:00")], "id int, ts string") \
        .withColumn("ts", F.to_timestamp("ts"))
    assert sorted(r.id for r in sink.retention_keep(df, "ts", 7).collect()) == [2, 3]
