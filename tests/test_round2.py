"""Regression tests: value caps, retry-safe sinks, title and time parsing,
stratified split, models on thin data, queue state, fresh scans."""

from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from ratelens.functions.scalar import round_half_up
from ratelens.operators import interpret as it
from ratelens.operators import models as md
from ratelens.operators import series as se
from ratelens.operators import tagging as tg
from ratelens.plans.q_articles import stratified_split
from ratelens.sinks import tables as sink
from ratelens.sources import driver
from ratelens.sources import tpch_star as ts
from ratelens.streaming import queue_job as qj


def test_rounding_keeps_large_values(spark):
    values = [1e13, 1e17, -4.6e13, 2.5e-7, 1.0000005, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(round_half_up(F.col("x"), 6)).collect()]
    assert got == [1e13, 1e17, -4.6e13, 0.0, 1.000001, None]


def test_country_codes_beyond_two_digits(spark):
    df = spark.createDataFrame([(3,), (12,), (123,)], "k int")
    assert [r[0] for r in df.select(ts.country_code(F.col("k"))).collect()] == ["N03", "N12", "N123"]


def test_pairs_follow_the_sector_dimension(spark, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([(1, "SEVENTH"), (2, "PROMO")], "p_partkey int, p_type string") \
        .write.parquet(f"{sf}/part.parquet")
    spark.createDataFrame([(0, "A", 0), (101, "B", 0)], "n_nationkey int, n_name string, n_regionkey int") \
        .write.parquet(f"{sf}/nation.parquet")
    spark.createDataFrame([(0, "R")], "r_regionkey int, r_name string").write.parquet(f"{sf}/region.parquet")
    got = {tuple(r) for r in ts.pairs(spark, sf).collect()}
    assert got == {(c, s) for c in ("N00", "N101") for s in ("seventh", "promo")}


def test_fractional_quantities_are_kept(spark, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([(1, "PROMO")], "p_partkey int, p_type string").write.parquet(f"{sf}/part.parquet")
    spark.createDataFrame([(1, dt.date(2020, 1, 5), 10.0, 2.5, 0.0)],
                          "l_partkey int, l_shipdate date, l_extendedprice double, l_quantity double, l_discount double") \
        .write.parquet(f"{sf}/lineitem.parquet")
    assert ts.market_levels(spark, sf).first()["price_index"] == 4.0


def test_scan_sees_an_append(spark, tmp_path):
    sf = str(tmp_path)
    spark.range(5).write.parquet(f"{sf}/events.parquet")
    assert driver.read(spark, sf, "events").count() == 5
    spark.range(5).write.mode("append").parquet(f"{sf}/events.parquet")
    assert driver.read(spark, sf, "events").count() == 10


def test_result_append_is_retry_safe(spark, tmp_path):
    path = str(tmp_path / "results")
    run = lambda ts_, n: spark.range(n).select(
        F.col("id").alias("result_id"), F.to_timestamp_ntz(F.lit(ts_)).alias("computed_at"),
        F.to_date(F.lit(ts_[:10])).alias("run_date"))
    for _ in range(2):
        sink.append_results(run("2024-03-03 08:00:00", 3), path)
    sink.append_results(run("2024-03-03 09:00:00", 2), path)
    assert spark.read.parquet(path).count() == 5


def test_series_that_starts_after_the_end_has_no_months(spark):
    a = spark.createDataFrame([("N1", "g", 2030, 1.0), ("N2", "g", 2000, 2.0)],
                              "country_code string, indicator_id string, year int, value double")
    out = se.annual_to_monthly(a, "2001-12-01").groupBy("country_code").count().collect()
    assert [tuple(r) for r in out] == [("N2", 24)]


def test_publish_times(spark):
    raw = ["Fri, 5 Jan 2024 07:08:09 +0000", "5 Jan 24 07:08:09 GMT", "2024-01-05T10:00:00.123Z", "2024-01-05",
           "Fri, 05 Jan 2024 07:08 GMT", "nonsense"]
    df = spark.createDataFrame([(x,) for x in raw], "s string")
    got = [r[0] for r in df.select(F.date_format(tg.parse_published(F.col("s")), "yyyy-MM-dd HH:mm:ss")).collect()]
    assert got == ["2024-01-05 07:08:09", "2024-01-05 07:08:09", "2024-01-05 10:00:00", "2024-01-05 00:00:00",
                   "2024-01-05 07:08:00", None]


def test_titles_of_other_scripts_are_not_one_group(spark):
    df = spark.createDataFrame([(1, "Ставка растёт"), (2, "Рынок падает"), (3, "  "), (4, "2024"), (5, "Rates: UP!"),
                                (6, "rates up"), (7, None)], "id int, title string")
    out = tg.duplicate_titles(df, "id", "title").collect()
    assert [(r["n_docs"], r["first_id"]) for r in out] == [(2, 5)]


def test_tokens_keep_accented_words(spark):
    df = spark.createDataFrame([("Éupbad über UP",)], "t string")
    assert df.select(tg.tokens(F.col("t"))).first()[0] == ["éupbad", "über", "up"]


def test_split_is_stratified_exactly(spark):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 10 == 0).cast("int").alias("c"))
    out = stratified_split(rows, "k", "c").groupBy("c").agg(F.sum(F.col("is_train").cast("int")).alias("n")).collect()
    assert {r["c"]: r["n"] for r in out} == {0: 630, 1: 70}


def test_lasso_survives_a_constant_feature_and_a_single_row(spark):
    rows = [("a", i, float(i), 1.0, 2.0 * i) for i in range(30)] + [("b", 0, 1.0, 1.0, 1.0)]
    obs = spark.createDataFrame(rows, "m string, month int, x double, z double, y double")
    out = {(r["m"], r["feature"]): r["coef"] for r in md.lasso_cv(obs, ["m"], ["x", "z"], "y").collect()}
    assert out[("a", "x")] > 0 and out[("a", "z")] == 0 and out[("b", "x")] == 0


def test_classifier_minimum_counts_all_rows(spark):
    rows = spark.range(24).select((F.col("id") % 7).cast("double").alias("f"), (F.col("id") % 2).cast("int").alias("y"),
                                  F.col("id"))
    assert md.direction_classifier(rows.where("id < 17"), rows.where("id >= 17"), ["f"], "y") is not None
    assert md.direction_classifier(rows.where("id < 10"), rows.where("id between 10 and 18"), ["f"], "y") is None


def _articles(spark, day, ids):
    return spark.createDataFrame([(f"a{i}", f"u{i}", dt.datetime.fromisoformat(f"{day}T00:00:{i % 60:02d}")) for i in ids],
                                 "article_id string, source_url string, published timestamp")


def test_queue_state_over_empty_batches_and_one_day(spark, tmp_path):
    root = str(tmp_path)
    write = qj.queue_writer(root, budget=15)
    write(_articles(spark, "2024-01-01", range(20)), 0)
    write(_articles(spark, "2024-01-01", range(20, 30)), 1)
    done = sum(spark.read.parquet(f"{root}/processed/batch={b}").count() for b in (0, 1))
    assert done == 15
    write(_articles(spark, "2024-01-01", []), 2)
    write(_articles(spark, "2024-01-01", []), 2)          # replay
    assert spark.read.schema(qj.QUEUE).parquet(f"{root}/queue/batch=2").count() == 15
    drain = qj.queue_writer(root, budget=15, run_day_of=lambda batch, b: "2024-01-02")
    drain(_articles(spark, "2024-01-02", []), 3)
    assert spark.read.parquet(f"{root}/processed/batch=3").count() == 15
    assert spark.read.schema(qj.QUEUE).parquet(f"{root}/queue/batch=3").count() == 0


def test_failing_generator_is_recorded_and_not_cached(spark):
    rows = spark.createDataFrame([("k1", "rule text", "generated"), ("k2", "cached", "cache")],
                                 "cache_key string, interpretation_text string, source string")

    def broken(pdf: pd.DataFrame):
        raise RuntimeError("no model")

    out = {r["cache_key"]: (r["interpretation_text"], r["source"]) for r in
           it.generate_with_plugin(rows, broken).collect()}
    assert out == {"k1": ("rule text", "rules"), "k2": ("cached", "cache")}


def test_panel_reads_the_landed_facts(spark):
    from ratelens.plans.star import Star
    star = Star(spark, "/root/testdata/sf0.001")
    empty = spark.createDataFrame([], star.fact_macro_indicator.schema)
    assert star.with_facts(empty, star.market).panel.count() == 0
