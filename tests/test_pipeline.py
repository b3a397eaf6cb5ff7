"""Tagging (X01-X03, F15, F23), streaming jobs (L01, L02, L03 carry-over), models
(G17 Lasso vs brute force, G19 report) and registry smoke checks."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratelens.operators import models as md
from ratelens.operators import regression as rg
from ratelens.operators import tagging as tg
from ratelens.streaming import pipeline as sp
from tests.conftest import SF_SMALL

SECTORS = ["copper", "lithium"]


def test_lexicon_tagger_semantics(spark):
    docs = spark.createDataFrame([
        (1, "The central bank will hike rates again; copper prices fall. US and CL react."),
        (2, "Copper mining output and production rise; strong demand for lithium."),
        (3, "... 123 !!"),
        (4, "Dovish bank signals a rate cut and stimulus; dollar weak, bonds yield up."),
    ], "doc_id long, text string")
    rows = {r.doc_id: r for r in tg.lexicon_tagger(docs, "text", SECTORS).collect()}
    t1 = rows[1].tags
    assert t1.article_category == "monetary_policy" and t1.policy_stance == "contractionary"
    assert t1.country_codes == ["CL", "US"] and t1.sector_tags == ["copper"]
    assert "interest_rate" in t1.policy_subtype and t1.sentiment_score < 0
    t2 = rows[2].tags
    assert t2.article_category == "commodity_stocks" and t2.policy_stance == "neutral"
    assert t2.sector_tags == ["copper", "lithium"] and t2.policy_subtype == []
    assert "extraction_incentives" in t2.mechanisms and t2.sentiment_score > 0
    assert rows[3].tags is None and rows[3].error == "no words to tag"
    t4 = rows[4].tags
    assert t4.policy_stance == "expansionary"
    assert set(t4.mechanisms) >= {"usd_value", "investment_substitution"}


def test_validate_dead_letters(spark):
    good = '{"article_category":"monetary_policy","country_codes":["N01"],"sector_tags":[],' \
           '"policy_subtype":["interest_rate"],"sentiment_score":0.1,"sentiment_target":"",' \
           '"mechanisms":[],"policy_stance":"neutral"}'
    bad_enum = good.replace('"neutral"', '"sideways"')
    bad_tag = good.replace('"interest_rate"', '"tariffs"')
    bad_cc = good.replace('"N01"', '"ZZ"')
    df = spark.createDataFrame([(1, good), (2, bad_enum), (3, bad_tag), (4, "{oops"), (5, bad_cc)],
                               "doc_id long, payload string")
    dims = spark.createDataFrame([("N01",)], "country_code string")
    out = {r.doc_id: r.error for r in tg.validate(df, "payload", "doc_id", dims, []).collect()}
    assert out[1] is None
    assert out[2] == "policy_stance outside vocabulary"
    assert out[3] == "policy_subtype outside vocabulary"
    assert out[4] == "unparseable payload"
    assert out[5] == "country code outside dimension"
    ok, dead = tg.split_ok_dead(tg.validate(df, "payload", "doc_id", dims, []))
    assert ok.count() == 1 and dead.count() == 4


def test_publish_time_formats(spark):
    df = spark.createDataFrame([("Tue, 02 Jan 2024 10:00:00 +0000",), ("02 Jan 2024 10:00:00 GMT",),
                                ("2024-01-02T10:00:00",), ("Tue, 02 Jan 2024 12:00:00 +0200",),
                                ("garbage",)], "s string")
    got = [r.p for r in df.select(tg.parse_published(F.col("s")).alias("p")).collect()]
    assert [str(g) if g else None for g in got] == ["2024-01-02 10:00:00"] * 4 + [None]


def test_duplicate_titles_groups_near_copies(spark):
    df = spark.createDataFrame([(1, "Copper Rally!"), (2, "copper rally"), (3, "Other")],
                               "doc_id long, text string")
    rows = tg.duplicate_titles(df, "doc_id", "text").collect()
    assert len(rows) == 1 and rows[0].n_docs == 2 and rows[0].first_id == 1


def test_stream_dedup_across_files_and_rediscovery(spark, tmp_path):
    src = tmp_path / "landed"
    src.mkdir()
    schema = "url string, ts timestamp"
    spark.createDataFrame([("u1", "2024-01-01 00:00:00"), ("u2", "2024-01-01 01:00:00")], "url string, ts string") \
        .select("url", F.to_timestamp("ts").alias("ts")).write.parquet(str(src / "a"))
    spark.createDataFrame([("u1", "2024-01-02 00:00:00"), ("u3", "2024-01-02 01:00:00")], "url string, ts string") \
        .select("url", F.to_timestamp("ts").alias("ts")).write.parquet(str(src / "b"))
    from pyspark.sql import types as T
    st = T._parse_datatype_string(schema)
    stream = sp.landed_stream(spark, str(src / "*"), st)
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    sp.run_available_now(sp.dedup_within_watermark(stream, ["url"], "ts"), out, ck)
    assert sorted(r.url for r in spark.read.parquet(out).collect()) == ["u1", "u2", "u3"]
    sp.run_available_now(sp.dedup_within_watermark(sp.landed_stream(spark, str(src / "*"), st),
                                                   ["url"], "ts"), out, ck)
    assert spark.read.parquet(out).count() == 3  # rerun discovers nothing new


def test_lasso_moments_match_raw_data_cd(spark):
    rng = np.random.default_rng(11)
    n, p = 60, 4
    x = rng.normal(size=(n, p))
    y = 1.5 * x[:, 0] - 0.8 * x[:, 2] + rng.normal(scale=0.5, size=n)
    rows = [("m", i, float(y[i]), *map(float, x[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, month int, y double, " +
                               ", ".join(f"f{j} double" for j in range(p)))
    got = {r.feature: r.coef for r in md.lasso_cv(df, ["k"], [f"f{j}" for j in range(p)], "y")
           .withColumnRenamed("month", "m").collect()}
    # brute force on raw rows: standardise (population std), contiguous folds, CD per alpha
    xs = (x - x.mean(0)) / x.std(0)
    k = max(2, min(5, n // 10))
    bounds = np.cumsum([0] + [n // k + (1 if i < n % k else 0) for i in range(k)])

    def mom(idx):
        xi, yi = xs[idx], y[idx]
        return len(idx), xi.sum(0), yi.sum(), xi.T @ xi, xi.T @ yi, yi @ yi
    tot = mom(np.arange(n))
    a_max = np.max(np.abs(tot[4] - n * (tot[1] / n) * (tot[2] / n))) / n
    alphas = np.logspace(np.log10(a_max * 1e-3), np.log10(a_max), 100)[::-1]
    mse = np.zeros(100)
    for f in range(k):
        te = np.arange(bounds[f], bounds[f + 1])
        tr = np.setdiff1d(np.arange(n), te)
        for ai, a in enumerate(alphas):
            b0, b = md.lasso_cd(*mom(tr)[:5], a)
            mse[ai] += np.mean((y[te] - b0 - xs[te] @ b) ** 2) / k
    _, coef = md.lasso_cd(*tot[:5], alphas[int(np.argmin(mse))])
    for j in range(p):
        assert abs(got[f"f{j}"] - coef[j]) < 1e-5
    assert abs(got["f0"]) > 0.5 and abs(got["f1"]) < abs(got["f0"])


def test_classification_report_counts(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0), (0, 1), (1, 1)], "a int, p int")
    rep = {r.cls: r for r in rg.classification_report(df, "a", "p").collect()}
    assert (rep[1].tp, rep[1].fp, rep[1].fn) == (2, 1, 1)
    assert abs(rep[1].precision - 2 / 3) < 1e-12 and abs(rep[0].accuracy - 4 / 6) < 1e-12


SMOKE = ["q01_correlation_batch", "q03_country_activity", "q07_macro_ingest", "g13_ols_coefficients",
         "x01_lexicon_tagger", "t04_budget_slice"]


@pytest.mark.parametrize("name", SMOKE)
def test_registered_query_matches_oracle_small(spark, name):
    import duckdb

    import __spark_entry__ as entry
    from ratelens.sources.driver import DRIVER_TABLES, table_path
    from tools.check_oracle import rows_of
    sdf = entry.queries()[name](spark, SF_SMALL).toPandas()
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    ddf = con.execute(entry.oracle_sql()[name]).fetchdf()
    assert rows_of(sdf) == rows_of(ddf)


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() >= 0 and "pearson_r" in df.columns
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_queue_carryover_across_micro_batches(spark, tmp_path):
    from datetime import datetime, timedelta

    from ratelens.streaming import queue_job as qj
    src = tmp_path / "landed"
    base = datetime(2024, 1, 1, 8, 0, 0)
    for d in range(3):  # one landed file per day, written in arrival order
        rows = [(f"a{d}_{i:02d}", f"u{d}_{i}", base + timedelta(days=d, minutes=i)) for i in range(20)]
        spark.createDataFrame(rows, "article_id string, source_url string, published timestamp") \
            .coalesce(1).write.parquet(str(src / f"day={d}"))
    from pyspark.sql import types as T
    schema = T._parse_datatype_string("article_id string, source_url string, published timestamp")
    stream = sp.landed_stream(spark, str(src / "day=*"), schema, max_files=1)
    root, ck = str(tmp_path / "state"), str(tmp_path / "ck")
    sp.run_foreach_batch(stream, qj.queue_writer(root, budget=5), ck)
    done = spark.read.parquet(f"{root}/processed")
    per_day = {r.run_day.day: r.n for r in done.groupBy("run_day").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert per_day == {1: 5, 2: 5, 3: 5}
    # FIFO across runs: the backlog of day 1 is drained before any newer article
    assert sorted(r.article_id for r in done.collect()) == [f"a0_{i:02d}" for i in range(15)]
    last = max(int(p.name.split("=")[1]) for p in (tmp_path / "state" / "queue").iterdir())
    assert spark.read.parquet(f"{root}/queue/batch={last}").count() == 45


def test_exact_dedup_state_across_batches(spark, tmp_path):
    from ratelens.streaming import dedup_job as dj
    src = tmp_path / "landed"
    rows1 = [("h1", "a1", "2024-01-01 00:00:00"), ("h2", "a2", "2024-01-01 00:01:00"),
             ("h1", "a9", "2024-01-01 00:02:00")]           # repeat inside the first delivery
    rows2 = [("h2", "b2", "2024-01-02 00:00:00"), ("h3", "b3", "2024-01-02 00:01:00")]
    for name, rows in (("d1", rows1), ("d2", rows2)):
        spark.createDataFrame(rows, "url_hash string, article_id string, published string") \
            .select("url_hash", "article_id", F.to_timestamp("published").alias("published")) \
            .coalesce(1).write.parquet(str(src / name))
    from pyspark.sql import types as T
    schema = T._parse_datatype_string("url_hash string, article_id string, published timestamp")
    stream = sp.landed_stream(spark, str(src / "d*"), schema, max_files=1)
    root, ck = str(tmp_path / "state"), str(tmp_path / "ck")
    sp.run_foreach_batch(stream, dj.exact_dedup_writer(root, "url_hash", ["published", "article_id"],
                                                       ["url_hash", "article_id"]), ck)
    out = sorted(map(tuple, spark.read.parquet(f"{root}/out").select("url_hash", "article_id").collect()))
    assert out == [("h1", "a1"), ("h2", "a2"), ("h3", "b3")]
