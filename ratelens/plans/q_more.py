"""Further registered queries: landed-format round trips (S03-S05, S07,
S08, S10, S12, T05), composite entry points (Q06, Q09-Q11) and small
functions (F03, F06, F16, G01, J13, K09, T01)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import GLOBAL_INDICATORS
from ..functions import scalar as sc
from ..operators import articles as ar
from ..operators import queue as qu
from ..operators import series as se
from ..operators import tagging as tg
from ..schema import conform, empty
from ..sinks import tables as sink
from ..sources import driver, landed
from ..sources import tpch_star as ts
from ..streaming import pipeline as sp
from . import oracle as O
from . import q_ml, q_series  # noqa: F401  (registers the s_annual, s_instruments, s_ols CTEs)
from .q_articles import _star
from .q_correlation import _runs_sql, _history, KEYS4
from .q_tagging import _validated
from .registry import finish, register
from .star import Star


def _scratch(spark, name):
    return sp.scratch(spark, name)[0]


@register("s03_sdmx_csv", lambda: O.with_ctes(
    "SELECT country_code, month, " + O.r6("value", "value")
    + " FROM s_macro_levels WHERE indicator_id = 'policy_rate'", "s_macro_levels"))
def s03(spark: SparkSession, sf: str) -> DataFrame:
    """Policy-rate series landed as SDMX CSV (one file per country folder)
    and read back by the SDMX reader."""
    lv = Star(spark, sf).macro_levels.where(F.col("indicator_id") == "policy_rate")
    path = _scratch(spark, "sdmx")
    (lv.select(F.lit("M").alias("FREQ"), F.col("country_code").alias("REF_AREA"),
               F.date_format("month", "yyyy-MM").alias("TIME_PERIOD"),
               F.col("value").cast("string").alias("OBS_VALUE"))
     .write.option("header", True).csv(path))
    back = landed.read_sdmx_csv(spark, path, F.col("REF_AREA"))
    return finish(back.select("country_code", "month", "value"))


@register("s04_wdi_json", lambda: O.with_ctes(
    "SELECT country_code, year, " + O.r6("value", "value") + " FROM s_annual", "s_annual"))
def s04(spark: SparkSession, sf: str) -> DataFrame:
    """Annual series landed as [meta, rows] JSON documents, one per country
    (a country's yearly rows are a small bounded group), read back."""
    a = ts.annual_levels(spark, sf)
    docs = a.groupBy("country_code").agg(F.to_json(F.array(
        F.to_json(F.struct(F.lit(1).alias("page"))),
        F.to_json(F.collect_list(F.struct(F.col("year").cast("string").alias("date"), "value",
                                          F.col("country_code").alias("countryiso3code")))))).alias("j"))
    # the array of two JSON strings is re-encoded as a JSON array of documents
    text = docs.select(F.concat(F.lit("["), F.get_json_object("j", "$[0]"), F.lit(","),
                                F.get_json_object("j", "$[1]"), F.lit("]")).alias("value"),
                       "country_code")
    path = _scratch(spark, "wdi")
    text.write.partitionBy("country_code").text(path)
    back = landed.read_wdi_json(spark, path)
    return finish(back.select("country_code", "year", "value"))


@register("s05_fred_json", lambda: O.with_ctes(
    "SELECT indicator_id, month, " + O.r6("value", "value") + " FROM s_macro_levels "
    "WHERE country_code IS NULL AND month(month) <> 7", "s_macro_levels"))
def s05(spark: SparkSession, sf: str) -> DataFrame:
    """Global series landed as observation JSON (one document per series,
    '.' for July as the missing-value sentinel), read back."""
    lv = Star(spark, sf).macro_levels.where(F.col("country_code").isNull())
    val = F.when(F.month("month") == 7, F.lit(".")).otherwise(F.col("value").cast("string"))
    docs = lv.groupBy("indicator_id").agg(F.to_json(F.struct(F.collect_list(F.struct(
        F.date_format("month", "yyyy-MM-dd").alias("date"), val.alias("value"))).alias("observations")))
        .alias("value"))
    path = _scratch(spark, "fred")
    docs.write.partitionBy("indicator_id").text(path)
    back = spark.read.schema(landed.FRED_SCHEMA.add("indicator_id", "string")) \
        .option("multiLine", True).json(path)
    obs = back.select("indicator_id", F.explode("observations").alias("o"))
    out = obs.select("indicator_id", F.to_date("o.date").alias("month"),
                     landed.parse_sentinel(F.col("o.value")).alias("value")).where("value IS NOT NULL")
    return finish(out)


@register("s07_monthly_close", lambda: O.with_ctes(f"""
SELECT sector_id, month, {O.r6('close', 'close')} FROM (
  SELECT sector_id, {O.month('ts')} AS month, close,
         row_number() OVER (PARTITION BY sector_id, {O.month('ts')}
                            ORDER BY ts DESC, instrument_id DESC) AS rn
  FROM s_instruments WHERE close IS NOT NULL) t WHERE rn = 1""", "s_instruments"))
def s07(spark: SparkSession, sf: str) -> DataFrame:
    h = ts.instrument_history(spark, sf)
    return finish(se.last_per_month(h, ["sector_id"], "ts", "close", tiebreak="instrument_id"))


@register("s08_raw_batches", lambda: O.with_ctes("""
SELECT strftime(day, '%Y%m%d') AS run_ts, count(*) AS n, 'article' AS target FROM s_articles
WHERE CAST(substr(article_id, 2) AS BIGINT) % 50 <> 7 GROUP BY 1
UNION ALL SELECT strftime(day, '%Y%m%d'), count(*), 'article without url' FROM s_articles
WHERE CAST(substr(article_id, 2) AS BIGINT) % 50 = 7 GROUP BY 1
UNION ALL SELECT 'corrupt', 1, 'not a JSON article'""", "s_articles"))
def s08(spark: SparkSession, sf: str) -> DataFrame:
    """Raw article batches landed as JSON (one folder per run day, some records without
    URL, plus a corrupt file) and streamed into the article sink and the dead-letter
    sink; a replay of a batch changes neither."""
    f = _star(spark, sf).fact_article
    path, out = _scratch(spark, "raw"), _scratch(spark, "raw-out")
    no_url = F.substr("article_id", F.lit(2)).cast("bigint") % 50 == 7
    raw = f.select(F.when(~no_url, F.col("source_url")).alias("url"), "title",
                   F.date_format("published", "yyyy-MM-dd'T'HH:mm:ss").alias("published"),
                   F.col("source_id").alias("source"), F.col("article_category").alias("category"),
                   F.col("mech").alias("raw_text"), F.date_format("published", "yyyyMMdd").alias("run_ts"))
    raw.write.partitionBy("run_ts").json(path)
    spark.createDataFrame([("{not json",)], "value string").write.text(f"{path}/run_ts=corrupt")
    write = sp.raw_writer(out)

    def twice(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        write(batch, batch_id)
    sp.run_foreach_batch(landed.stream_raw_batches(spark, f"{path}/run_ts=*"), twice, f"{out}/_checkpoint")
    good = spark.read.parquet(f"{out}/articles").select("landed_file", F.lit("article").alias("target"))
    dead = spark.read.schema("error string, landed_file string").json(f"{out}/dead_letters")
    rows = good.unionByName(dead.select("landed_file", F.col("error").alias("target")))
    run = F.regexp_extract("landed_file", "run_ts=([^/]+)/", 1)
    return finish(rows.groupBy(run.alias("run_ts"), "target").agg(F.count(F.lit(1)).alias("n")))


@register("s10_table_or_empty", lambda: O.with_ctes(
    "SELECT sector_id, count(*) AS n FROM s_commodity_fact GROUP BY 1", "s_commodity_fact"))
def s10(spark: SparkSession, sf: str) -> DataFrame:
    """Create-if-missing: a present snapshot and a missing table path read
    through the same call (the missing one is a typed empty table)."""
    f = Star(spark, sf).fact_commodity_price
    root = _scratch(spark, "s10")
    present = sink.write_snapshot(f, root, "fact_commodity_price")
    both = read_or_empty(spark, present, "fact_commodity_price").unionByName(
        read_or_empty(spark, f"{root}/missing", "fact_commodity_price"))
    return finish(both.groupBy("sector_id").agg(F.count(F.lit(1)).alias("n")))


def read_or_empty(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The table at ``path`` cast to its registry type, or a typed
    empty table when nothing has been written yet."""
    try:
        return conform(spark.read.parquet(path), table)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return empty(spark, table)
        raise


@register("s12_nonempty_probe", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, (SELECT count(*) > 0 FROM {t}) AS nonempty"
    for t in driver.DRIVER_TABLES))
def s12(spark: SparkSession, sf: str) -> DataFrame:
    """Non-empty probe of every driver table (stops at the first row)."""
    rows = [(t, not driver.read(spark, sf, t).isEmpty()) for t in driver.DRIVER_TABLES]
    return spark.createDataFrame(rows, "table_name string, nonempty boolean")


@register("t05_newest_raw_batch", lambda: O.with_ctes(
    "SELECT max(strftime(day, '%Y%m%d')) AS newest_run FROM s_articles", "s_articles"))
def t05(spark: SparkSession, sf: str) -> DataFrame:
    """Newest landed raw batch: max over the run partitions."""
    f = _star(spark, sf).fact_article
    path = _scratch(spark, "t05")
    sink.write_raw_batch(f.select(F.col("source_url").alias("url"),
                                  F.date_format("published", "yyyyMMdd").alias("run_ts")), path)
    back = spark.read.schema("url string, run_ts string").json(path)
    return finish(back.agg(F.max("run_ts").alias("newest_run")))


@register("f03_content_id", lambda: O.with_ctes(
    "SELECT article_id, sha256(source_url) AS content_id FROM s_articles", "s_articles"))
def f03(spark: SparkSession, sf: str) -> DataFrame:
    """Content-derived ids (retry-safe) in place of random ids."""
    f = _star(spark, sf).fact_article
    return finish(f.select("article_id", qu.url_hash(F.col("source_url")).alias("content_id")))


@register("f06_month_format", """
SELECT strftime(o_orderdate, '%Y-%m') AS date_key, count(*) AS n FROM orders GROUP BY 1""")
def f06(spark: SparkSession, sf: str) -> DataFrame:
    o = driver.read(spark, sf, "orders", "o_orderdate")
    return finish(o.groupBy(se.date_key_month(F.col("o_orderdate")).alias("date_key"))
                  .agg(F.count(F.lit(1)).alias("n")))


@register("f16_nan_to_null", lambda: O.with_ctes("""
SELECT record_id, CASE WHEN value_change IS NULL OR value_change = 0 THEN NULL
                       ELSE """ + O.rnd("value_change") + """ END AS value_change
FROM s_macro_fact""", "s_macro_fact"))
def f16(spark: SparkSession, sf: str) -> DataFrame:
    """A change of exactly zero is marked as NaN upstream (the shape pandas
    produces for 0/0); NaN and null both become null."""
    f = Star(spark, sf).fact_macro_indicator
    marked = F.when(F.col("value_change") == 0, F.lit(float("nan"))).otherwise(F.col("value_change"))
    return finish(f.select("record_id", sc.nan_to_null(marked).alias("value_change")))


@register("g01_country_activity", lambda: O.with_ctes(f"""
SELECT bc.country_code, count(*) AS article_count,
       {O.r6("(CAST(sum(CAST(round(a.sentiment_score * 10000) AS BIGINT)) AS DOUBLE) / count(a.sentiment_score)) / 10000.0", 'avg_sentiment')}
FROM s_articles a JOIN s_bridge_country bc ON a.article_id = bc.article_id GROUP BY 1""",
    "s_articles", "s_bridge_country"))
def g01(spark: SparkSession, sf: str) -> DataFrame:
    """Country activity over all articles (no window)."""
    s = _star(spark, sf)
    return finish(ar.country_activity(s.fact_article, s.bridge_article_country))


@register("j13_global_controls", lambda: O.with_ctes("""
, g AS (SELECT month, """ + ", ".join(
    f"max(CASE WHEN indicator_id = '{i}' THEN value_change END) AS {i}" for i in GLOBAL_INDICATORS) + """
        FROM s_macro_fact WHERE country_code IS NULL GROUP BY 1)
SELECT p.country_code, p.sector_id, p.month, """ + ", ".join(
    O.r6(f"g.{i}", i) for i in GLOBAL_INDICATORS) + """
FROM s_panel p LEFT JOIN g ON p.month = g.month""", "s_panel"))
def j13(spark: SparkSession, sf: str) -> DataFrame:
    """Global benchmarks joined to every pair's panel on the month only, so
    they can act as controls.  The global side has one row per month."""
    star = Star(spark, sf)
    glob = (star.fact_macro_indicator.where(F.col("country_code").isNull())
            .groupBy("month").pivot("indicator_id", GLOBAL_INDICATORS).agg(F.max("value_change")))
    out = star.panel.join(glob, "month", "left")
    return finish(out.select("country_code", "sector_id", "month", *GLOBAL_INDICATORS))


@register("k09_conform_schema", lambda: O.with_ctes(
    "SELECT record_id, date_key, country_code, indicator_id, " + O.r6("value", "value") + ", "
    + O.r6("value_change", "value_change") + ", is_interpolated FROM s_macro_fact", "s_macro_fact"))
def k09(spark: SparkSession, sf: str) -> DataFrame:
    """Explicit-schema staging: cast by name to the registry type."""
    return finish(conform(Star(spark, sf).fact_macro_indicator, "fact_macro_indicator"))


@register("t01_newest_articles", lambda: O.with_ctes(
    "SELECT article_id, title, published FROM s_articles ORDER BY published DESC, article_id "
    "LIMIT 50", "s_articles"))
def t01(spark: SparkSession, sf: str) -> DataFrame:
    """Newest articles with the default limit (50)."""
    return finish(ar.newest(_star(spark, sf).fact_article).select("article_id", "title", "published"))


@register("q06_export_correlation", lambda: _runs_sql("""
SELECT country_code, sector_id, rate_basis, target_variable,
       arg_max(result_id, computed_at) AS result_id FROM hist GROUP BY 1, 2, 3, 4"""))
def q06(spark: SparkSession, sf: str) -> DataFrame:
    """Export of the latest result per full key as CSV, read back."""
    h = _history(spark, sf)
    latest = h.groupBy(*KEYS4).agg(F.max_by("result_id", F.struct("computed_at", "result_id"))
                                   .alias("result_id"))
    path = _scratch(spark, "export")
    sink.export_csv(latest, path)
    back = spark.read.option("header", True).schema(
        "country_code string, sector_id string, rate_basis string, target_variable string, "
        "result_id string").csv(path)
    return finish(back)


@register("q09_tag_pipeline", lambda: O.with_ctes("""
SELECT d.source, count(*) AS n_docs, count(*) FILTER (WHERE v.error IS NULL) AS n_ok,
       count(*) FILTER (WHERE v.error IS NOT NULL) AS n_dead_letter
FROM documents d JOIN s_validated v ON d.doc_id = v.doc_id GROUP BY 1""", "s_validated"))
def q09(spark: SparkSession, sf: str) -> DataFrame:
    """Tagging run over every document: tag, validate, split good rows from
    dead letters, report per source."""
    v = _validated(spark, sf)
    docs = driver.read(spark, sf, "documents", "doc_id", "source")
    j = docs.join(v.select("doc_id", "error"), "doc_id")
    return finish(j.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"), F.count(F.when(F.col("error").isNull(), 1)).alias("n_ok"),
        F.count(F.when(F.col("error").isNotNull(), 1)).alias("n_dead_letter")))


_ARTICLE_URL = "'https://docs.example.com/' || doc_id"


@register("q09_article_run", lambda: O.with_ctes(f"""
, a AS (SELECT doc_id, sha256({_ARTICLE_URL}) AS article_id, source, doc_id % 30 AS d FROM documents),
k AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY article_id) <= 15 AS processed FROM a),
v AS (SELECT k.*, t.* EXCLUDE (doc_id) FROM k JOIN s_validated t ON t.doc_id = k.doc_id WHERE processed)
SELECT 'fact_article' AS target, article_id AS key,
       concat_ws('|', article_category, policy_subtype, mechanisms, policy_stance, source) AS value FROM v WHERE error IS NULL
UNION ALL SELECT 'bridge_article_country', article_id, unnest(string_split(country_codes, ','))
FROM v WHERE error IS NULL AND country_codes <> ''
UNION ALL SELECT 'bridge_article_sector', article_id, unnest(string_split(sector_tags, ','))
FROM v WHERE error IS NULL AND sector_tags <> ''
UNION ALL SELECT DISTINCT 'dim_source', source, '' FROM v WHERE error IS NULL AND source <> ''
UNION ALL SELECT 'dead_letter', article_id, error FROM v WHERE error IS NOT NULL
UNION ALL SELECT 'queue', article_id, '' FROM k WHERE NOT processed""", "s_validated"))
def q09_run(spark: SparkSession, sf: str) -> DataFrame:
    """The article run over every document: two deliveries of raw articles (the first
    with repeats, the second all seen before), each one committed batch; a row per
    target and key of what readers see."""
    from ..streaming import article_job as aj
    from .q_tagging import COUNTRY_CODES, SECTOR_WORDS, SECTORS
    docs = driver.read(spark, sf, "documents", "doc_id", "text", "source")
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("doc_id", F.lit(30)).cast("int"))
    raw = docs.select(F.concat(F.lit("https://docs.example.com/"), F.col("doc_id").cast("string")).alias("url"),
                      F.concat(F.lit("Document "), F.col("doc_id").cast("string")).alias("title"),
                      F.date_format(day, "EEE, dd MMM yyyy 08:00:00 'GMT'").alias("published"), "source",
                      F.lit("news").alias("category"), F.col("text").alias("raw_text"))
    landed_dir, root = _scratch(spark, "articles"), _scratch(spark, "article-run")

    def tagger(rows: DataFrame) -> DataFrame:
        return tg.lexicon_tagger(rows, "raw_text", SECTOR_WORDS, "article_id", COUNTRY_CODES)
    write = aj.article_writer(root, tagger, _star(spark, sf).dim_country, SECTORS)
    for delivery in (raw.unionByName(raw.where(F.length("url") % 3 == 0)), raw):
        path = f"{landed_dir}/run={sink.unique_suffix()}"
        delivery.write.parquet(path)
        stream = sp.landed_stream(spark, f"{landed_dir}/run=*", raw.schema)
        sp.run_foreach_batch(stream, write, f"{root}/_checkpoint")

    def target(name: str, key: str, value) -> DataFrame:
        return aj.committed(spark, root, name).select(F.lit(name).alias("target"), F.col(key).alias("key"), value.alias("value"))
    queue = aj.committed(spark, root, "queue", aj.QUEUED)
    newest = aj.committed(spark, root, "commits").agg(F.max("batch")).first()[0]
    out = [target("fact_article", "article_id", F.concat_ws("|", "article_category", "policy_subtype", "mech",
                                                            "policy_stance", "source_id")),
           target("bridge_article_country", "article_id", F.col("country_code")),
           target("bridge_article_sector", "article_id", F.col("sector_id")),
           target("dim_source", "source_id", F.lit("")).distinct(),
           target("dead_letter", "article_id", F.col("error")),
           queue.where(F.col("batch") == newest).select(F.lit("queue").alias("target"), F.col("article_id").alias("key"),
                                                        F.lit("").alias("value"))]
    every = out[0]
    for part in out[1:]:
        every = every.unionByName(part)
    return finish(every)


@register("q10_latest_results", lambda: _runs_sql("""
SELECT country_code, sector_id, rate_basis, target_variable, """ + O.r6("pearson_r", "pearson_r")
    + """, CAST(lag AS BIGINT) AS lag FROM (SELECT *, row_number() OVER (PARTITION BY country_code,
  sector_id, rate_basis, target_variable ORDER BY computed_at DESC, result_id DESC) AS rn FROM hist) t
WHERE rn = 1 ORDER BY pearson_r"""))
def q10(spark: SparkSession, sf: str) -> DataFrame:
    """Latest result per key across runs, ordered by r (comparison table)."""
    from pyspark.sql import Window
    h = _history(spark, sf)
    w = Window.partitionBy(*KEYS4).orderBy(F.col("computed_at").desc(), F.col("result_id").desc())
    latest = h.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
    return finish(latest.select(*KEYS4, "pearson_r", "lag")).orderBy("pearson_r")


@register("q11_regression_diagnostics", lambda: O.with_ctes(
    "SELECT country_code, sector_id, rate_basis, target_variable, names, "
    + O.r6("coef", "coef") + ", " + O.r6("r2", "r2") + " FROM s_ols", "s_ols"))
def q11(spark: SparkSession, sf: str) -> DataFrame:
    from .q_ml import _coefs
    c = _coefs(spark, sf)
    return finish(c.select("country_code", "sector_id", "rate_basis", "target_variable", "names",
                           "coef", "r2"))


@register("b11_dim_date", """
SELECT strftime(d, '%Y-%m-%d') AS date_key, d AS full_date, CAST(year(d) AS BIGINT) AS year,
       CAST(month(d) AS BIGINT) AS month, CAST(quarter(d) AS BIGINT) AS quarter
FROM (SELECT unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE),
                                    INTERVAL 1 DAY))::DATE AS d FROM orders) t""")
def b11(spark: SparkSession, sf: str) -> DataFrame:
    """dim_date as a generated calendar over the order-date range (the
    documented dimension that has no DDL in the analysed application)."""
    o = driver.read(spark, sf, "orders", "o_orderdate")
    first = o.agg(F.min(F.to_date("o_orderdate"))).scalar()
    last = o.agg(F.max(F.to_date("o_orderdate"))).scalar()
    cal = spark.range(1).select(F.explode(F.sequence(first, last)).alias("d"))
    return finish(cal.select(F.date_format("d", "yyyy-MM-dd").alias("date_key"), F.col("d").alias("full_date"),
                             F.year("d").alias("year"), F.month("d").alias("month"),
                             F.quarter("d").alias("quarter")))
