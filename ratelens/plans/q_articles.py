"""Registered queries of the article side and the news pipeline bookkeeping
(Q03, Q04, J01, J02, J05-J07, J10, J14, G01, G02, G20-G23, G29, P01-P03,
P07, P09-P11, P13, T01, T04, U02, W10-W13, K04, S01, F01, F04, F09, F17, F19)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..constants import MECHANISM_IDS, POLICY_SUBTYPES, SOURCE_TYPES
from ..functions import scalar as sc
from ..operators import articles as ar
from ..operators import queue as qu
from ..sources import tpch_star as ts
from . import oracle as O
from .registry import finish, register
from .star import Star

START, END = "2024-01-05", "2024-01-25"
SEEN_BEFORE = "2024-01-11"
OVERLAP_DAYS = 2        # days before the middle of the data that both backlog and new articles hold
SPLIT_SEED = "split-1"

_k = "CAST(json_extract(props, '$.k') AS INTEGER)"
_policy = "event_type IN ('signup', 'purchase')"
_subtypes = "[" + O.sql_list(POLICY_SUBTYPES) + "]"
O.cte("s_articles", [], f"""
SELECT 'a' || CAST(event_id AS VARCHAR) AS article_id, strftime(ts, '%Y-%m-%d') AS date_key,
       'src' || CAST(user_id % 20 AS VARCHAR) AS source_id,
       CASE WHEN {_policy} THEN 'monetary_policy' ELSE 'commodity_stocks' END AS article_category,
       CASE WHEN {_policy} THEN {_subtypes}[{_k} % 4 + 1] ELSE '' END AS policy_subtype,
       {O.rnd('(value - 50) / 500', 4)} AS sentiment_score,
       CASE WHEN {_policy} THEN 'policy_outlook' ELSE 'sector_producers' END AS sentiment_target,
       'https://news' || CAST(user_id % 20 AS VARCHAR) || '.example.com/a/' || CAST(event_id AS VARCHAR)
         AS source_url,
       upper(substr(event_type, 1, 1)) || substr(event_type, 2) || ' report ' || CAST(event_id AS VARCHAR)
         AS title,
       ts AS published,
       concat_ws(',', CASE WHEN {_k} % 4 = 0 THEN '{MECHANISM_IDS[0]}' END,
                      CASE WHEN {_k} % 3 = 1 THEN '{MECHANISM_IDS[1]}' END,
                      CASE WHEN {_k} % 5 = 2 THEN '{MECHANISM_IDS[2]}' END,
                      CASE WHEN {_k} % 7 = 3 THEN '{MECHANISM_IDS[3]}' END) AS mech,
       CASE event_type WHEN 'purchase' THEN 'contractionary' WHEN 'signup' THEN 'expansionary'
            ELSE 'neutral' END AS policy_stance,
       CAST(ts AS DATE) AS day, {_k} AS k
FROM events""")

O.cte("s_bridge_country", [], f"""
SELECT DISTINCT article_id, country_code FROM (
  SELECT 'a' || CAST(event_id AS VARCHAR) AS article_id, {O.cc('user_id % 25')} AS country_code
  FROM events
  UNION ALL
  SELECT 'a' || CAST(event_id AS VARCHAR), {O.cc('(user_id * 7 + 3) % 25')} FROM events
  WHERE event_id % 3 = 0) t""")

O.cte("s_bridge_sector", [], f"""
SELECT 'a' || CAST(event_id AS VARCHAR) AS article_id,
       [{O.sql_list(ts.FIXTURE_SECTORS)}][event_id % 6 + 1] AS sector_id
FROM events WHERE NOT ({_policy})""")

O.cte("s_catalogue", [], f"""
SELECT source_id, 'Source ' || CAST(idx AS VARCHAR) AS source_name,
       [{O.sql_list(SOURCE_TYPES)}][idx % 5 + 1] AS source_type,
       CASE WHEN idx % 4 = 3 THEN 'paused' ELSE 'active' END AS status
FROM (SELECT DISTINCT source AS source_id,
             CAST(regexp_extract(source, '(\\d+)$', 1) AS INTEGER) AS idx FROM documents) t""")


def _star(spark, sf) -> Star:
    return Star(spark, sf)


def catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """Feed catalogue: the document sources with a status (every fourth paused)."""
    src = Star(spark, sf).dim_source
    idx = F.regexp_extract("source_id", r"(\d+)$", 1).cast("int")
    return src.select("source_id", "source_name", "source_type",
                      F.when(idx % 4 == 3, "paused").otherwise("active").alias("status"))


LIST_COLS = ar.ARTICLE_LIST_COLS


@register("q03_country_activity", lambda: O.with_ctes(f"""
SELECT bc.country_code, count(*) AS article_count,
       {O.r6("(CAST(sum(CAST(round(a.sentiment_score * 10000) AS BIGINT)) AS DOUBLE) / count(a.sentiment_score)) / 10000.0", 'avg_sentiment')}
FROM s_articles a JOIN s_bridge_country bc ON a.article_id = bc.article_id
WHERE a.day BETWEEN DATE '{START}' AND DATE '{END}' GROUP BY 1""",
    "s_articles", "s_bridge_country"))
def q03(spark: SparkSession, sf: str) -> DataFrame:
    s = _star(spark, sf)
    return finish(ar.country_activity(s.fact_article, s.bridge_article_country, START, END))


@register("q04_articles", lambda: O.with_ctes(f"""
SELECT {', '.join(c if c != 'sentiment_score' else O.r6(c, c) for c in LIST_COLS)}
FROM s_articles WHERE article_category = 'commodity_stocks'
  AND day BETWEEN DATE '{START}' AND DATE '{END}'
ORDER BY published DESC, article_id LIMIT 200""", "s_articles"))
def q04(spark: SparkSession, sf: str) -> DataFrame:
    """Newest 200 commodity articles in the window (API list, limit clamped)."""
    s = _star(spark, sf)
    f = ar.filter_articles(s.fact_article, category="commodity_stocks", start=START, end=END)
    return finish(ar.newest(f, 200).select(*LIST_COLS))


@register("j01_article_country", lambda: O.with_ctes("""
SELECT a.article_id, bc.country_code, a.article_category, """ + O.r6("a.sentiment_score", "sentiment_score") + """
FROM s_articles a JOIN s_bridge_country bc ON a.article_id = bc.article_id""",
    "s_articles", "s_bridge_country"))
def j01(spark: SparkSession, sf: str) -> DataFrame:
    s = _star(spark, sf)
    return finish(ar.with_countries(s.fact_article, s.bridge_article_country)
                  .select("article_id", "country_code", "article_category", "sentiment_score"))


@register("j02_article_sector", lambda: O.with_ctes("""
SELECT a.article_id, bs.sector_id, a.title
FROM s_articles a JOIN s_bridge_sector bs ON a.article_id = bs.article_id""",
    "s_articles", "s_bridge_sector"))
def j02(spark: SparkSession, sf: str) -> DataFrame:
    s = _star(spark, sf)
    return finish(ar.with_sectors(s.fact_article, s.bridge_article_sector)
                  .select("article_id", "sector_id", "title"))


@register("p02_optional_predicates", lambda: O.with_ctes(f"""
SELECT a.article_id, a.title, a.published FROM s_articles a
WHERE a.article_id IN (SELECT article_id FROM s_bridge_sector WHERE sector_id = 'promo')
  AND a.article_category = 'commodity_stocks'
  AND a.day BETWEEN DATE '{START}' AND DATE '{END}'""", "s_articles", "s_bridge_sector"))
def p02(spark: SparkSession, sf: str) -> DataFrame:
    s = _star(spark, sf)
    f = ar.filter_articles(s.fact_article, s.bridge_article_country, s.bridge_article_sector,
                           sector="promo", category="commodity_stocks", start=START, end=END)
    return finish(f.select("article_id", "title", "published"))


@register("p03_day_range", lambda: O.with_ctes(f"""
SELECT day, count(*) AS n FROM s_articles WHERE day BETWEEN DATE '{START}' AND DATE '{END}'
GROUP BY 1""", "s_articles"))
def p03(spark: SparkSession, sf: str) -> DataFrame:
    f = ar.filter_articles(_star(spark, sf).fact_article, start=START, end=END)
    return finish(f.groupBy(ar.day_of(F.col("published")).alias("day"))
                  .agg(F.count(F.lit(1)).alias("n")))


_AVG_SENT = ("(CAST(sum(CAST(round(a.sentiment_score * 10000) AS BIGINT)) AS DOUBLE) "
             "/ count(a.sentiment_score)) / 10000.0")
O.cte("s_stance", ["s_articles", "s_bridge_country"], f"""
SELECT bc.country_code, a.day AS period,
       avg(CASE WHEN a.policy_stance = 'contractionary' THEN 1.0 ELSE 0.0 END) AS pct_contractionary,
       avg(CASE WHEN a.policy_stance = 'expansionary' THEN 1.0 ELSE 0.0 END) AS pct_expansionary,
       {_AVG_SENT} AS avg_sentiment, count(*) AS n_articles
FROM s_articles a JOIN s_bridge_country bc ON a.article_id = bc.article_id
WHERE a.article_category = 'monetary_policy' GROUP BY 1, 2""")


@register("g02_stance_shares", lambda: O.with_ctes(
    "SELECT country_code, period, " + ", ".join(O.r6(c, c) for c in [
        "pct_contractionary", "pct_expansionary", "avg_sentiment"]) + ", n_articles FROM s_stance",
    "s_stance"))
def g02(spark: SparkSession, sf: str) -> DataFrame:
    s = _star(spark, sf)
    return finish(ar.stance_shares(s.fact_article, s.bridge_article_country, "day"))


@register("g23_mechanism_share", lambda: O.with_ctes("""
, per AS (SELECT bc.country_code, a.article_id, a.mech FROM s_articles a
          JOIN s_bridge_country bc ON a.article_id = bc.article_id),
tot AS (SELECT country_code, count(*) AS n_articles FROM per GROUP BY 1),
m AS (SELECT country_code, mechanism, count(DISTINCT article_id) AS n_mech FROM (
        SELECT country_code, article_id, unnest(string_split(mech, ',')) AS mechanism FROM per) t
      WHERE mechanism <> '' GROUP BY 1, 2)
SELECT m.country_code, m.mechanism, m.n_mech, t.n_articles,
       """ + O.r6("CAST(m.n_mech AS DOUBLE) / t.n_articles", "share") + """
FROM m JOIN tot t USING (country_code)""", "s_articles", "s_bridge_country"))
def g23(spark: SparkSession, sf: str) -> DataFrame:
    s = _star(spark, sf)
    return finish(ar.mechanism_share(s.fact_article, s.bridge_article_country))


@register("p07_category_fields", lambda: O.with_ctes("""
SELECT article_id,
       CASE WHEN article_category = 'monetary_policy' THEN policy_subtype ELSE '' END AS policy_subtype,
       CASE WHEN article_category = 'monetary_policy' THEN policy_stance ELSE 'neutral' END AS policy_stance
FROM s_articles""", "s_articles"))
def p07(spark: SparkSession, sf: str) -> DataFrame:
    f = ar.category_fields(_star(spark, sf).fact_article)
    return finish(f.select("article_id", "policy_subtype", "policy_stance"))


@register("p09_drop_untagged", lambda: O.with_ctes("""
SELECT article_category, count(*) AS n FROM s_articles a
WHERE article_id IN (SELECT article_id FROM s_bridge_country UNION ALL
                     SELECT article_id FROM s_bridge_sector)
GROUP BY 1""", "s_articles", "s_bridge_country", "s_bridge_sector"))
def p09(spark: SparkSession, sf: str) -> DataFrame:
    s = _star(spark, sf)
    kept = ar.drop_untagged(s.fact_article, s.bridge_article_country, s.bridge_article_sector)
    return finish(kept.groupBy("article_category").agg(F.count(F.lit(1)).alias("n")))


@register("p10_dimension_listing", lambda: O.with_ctes(f"""
SELECT DISTINCT p.sector_id, upper(substr(p.sector_id, 1, 1)) || substr(p.sector_id, 2) AS sector_name,
       CASE WHEN p.sector_id = 'promo' THEN 'semiconductor' ELSE 'metal' END AS sector_category
FROM s_pairs p WHERE p.sector_id IN (SELECT DISTINCT lower(p_type) FROM part)""", "s_pairs"))
def p10(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct sectors of the configured pairs, with their dimension row."""
    s = _star(spark, sf)
    return finish(s.pairs.select("sector_id").distinct().join(s.dim_sector, "sector_id"))


@register("p11_export_projection", lambda: O.with_ctes(
    "SELECT title, article_category, " + O.r6("sentiment_score", "sentiment_score")
    + ", source_url, published FROM s_articles ORDER BY published DESC", "s_articles"))
def p11(spark: SparkSession, sf: str) -> DataFrame:
    f = _star(spark, sf).fact_article
    return finish(f.select(*ar.EXPORT_COLS).orderBy(F.col("published").desc()))


@register("p13_sector_filter", lambda: O.with_ctes(
    "SELECT country_code, sector_id FROM s_pairs WHERE sector_id = 'promo'", "s_pairs"))
def p13(spark: SparkSession, sf: str) -> DataFrame:
    return finish(_star(spark, sf).pairs.where(F.col("sector_id") == "promo"))


@register("p01_allow_list", lambda: O.with_ctes("""
SELECT b.article_id, b.country_code, (d.country_code IS NOT NULL) AS is_valid
FROM s_bridge_country b LEFT JOIN s_dim_country d ON b.country_code = d.country_code""",
    "s_bridge_country", "s_dim_country"))
def p01(spark: SparkSession, sf: str) -> DataFrame:
    s = _star(spark, sf)
    return finish(ar.allow_list_flag(s.bridge_article_country, "country_code", s.dim_country,
                                     "country_code"))


@register("j14_article_source", lambda: O.with_ctes("""
SELECT a.article_id, a.source_id, c.source_type, c.source_name
FROM s_articles a JOIN s_catalogue c ON a.source_id = c.source_id""", "s_articles", "s_catalogue"))
def j14(spark: SparkSession, sf: str) -> DataFrame:
    s = _star(spark, sf)
    return finish(s.fact_article.join(s.dim_source, "source_id")
                  .select("article_id", "source_id", "source_type", "source_name"))


@register("w13_top_per_category", lambda: O.with_ctes("""
SELECT country_code, article_category, article_id, CAST(rn AS BIGINT) AS rank FROM (
  SELECT bc.country_code, a.article_category, a.article_id,
         row_number() OVER (PARTITION BY bc.country_code, a.article_category
                            ORDER BY a.published DESC, a.article_id) AS rn
  FROM s_articles a JOIN s_bridge_country bc ON a.article_id = bc.article_id) t WHERE rn <= 8""",
    "s_articles", "s_bridge_country"))
def w13(spark: SparkSession, sf: str) -> DataFrame:
    """Country feed panels: newest 8 per (country, category)."""
    s = _star(spark, sf)
    j = ar.with_countries(s.fact_article.select("article_id", "article_category", "published"),
                          s.bridge_article_country)
    top = ar.top_per_category(j, 8, keys=("country_code", "article_category"))
    return finish(top.select("country_code", "article_category", "article_id", "rank"))


@register("f19_sentiment_label", lambda: O.with_ctes("""
SELECT article_category, CASE WHEN sentiment_score >= 0 THEN 'positive' ELSE 'negative' END AS label,
       count(*) AS n FROM s_articles GROUP BY 1, 2""", "s_articles"))
def f19(spark: SparkSession, sf: str) -> DataFrame:
    f = _star(spark, sf).fact_article
    return finish(f.groupBy("article_category", ar.sentiment_label(F.col("sentiment_score")).alias("label"))
                  .agg(F.count(F.lit(1)).alias("n")))


# ------------------------------------------------------- labels / split
O.cte("s_daily_rate", [], f"""
SELECT {O.cc('user_id % 25')} AS country_code, CAST(ts AS DATE) AS period,
       {O.ratio(f"sum({O.cents('value')})", 'count(value) * 1000')} AS value
FROM events GROUP BY 1, 2""")
O.cte("s_labels", ["s_daily_rate"], """
SELECT country_code, CAST(period - INTERVAL 1 DAY AS DATE) AS period,
       CAST(CASE WHEN value - lag(value) OVER (PARTITION BY country_code ORDER BY period) > 0
            THEN 1 ELSE 0 END AS BIGINT) AS contractionary_actual
FROM s_daily_rate""")
O.cte("s_train", ["s_stance", "s_labels"], """
SELECT s.*, l.contractionary_actual FROM s_stance s JOIN s_labels l
  ON s.country_code = l.country_code AND s.period = l.period""")


def labels(spark: SparkSession, sf: str) -> DataFrame:
    """Per (country, period): did the rate rise in the *next* period -- the
    label of period p is the outcome of p+1 (J10)."""
    r = ts.daily_rate(spark, sf)
    w = Window.partitionBy("country_code").orderBy("period")
    chg = F.col("value") - F.lag("value").over(w)
    return r.select("country_code", F.date_sub("period", 1).alias("period"),
                    F.when(chg > 0, 1).otherwise(0).alias("contractionary_actual"))


def training_rows(spark: SparkSession, sf: str) -> DataFrame:
    s = _star(spark, sf)
    feats = ar.stance_shares(s.fact_article, s.bridge_article_country, "day")
    return feats.join(labels(spark, sf), ["country_code", "period"])


@register("j10_label_shift", lambda: O.with_ctes(
    "SELECT country_code, period, " + ", ".join(O.r6(c, c) for c in [
        "pct_contractionary", "pct_expansionary", "avg_sentiment"])
    + ", n_articles, contractionary_actual FROM s_train", "s_train"))
def j10(spark: SparkSession, sf: str) -> DataFrame:
    return finish(training_rows(spark, sf))


def split_flag(key, seed: str = SPLIT_SEED, train_share: float = 0.7):
    """Train or test by a seeded hash of the row key alone: the held-out rows of
    G19, whose SQL takes the same hash threshold (no class quota)."""
    h = F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(seed), key), 256), 1, 8), 16, 10)
    return (h.cast("bigint") % 10000) < int(train_share * 10000)


SPLIT_BINS = 4096


def stratified_split(rows: DataFrame, key: str, cls: str, seed: str = SPLIT_SEED,
                     train_share: float = 0.7) -> DataFrame:
    """``rows`` with ``is_train``: in every class exactly the
    floor(share * n) rows with the smallest seeded hashes (ties by key).

    Hashes fall into bins; a running count over the bins of a class says where
    its quota ends, so only rows of one bin are ever ranked together."""
    h = F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(seed), F.col(key)), 256), 1, 8), 16, 10).cast("bigint")
    d = rows.withColumn("_h", h).withColumn("_bin", F.floor(F.col("_h") * SPLIT_BINS / (1 << 32)).cast("int"))
    counts = d.groupBy(F.col(cls).alias("_c"), F.col("_bin").alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    per_class = Window.partitionBy("_c")
    quota = counts.select("_c", "_b",
                          (F.sum("_n").over(per_class.orderBy("_b")) - F.col("_n")).alias("_before"),
                          F.floor(F.sum("_n").over(per_class) * F.lit(train_share) + F.lit(1e-9)).alias("_quota"))
    d = d.withColumn("_rank", F.row_number().over(Window.partitionBy(cls, "_bin").orderBy("_h", key)))
    d = d.join(quota, d[cls].eqNullSafe(quota["_c"]) & (d["_bin"] == quota["_b"]))
    return d.withColumn("is_train", F.col("_before") + F.col("_rank") <= F.col("_quota")).select(*rows.columns, "is_train")


@register("w12_stratified_split", lambda: O.with_ctes(f"""
SELECT country_code, period, contractionary_actual,
       row_number() OVER (PARTITION BY contractionary_actual ORDER BY h, k)
         <= floor(0.7 * count(*) OVER (PARTITION BY contractionary_actual) + 1e-9) AS is_train
FROM (SELECT *, country_code || '|' || strftime(period, '%Y-%m-%d') AS k,
             CAST('0x' || substr(sha256('{SPLIT_SEED}' || '|' || country_code || '|' || strftime(period, '%Y-%m-%d')), 1, 8)
                  AS UBIGINT) AS h FROM s_train) t""", "s_train"))
def w12(spark: SparkSession, sf: str) -> DataFrame:
    t = training_rows(spark, sf)
    key = F.concat_ws("|", "country_code", F.date_format("period", "yyyy-MM-dd"))
    split = stratified_split(t.withColumn("_key", key), "_key", "contractionary_actual")
    return finish(split.select("country_code", "period", "contractionary_actual", "is_train"))


# ------------------------------------------------------- queue and budget
def _queue_frame(spark: SparkSession, sf: str) -> DataFrame:
    f = _star(spark, sf).fact_article
    return f.select("article_id", "source_url", F.to_date("published").alias("run_day"),
                    F.col("published").alias("queued_at"), F.lit(0).alias("prio"))


def _used(cands: DataFrame) -> DataFrame:
    """Calls already used on each run day (a previous run of the same day)."""
    return (cands.select("run_day").distinct()
            .select(F.date_format("run_day", "yyyy-MM-dd").alias("date_key"),
                    (F.dayofmonth("run_day") % 3).alias("calls_used")))


O.cte("s_slice", ["s_articles"], """
SELECT article_id, day AS run_day, k,
       row_number() OVER (PARTITION BY day ORDER BY published, article_id) AS slot_all,
       15 - (dayofmonth(day) % 3) AS remaining
FROM s_articles""")


def _sliced(spark: SparkSession, sf: str) -> DataFrame:
    c = _queue_frame(spark, sf)
    return qu.budget_slice(c, _used(c))


@register("t04_budget_slice", lambda: O.with_ctes("""
SELECT article_id, run_day, slot_all <= remaining AS processed,
       CAST(CASE WHEN slot_all <= remaining THEN slot_all END AS BIGINT) AS slot
FROM s_slice""", "s_slice"))
def t04(spark: SparkSession, sf: str) -> DataFrame:
    """FIFO budgeted slice per run day: the first (budget - used) articles
    are processed, the rest stay queued."""
    return finish(_sliced(spark, sf).select("article_id", "run_day", "processed", "slot"))


@register("g21_daily_calls", lambda: O.with_ctes("""
SELECT strftime(run_day, '%Y-%m-%d') AS date_key, count(*) AS calls_used
FROM s_slice WHERE slot_all <= remaining GROUP BY 1""", "s_slice"))
def g21(spark: SparkSession, sf: str) -> DataFrame:
    return finish(qu.daily_calls(_sliced(spark, sf)))


@register("g22_run_summary", lambda: O.with_ctes("""
SELECT run_day, count(*) FILTER (WHERE slot_all <= remaining AND k % 13 <> 0) AS processed,
       count(*) FILTER (WHERE slot_all <= remaining AND k % 13 = 0) AS failed,
       count(*) FILTER (WHERE slot_all > remaining) AS queued
FROM s_slice GROUP BY 1""", "s_slice"))
def g22(spark: SparkSession, sf: str) -> DataFrame:
    s = _sliced(spark, sf)
    ev_k = (ts.read(spark, sf, "events", "event_id", "props")
            .select(F.concat(F.lit("a"), F.col("event_id").cast("string")).alias("article_id"),
                    ts._k(F.col("props")).alias("k")))
    s = s.join(ev_k, "article_id")
    return finish(qu.run_summary(s, F.col("k") % 13 == 0))


@register("j05_seen_anti", lambda: O.with_ctes(f"""
SELECT sha256(source_url) AS url_hash, article_id FROM s_articles a
WHERE sha256(source_url) NOT IN (SELECT sha256(source_url) FROM s_articles
                                 WHERE day < DATE '{SEEN_BEFORE}')""", "s_articles"))
def j05(spark: SparkSession, sf: str) -> DataFrame:
    f = _star(spark, sf).fact_article.withColumn("url_hash", qu.url_hash(F.col("source_url")))
    seen = f.where(F.to_date("published") < F.to_date(F.lit(SEEN_BEFORE)))
    return finish(qu.unseen(f, seen).select("url_hash", "article_id"))


@register("k04_seen_state", lambda: O.with_ctes("""
SELECT sha256(source_url) AS url_hash, min(day) AS first_seen FROM s_articles GROUP BY 1""",
    "s_articles"))
def k04(spark: SparkSession, sf: str) -> DataFrame:
    f = _star(spark, sf).fact_article.select(qu.url_hash(F.col("source_url")).alias("url_hash"),
                                             F.to_date("published").alias("run_day"))
    return finish(qu.seen_state(f))


O.cte("s_backlog", ["s_articles"], f"""
SELECT * FROM s_articles WHERE day <= (SELECT min(day) + CAST((max(day) - min(day)) // 2 AS INTEGER) FROM s_articles)""")
O.cte("s_new", ["s_articles"], f"""
SELECT * FROM s_articles
WHERE day >= (SELECT min(day) + CAST((max(day) - min(day)) // 2 AS INTEGER) - {OVERLAP_DAYS} FROM s_articles)""")


def _backlog_new(spark: SparkSession, sf: str):
    """All articles, cut at the middle day of the data: queued up to it, new from
    shortly before it on."""
    f = _star(spark, sf).fact_article.withColumn("day", F.to_date("published"))
    middle = f.agg(F.expr("date_add(min(day), CAST(datediff(max(day), min(day)) div 2 AS INT))")).scalar()
    return f.where(F.col("day") <= middle), f.where(F.col("day") >= F.date_sub(middle, OVERLAP_DAYS))


@register("j06_backlog_anti", lambda: O.with_ctes("""
SELECT article_id, source_url FROM s_new WHERE source_url NOT IN (SELECT source_url FROM s_backlog)""",
    "s_new", "s_backlog"))
def j06(spark: SparkSession, sf: str) -> DataFrame:
    backlog, new = _backlog_new(spark, sf)
    return finish(qu.not_in_backlog(new, backlog).select("article_id", "source_url"))


@register("u02_ordered_union", lambda: O.with_ctes("""
SELECT article_id, CAST(0 AS BIGINT) AS prio FROM s_backlog
UNION ALL
SELECT article_id, 1 FROM s_new WHERE source_url NOT IN (SELECT source_url FROM s_backlog)""",
    "s_new", "s_backlog"))
def u02(spark: SparkSession, sf: str) -> DataFrame:
    backlog, new = _backlog_new(spark, sf)
    return finish(qu.candidates(backlog, new).select("article_id", "prio"))


@register("j07_delete_keys", lambda: O.with_ctes("""
SELECT article_id FROM s_backlog
WHERE article_id NOT IN (SELECT article_id FROM s_slice WHERE slot_all <= remaining)""",
    "s_backlog", "s_slice"))
def j07(spark: SparkSession, sf: str) -> DataFrame:
    """Dequeue: backlog rows minus the processed ids."""
    backlog, _ = _backlog_new(spark, sf)
    done = _sliced(spark, sf).where("processed").select("article_id")
    return finish(qu.delete_keys(backlog, done, "article_id").select("article_id"))


@register("w10_first_arrival", lambda: O.with_ctes("""
SELECT source_id, article_id, published FROM (
  SELECT source_id, article_id, published,
         row_number() OVER (PARTITION BY source_id ORDER BY published, article_id) AS rn
  FROM s_articles) t WHERE rn = 1""", "s_articles"))
def w10(spark: SparkSession, sf: str) -> DataFrame:
    f = _star(spark, sf).fact_article
    return finish(qu.first_arrival(f, "source_id", ["published", "article_id"],
                                   ["article_id", "published"]))


@register("s01_active_sources", lambda: O.with_ctes(
    "SELECT source_id, source_name, source_type FROM s_catalogue WHERE status = 'active'",
    "s_catalogue"))
def s01(spark: SparkSession, sf: str) -> DataFrame:
    return finish(qu.active_sources(catalogue(spark, sf)).select("source_id", "source_name",
                                                                 "source_type"))


@register("g20_source_counts", lambda: O.with_ctes(f"""
SELECT c.source_id, coalesce(p.entries, 0) AS entries, coalesce(p.new_entries, 0) AS new_entries,
       coalesce(p.entries, 0) > 0 AS healthy
FROM s_catalogue c LEFT JOIN (
  SELECT source_id, count(*) AS entries,
         count(*) FILTER (WHERE day >= DATE '{SEEN_BEFORE}') AS new_entries
  FROM s_articles GROUP BY 1) p ON c.source_id = p.source_id""", "s_catalogue", "s_articles"))
def g20(spark: SparkSession, sf: str) -> DataFrame:
    f = _star(spark, sf).fact_article
    is_new = F.to_date("published") >= F.to_date(F.lit(SEEN_BEFORE))
    return finish(qu.source_counts(catalogue(spark, sf), f, is_new))


@register("g29_feed_coverage", lambda: O.with_ctes("""
, rec AS (SELECT DISTINCT source_id FROM s_articles
          WHERE day > (SELECT max(day) FROM s_articles) - INTERVAL 7 DAY)
SELECT count(*) AS n_sources, count(r.source_id) AS n_recent,
       """ + O.r6("CAST(count(r.source_id) AS DOUBLE) / count(*)", "coverage") + """
FROM s_catalogue c LEFT JOIN rec r ON c.source_id = r.source_id""", "s_catalogue", "s_articles"))
def g29(spark: SparkSession, sf: str) -> DataFrame:
    f = _star(spark, sf).fact_article
    return finish(qu.feed_coverage(catalogue(spark, sf), f))


O.cte("s_fetch_grid", ["s_catalogue", "s_articles"], """
SELECT g.source_id, g.day, coalesce(c.entries, 0) AS entries
FROM (SELECT source_id, unnest(generate_series((SELECT min(day) FROM s_articles),
                                               (SELECT max(day) FROM s_articles), INTERVAL 1 DAY))::DATE AS day
      FROM s_catalogue) g
LEFT JOIN (SELECT source_id, day, count(*) AS entries FROM s_articles
           WHERE sentiment_score >= 0.3 GROUP BY 1, 2) c
  ON g.source_id = c.source_id AND g.day = c.day""")


@register("w11_stale_streaks", lambda: O.with_ctes("""
, isl AS (SELECT *, sum(CASE WHEN entries > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY source_id
            ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM s_fetch_grid),
st AS (SELECT *, sum(CASE WHEN entries > 0 THEN 0 ELSE 1 END) OVER (PARTITION BY source_id, island
            ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS streak FROM isl)
SELECT source_id, CAST(max(streak) AS BIGINT) AS longest_streak,
       CAST(arg_max(streak, day) AS BIGINT) AS current_streak,
       arg_max(streak, day) >= 5 AS stale FROM st GROUP BY 1""", "s_fetch_grid"))
def w11(spark: SparkSession, sf: str) -> DataFrame:
    """Stale-feed detection: per catalogue source and day, the number of
    strongly positive items (a 'productive fetch'); streaks of empty days."""
    f = _star(spark, sf).fact_article.withColumn("day", F.to_date("published"))
    first, last = f.agg(F.min("day")).scalar(), f.agg(F.max("day")).scalar()
    grid = catalogue(spark, sf).select("source_id", F.explode(F.sequence(first, last)).alias("day"))
    counts = (f.where(F.col("sentiment_score") >= 0.3).groupBy("source_id", "day")
              .agg(F.count(F.lit(1)).alias("entries")))
    daily = grid.join(counts, ["source_id", "day"], "left").fillna(0, ["entries"])
    return finish(qu.stale_streaks(daily))


@register("f01_url_hash", "SELECT page_id, sha256(url) AS url_hash FROM pages")
def f01(spark: SparkSession, sf: str) -> DataFrame:
    p = ts.read(spark, sf, "pages", "page_id", "url")
    return finish(p.select("page_id", qu.url_hash(F.col("url")).alias("url_hash")))


@register("f04_slug", lambda: O.with_ctes(
    "SELECT source_id, replace(lower(source_name), ' ', '_') AS slug FROM s_catalogue",
    "s_catalogue"))
def f04(spark: SparkSession, sf: str) -> DataFrame:
    c = catalogue(spark, sf)
    return finish(c.select("source_id", sc.slug(F.col("source_name")).alias("slug")))


@register("f09_tag_roundtrip", lambda: O.with_ctes("""
SELECT article_id, len(list_filter(string_split(mech, ','), lambda x: x <> '')) AS n_tags,
       array_to_string(list_filter(string_split(mech, ','), lambda x: x <> ''), ',') AS rejoined
FROM s_articles""", "s_articles"))
def f09(spark: SparkSession, sf: str) -> DataFrame:
    f = _star(spark, sf).fact_article
    tags = ar.split_tags(F.col("mech"))
    return finish(f.select("article_id", F.size(tags).alias("n_tags"),
                           ar.join_tags(tags).alias("rejoined")))


@register("f17_clamp", lambda: O.with_ctes("""
SELECT day, least(greatest(count(*) - 300, 1), 200) AS page_limit FROM s_articles GROUP BY 1""",
    "s_articles"))
def f17(spark: SparkSession, sf: str) -> DataFrame:
    """Per-day article counts used as requested list limits, clamped to [1, 200]."""
    f = _star(spark, sf).fact_article
    per = f.groupBy(F.to_date("published").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return finish(per.select("day", sc.clamp(F.col("n") - 300, 1, 200).alias("page_limit")))
