"""Operators over tagged articles and their country / sector bridges
(J01, J02, P01-P03, P07-P11, G01, G02, G23, T01, W13, J10, J14)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (ARTICLE_CATEGORIES, ARTICLE_LIMIT_DEFAULT, ARTICLE_LIMIT_MAX,
                         FEED_TOP_N)
from ..functions.scalar import exact_avg
from .topk import top_k_per_group

ARTICLE_LIST_COLS = ["article_id", "title", "source_url", "source_id", "article_category",
                     "policy_subtype", "sentiment_score", "sentiment_target", "mech", "published"]
EXPORT_COLS = ["title", "article_category", "sentiment_score", "source_url", "published"]


def require(value: str | None, allowed: Sequence[str], field: str) -> None:
    """P01 (scalar side): reject a parameter outside its allow-list."""
    if value is not None and value not in allowed:
        raise ValueError(f"Invalid {field}: {value!r}. Must be one of {sorted(allowed)}")


def allow_list_flag(df: DataFrame, col: str, dim: DataFrame, dim_col: str,
                    out: str = "is_valid") -> DataFrame:
    """P01 (column side): flag values present in a dimension by a left join on
    the distinct dimension keys."""
    keys = dim.select(F.col(dim_col).alias("_k")).distinct().withColumn("_hit", F.lit(True))
    return (df.join(keys, df[col] == keys["_k"], "left")
            .withColumn(out, F.coalesce("_hit", F.lit(False))).drop("_k", "_hit"))


def day_of(published: Column) -> Column:
    return F.to_date(published)


def filter_articles(fact: DataFrame, bridge_country: DataFrame | None = None,
                    bridge_sector: DataFrame | None = None, country: str | None = None,
                    sector: str | None = None, category: str | None = None,
                    start: str | None = None, end: str | None = None) -> DataFrame:
    """P02 + P03 + J01/J02 as filters: conjunctive predicates built only from
    the given parameters; a bridge is touched only when filtered on (join
    elimination), and then as a semi-join so an article never multiplies."""
    require(category, ARTICLE_CATEGORIES, "article_category")
    out = fact
    if country is not None:
        out = out.join(bridge_country.where(F.col("country_code") == country)
                       .select("article_id"), "article_id", "left_semi")
    if sector is not None:
        out = out.join(bridge_sector.where(F.col("sector_id") == sector)
                       .select("article_id"), "article_id", "left_semi")
    if category is not None:
        out = out.where(F.col("article_category") == category)
    if start is not None:
        out = out.where(day_of(F.col("published")) >= F.to_date(F.lit(start)))
    if end is not None:
        out = out.where(day_of(F.col("published")) <= F.to_date(F.lit(end)))
    return out


def clamp_limit(limit: int | None) -> int:
    """limit clamped to [1, 200], default 50."""
    return max(1, min(ARTICLE_LIMIT_DEFAULT if limit is None else int(limit), ARTICLE_LIMIT_MAX))


def newest(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Newest first, id as total tiebreak, limited (TakeOrderedAndProject:
    each task keeps its own top n, the driver merges n x tasks rows)."""
    return df.orderBy(F.col("published").desc(), F.col("article_id").asc()).limit(clamp_limit(limit))


def with_countries(fact: DataFrame, bridge_country: DataFrame) -> DataFrame:
    """Article x country bridge (inner; one row per tagged country)."""
    return fact.join(bridge_country, "article_id")


def with_sectors(fact: DataFrame, bridge_sector: DataFrame) -> DataFrame:
    """Article x sector bridge."""
    return fact.join(bridge_sector, "article_id")


def country_activity(fact: DataFrame, bridge_country: DataFrame, start: str | None = None,
                     end: str | None = None) -> DataFrame:
    """Per country: article count and average sentiment in the
    window."""
    f = filter_articles(fact, start=start, end=end)
    return (with_countries(f.select("article_id", "sentiment_score"), bridge_country)
            .groupBy("country_code")
            .agg(F.count(F.lit(1)).alias("article_count"),
                 exact_avg(F.col("sentiment_score"), 4).alias("avg_sentiment")))


def stance_shares(fact: DataFrame, bridge_country: DataFrame, period: str = "day") -> DataFrame:
    """Per (country, period) of monetary-policy articles: share
    contractionary, share expansionary, average sentiment, count.  The period
    unit is a parameter applied to both feature and label sides alike."""
    unit = {"day": lambda c: F.to_date(c), "month": lambda c: F.trunc(c, "MM")}[period]
    f = fact.where(F.col("article_category") == "monetary_policy").select(
        "article_id", "policy_stance", "sentiment_score", unit(F.col("published")).alias("period"))
    st = F.col("policy_stance")
    return (with_countries(f, bridge_country).groupBy("country_code", "period").agg(
        F.avg(F.when(st == "contractionary", 1.0).otherwise(0.0)).alias("pct_contractionary"),
        F.avg(F.when(st == "expansionary", 1.0).otherwise(0.0)).alias("pct_expansionary"),
        exact_avg(F.col("sentiment_score"), 4).alias("avg_sentiment"),
        F.count(F.lit(1)).alias("n_articles")))


def split_tags(s: Column) -> Column:
    """F09 inverse: comma-joined tags -> array; '' -> empty array."""
    return F.filter(F.split(F.coalesce(s, F.lit("")), ","), lambda x: x != "")


def join_tags(arr: Column) -> Column:
    """array -> comma-joined string."""
    return F.concat_ws(",", arr)


def mechanism_share(fact: DataFrame, bridge_country: DataFrame) -> DataFrame:
    """Share of a country's articles touching each mechanism."""
    per = with_countries(fact.select("article_id", "mech"), bridge_country)
    totals = per.groupBy("country_code").agg(F.count(F.lit(1)).alias("n_articles"))
    mech = (per.select("country_code", "article_id", F.explode(split_tags(F.col("mech"))).alias("mechanism"))
            .groupBy("country_code", "mechanism").agg(F.countDistinct("article_id").alias("n_mech")))
    return (mech.join(totals, "country_code")
            .select("country_code", "mechanism", "n_mech", "n_articles",
                    (F.col("n_mech") / F.col("n_articles")).alias("share")))


def category_fields(fact: DataFrame) -> DataFrame:
    """Policy subtype and stance only for monetary-policy articles
    (otherwise '' and 'neutral')."""
    policy = F.col("article_category") == "monetary_policy"
    return fact.withColumn("policy_subtype", F.when(policy, F.col("policy_subtype")).otherwise(F.lit(""))) \
        .withColumn("policy_stance", F.when(policy, F.col("policy_stance")).otherwise(F.lit("neutral")))


def vocab_tags(arr: Column, vocab: Sequence[str]) -> Column:
    """Keep only vocabulary members of a tag array."""
    return F.array_intersect(arr, F.array(*[F.lit(v) for v in vocab]))


def vocab_violations(arr: Column, vocab: Sequence[str]) -> Column:
    return F.array_except(arr, F.array(*[F.lit(v) for v in vocab]))


def drop_untagged(fact: DataFrame, bridge_country: DataFrame, bridge_sector: DataFrame) -> DataFrame:
    """Drop articles tagged with neither a country nor a sector."""
    tagged = bridge_country.select("article_id").unionByName(bridge_sector.select("article_id"))
    return fact.join(tagged, "article_id", "left_semi")


def top_per_category(df: DataFrame, k: int = FEED_TOP_N, keys: Sequence[str] = ("article_category",)) -> DataFrame:
    """Newest k per category (and any extra keys)."""
    return top_k_per_group(df, keys, [F.col("published").desc(), F.col("article_id").asc()], k,
                           unique="article_id")


def sentiment_label(score: Column) -> Column:
    """sentiment sign label (>= 0 positive)."""
    return F.when(score >= 0, F.lit("positive")).otherwise(F.lit("negative"))
