"""Readers for externally landed files.

The analysed application fetches these over HTTP; here they are files landed
in a folder (raw zone).  Every reader declares its schema; nothing is
inferred.  Each returns the long series shape
``(country_code, month|year, value)`` or raw article rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import RAW_ARTICLE


def _month_from_key(key: Column) -> Column:
    """``yyyy-MM`` (or a longer date string) -> first day of the month."""
    return F.to_date(F.concat(F.substring(key, 1, 7), F.lit("-01")))


# S03 -------------------------------------------------------------------------
SDMX_SCHEMA = T.StructType([T.StructField("TIME_PERIOD", T.StringType()),
                            T.StructField("OBS_VALUE", T.StringType())])


def read_sdmx_csv(spark: SparkSession, path: str, country_code: str | Column) -> DataFrame:
    """SDMX CSV: keep TIME_PERIOD / OBS_VALUE, add the country, drop null
    values.  Extra columns of the file are ignored (header-matched)."""
    # columns are located by header name (files carry many dimension columns);
    # without inferSchema every column is read as a string and cast here
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    cc = F.lit(country_code) if isinstance(country_code, str) else country_code
    return (raw.select(cc.alias("country_code"), _month_from_key(F.col("TIME_PERIOD")).alias("month"),
                       F.col("OBS_VALUE").try_cast("double").alias("value"))
            .where(F.col("value").isNotNull()))


# S04 -------------------------------------------------------------------------
WDI_ROWS = T.ArrayType(T.StructType([T.StructField("date", T.StringType()),
                                     T.StructField("value", T.DoubleType()),
                                     T.StructField("countryiso3code", T.StringType())]))


def read_wdi_json(spark: SparkSession, path: str, country_code: str | None = None) -> DataFrame:
    """Annual indicator JSON ``[meta, [{date, value}, ...]]`` (one document
    per file): the second element exploded, null values dropped ->
    (country_code, year, value).  The country comes from the argument or,
    when omitted, from each row's country code."""
    text = spark.read.option("wholetext", True).text(path)
    rows = F.from_json(F.get_json_object("value", "$[1]"), WDI_ROWS)
    cc = F.lit(country_code) if country_code else F.col("r.countryiso3code")
    return (text.select(F.explode_outer(rows).alias("r"))
            .where(F.col("r.value").isNotNull())
            .select(cc.alias("country_code"),
                    F.col("r.date").try_cast("int").alias("year"), F.col("r.value").alias("value")))


# S05 -------------------------------------------------------------------------
FRED_SCHEMA = T.StructType([T.StructField("observations", T.ArrayType(T.StructType([
    T.StructField("date", T.StringType()), T.StructField("value", T.StringType())])))])


def parse_sentinel(value: Column, sentinel: str = ".") -> Column:
    """numeric parse where ``sentinel`` (and anything unparseable) is
    missing."""
    return F.nullif(value, F.lit(sentinel)).try_cast("double")


def read_fred_json(spark: SparkSession, path: str) -> DataFrame:
    """Observation JSON: explode observations, skip the '.' sentinel, month
    key = first 7 chars of the date -> (ts, month, value).  Daily series keep
    their day; collapse with ``series.last_per_month``."""
    doc = spark.read.schema(FRED_SCHEMA).option("multiLine", True).json(path)
    obs = doc.select(F.explode("observations").alias("o"))
    return (obs.select(F.to_date("o.date").alias("ts"), _month_from_key(F.col("o.date")).alias("month"),
                       parse_sentinel(F.col("o.value")).alias("value"))
            .where(F.col("value").isNotNull()))


# S06 -------------------------------------------------------------------------
def period_to_key(period: Column) -> Column:
    """``1960M01`` -> ``1960-01``."""
    return F.replace(F.trim(period), F.lit("M"), F.lit("-"))


def sheet_to_long(sheet: DataFrame, mapping: Mapping[str, str], period_col: str = "period",
                  value_name: str = "price_index") -> DataFrame:
    """Wide monthly price sheet -> long ``(sector_id, date_key, month, value)``.

    ``mapping`` sector -> sheet column; sectors whose column is missing from
    the sheet are skipped.  One ``unpivot`` (a projection, no shuffle)."""
    present = {s: c for s, c in mapping.items() if c in sheet.columns}
    if not present:
        return sheet.sparkSession.createDataFrame(
            [], f"sector_id string, date_key string, month date, {value_name} double")
    base = sheet.where(F.col(period_col).isNotNull()).select(
        period_to_key(F.col(period_col).cast("string")).alias("date_key"),
        *[F.col(f"`{c}`").cast("double").alias(s) for s, c in present.items()])
    long = base.unpivot(["date_key"], list(present), "sector_id", value_name)
    return (long.where(F.col(value_name).isNotNull())
            .select("sector_id", "date_key", _month_from_key(F.col("date_key")).alias("month"),
                    value_name))


def read_price_sheet(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Price sheet landed as CSV with banner lines above the header.  Rows
    are kept when their first cell is a ``yyyyMmm`` period, so banner and
    header lines drop out without any row numbering; ``columns`` names the
    sheet columns in order (the first is the period)."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    named = spark.read.option("header", False).option("mode", "PERMISSIVE").schema(schema).csv(path)
    first = columns[0]
    return (named.where(F.trim(F.col(first)).rlike(r"^[0-9]{4}M[0-9]{2}$"))
            .withColumnRenamed(first, "period"))


# S02 -------------------------------------------------------------------------
_LINK = T.StructType([T.StructField("_VALUE", T.StringType()), T.StructField("_href", T.StringType()),
                      T.StructField("_rel", T.StringType())])
FEED_ITEM = T.StructType([T.StructField(n, T.ArrayType(_LINK) if n == "link" else T.StringType()) for n in (
    "title", "link", "guid", "id", "pubDate", "published", "updated", "date", "description", "summary", "content",
    "encoded", "_corrupt_record")])
FEED_ARTICLE = T.StructType(RAW_ARTICLE.fields + [T.StructField("_corrupt_record", T.StringType())])


def read_feed_items(spark: SparkSession, path: str, source: str | Column, category: str | Column) -> DataFrame:
    """RSS items and Atom entries of the feed files under ``path`` as raw article rows
    with ``_corrupt_record`` (the element's text where it is not well-formed, else
    null).  The link is the element's text or its ``href`` (of several the one without
    ``rel`` or with ``alternate``, else the first); ``published`` is the first of pubDate, published, updated and
    date, the text the first of summary, description, content and encoded; empty
    strings count as missing, name spaces are ignored, CDATA is text.  Well-formed items
    without a link are dropped."""
    def literal(value: str | Column) -> Column:
        return F.lit(value) if isinstance(value, str) else value

    def first(*names: str) -> Column:
        return F.coalesce(*[F.nullif(F.trim(F.col(n)), F.lit("")) for n in names], F.lit(""))

    def elements(tag: str) -> DataFrame:
        # the closing tag ends a record, so files split and a broken element spoils no other one
        chunk = spark.read.option("lineSep", f"</{tag}>").text(path)
        whole = chunk.select(F.regexp_extract("value", rf"(?s)<{tag}[\s>/].*", 0).alias("value")).where("value <> ''")
        parsed = F.from_xml(F.concat("value", F.lit(f"</{tag}>")), FEED_ITEM.simpleString(), {
            "mode": "PERMISSIVE", "ignoreNamespace": "true", "columnNameOfCorruptRecord": "_corrupt_record"})
        return whole.select(parsed.alias("x"), "value").select(
            *[F.col("x")[n].alias(n) for n in FEED_ITEM.names[:-1]],
            F.when(F.col("x").isNull() | F.col("x._corrupt_record").isNotNull(), F.col("value")).alias("_corrupt_record"))

    items = elements("item").unionByName(elements("entry"))
    address = lambda link: F.coalesce(F.nullif(F.trim(link["_href"]), F.lit("")),
                                      F.nullif(F.trim(link["_VALUE"]), F.lit("")))
    plain = F.filter("link", lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    url = F.coalesce(address(F.get(plain, F.lit(0))), address(F.get("link", F.lit(0))))
    broken = F.col("_corrupt_record").isNotNull()
    return (items.select(F.when(~broken, url).alias("url"), first("title").alias("title"),
                         first("pubDate", "published", "updated", "date").alias("published"),
                         literal(source).alias("source"), literal(category).alias("category"),
                         first("summary", "description", "content", "encoded").alias("raw_text"), "_corrupt_record")
            .where(broken | F.col("url").isNotNull()))


def read_rss_items(spark: SparkSession, path: str, source: str, category: str) -> DataFrame:
    """The well-formed items of ``read_feed_items``."""
    return read_feed_items(spark, path, source, category).where("_corrupt_record IS NULL").drop("_corrupt_record")


def page_items(pages: DataFrame) -> DataFrame:
    """S02 over landed HTML pages: link = url, title from <title> (trimmed,
    else the first <h1>), pages without a url dropped."""
    title = F.nullif(F.trim(F.regexp_extract("html", r"<title>(.*?)</title>", 1)), F.lit(""))
    h1 = F.nullif(F.trim(F.regexp_extract("html", r"<h1[^>]*>(.*?)</h1>", 1)), F.lit(""))
    return (pages.where(F.col("url").isNotNull() & (F.col("url") != ""))
            .select("page_id", F.col("url").alias("link"),
                    F.coalesce(title, h1, F.lit("")).alias("title")))


# S08 -------------------------------------------------------------------------
RAW_BATCH = T.StructType(RAW_ARTICLE.fields + [T.StructField("_corrupt_record", T.StringType())])


def read_raw_batches(spark: SparkSession, path: str) -> DataFrame:
    """Raw article batches (JSON array files or JSON lines) under ``raw/``.
    Records that are not article objects land in ``_corrupt_record`` for the
    dead-letter sink instead of failing the batch."""
    return (spark.read.schema(RAW_BATCH).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record")
            .option("multiLine", True).json(path))


def stream_raw_batches(spark: SparkSession, path: str) -> DataFrame:
    """``read_raw_batches`` as a stream over landed files (JSON lines), with the file that each
    record came from."""
    return (spark.readStream.schema(RAW_BATCH).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
            .withColumn("landed_file", F.col("_metadata.file_path")))


def split_raw(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(articles, dead letters) of raw records: dead are those that do not parse and
    those that are objects without a URL."""
    dead = F.col("_corrupt_record").isNotNull() | F.col("url").isNull()
    names = [f.name for f in RAW_ARTICLE.fields]
    error = F.when(F.col("_corrupt_record").isNotNull(), "not a JSON article").otherwise("article without url")
    article = F.when(F.col("_corrupt_record").isNull(), F.to_json(F.struct(*names)))
    return (batch.where(~dead).select(*names, "landed_file"),
            batch.where(dead).select(F.coalesce("_corrupt_record", article).alias("article"), error.alias("error"),
                                     "landed_file"))
