"""Article tagging (X01-X03), validation and dead-lettering (X02, K05, P08),
near-duplicate titles (F23) and publish-time parsing (F15).

X01 is a plug-in point: any ``pandas.DataFrame -> pandas.DataFrame`` tagger
returning the TAG_RECORD fields can run through ``tag_with_plugin``
(``mapInPandas``, Arrow batches).  The default tagger is a keyword lexicon
run as a Spark plan -- tokens exploded, looked up in a broadcast lexicon,
counted by one aggregate -- so it stays deterministic, offline and JVM-side.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import (ARTICLE_CATEGORIES, MECHANISM_IDS, POLICY_STANCES, POLICY_SUBTYPES)
from ..functions.scalar import round_half_up
from ..schema import TAG_RECORD

# Default keyword lexicon of the built-in tagger (our own word lists).
POLICY_WORDS = ["rate", "rates", "bank", "central", "inflation", "policy", "monetary",
                "hike", "cut", "regulation", "export", "controls", "capital", "tightening",
                "easing"]
MARKET_WORDS = ["price", "prices", "stock", "stocks", "shares", "market", "markets", "mining",
                "mine", "production", "supply", "demand", "output", "company"]
HAWK_WORDS = ["hike", "hikes", "raise", "raises", "tighten", "tightening", "hawkish"]
DOVE_WORDS = ["cut", "cuts", "ease", "easing", "stimulus", "dovish", "lower"]
POSITIVE_WORDS = ["gain", "gains", "rise", "rises", "growth", "strong", "boost", "record",
                  "up", "good", "best", "high"]
NEGATIVE_WORDS = ["loss", "losses", "fall", "falls", "weak", "drop", "decline", "risk",
                  "down", "bad", "worst", "low"]
SUBTYPE_WORDS = {
    "interest_rate": ["rate", "rates", "interest"],
    "market_regulation": ["regulation", "regulator", "rules"],
    "export_control": ["export", "exports", "ban"],
    "capital_controls": ["capital", "outflows", "controls"],
}
MECHANISM_WORDS = {
    "cost_of_carry": ["storage", "inventory", "inventories", "carry", "warehouse"],
    "usd_value": ["dollar", "usd", "currency"],
    "investment_substitution": ["bonds", "yield", "yields", "treasury"],
    "extraction_incentives": ["extraction", "drilling", "output", "production"],
}


def tokens(text: Column) -> Column:
    """Lower-case word tokens (letter runs of any script) of the whole text."""
    return F.split(F.lower(text), r"[^\p{L}]+")


def lexicon_groups(sectors: Sequence[str] | Mapping[str, Sequence[str]]) -> dict[str, list[str]]:
    """Words per group; a sector without words of its own is found by its name."""
    words = sectors if isinstance(sectors, Mapping) else {s: [s] for s in sectors}
    g = {"policy": POLICY_WORDS, "market": MARKET_WORDS, "hawk": HAWK_WORDS,
         "dove": DOVE_WORDS, "pos": POSITIVE_WORDS, "neg": NEGATIVE_WORDS}
    g.update({f"sub_{k}": v for k, v in SUBTYPE_WORDS.items()})
    g.update({f"mech_{k}": v for k, v in MECHANISM_WORDS.items()})
    g.update({f"sec_{s}": list(w) for s, w in words.items()})
    return g


def _tags_where(counts: Column, prefix: str, names: Sequence[str]) -> Column:
    return F.array_compact(F.array(*[F.when(counts[f"{prefix}{n}"] > 0, F.lit(n)) for n in names]))


def country_tokens(text: Column) -> Column:
    """Two-letter upper-case tokens (ISO-code shaped: not adjacent to another
    letter), sorted and distinct -- one regex scan of the text."""
    found = F.regexp_extract_all(text, F.lit(r"(?<!\p{L})([A-Z]{2})(?!\p{L})"), F.lit(1))
    return F.array_sort(F.array_distinct(found))


def _within(hits: str, words: Sequence[str]) -> Column:
    return F.filter(hits, lambda t: t.isin(list(words)))


def lexicon_tagger(df: DataFrame, text_col: str, sectors: Sequence[str] | Mapping[str, Sequence[str]],
                   id_col: str = "doc_id", countries: Mapping[str, str] | None = None) -> DataFrame:
    """X01 default over whole texts: returns ``(id, tags, error)`` with
    ``tags`` a TAG_RECORD struct (null when the text has no word).
    ``countries`` maps two-letter codes in texts to country codes; other
    capitals are no countries then (without it every such token is one).

    Everything stays in the document's row: the tokens are filtered once by
    the whole lexicon, and the few hits are counted per group -- no row per
    token, no shuffle."""
    groups = lexicon_groups(sectors)
    every = sorted({w for words in groups.values() for w in words})
    none = F.array().cast("array<string>")
    found = F.coalesce(country_tokens(F.col(text_col)), none)
    if countries is not None:
        names = F.create_map(*[F.lit(x) for kv in countries.items() for x in kv])
        found = F.array_sort(F.array_distinct(F.array_compact(F.transform(found, lambda t: names[t]))))
    d = df.select(F.col(id_col).alias("_id"),
                  F.coalesce(F.regexp_count(F.lower(F.col(text_col)), F.lit(r"\p{L}{2,}")), F.lit(0)).alias("_n_words"),
                  found.alias("_countries"),
                  F.filter(F.coalesce(tokens(F.col(text_col)), none), lambda t: t.isin(every)).alias("_hits"))
    c = F.struct(*[F.size(_within("_hits", words)).alias(n) for n, words in groups.items()])
    d = d.select("_id", "_n_words", "_countries", c.alias("_c"))
    c = F.col("_c")
    policy = (c["policy"] > 0) & (c["policy"] >= c["market"])
    category = F.when(policy, F.lit("monetary_policy")).otherwise(F.lit("commodity_stocks"))
    stance = (F.when(~policy, F.lit("neutral"))
              .when(c["hawk"] > c["dove"], F.lit("contractionary"))
              .when(c["dove"] > c["hawk"], F.lit("expansionary")).otherwise(F.lit("neutral")))
    sectors_hit = _tags_where(c, "sec_", list(sectors))
    sentiment = round_half_up((c["pos"] - c["neg"]) / (c["pos"] + c["neg"] + 1), 4)
    tags = F.struct(
        category.alias("article_category"),
        F.coalesce(F.col("_countries"), F.array().cast("array<string>")).alias("country_codes"),
        sectors_hit.alias("sector_tags"),
        F.when(policy, _tags_where(c, "sub_", POLICY_SUBTYPES))
         .otherwise(F.array().cast("array<string>")).alias("policy_subtype"),
        sentiment.alias("sentiment_score"),
        F.coalesce(F.try_element_at(sectors_hit, F.lit(1)), F.lit("")).alias("sentiment_target"),
        _tags_where(c, "mech_", MECHANISM_IDS).alias("mechanisms"),
        stance.alias("policy_stance"))
    return d.select(F.col("_id").alias(id_col),
                    F.when(F.col("_n_words") > 0, tags).alias("tags"),
                    F.when(F.col("_n_words") == 0, F.lit("no words to tag")).alias("error"))


def tag_with_plugin(df: DataFrame, tagger: Callable, text_cols: Sequence[str]) -> DataFrame:
    """X01 plug-in path: ``tagger(pdf) -> pdf`` with the TAG_RECORD fields
    plus ``error`` (string, null when fine), run per Arrow batch."""
    out_schema = T.StructType(df.schema.fields + [T.StructField("tags", TAG_RECORD),
                                                 T.StructField("error", T.StringType())])

    def run(batches):
        import pandas as pd
        for pdf in batches:
            res = tagger(pdf[list(text_cols)])
            tags = res.drop(columns=["error"]).to_dict("records")
            yield pdf.assign(tags=pd.Series(tags, index=pdf.index), error=res["error"].values)
    return df.mapInPandas(run, out_schema)


def tag_json(tags: Column) -> Column:
    """tag record -> JSON payload."""
    return F.to_json(tags)


def validate(payloads: DataFrame, json_col: str, key: str,
             valid_countries: DataFrame | None = None,
             sectors: Sequence[str] = ()) -> DataFrame:
    """X02 + P08: parse model output with the record schema (PERMISSIVE: an
    unparseable payload is kept as the corrupt record) and check every enum
    and tag against its vocabulary.  Adds ``tags`` and ``error`` (null when
    valid).  Unknown country codes are checked against ``valid_countries``
    by a join on the exploded codes (no collect)."""
    schema = T.StructType(TAG_RECORD.fields + [T.StructField("_corrupt", T.StringType())])
    parsed = payloads.withColumn(
        "tags", F.from_json(F.col(json_col), schema,
                            {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    t = F.col("tags")

    def bad_tags(field: str, vocab: Sequence[str]) -> Column:
        return F.size(F.array_except(F.coalesce(t[field], F.array().cast("array<string>")),
                                     F.array(*[F.lit(v) for v in vocab]))) > 0

    checks = [
        (t.isNull() | t["_corrupt"].isNotNull(), "unparseable payload"),
        (~t["article_category"].isin(*ARTICLE_CATEGORIES) | t["article_category"].isNull(),
         "article_category outside vocabulary"),
        (~t["policy_stance"].isin(*POLICY_STANCES) | t["policy_stance"].isNull(),
         "policy_stance outside vocabulary"),
        (bad_tags("policy_subtype", POLICY_SUBTYPES), "policy_subtype outside vocabulary"),
        (bad_tags("mechanisms", MECHANISM_IDS), "mechanisms outside vocabulary"),
    ]
    if sectors:
        checks.append((bad_tags("sector_tags", sectors), "sector_tags outside vocabulary"))
    err = F.lit(None).cast("string")
    for cond, msg in reversed(checks):
        err = F.when(cond, F.lit(msg)).otherwise(err)
    out = parsed.withColumn("error", err)
    if valid_countries is not None:
        codes = out.select(key, F.explode_outer("tags.country_codes").alias("cc"))
        known = valid_countries.select(F.col("country_code").alias("cc")).distinct() \
            .withColumn("_ok", F.lit(True))
        unknown = (codes.where(F.col("cc").isNotNull()).join(known, "cc", "left")
                   .where(F.col("_ok").isNull()).select(key).distinct()
                   .withColumn("_unknown", F.lit(True)))
        out = (out.join(unknown, key, "left")
               .withColumn("error", F.coalesce(F.col("error"), F.when(
                   F.col("_unknown"), F.lit("country code outside dimension"))))
               .drop("_unknown"))
    return out.withColumn("tags", F.col("tags").dropFields("_corrupt"))


def split_ok_dead(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One pass, two outputs: valid records and dead letters."""
    return df.where(F.col("error").isNull()), df.where(F.col("error").isNotNull())


def to_star_rows(tagged: DataFrame, id_col: str = "article_id") -> dict[str, DataFrame]:
    """Tag records -> fact rows (arrays comma-joined at the storage edge)
    and bridge rows (one per tag)."""
    t = F.col("tags")
    fact = tagged.select(id_col, t["article_category"].alias("article_category"),
                         F.concat_ws(",", t["policy_subtype"]).alias("policy_subtype"),
                         t["sentiment_score"].alias("sentiment_score"),
                         t["sentiment_target"].alias("sentiment_target"),
                         F.concat_ws(",", t["mechanisms"]).alias("mech"),
                         t["policy_stance"].alias("policy_stance"))
    bc = tagged.select(id_col, F.explode(t["country_codes"]).alias("country_code")).distinct()
    bs = tagged.select(id_col, F.explode(t["sector_tags"]).alias("sector_id")).distinct()
    return {"fact_article": fact, "bridge_article_country": bc, "bridge_article_sector": bs}


def normalized_title(text: Column) -> Column:
    """F23 key: the title lower-cased, letters and digits of any script only."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]", "")


def duplicate_titles(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """F23 (exact after cleanup): groups of rows whose normalised title hashes
    alike -- an aggregate, no pairwise comparison.  Rows whose title has no
    letter or digit are in no group."""
    title = normalized_title(F.col(text_col))
    return (docs.where(title != "").select(id_col, F.sha2(title, 256).alias("title_hash"))
            .groupBy("title_hash").agg(F.count(F.lit(1)).alias("n_docs"),
                                       F.min(id_col).alias("first_id"))
            .where(F.col("n_docs") > 1))


_RFC_FORMATS = [f"d MMM {year} {time} {zone}" for year in ("yyyy", "yy") for time in ("HH:mm:ss", "HH:mm")
                for zone in ("Z", "z")]
_ISO_FORMATS = [f"yyyy-MM-dd{sep}HH:mm:ss{part}{zone}" for sep in ("'T'", " ") for part in ("", ".SSSSSS")
                for zone in ("XXX", "")] + ["yyyy-MM-dd"]


def parse_published(s: Column) -> Column:
    """RFC-822 (weekday prefix stripped -- pattern letter E is not
    accepted for parsing) or ISO-8601 publish time, with one- or two-digit
    days, two-digit years, fractions of a second or a date alone;
    unparseable -> null."""
    body = F.trim(F.regexp_replace(s, r"^\s*[A-Za-z]{3},\s*", ""))
    return F.coalesce(*[F.try_to_timestamp(body, F.lit(f)) for f in _RFC_FORMATS + _ISO_FORMATS])
