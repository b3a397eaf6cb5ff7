"""Plain-language interpretation of correlation results (F02, F18-F21, J11,
X04).

The rule-based interpretation is a set of column expressions over result
rows.  A text generator (X04) is a plug-in called on cache misses only; the
cache is a keyed table looked up with a left join.  Numbers are rendered with
integer arithmetic (half-up), so the text is identical in any engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import SIGNIFICANCE, STRENGTH_BANDS, STRENGTH_TOP

RESULT_KEYS = ["country_code", "sector_id", "rate_basis", "target_variable"]


def fixed(x: Column, decimals: int, signed: bool = False) -> Column:
    """Fixed-point text of x with ``decimals`` decimals, half-up on |x|;
    ``signed`` adds '+' to non-negative values."""
    scale = 10 ** decimals
    v = F.floor(F.abs(x) * F.lit(float(scale)) + F.lit(0.5)).cast("bigint")
    body = F.concat((v / scale).cast("bigint").cast("string"), F.lit("."),
                    F.lpad((v % scale).cast("string"), decimals, "0"))
    neg = (x < 0) & (v > 0)
    sign = F.when(neg, F.lit("-")).otherwise(F.lit("+") if signed else F.lit(""))
    return F.when(x.isNotNull(), F.concat(sign, body))


def strength_band(r: Column) -> Column:
    """conventional strength band of |r|."""
    a = F.abs(r)
    out = None
    for bound, label in STRENGTH_BANDS:
        out = F.when(a < bound, F.lit(label)) if out is None else out.when(a < bound, F.lit(label))
    return out.otherwise(F.lit(STRENGTH_TOP))


def significant(p: Column) -> Column:
    """p below the significance level."""
    return p < SIGNIFICANCE


def target_label(target: Column, sector_name: Column) -> Column:
    """display label of the target variable."""
    return F.when(target == "equity_valuation", F.concat(sector_name, F.lit(" sector valuation"))) \
        .otherwise(F.concat(sector_name, F.lit(" spot price")))


def control_label(control: Column) -> Column:
    """display label of the control ('' = none)."""
    return F.when(F.coalesce(control, F.lit("")) == "", F.lit("none (raw correlation only)")) \
        .otherwise(F.replace(control, F.lit("_"), F.lit(" ")))


def pair_key(country: Column, sector: Column) -> Column:
    return F.concat_ws("/", country, sector)


def cache_key(r: dict[str, Column]) -> Column:
    """sha256 of the result's keys and 3-decimal statistics, first 32
    hex characters.  A missing control renders as 'None'."""
    ctrl = F.when(F.coalesce(r["control"], F.lit("")) == "", F.lit("None")).otherwise(r["control"])
    raw = F.concat_ws("|", r["country_code"], r["sector_id"], r["rate_basis"],
                      r["target_variable"], ctrl, fixed(r["pearson_r"], 3), fixed(r["partial_r"], 3),
                      fixed(r["p_value"], 3), fixed(r["r_squared"], 3), r["lag"].cast("string"))
    return F.substring(F.sha2(raw, 256), 1, 32)


def sentences(country_name: Column, sector_name: Column) -> Column:
    """five notes on a result row (columns of fact_correlation_result):
    timing (lag), link (direction and strength), evidence (significance),
    share explained, control."""
    pr, p, r2, lag = F.col("partial_r"), F.col("p_value"), F.col("r_squared"), F.col("lag")
    target = target_label(F.col("target_variable"), sector_name)
    delay = F.when(lag == 0, F.lit("within the same month")).when(lag == 1, F.lit("one month later")) \
        .otherwise(F.concat(lag.cast("string"), F.lit(" months later")))
    timing = F.concat(F.lit("Timing: "), F.col("rate_basis"), F.lit(" rate moves of "), country_name,
                      F.lit(" line up best with the "), target, F.lit(" measured "), delay, F.lit("."))
    link = F.concat(F.lit("Link: "), strength_band(pr), F.lit(", the two tend to move "),
                    F.when(pr >= 0, F.lit("together")).otherwise(F.lit("in opposite directions")),
                    F.lit(" (partial r "), fixed(pr, 2, signed=True), F.lit(")."))
    evidence = F.concat(F.lit("Evidence: p "), fixed(p, 3),
                        F.when(significant(p), F.lit(" passes the 0.05 level."))
                         .otherwise(F.lit(" fails the 0.05 level, so chance remains an adequate account.")))
    share = F.concat(F.lit("Share: the fit covers "), F.floor(r2 * 100 + 0.5).cast("bigint").cast("string"),
                     F.lit("% of month-to-month changes (R2 "), fixed(r2, 2), F.lit(")."))
    control = F.concat(F.lit("Control: "), control_label(F.col("control_set")), F.lit("."))
    return F.array(timing, link, evidence, share, control)


def with_labels(results: DataFrame, dim_country: DataFrame, dim_sector: DataFrame) -> DataFrame:
    """attach country and sector display names (dimension joins)."""
    return (results.join(dim_country.select("country_code", "country_name"), "country_code", "left")
            .join(dim_sector.select("sector_id", "sector_name"), "sector_id", "left"))


def rule_text(results_labelled: DataFrame) -> DataFrame:
    """X04 default generator: the rule-based text, joined into one string."""
    return results_labelled.withColumn(
        "interpretation_text",
        F.concat_ws(" ", sentences(F.coalesce("country_name", "country_code"),
                                   F.coalesce("sector_name", "sector_id"))))


def with_cache_key(results: DataFrame) -> DataFrame:
    cols = {k: F.col(k) for k in RESULT_KEYS + ["pearson_r", "partial_r", "p_value", "r_squared",
                                                "lag"]}
    cols["control"] = F.col("control_set")
    return results.withColumn("cache_key", cache_key(cols))


def generate_with_plugin(rows: DataFrame, generator: Callable) -> DataFrame:
    """X04 plug-in path: ``generator(pdf) -> pandas.Series`` of texts, run per
    Arrow batch and called only for the batch's cache misses (rows with
    ``source == 'generated'``).  A failing call leaves the rule text already
    present in ``interpretation_text`` and marks the rows ``rules``: they are
    answered, but not cached as generated."""
    schema = rows.schema

    def run(batches):
        for pdf in batches:
            miss = (pdf["source"] == "generated").to_numpy()
            if miss.any():
                try:
                    texts = list(generator(pdf[miss]))
                    pdf.loc[miss, "interpretation_text"] = texts
                except Exception:  # noqa: BLE001 - plug-in failure -> rule text, recorded as such
                    pdf.loc[miss, "source"] = "rules"
            yield pdf
    return rows.mapInPandas(run, schema)


def lookup_or_generate(results: DataFrame, cache: DataFrame, dim_country: DataFrame,
                       dim_sector: DataFrame, generator: Callable | None = None,
                       model: str = "rules") -> tuple[DataFrame, DataFrame]:
    """J11 + X04 in one pass: results left-joined to the cache on the key;
    hits take the cached text, misses the generated one (rule text by
    default, or the plug-in, called on misses only).  Returns (answers, new
    cache rows to upsert)."""
    keyed = with_cache_key(results)
    cached = cache.select("cache_key", F.col("interpretation_text").alias("_cached"))
    j = with_labels(keyed.join(cached, "cache_key", "left"), dim_country, dim_sector)
    j = rule_text(j)
    hit = F.col("_cached").isNotNull()
    answers = (j.withColumn("source", F.when(hit, F.lit("cache")).otherwise(F.lit("generated")))
               .withColumn("interpretation_text", F.coalesce("_cached", "interpretation_text"))
               .drop("_cached"))
    if generator is not None:
        answers = generate_with_plugin(answers, generator)
    new_rows = answers.where(F.col("source") == "generated").select(
        "cache_key", "country_code", "sector_id", "rate_basis", "target_variable",
        F.col("control_set").alias("control_used"), "interpretation_text",
        F.lit(model).alias("model"), F.lit("generated").alias("source"),
        F.current_timestamp().alias("created_at"))
    return answers, new_rows.select(*cache.columns)
