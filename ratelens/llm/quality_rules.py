"""Quality rules: distribution divergence against language references.

Every document gets two histograms, one of character classes and one of
common words, and is compared with the reference of its language -- the same
histograms summed over all documents of that language -- by Jensen-Shannon
distance (square root of the divergence in bits, 0 to 1).  A document whose
distance exceeds a threshold is rejected; each comparison is made only above
a minimum length, below which a histogram is mostly sampling noise, and with
wider limits for short texts.  Base
rules (too short, mostly repeated three-word windows) come first.

DataFrame functions only.  One pass over the texts sums the references (one
row per language, combined map-side), a second scores every row in place: no
shuffle carries a text, and a document's work is linear or n log n in its
length.

Defined results: a null or blank text has no words, fails the base rules and
is not kept.  A null language, or one whose documents have no reference, is
compared with the reference of all documents together (key ``LANG_ALL``).
Repeated rows are scored alike, each row on its own.  Extra columns pass
through; working names that would clash are replaced by the result columns.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sized_broadcast, words_of, written

MIN_WORDS = 50              # base rule: fewer words fail
MAX_REPEAT_PERCENT = 50     # base rule: a larger share of repeated-window words fails
CHAR_GUARD = 300            # word characters below which character classes are not compared
WORD_GUARD = 100            # words below which common words are not compared
MAX_CHAR_DISTANCE = 0.24
MAX_WORD_DISTANCE = 0.25
SHORT_CHARS, SHORT_CHAR_DISTANCE = 900, 0.28    # shorter texts scatter more: wider limits
SHORT_WORDS, SHORT_WORD_DISTANCE = 150, 0.30
LANG_ALL = "*"

#: Frequent function words of four languages, in each
#: language's order of frequency.
COMMON_WORDS = [
    "the", "of", "and", "to", "in", "a", "is", "that",
    "der", "die", "und", "den", "von", "zu", "das", "mit",
    "de", "la", "le", "et", "les", "des", "en", "un",
    "el", "y", "los", "se", "del", "las", "que", "por",
]
WORD_BINS = list(dict.fromkeys(COMMON_WORDS))
#: Character classes besides white space, counted on the joined words.
CHAR_BINS = ["lower", "upper", "digit", "punctuation", "symbol", "other"]
SYMBOLS = r"[#*$%&|<>]"
PUNCTUATION = r"[.,;:!?'\"()\[\]\-]"

BASE_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                "base_failed", "char_distance", "word_distance", "kept"]


def _only(text: Column, cls: str) -> Column:
    """Number of characters of a class given as ``[...]``."""
    return F.length(F.regexp_replace(text, "[^" + cls[1:-1] + "]+", ""))


def histograms(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds _words, _plain (the words joined by one space), word_chars,
    n_symbols and the two count arrays."""
    d = df.withColumn("_words", words_of(F.col(text)))
    d = d.withColumn("_plain", F.array_join("_words", " "))
    d = d.withColumn("_rest", F.regexp_replace("_plain", r"[\p{Ll} ]+", ""))
    d = d.withColumn("_common", F.filter("_words", lambda w: w.isin(WORD_BINS)))
    rest = F.col("_rest")
    spaces = F.greatest(F.size("_words") - 1, F.lit(0))
    d = d.withColumn("word_chars", (F.length("_plain") - spaces).cast("bigint"))
    d = d.withColumn("n_symbols", _only(rest, SYMBOLS).cast("bigint"))
    d = d.withColumn("_n_upper", _only(rest, r"[\p{Lu}]")) \
         .withColumn("_n_digit", _only(rest, r"[\p{N}]")) \
         .withColumn("_n_punct", _only(rest, PUNCTUATION))
    other = F.length(rest) - F.col("_n_upper") - F.col("_n_digit") - F.col("_n_punct") - F.col("n_symbols")
    chars = F.array(F.col("word_chars") - F.length(rest), F.col("_n_upper"), F.col("_n_digit"),
                    F.col("_n_punct"), F.col("n_symbols"), other).cast("array<bigint>")
    counts = F.transform(
        F.array(*[F.lit(w) for w in WORD_BINS]),
        lambda w: (F.size("_common") - F.size(F.array_remove(F.col("_common"), w))).cast("bigint"))
    words = F.concat(counts, F.array((F.size("_words") - F.size("_common")).cast("bigint")))
    return d.withColumn("_char_counts", chars).withColumn("_word_counts", words)


def language_references(counts: DataFrame) -> DataFrame:
    """(lang, ref_chars, ref_words) from a frame with _lang, _char_counts and
    _word_counts: summed histograms per language and, under ``LANG_ALL``, over
    all documents; a few numbers per language."""
    n_char, n_word = len(CHAR_BINS), len(WORD_BINS) + 1
    names = [f"c{i}" for i in range(n_char)] + [f"w{i}" for i in range(n_word)]
    sums = [F.sum(F.get("_char_counts", F.lit(i))).alias(f"c{i}") for i in range(n_char)] + \
           [F.sum(F.get("_word_counts", F.lit(i))).alias(f"w{i}") for i in range(n_word)]
    per = written(counts.groupBy(F.col("_lang").alias("lang")).agg(*sums), "quality-refs")
    everything = per.agg(*[F.sum(n).alias(n) for n in names]).select(F.lit(LANG_ALL).alias("lang"), *names)
    both = per.where("lang is not null").where(F.col("lang") != LANG_ALL).unionByName(everything)
    return both.select("lang", F.array(*[F.col(n) for n in names[:n_char]]).alias("ref_chars"),
                       F.array(*[F.col(n) for n in names[n_char:]]).alias("ref_words"))


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, x: a + x)


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two count arrays; null if either is empty."""
    np_, nq = _total(p).cast("double"), _total(q).cast("double")

    def term(a: Column, b: Column) -> Column:
        pa, qb = a / np_, b / nq
        m = (pa + qb) / 2
        return (F.when(a > 0, pa * F.log2(pa / m)).otherwise(0.0)
                + F.when(b > 0, qb * F.log2(qb / m)).otherwise(0.0)) / 2

    total = F.aggregate(F.zip_with(p, q, term), F.lit(0.0), lambda acc, x: acc + x)
    return F.when((np_ > 0) & (nq > 0), F.sqrt(F.greatest(total, F.lit(0.0))))


def _repeat_words(d: DataFrame) -> DataFrame:
    """n_repeat_words: words covered by three-word windows found twice or more.

    The windows are cut from ``_plain`` by one look-ahead per word start.
    Only where one repeats, (hash, position) pairs are sorted so that equal
    windows are neighbours, and the covered words are counted from the gaps
    between flagged positions."""
    d = d.withColumn("_win", F.regexp_extract_all("_plain", F.lit(r"\G(?=(\S++ \S++ \S++))\S++ "), 1))
    d = d.withColumn("_pairs", F.when(
        F.size(F.array_distinct("_win")) < F.size("_win"),
        F.sort_array(F.transform("_win", lambda w, i: F.struct(F.xxhash64(w).alias("h"), i.alias("i"))))
    ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    d = d.withColumn("_at", F.sort_array(F.transform(
        F.filter("_pairs", lambda x, k: F.coalesce(F.get("_pairs", k - 1)["h"] == x["h"], F.lit(False))
                 | F.coalesce(F.get("_pairs", k + 1)["h"] == x["h"], F.lit(False))),
        lambda x: x["i"])))
    gaps = F.transform("_at", lambda p, k: F.coalesce(F.least(F.get("_at", k + 1) - p, F.lit(3)), F.lit(3)))
    return d.withColumn("n_repeat_words", F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, x: a + x))


def features(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``_row`` (the input row), ``_lang``, the histograms and the base counts."""
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                    F.col(f"`{text}`").cast("string").alias("text"),
                    F.col(f"`{lang}`").cast("string").alias("_lang"))
    d = _repeat_words(histograms(d))
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.rlike(x, F.lit(r"\S")))
    return d.withColumn("_lines", lines) \
            .withColumn("n_words", F.size("_words").cast("bigint")) \
            .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"))


COUNT_COLUMNS = ["_lang", "_char_counts", "_word_counts", "n_words", "word_chars", "n_symbols",
                 "n_dup_lines", "n_repeat_words"]


def verdict(feats: DataFrame, references: DataFrame) -> DataFrame:
    """``feats`` with base_failed, char_distance, word_distance and kept."""
    refs = sized_broadcast(references, references.count())
    d = feats.join(refs.withColumnRenamed("lang", "_lang"), "_lang", "left")
    pooled = references.where(F.col("lang") == LANG_ALL)
    own = F.col("ref_words").isNotNull()
    d = d.withColumn("_rc", F.when(own, F.col("ref_chars")).otherwise(pooled.select("ref_chars").scalar())) \
         .withColumn("_rw", F.when(own, F.col("ref_words")).otherwise(pooled.select("ref_words").scalar()))
    d = d.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                     | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT))
    d = d.withColumn("char_distance", F.when(F.col("word_chars") >= CHAR_GUARD,
                                             F.round(js_distance(F.col("_char_counts"), F.col("_rc")), 6))) \
         .withColumn("word_distance", F.when(F.col("n_words") >= WORD_GUARD,
                                             F.round(js_distance(F.col("_word_counts"), F.col("_rw")), 6)))
    char_limit = F.when(F.col("word_chars") < SHORT_CHARS, SHORT_CHAR_DISTANCE).otherwise(MAX_CHAR_DISTANCE)
    word_limit = F.when(F.col("n_words") < SHORT_WORDS, SHORT_WORD_DISTANCE).otherwise(MAX_WORD_DISTANCE)
    fits = (F.coalesce(F.col("char_distance"), F.lit(0.0)) <= char_limit) & \
           (F.coalesce(F.col("word_distance"), F.lit(0.0)) <= word_limit)
    return d.withColumn("kept", ~F.col("base_failed") & fits)


def quality_report(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Key and ``BASE_COLUMNS`` of every row; texts are read once, only their
    counts are written and scored."""
    feats = features(docs.select(key, text, lang), text, lang)
    feats = written(feats.select(F.col("_row")[key].alias("_key"), *COUNT_COLUMNS), "quality-counts")
    out = verdict(feats, language_references(feats))
    return out.select(F.col("_key").alias(key), *BASE_COLUMNS)


def quality_filter(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns only."""
    feats = features(docs, text, lang)
    # a row number beside the verdict keeps the filter above it: pushed below,
    # the verdict's expressions would be expanded into one another
    out = verdict(feats, language_references(feats)).select("_row", "kept", F.monotonically_increasing_id().alias("_n"))
    return out.where((F.col("_n") >= 0) & F.col("kept")).select(*[F.col("_row")[c].alias(c) for c in docs.columns])
