"""Language identification by compression.

For every learned language a zstandard raw-content dictionary is filled with
sample text.  Texts are reduced to their lower-case letter runs, so junk
between words does not hide them from the dictionary.  A text is cut into pieces, every piece is compressed with each
dictionary, and the language with the smallest total wins; when the runner-up
is nearly as small the prediction is marked as rejected.  Whole texts are
compressed; the pieces only keep every part of a long text close to the
dictionary.

The dictionaries are fitted on a bounded sample (``SAMPLE_DOCS`` texts per
language, ``SAMPLE_CHARS`` characters of each; the texts with the smallest
hashes), so the only thing broadcast is ``SAMPLE_DOCS * SAMPLE_CHARS``
characters per language, whatever the size of the corpus.

Defined results: a null text or one without a letter is ``und`` with score 0;
without any learned language every text is ``und``; ties go to the language
with the most learned rows, then to the first name; repeated rows are predicted each; a null key
is neither held out nor learned from.  Extra columns of the input are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh

SAMPLE_DOCS = 64
SAMPLE_CHARS = 2048
PIECE_CHARS = 4096
LEVEL, MIN_MATCH = 9, 4     # finds matches of four bytes; dearer searches predict no better (README)
NARROW_MARGIN = 0.02        # runner-up within this share of the best size: rejected
UNDETERMINED = "und"
_LETTERS = r"[^\W\d_]+"


def held_out(key: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.encode(key.cast("string"), "UTF-8")), F.lit(4)) == 2, F.lit(False))


def fit_dictionaries(labelled: DataFrame, text: str = "text", lang: str = "lang",
                     sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> dict[str, bytes]:
    """Dictionary content per language from (text, lang): the ``sample_docs``
    distinct texts with the smallest hashes.  The hash range that can matter is
    cut by a count of distinct texts first, so copies do not thin the sample and
    only a few times the sample is shuffled."""
    d = labelled.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")) \
                .where("text is not null and lang is not null")
    h = F.xxhash64("text")
    found = d.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(h).alias("texts")).collect()
    counts = {r["lang"]: r["n"] for r in found}
    if not counts:
        return {}
    share = F.create_map(*[F.lit(x) for r in found for x in (r["lang"], min(1.0, 4.0 * sample_docs / max(1, r["texts"])))])
    place = F.pmod(h, F.lit(1 << 30)).cast("double") / float(1 << 30)
    sample = (d.withColumn("h", h).where(place < share[F.col("lang")])
              .groupBy("lang", "h").agg(F.min(F.substring("text", 1, sample_chars)).alias("text")).collect())
    out: dict[str, list[tuple[int, str]]] = {}
    for row in sample:
        out.setdefault(row["lang"], []).append((row["h"] % (1 << 30), row["text"]))
    return {name: "\n".join(plain_letters(t) for _, t in sorted(out[name])[:sample_docs]).encode("utf-8", "replace")
            for name in sorted(out, key=lambda k: (-counts[k], k))}


def plain_letters(text: str) -> str:
    """The letter runs of a text in lower case, joined by one space."""
    return " ".join(re.findall(_LETTERS, text.lower()))


def classify(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and rejected in place of ``text``."""
    others = [c for c in docs.columns if c != text and c not in ("lang_pred", "score", "rejected")]
    src = docs.select(*others, F.col(text).cast("string").alias(fresh(others, "_text")))
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)
    names = [*others, "lang_pred", "score", "rejected"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard as zstd
        settings = zstd.ZstdCompressionParameters.from_level(LEVEL, min_match=MIN_MATCH, write_content_size=False)
        coders = []
        for name, sample in shared.value.items():
            content = zstd.ZstdCompressionDict(sample or b"\n", dict_type=zstd.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(compression_params=settings)
            coders.append((name, zstd.ZstdCompressor(compression_params=settings, dict_data=content)))

        def one(value: str | None) -> tuple[str, float, bool]:
            value = plain_letters(value or "")
            if not coders or not any(map(str.isalpha, value)):
                return UNDETERMINED, 0.0, True
            pieces = [value[i:i + PIECE_CHARS].encode("utf-8", "replace") for i in range(0, len(value), PIECE_CHARS)]
            sizes = [sum(len(c.compress(p)) for p in pieces) for _, c in coders]
            best = min(range(len(sizes)), key=sizes.__getitem__)
            total = sum(math.exp(min(0.0, (sizes[best] - s) / 2)) for s in sizes)
            runner_up = min((s for i, s in enumerate(sizes) if i != best), default=None)
            narrow = runner_up is not None and runner_up - sizes[best] < NARROW_MARGIN * sizes[best]
            return coders[best][0], 1.0 / total, narrow

        for batch in batches:
            found = [one(t) for t in batch.column(len(others)).to_pylist()]
            cols = list(zip(*found)) if found else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(others))]
                + [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.bool_())],
                names=names)

    schema = T.StructType([*src.schema.fields[:-1], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    return src.mapInArrow(run, schema)


def language_report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected: learned from the rows that
    are not held out, predicted for all."""
    d = docs.select("doc_id", "text", "lang").withColumn("held_out", held_out(F.col("doc_id")))
    learn = d.where(~F.col("held_out") & F.col("doc_id").isNotNull()).where(F.rlike("text", F.lit(r"\p{L}")))
    return classify(d.select("doc_id", "held_out", "text"), fit_dictionaries(learn))
