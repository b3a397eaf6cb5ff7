"""Substring dedup by content-defined chunks of a gear rolling hash.

The gear hash h = (h << 16) + G(word) rolls over the words of a text (64 bits:
the last four words).  A word start is a cut where the hash before it is the
least within some window of ``CUT_WINDOW`` word starts, so cuts depend only on
nearby words, shift with insertions, and lie at most ``CUT_WINDOW`` words
apart.  From every cut a chunk runs to the first cut at least ``MIN_WORDS`` words
on (or the end of the text).  Equal chunks are repeated passages of that many
words: the one in the smallest (doc_id, place) stays, the spans of all others
are removed.  With the values below every passage of 51 words or more that two
texts share holds a common chunk, and a chunk of fewer than ``MIN_WORDS`` words is
never compared, so common lines and phrases do not count.

Texts are dealt to blocks of about ``BLOCK_BYTES`` by a hash and shuffled once.
Each block sends its distinct chunk digests (96 bits), packed by bucket; a
bucket finds for each digest the block of the first occurrence and answers the
others; the blocks, joined with their answers, cut their texts again and drop
the spans.  A passage in every document costs one entry per block.

Defined results: null and empty texts have no chunks and stay as they are;
rows that repeat key and text are separate occurrences, of which the first in
an arbitrary but harmless order stays; null keys come last in the order.
Extra columns pass through.  Text between removed spans is kept byte for byte.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import pretokens, wordscan
from .common import releasing_group

CUT_WINDOW = 10
MIN_WORDS = 16
BLOCK_BYTES = 4_000_000
MIN_BLOCKS = 128
MIN_BUCKETS = 96
BUCKET_BYTES = 8_000_000
_LAST = np.int64(2 ** 63 - 1)
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                                  T.StructField("n_words", T.LongType()), T.StructField("source", T.LongType())]))


def gear_hashes(words: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The rolling hash after each word, sum of G(word) << 16 * age over the
    words of the same text; ``place``: the word's number in its text."""
    g = pretokens.mix(words ^ np.uint64(0x2545F4914F6CDD1D))
    out = g.copy()
    for age in (1, 2, 3):
        out[age:] += np.where(place[age:] >= age, g[:-age] << np.uint64(16 * age), np.uint64(0))
    return out


def chunk_spans(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word, end word) of every chunk; ``rows``: first word of each text
    and the total."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = np.arange(n) - np.repeat(rows[:-1], np.diff(rows))
    before = np.concatenate([[np.uint64(0)], pretokens.mix(gear_hashes(words, place))[:-1]])
    before[place == 0] = 0
    cut = np.zeros(n + 1, dtype=bool)
    cut[rows] = True
    if n >= CUT_WINDOW:
        least = np.lib.stride_tricks.sliding_window_view(before, CUT_WINDOW).argmin(axis=1)
        first = np.arange(len(least))
        text = np.searchsorted(rows, first, side="right")
        inside = rows[np.minimum(text, len(rows) - 1)] >= first + CUT_WINDOW
        cut[(first + least)[inside]] = True
    cuts = np.flatnonzero(cut)
    starts = cuts[:-1]
    ends = cuts[np.minimum(np.searchsorted(cuts, starts + MIN_WORDS), len(cuts) - 1)]
    text_end = rows[np.minimum(np.searchsorted(rows, starts, side="right"), len(rows) - 1)]
    ok = (starts + MIN_WORDS <= text_end) & (ends <= text_end)
    return starts[ok], ends[ok]


class _Chunks:
    """All chunks of a block's texts, in row order."""

    def __init__(self, texts: pa.ChunkedArray) -> None:
        rows, low, high, size, first, second = [], [], [], [], [], []
        for at, _, data, bounds in wordscan.text_steps(texts):
            starts, ends, words_at = wordscan.word_spans(data, bounds)
            words = wordscan.word_hashes(data, starts, ends, fold=False)
            i, j = chunk_spans(words, words_at)
            row = np.searchsorted(words_at, i, side="right") - 1
            rows.append(row + at)
            low.append(starts[i] - bounds[row] if len(i) else i)
            high.append(ends[j - 1] - bounds[row] if len(i) else i)
            size.append(j - i)
            first.append(pretokens.coded_span_hashes(words, i, j))
            second.append(pretokens.coded_span_hashes(pretokens.mix(words ^ np.uint64(0x9FB21C651E98DF25)), i, j))
        join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
        self.row, self.low, self.high = join(rows, np.int64), join(low, np.int64), join(high, np.int64)
        self.size, self.digest = join(size, np.int64), join(first, np.uint64)
        self.check = (join(second, np.uint64) >> np.uint64(32)).astype(np.uint32)


def _keys(table: pa.Table) -> np.ndarray:
    import pyarrow.compute as pc
    return pc.fill_null(table.column("key"), int(_LAST)).to_numpy()


def _ordered(table: pa.Table) -> pa.Table:
    return table.sort_by([("key", "ascending"), ("row", "ascending")]) if table.num_rows else table


def _digests(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        table = _ordered(table)
        chunks = _Chunks(table.column("text"))
        keys = _keys(table)[chunks.row] if len(chunks.row) else np.zeros(0, np.int64)
        order = np.lexsort((keys, chunks.check, chunks.digest))
        digest, check, keys = chunks.digest[order], chunks.check[order], keys[order]
        new = np.ones(len(digest), dtype=bool)
        new[1:] = (digest[1:] != digest[:-1]) | (check[1:] != check[:-1])
        digest, check, keys = digest[new], check[new], keys[new]
        bucket = (digest % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket, digest, check, keys = bucket[order], digest[order], check[order], keys[order]
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        at = np.concatenate([[0], cuts]).astype(np.int64) if len(bucket) else np.zeros(0, np.int64)
        to = np.concatenate([cuts, [len(bucket)]]).astype(np.int64) if len(bucket) else at
        block = table.column("block")[0].as_py()
        blobs = lambda x: pa.array([x[i:j].tobytes() for i, j in zip(at, to)], pa.binary())
        return pa.table({"block": pa.array([block] * len(at), pa.int64()), "bucket": pa.array(bucket[at], pa.int64()),
                         "digest": blobs(digest), "checks": blobs(check), "keys": blobs(keys)})
    return run


def _answers(table: pa.Table) -> pa.Table:
    """For every block the digests of this bucket that occur first elsewhere."""
    digests = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("digest")]
    sizes = np.array([len(x) for x in digests])
    digest = np.concatenate(digests)
    check = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in table.column("checks")])
    key = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in table.column("keys")])
    block = np.repeat(table.column("block").to_numpy(), sizes)
    order = np.lexsort((block, key, check, digest))
    digest, check, key, block = digest[order], check[order], key[order], block[order]
    new = np.ones(len(digest), dtype=bool)
    new[1:] = (digest[1:] != digest[:-1]) | (check[1:] != check[:-1])
    source = key[new][np.cumsum(new) - 1]
    digest, source, block = digest[~new], source[~new], block[~new]
    order = np.argsort(block, kind="stable")
    digest, source, block = digest[order], source[order], block[order]
    blocks, at = np.unique(block, return_index=True)
    to = np.append(at[1:], len(block))
    return pa.table({"block": pa.array(blocks, pa.int64()),
                     "digest": pa.array([digest[i:j].tobytes() for i, j in zip(at, to)], pa.binary()),
                     "source": pa.array([source[i:j].tobytes() for i, j in zip(at, to)], pa.binary())})


def _drop_spans(texts: pa.Table, answers: pa.Table) -> pa.Table:
    table = _ordered(texts)
    chunks = _Chunks(table.column("text"))
    keys = _keys(table)
    foreign = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in answers.column("digest")]
                             or [np.zeros(0, np.uint64)])
    sources = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in answers.column("source")]
                             or [np.zeros(0, np.int64)])
    order = np.argsort(foreign, kind="stable")
    foreign, sources = foreign[order], sources[order]
    spans: list[list[dict]] = [[] for _ in range(table.num_rows)]
    if len(chunks.row):
        # rows are in order of key, so the first of equal digests is the local original
        _, first, inverse = np.unique(chunks.digest, return_index=True, return_inverse=True)
        local = first[inverse] != np.arange(len(chunks.row))
        source = keys[chunks.row[first[inverse]]]
        if len(foreign):
            at = np.minimum(np.searchsorted(foreign, chunks.digest), len(foreign) - 1)
            away = foreign[at] == chunks.digest
            source = np.where(away, sources[at], source)
            local |= away
        for k in np.flatnonzero(local).tolist():
            row, low, high = int(chunks.row[k]), int(chunks.low[k]), int(chunks.high[k])
            mine = spans[row]
            if mine and low <= mine[-1]["end"]:
                mine[-1]["end"] = max(mine[-1]["end"], high)
            else:
                mine.append({"start": low, "end": high, "n_words": 0,
                             "source": None if source[k] == _LAST else int(source[k])})
    kept = []
    for text, mine in zip(table.column("text"), spans):
        if not mine:
            kept.append(text.as_py())
            continue
        raw, out, at = text.as_py().encode(), [], 0
        for s in mine:
            s["n_words"] = len(raw[s["start"]:s["end"]].split())
            out.append(raw[at:s["start"]])
            at = s["end"]
        kept.append(b"".join([*out, raw[at:]]).decode())
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("n_words", pa.int64()), ("source", pa.int64())]))
    cols = {"key": table.column("key")}
    if "rest" in table.column_names:
        cols["rest"] = table.column("rest")
    return pa.table({**cols, "text": pa.array(kept, pa.string()), "spans": pa.array(spans, kind)})


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, [rest], text, spans): texts without the repeated spans; ``rest`` is
    a struct of the other columns, ``spans`` the byte spans removed from the
    input text, with their words and the key of the copy that stays."""
    others = [c for c in docs.columns if c not in (key, text)]
    volume = docs.agg(F.sum(F.octet_length(text)).alias("b")).first()["b"] or 0
    blocks = max(MIN_BLOCKS, volume // BLOCK_BYTES)
    buckets = max(MIN_BUCKETS, volume // 2 // BUCKET_BYTES)      # digests take about half of the text
    place = F.pmod(F.xxhash64(F.col(key), F.col(text)), F.lit(blocks))
    rest = [F.struct(*[F.col(f"`{c}`") for c in others]).alias("rest")] if others else []
    dealt = docs.select(place.alias("block"), F.col(key).cast("bigint").alias("key"), F.xxhash64(text).alias("row"),
                        F.col(text).cast("string").alias("text"), *rest).repartition(int(blocks), "block")
    sent = dealt.groupBy("block").applyInArrow(
        releasing_group(_digests(int(buckets))), "block bigint, bucket bigint, digest binary, checks binary, keys binary")
    answered = sent.groupBy("bucket").applyInArrow(releasing_group(_answers), "block bigint, digest binary, source binary")
    fields = [T.StructField("key", T.LongType())]
    if others:
        fields.append(T.StructField("rest", dealt.schema["rest"].dataType))
    schema = T.StructType([*fields, T.StructField("text", T.StringType()), T.StructField("spans", SPANS)])
    return dealt.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(releasing_group(_drop_spans), schema)


def repeat_report(docs: DataFrame) -> DataFrame:
    """One row per removed span: doc_id, span_start, span_end, n_words and the
    doc_id of the copy that stays."""
    out = remove_repeats(docs.select("doc_id", "text"))
    return out.select(F.col("key").alias("doc_id"), F.explode("spans").alias("s")).select(
        "doc_id", F.col("s.start").alias("span_start"), F.col("s.end").alias("span_end"),
        F.col("s.n_words").alias("n_words"), F.col("s.source").alias("source_doc_id"))


def dedup_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", chars: str = "n_chars") -> DataFrame:
    """``docs`` with the repeated spans taken out of the texts (and ``chars``, if
    there, counted anew); a text of which no word is left goes."""
    out = remove_repeats(docs, key, text)
    changed = F.size("spans") > 0
    out = out.where(~changed | F.rlike("text", F.lit(r"[^\x20\x09-\x0D]")))
    cols = []
    for f in docs.schema.fields:
        if f.name == key:
            cols.append(F.col("key").cast(f.dataType).alias(f.name))
        elif f.name == text:
            cols.append(F.col("text").alias(f.name))
        elif f.name == chars:
            cols.append(F.when(changed, F.length("text").cast(f.dataType)).otherwise(F.col("rest")[f.name]).alias(f.name))
        else:
            cols.append(F.col("rest")[f.name].alias(f.name))
    return out.select(*cols)
