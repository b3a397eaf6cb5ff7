"""Ranked lexical search, reversed: the queries are indexed and the documents
stream through the index.

For each item of a query table the documents with the highest integer score are
found in two passes over the documents:

1. the items' terms make an inverted index (term -> items), which is broadcast in
   blocks of bounded size; every document's whole text is read once and its
   counts of indexed terms are written, with its length;
2. document frequencies, the number of documents and the total length are summed
   from those counts; then the counts stream through the index, each task holding
   one heap of the best ``top`` documents per item, and the heaps are merged.

A term is a maximal run of code points that are ASCII letters or digits or not
ASCII, only A-Z lower-cased; terms are told apart by 64-bit hashes.  With N
documents that hold a term, L terms in all, df documents that hold the term, tf
its occurrences and n the document's terms, all integers with division rounding
down except for the logarithm:

    w = floor(1000 * ln((2N + 2) / (2df + 1)))
    m = 100 - 90 + (90 * n * N) div L
    score = sum of w * ((10^9 * tf) div (1000 * tf + 8m)) over the item's terms

Defined results: null, empty and term-free texts count in neither N nor L and are
never found; an item without terms, or found nowhere, has no rows; items that
repeat key and text are one item, items with the same key and other texts are
ranked each for itself; equal scores are ordered by ascending document key (nulls
last), so repeated document rows take neighbouring ranks.  Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import wordscan
from .common import written

TOP = 10
INDEX_BYTES = 32_000_000        # bound on one broadcast index block (a single item may be larger)
CELLS = 2_000_000               # document x item scores held by a task at once
POSTINGS = 4_000_000            # (term count, item) pairs expanded at once
MERGE_GROUPS = 64               # heaps of one item are merged in this many groups first


def _term_bytes() -> np.ndarray:
    """Which UTF-8 bytes belong to terms."""
    table = np.ones(256, dtype=bool)
    for low, high in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
        table[low:high + 1] = False
    return table


_TERM = _term_bytes()


def term_hashes(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, hashes of all terms, first term of each row and the total)."""
    for at, to, data, bounds in wordscan.text_steps(column):
        n = len(data)
        inside = np.zeros(n + 1, dtype=bool)
        inside[:n] = _TERM[data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[bounds] = True
        before = np.concatenate([[False], inside[:-1]])
        starts = np.flatnonzero(inside & (~before | edge))
        ends = np.flatnonzero(before & (~inside | edge))
        yield at, to, wordscan.word_hashes(data, starts, ends), np.searchsorted(starts, bounds)


def _describe_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """item, its distinct term hashes."""
    for batch in batches:
        out = []
        for _, _, hashes, rows in term_hashes(batch.column(1)):
            out += [np.unique(hashes[i:j]).tobytes() for i, j in zip(rows[:-1], rows[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["item", "terms"])


def _blocks(items: DataFrame) -> list[DataFrame]:
    """Parts of ``items`` whose indexes stay below ``INDEX_BYTES``."""
    sized = items.withColumn("bytes", F.length("terms") * 2 + 64).withColumn("slot", F.xxhash64("item", "terms"))
    n = max(1, -(-(sized.agg(F.sum("bytes")).first()[0] or 0) // INDEX_BYTES))
    while True:
        block = F.pmod("slot", F.lit(n))
        widest = sized.groupBy(block.alias("b")).agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("m")) \
            .where(f"bytes > {INDEX_BYTES} AND m > 1").limit(1).count()
        if not widest:
            return [items.where(F.pmod(F.xxhash64("item", "terms"), F.lit(n)) == k) for k in range(n)]
        n *= 2


class _Index:
    """Inverted index of one block of items: sorted term hashes, and the items of each."""

    def __init__(self, block: pa.Table):
        self.items = block.column("item").combine_chunks()
        terms = [np.frombuffer(t, dtype=np.uint64) for t in block.column("terms").to_pylist()]
        every = np.concatenate(terms) if terms else np.zeros(0, np.uint64)
        self.terms, of = np.unique(every, return_inverse=True)
        order = np.argsort(of, kind="stable")
        self.postings = np.repeat(np.arange(len(terms), dtype=np.int32), [len(t) for t in terms])[order]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(self.terms)))]).astype(np.int64)

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in ``hashes``, term numbers) of the indexed ones."""
        if not len(self.terms) or not len(hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        found = np.flatnonzero(self.terms[at] == hashes)
        return found, at[found]


def _count_terms(docs: DataFrame, index, kind: str) -> DataFrame:
    """doc, n and the packed (term number, occurrences) of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = index.value
        for batch in batches:
            sizes, terms, counts = [], [], []
            for _, _, hashes, rows in term_hashes(batch.column(1)):
                sizes.append(np.diff(rows))
                at, term = ix.lookup(hashes)
                row = np.searchsorted(rows, at, side="right") - 1
                pair, tf = np.unique(row * len(ix.terms) + term, return_counts=True)
                row, term = np.divmod(pair, max(1, len(ix.terms)))
                cut = np.searchsorted(row, np.arange(len(rows)))
                term, tf = term.astype(np.int32), tf.astype(np.int32)
                terms += [term[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:])]
                counts += [tf[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(sizes) if sizes else [], pa.int64()),
                 pa.array(terms, pa.binary()), pa.array(counts, pa.binary())], names=["doc", "n", "terms", "tfs"])

    return docs.mapInArrow(run, f"doc {kind}, n bigint, terms binary, tfs binary")


def _document_frequencies(counts: DataFrame, size: int) -> np.ndarray:
    """Documents per term number: summed in each task, then over tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, dtype=np.int64)
        for batch in batches:
            held = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=np.int32)
            df += np.bincount(held, minlength=size)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["term", "df"])

    found = counts.select("terms").mapInArrow(run, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    table = found.toArrow()                     # at most one narrow row per indexed term
    df = np.zeros(size, dtype=np.int64)
    df[table.column("term").to_numpy()] = table.column("df").to_numpy()
    return df


def _best(ranked: list, new: list, top: int) -> list:
    return sorted(ranked + new)[:top]


def _task_heaps(counts: DataFrame, index, weights, n_docs: int, n_terms: int, top: int, item_kind: str,
                kind: str) -> DataFrame:
    """(item, unit, doc, score): every task's best documents of each item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix, w = index.value, weights.value
        n_items = len(ix.items)
        fanout = np.diff(ix.first)
        most = np.bincount(ix.postings, weights=np.repeat(w, fanout) * 1e6, minlength=n_items).max(initial=0)
        exact = most < 2 ** 53                  # float64 sums of integers stay exact
        heaps: dict[int, list] = {}
        least = np.ones(n_items, dtype=np.int64)        # a score below this cannot enter
        step = max(1, CELLS // max(1, n_items))

        def score(doc: np.ndarray, term: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
            total = np.zeros(rows * n_items, dtype=np.int64)
            ends = np.cumsum(fanout[term])
            at = 0
            while at < len(term):
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + POSTINGS, side="right")))
                t, k = term[at:to], fanout[term[at:to]]
                offset = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
                cell = np.repeat(doc[at:to] * n_items, k) + ix.postings[np.repeat(ix.first[t], k) + offset]
                part = np.repeat(value[at:to], k)
                if exact:
                    total += np.bincount(cell, weights=part, minlength=len(total)).astype(np.int64)
                else:
                    np.add.at(total, cell, part)
                at = to
            return total.reshape(rows, n_items)

        for batch in batches:
            for low in range(0, batch.num_rows, step):
                part = batch.slice(low, step)
                terms = part.column(2).to_pylist()
                term = np.frombuffer(b"".join(terms), dtype=np.int32)
                tf = np.frombuffer(b"".join(part.column(3).to_pylist()), dtype=np.int32).astype(np.int64)
                doc = np.repeat(np.arange(len(terms)), [len(t) // 4 for t in terms])
                n = part.column(1).to_numpy()
                m = 100 - 90 + 90 * n * n_docs // max(1, n_terms)
                value = w[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
                scores = score(doc, term, value, len(terms))
                row, item = np.nonzero(scores >= least)
                if not len(row):
                    continue
                place = np.empty(part.num_rows, dtype=np.int64)
                place[pc.sort_indices(part.column(0)).to_numpy()] = np.arange(part.num_rows)     # nulls last
                found = scores[row, item]
                order = np.lexsort((place[row], -found, item))
                row, item, found = row[order], item[order], found[order]
                first = np.searchsorted(item, item)
                keep = np.arange(len(item)) - first < top
                keys = part.column(0).take(pa.array(row[keep])).to_pylist()
                fresh: dict[int, list] = {}
                for i, s, key in zip(item[keep].tolist(), found[keep].tolist(), keys):
                    fresh.setdefault(i, []).append((-s, key is None, key if key is not None else 0))
                for i, new in fresh.items():
                    heaps[i] = _best(heaps.get(i, []), new, top)
                    if len(heaps[i]) == top:
                        least[i] = -heaps[i][-1][0]
        units = [i for i, heap in heaps.items() for _ in heap]
        if units:
            yield pa.RecordBatch.from_arrays(
                [ix.items.take(pa.array(units)), pa.array(units, pa.int32()),
                 pa.array([None if none else key for h in heaps.values() for _, none, key in h], doc_type),
                 pa.array([-s for h in heaps.values() for s, _, _ in h], pa.int64())],
                names=["item", "unit", "doc", "score"])

    from pyspark.sql.pandas.types import to_arrow_type
    doc_type = to_arrow_type(counts.schema["doc"].dataType)
    return counts.select("doc", "n", "terms", "tfs").mapInArrow(
        run, f"item {item_kind}, unit int, doc {kind}, score bigint")


def _merged(heaps: DataFrame, top: int) -> DataFrame:
    """Ranks from the tasks' heaps: merged in groups of tasks first, so that no
    task gets all heaps of an item."""
    best_first = [F.desc("score"), F.asc_nulls_last("doc")]
    spread = heaps.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)))
    for keys in (["unit", "part"], ["unit"]):
        spread = spread.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*best_first))) \
            .where(F.col("rank") <= top)
    return spread.select("item", "rank", "doc", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, key: str = "doc_id", item_key: str = "item_id",
           text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``top`` best documents."""
    spark = docs.sparkSession
    source = docs.select(F.col(key).alias("doc"), F.col(text).cast("string").alias("text"))
    kind = source.schema["doc"].dataType.simpleString()
    asked = items.select(F.col(item_key).alias("item"), F.col(text).cast("string").alias("text")).distinct()
    item_kind = asked.schema["item"].dataType.simpleString()
    described = written(asked.mapInArrow(_describe_items, f"item {item_kind}, terms binary"), "search-items")
    results = None
    for block in _blocks(described):
        ix = _Index(block.toArrow())                    # bounded by INDEX_BYTES
        index = spark.sparkContext.broadcast(ix)
        counts = written(_count_terms(source, index, kind), "search-counts")
        n_docs, n_terms = counts.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = _document_frequencies(counts, len(ix.terms))
        weights = spark.sparkContext.broadcast(np.array(
            [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * k + 1))) for k in df.tolist()], dtype=np.int64))
        heaps = _task_heaps(counts, index, weights, n_docs, n_terms, top, item_kind, kind)
        ranked = written(_merged(heaps, top), "search-ranked")
        index.unpersist()
        weights.unpersist()
        results = ranked if results is None else results.unionByName(ranked)
    return results.select(F.col("item").alias(item_key), "rank", F.col("doc").alias(key), "score")
