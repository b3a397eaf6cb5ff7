"""Token counts from flat token files by a separator scan.

A token file is a plain sequence of fixed-width ids without any index; each
document ends with a separator id.  Files are cut into blocks of
``BLOCK_TOKENS``; each block is read on its own and searched with one vector
comparison, giving the separator positions inside it.  Documents that cross
blocks are stitched by a prefix scan over one narrow row per block: the running
maximum of separator positions says where the block's first document began,
the running count gives document ordinals.

``write_token_files`` makes such files from texts: one file per scan task,
written aside and renamed, so a repeated task replaces its own file.  Files
are read and written through the file system the path names, not through local
paths.

Defined results: null and empty texts are documents of 0 tokens; ids after the
last separator form one unterminated document; an empty file has none;
repeated rows are documents each; an empty table gives an empty result.  Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch, written

BLOCK_TOKENS = 2_000_000


def open_store(path: str):
    """(file system, path inside it) for a Hadoop-style path."""
    from pyarrow import fs
    if path.startswith("file:"):
        path = "file://" + "/" + path[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(path)


def write_token_files(docs: DataFrame, path: str, ranks: dict[bytes, int], pattern: str, separator: int,
                      width: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the files under ``path`` and return the written order of
    documents: (file, ordinal, doc_id)."""
    if separator >= 1 << (8 * width) or max(ranks.values(), default=0) >= 1 << (8 * width):
        raise ValueError("ids do not fit the token width")
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    store, folder = open_store(path)
    store.create_dir(folder, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken
        from pyspark import TaskContext
        task = TaskContext.get()
        store, folder = open_store(path)
        name = f"tokens-{task.partitionId():06d}.bin"
        aside = f"{folder}/.{name}-{task.taskAttemptId()}"
        bpe = tiktoken.Encoding("flat", pat_str=pattern, mergeable_ranks=shared.value, special_tokens={})
        ordinal = 0
        with store.open_output_stream(aside) as sink:
            for batch in batches:
                for value in batch.column(1):
                    ids = bpe.encode_ordinary(value.as_py() or "")
                    ids.append(separator)
                    sink.write(np.array(ids, dtype=f"<u{width}").tobytes())
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * n, pa.string()), pa.array(np.arange(ordinal, ordinal + n)), batch.column(0)],
                    names=["file", "ordinal", "doc_id"])
                ordinal += n
        store.move(aside, f"{folder}/{name}")

    src = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return written(src.mapInArrow(run, "file string, ordinal bigint, doc_id bigint"), "token-order")


def separator_positions(spark: SparkSession, path: str, separator: int, width: int = 2,
                        block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, block, first, n, positions): per block its first token's index,
    its number of tokens and the indexes of separators in the file."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(path).select("path", "length")
    blocks = files.where("length > 0").select(
        "path", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("length") / width - 1) / block_tokens)
                                     .cast("bigint"))).alias("block"),
        F.floor(F.col("length") / width).cast("bigint").alias("tokens"))
    blocks = blocks.repartition("path", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, block, tokens in zip(*(c.to_pylist() for c in batch.columns)):
                store, inner = open_store(file)
                first = block * block_tokens
                n = min(block_tokens, tokens - first)
                with store.open_input_file(inner) as source:
                    source.seek(first * width)
                    ids = np.frombuffer(source.read(n * width), dtype=f"<u{width}")
                at = np.flatnonzero(ids == separator) + first
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file.rsplit("/", 1)[-1]]), pa.array([block], pa.int64()), pa.array([first], pa.int64()),
                     pa.array([n], pa.int64()), pa.array([at], pa.list_(pa.int64()))],
                    names=["file", "block", "first", "n", "positions"])

    return blocks.mapInArrow(run, "file string, block bigint, first bigint, n bigint, positions array<bigint>")


def document_spans(blocks: DataFrame) -> DataFrame:
    """(file, ordinal, token_start, n_tokens, terminated) of every document."""
    w = Window.partitionBy("file").orderBy("block")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    narrow = blocks.select("file", "block", F.size("positions").alias("seps"),
                           F.array_max("positions").alias("last"), (F.col("first") + F.col("n")).alias("end"))
    scan = narrow.select(
        "file", "block", F.coalesce(F.sum("seps").over(before), F.lit(0)).alias("base"),
        F.coalesce(F.max("last").over(before), F.lit(-1).cast("bigint")).alias("previous"), "seps", "last", "end",
        F.lead("block").over(w).isNull().alias("final"))
    d = blocks.select("file", "block", "positions").join(scan, ["file", "block"])
    ended = F.transform("positions", lambda p, i: F.struct(
        (F.col("base") + i).alias("ordinal"),
        (F.when(i == 0, F.col("previous")).otherwise(F.get("positions", i - 1)) + 1).alias("start"),
        p.alias("end"), F.lit(True).alias("terminated")))
    last = F.coalesce(F.col("last"), F.col("previous"))
    open_end = F.when(F.col("final") & (F.col("end") - 1 > last), F.array(F.struct(
        (F.col("base") + F.col("seps")).alias("ordinal"), (last + 1).alias("start"), F.col("end").alias("end"),
        F.lit(False).alias("terminated")))).otherwise(F.slice(ended, 1, 0))
    return d.select("file", F.explode(F.concat(ended, open_end)).alias("d")).select(
        "file", F.col("d.ordinal").cast("bigint").alias("ordinal"), F.col("d.start").alias("token_start"),
        (F.col("d.end") - F.col("d.start")).alias("n_tokens"), F.col("d.terminated").alias("terminated"))


def count_tokens(docs: DataFrame, ranks: dict[bytes, int], pattern: str, separator: int,
                 block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """doc_id and n_tokens of every document, counted in flat files."""
    spark = docs.sparkSession
    path = scratch(spark, "tokens")
    order = write_token_files(docs, path, ranks, pattern, separator)
    blocks = written(separator_positions(spark, path, separator, block_tokens=block_tokens), "token-blocks")
    spans = document_spans(blocks)
    return order.join(spans, ["file", "ordinal"]).select("doc_id", "n_tokens")
