"""Helpers shared by the corpus operators: scans, written intermediates,
size-checked joins and the word definition."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import pretokens

#: The six ASCII white-space characters that end a word.
WORD_SPACE = " \t\n\x0b\f\r"
WORD_SPACE_CLASS = r"[\x20\x09-\x0D]"

#: A side of a join is broadcast only below this many rows (and only when its
#: rows are narrow); beyond it the join is an ordinary shuffle join.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder for one written intermediate, under the shared folder
    named by ``spark.checkpoint.dir``."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back, so
    later stages neither recompute it nor depend on any one executor."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sized_broadcast(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only when the counted ``rows`` stay below ``limit``."""
    return F.broadcast(df) if rows <= limit else df


def fresh(columns: list[str], name: str) -> str:
    """A column name not used in ``columns`` (extra input columns may clash
    with working names)."""
    taken = {c.lower() for c in columns}
    out = name
    while out.lower() in taken:
        out = "_" + out
    return out


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array (null: empty).
    Other white space becomes a space first, so that the split itself is by
    one literal character."""
    spaced = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D]", " ")
    return F.array_remove(F.split(spaced, " "), "")


def release_memory() -> None:
    """Give freed memory and the tables of powers back to the system: Python workers are
    used again by later stages and would keep the largest amount that any earlier one
    needed."""
    pretokens.powers.cache_clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``, with its memory released when the task ends."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release_memory()
    return wrapped


def releasing_group(run: Callable[..., pa.Table]):
    """``run`` for ``applyInArrow`` of one group or two cogrouped ones, likewise."""
    def one(table: pa.Table) -> pa.Table:
        try:
            return run(table)
        finally:
            release_memory()

    def two(left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return run(left, right)
        finally:
            release_memory()
    return two if run.__code__.co_argcount == 2 else one
