"""F23, second pass: near-duplicate titles by MinHash bands.

Titles are normalised and told apart once, so a title that a third of the rows
carry is one row from there on.  A distinct title is the set of its character
3-grams; its signature is the smallest of ``BANDS * ROWS`` seeded hashes, and titles
with an equal band are candidates.  A band's bucket is never expanded into pairs:
its members are compared with two of them (those first and last in a hash order of the
bucket's own), each comparison by the exact Jaccard similarity; links over all
bands make the groups.  Titles of similarity ``PERCENT`` share some band with a
probability of 0.998.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import _written, components

GRAM = 3
BANDS, ROWS = 16, 4
PERCENT = 75


def spaced_title(text: Column) -> Column:
    """Lower-case letters and digits of any script, one space between words."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))


def title_grams(title: Column) -> Column:
    """Distinct character 3-grams; a shorter title is its own gram."""
    at = F.sequence(F.lit(1), F.greatest(F.length(title) - GRAM + 1, F.lit(1)))
    return F.array_distinct(F.transform(at, lambda i: F.substr(title, i, F.lit(GRAM))))


def similar(a: Column, b: Column) -> Column:
    """Whether two gram sets have at least ``PERCENT`` of their union in common."""
    both = F.size(F.array_intersect(a, b))
    return 100 * both >= PERCENT * (F.size(a) + F.size(b) - both)


def _bands(grams: Column) -> Column:
    """One hash per band of the MinHash signature."""
    def least(seed: int) -> Column:
        return F.array_min(F.transform(grams, lambda g: F.xxhash64(g, F.lit(seed))))
    return F.array(*[F.xxhash64(F.lit(band), *[least(band * ROWS + row) for row in range(ROWS)])
                     for band in range(BANDS)])


def near_titles(docs: DataFrame, id_col: str, title_col: str) -> DataFrame:
    """(id, group_id, exact) for every row with a letter or digit in its title:
    ``group_id`` is the smallest id of the titles that it reaches by links, ``exact`` whether
    its own title is that one's.  Null ids take part under the smallest id of their
    title; a title carried by null ids only has no row."""
    titled = docs.select(F.col(id_col).alias("id"), spaced_title(F.col(title_col)).alias("title")).where("title <> ''")
    names = _written(titled.groupBy("title").agg(F.min("id").alias("node")).where("node is not null"), "titles")
    sets = _written(names.select("node", title_grams(F.col("title")).alias("grams")), "title-grams")
    banded = _written(sets.select("node", F.explode(_bands(F.col("grams"))).alias("band")), "title-bands")
    order = F.xxhash64("node", "band")
    heads = banded.groupBy("band").agg(F.min_by("node", order).alias("first"), F.max_by("node", order).alias("last"),
                                       F.count(F.lit(1)).alias("m")).where("m > 1").drop("m")
    met = banded.join(heads, "band").select("node", F.explode(F.array_distinct(F.array("first", "last"))).alias("head"))
    pairs = met.where("node <> head").select(F.least("node", "head").alias("a"),
                                             F.greatest("node", "head").alias("b")).distinct()
    left = sets.select(F.col("node").alias("a"), F.col("grams").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("grams").alias("y"))
    links = _written(pairs.join(left, "a").join(right, "b").where(similar(F.col("x"), F.col("y"))).select("a", "b"),
                     "title-links")
    groups = names.join(components(links), "node", "left").select(
        "title", F.coalesce("label", "node").alias("group_id"), (F.coalesce("label", "node") == F.col("node")).alias("exact"))
    return titled.join(groups, "title").select(F.col("id").alias(id_col), "group_id", "exact")
