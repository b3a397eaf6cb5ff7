"""Uniform shuffle into shards of exact size by a hypergeometric
communication matrix.

The rows lie in partitions p (one per scan task) and must go to shards s of
fixed sizes (row counts at most one apart).  In a uniformly random shuffle the
number of rows that p sends to s follows a multivariate hypergeometric law.
So the matrix is drawn first, exactly, from the partition sizes alone; then
every partition permutes its rows locally and cuts them by its matrix row, the
rows are exchanged, and every shard permutes what it received.  Shard sizes
are exact by construction.

* ``spark_partition_id`` and the two random keys are written with the rows to
  the shared folder before anything is counted, so a recomputed task cannot
  change them.
* The matrix comes from a tree of partitions with fan-out ``FAN_OUT``: a node
  splits its column totals among its children by successive hypergeometric
  draws, children of different nodes in parallel.  No step sees more than
  ``FAN_OUT`` rows at once, whatever the number of partitions.
* A draw inverts the distribution function from the mode outwards.  Terms
  farther than ten standard deviations plus sixty from the mode are below the
  resolution of a double-precision uniform and cannot be drawn.
* The second permutation is a sort by random key, done in sub-ranges of the
  key space; a running total over the small table of sub-range counts turns
  local ranks into gapless slots, so no task sorts a whole shard.

DataFrame and SQL functions only.

Defined results: null texts count as no bytes (size 1, CRC 0); repeated rows are
separate rows with slots of their own; fewer rows than shards leave the last
shards empty; an empty table gives an empty result.  Extra columns pass
through unless they carry the name of a result column.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

FAN_OUT = 64
ROWS_PER_RANGE = 250_000
RESULT_COLUMNS = ["shard", "slot"]


def _uniform(seed: int, *cols: Column) -> Column:
    """A uniform double in (0, 1) as a function of the given columns."""
    h = F.xxhash64(F.lit(seed), *cols)
    return (F.pmod(h, F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), lambda v: body(v)), 1)


def hypergeometric(total: Column, good: Column, draws: Column, u: Column) -> Column:
    """Number of good items among ``draws`` taken without replacement from
    ``total``, as the ``u`` quantile: an outward sum of probability ratios
    relative to the mode, then a walk to the quantile."""
    zero, one = F.lit(0.0), F.lit(1.0)

    def ratio_up(p: Column, x: Column) -> Column:        # P(x + 1) / P(x)
        return (p["k"] - x) * (p["m"] - x) / ((x + 1) * (p["n"] - p["k"] - p["m"] + x + 1))

    def ratio_down(p: Column, x: Column) -> Column:      # P(x - 1) / P(x)
        return x * (p["n"] - p["k"] - p["m"] + x) / ((p["k"] - x + 1) * (p["m"] - x + 1))

    def walk(p: Column, end: str, by: int, ratio, target: Column | None = None) -> Column:
        """Weights from the mode to ``end``: their sum, or where it passes ``target``."""
        path = F.sequence(p["mode"].cast("bigint"), p[end].cast("bigint"), F.lit(by).cast("bigint"))
        at = {} if target is None else {"at": p["mode"]}
        start = F.struct(one.alias("w"), zero.alias("sum"), *[c.alias(k) for k, c in at.items()])

        def step(a: Column, i: Column) -> Column:
            x = i.cast("double")
            more = [] if target is None else [F.when(a["sum"] <= target, x).otherwise(a["at"]).alias("at")]
            return F.struct((a["w"] * ratio(p, x)).alias("w"), (a["sum"] + a["w"]).alias("sum"), *more)

        return F.aggregate(path, start, step)["sum" if target is None else "at"]

    def choose(p: Column) -> Column:
        # the mode is in both sums; order of outcomes: mode, mode + 1, ..., then mode - 1, ...
        sums = F.struct(walk(p, "last", 1, ratio_up).alias("above"), walk(p, "first", -1, ratio_down).alias("below"))

        def pick(s: Column) -> Column:
            def go(target: Column) -> Column:
                return F.when(target < s["above"], walk(p, "last", 1, ratio_up, target)).otherwise(
                    _let(target - s["above"] + 1.0, lambda rest: walk(p, "first", -1, ratio_down, rest)))
            return _let(p["u"] * (s["above"] + s["below"] - 1.0), go)

        return _let(sums, pick)

    def ranged(p: Column) -> Column:
        return F.struct(p["n"].alias("n"), p["k"].alias("k"), p["m"].alias("m"), p["u"].alias("u"), p["mode"].alias("mode"),
                        F.greatest(p["lo"], p["mode"] - p["reach"]).alias("first"),
                        F.least(p["hi"], p["mode"] + p["reach"]).alias("last"))

    def prepared(p: Column) -> Column:
        sd = F.sqrt(F.greatest(zero, p["m"] * (p["k"] / p["n"]) * (1 - p["k"] / p["n"])
                               * (p["n"] - p["m"]) / F.greatest(p["n"] - 1, one)))
        mode = F.least(p["hi"], F.greatest(p["lo"], F.floor((p["m"] + 1) * (p["k"] + 1) / (p["n"] + 2)).cast("double")))
        return F.struct(*[p[c].alias(c) for c in ("n", "k", "m", "u", "lo", "hi")], mode.alias("mode"),
                        (F.ceil(sd * 10).cast("double") + 60).alias("reach"))

    def bounded(p: Column) -> Column:
        return F.struct(*[p[c].alias(c) for c in ("n", "k", "m", "u")],
                        F.greatest(zero, p["m"] - (p["n"] - p["k"])).alias("lo"), F.least(p["m"], p["k"]).alias("hi"))

    def draw(p: Column) -> Column:
        return F.when(p["n"] <= 0, zero).when(p["lo"] >= p["hi"], p["lo"]).otherwise(
            _let(prepared(p), lambda q: _let(ranged(q), choose)))

    args = F.struct(total.cast("double").alias("n"), good.cast("double").alias("k"),
                    draws.cast("double").alias("m"), u.alias("u"))
    return _let(args, lambda p: _let(bounded(p), draw)).cast("bigint")


def _split_row(columns: Column, size: Column, uniforms) -> Column:
    """Draw one child's row: how many of its ``size`` rows go to each column,
    given the columns' remaining totals.  ``uniforms(i)``: a uniform per column."""
    start = F.struct(size.cast("bigint").alias("left"),
                     F.aggregate(columns, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"),
                     F.array().cast("array<bigint>").alias("row"))

    def step(acc: Column, item: Column) -> Column:
        got = hypergeometric(acc["total"], item["n"], acc["left"], uniforms(item["i"]))
        return _let(got, lambda g: F.struct((acc["left"] - g).alias("left"), (acc["total"] - item["n"]).alias("total"),
                                            F.concat(acc["row"], F.array(g)).alias("row")))

    items = F.transform(columns, lambda n, i: F.struct(n.alias("n"), i.alias("i")))
    return F.aggregate(items, start, step)["row"]


def _children_rows(seed: int, depth: int) -> Column:
    """Split a node's ``row`` among its ``kids`` one after another."""
    start = F.struct(F.col("row").alias("left"),
                     F.array().cast("array<struct<child:bigint,row:array<bigint>>>").alias("out"))

    def give(acc: Column, kid: Column) -> Column:
        row = _split_row(acc["left"], kid["n"], lambda i: _uniform(seed, F.lit(depth), kid["child"], i))
        return _let(row, lambda r: F.struct(
            F.zip_with(acc["left"], r, lambda a, b: a - b).alias("left"),
            F.concat(acc["out"], F.array(F.struct(kid["child"].alias("child"), r.alias("row")))).alias("out")))

    return F.aggregate("kids", start, give)["out"]


def communication_matrix(sizes: DataFrame, n_shards: int, seed: int) -> DataFrame:
    """(part, row): for every partition the exact counts it sends to each
    shard.  ``sizes``: (part int, n long), one row per non-empty partition."""
    stats = sizes.agg(F.max("part").alias("top"), F.sum("n").alias("n")).first()
    if stats["n"] is None:
        return sizes.select("part", F.array().cast("array<bigint>").alias("row"))
    total = int(stats["n"])
    depth = max(1, math.ceil(math.log(int(stats["top"]) + 1, FAN_OUT)))
    columns = [total // n_shards + (1 if s < total % n_shards else 0) for s in range(n_shards)]
    spark = sizes.sparkSession
    level = spark.range(1).select(F.lit(0).cast("bigint").alias("node"),
                                  F.array(*[F.lit(c).cast("bigint") for c in columns]).alias("row"))
    for d in range(depth - 1, -1, -1):
        width = FAN_OUT ** d
        child = F.floor(F.col("part") / F.lit(width)).cast("bigint")
        kids = (sizes.groupBy(child.alias("child")).agg(F.sum("n").alias("n"))
                .groupBy(F.floor(F.col("child") / F.lit(FAN_OUT)).cast("bigint").alias("node"))
                .agg(F.sort_array(F.collect_list(F.struct("child", "n"))).alias("kids")))
        level = (level.join(kids, "node")
                 .select(F.explode(_children_rows(seed, d)).alias("k"))
                 .select(F.col("k.child").alias("node"), F.col("k.row").alias("row")))
    return level.select(F.col("node").cast("int").alias("part"), "row")


def shuffle_into_shards(df: DataFrame, n_shards: int, seed: int = 7) -> DataFrame:
    """``df`` with ``shard`` (0 to n_shards - 1, sizes at most one apart) and
    ``slot`` (gapless from 0 within the shard): a uniform random shuffle."""
    keep = [c for c in df.columns if c not in RESULT_COLUMNS]
    dealt = written(df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"),
                              F.spark_partition_id().alias("part"),
                              F.rand(seed).alias("r1"), F.rand(seed + 1).alias("r2")), "shards-dealt")
    sizes = written(dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n")), "shards-sizes")
    matrix = written(communication_matrix(sizes, n_shards, seed), "shards-matrix")
    # local permutation, cut by the partition's row of the matrix
    local = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("part").orderBy("r1", "r2")) - 1)
    ends = F.transform("row", lambda x, i: F.aggregate(F.slice("row", 1, i + 1), F.lit(0).cast("bigint"),
                                                       lambda a, y: a + y))
    sent = local.join(matrix.withColumn("ends", ends), "part") \
                .withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("rank"))))
    # exchange, and the second permutation in sub-ranges of its key
    total = int(sizes.agg(F.sum("n")).first()[0] or 0)
    ranges = max(1, math.ceil(total / n_shards / ROWS_PER_RANGE), math.ceil(64 / n_shards))
    sent = sent.select("_row", "shard", "r2", "part", "rank",
                       F.floor(F.col("r2") * ranges).cast("int").alias("range"))
    sent = written(sent, "shards-sent")
    before = (sent.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("before", F.sum("n").over(Window.partitionBy("shard").orderBy("range")) - F.col("n")))
    ranked = sent.withColumn("within", F.row_number().over(
        Window.partitionBy("shard", "range").orderBy("r2", "part", "rank")) - 1)
    out = ranked.join(F.broadcast(before.select("shard", "range", "before")) if n_shards * ranges <= 1_000_000
                      else before.select("shard", "range", "before"), ["shard", "range"])
    return out.select(*[F.col("_row")[c].alias(c) for c in keep], F.col("shard").cast("int").alias("shard"),
                      (F.col("before") + F.col("within")).cast("bigint").alias("slot"))


def shard_documents(docs: DataFrame, n_shards: int, seed: int = 7, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """Shard assignment of documents by the law of equal row counts: key, size
    (UTF-8 bytes plus 1), text_crc32, law, shard, slot, grown_shard.  Texts
    are measured where they are read and not moved."""
    measured = docs.select(
        F.col(key).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")).cast("bigint").alias("text_crc32"))
    out = shuffle_into_shards(measured, n_shards, seed)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
