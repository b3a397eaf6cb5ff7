"""Exact n-gram Jaccard join: size-banded tiles with hashed bitmaps.

Documents are sets of five-word shingles; two link when
100 * |A and B| >= 75 * |A or B|.  Result: per document its set size and
the smallest doc_id it reaches by links.

1. Equal sets form one class (64-bit digest of the sorted set), so exact copies
   are compared once.  Each class also gets a hashed bitmap of four to eight bits
   per shingle, and one folded to a quarter of that, which still rules out
   unrelated sets.
2. Prefix tiles.  Under any fixed order of shingles, two sets that link share
   one of their first n - ceil(0.75 n) + 1.  The order is by hash, with the
   shingles that are frequent in some scan window last (at most ``HOT_TOKENS``
   of them, so their list may be broadcast): passages that many documents
   share do not make tiles.  Prefix entries are shuffled as packed arrays, one
   row per (batch, bucket); a bucket is sorted and only shingles with two
   classes or more go on.
3. In a few rounds every class is compared with one class of another component
   that heads one of its tiles (first the class in most tiles).  Linked classes
   are joined into components, and tiles of one component are done.
4. Then all pairs that share a tile but not a component are compared: of tiles
   with the same classes one is kept, tiles of more than ``TILE_ROWS`` are cut
   into size bands (linked sets differ by less than 4/3 in size) and blocks, and
   each pair of blocks is worked off by bit counts:
   |A and B| <= (|A| + |B| - popcount(A xor B)) / 2.  A class that this bound and
   the size ratio let through with another one stays in its tile; again one of the
   tiles with the same classes is kept.  Rows name the largest uncut tiles of their
   class, and a pair that meets in one of them keeps neither class in a later tile.
5. The sorted shingle arrays of the classes that stay are sent to their tiles and
   intersected exactly there.  Only links that join two components go out, fewer
   than a tile has components.  Pairs inside one component need no comparison; no
   pair of different components is skipped, and no step puts out pairs that only
   may link.

Hash identity stands for equality (64 bits).

Defined results: null, empty and blank texts have n_shingles 0 and their own
doc_id as component; repeated rows are one class and all reported; a null
doc_id takes part and takes the smallest non-null doc_id of its component (null
if there is none).  Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import pretokens, wordscan
from .common import fresh, releasing, sized_broadcast, written
from .components import connected_components

PERCENT = 75
HOT_IN_BATCH = 3            # classes of one scan window that make a shingle a hot candidate
HOT_WINDOW = 5_000_000      # shingles in a scan window
HOT_TOKENS = 1 << 22        # bound on the broadcast list of hot shingles
TILE_ROWS = 2048
LONG_SET = 2048             # shingles from which a set counts towards cutting its tiles
STAR_ROUNDS = 4             # most rounds of star comparisons before all remaining pairs
STAR_SHARE = 8              # another round follows while one picked pair in so many links
FIRST_TILES = 4             # largest tiles of a class that its rows name
BUCKET_BYTES = 8_000_000
MIN_BUCKETS = 96


def _prefix_length(n: np.ndarray | int):
    return n - (PERCENT * n + 99) // 100 + 1


def _class_ref(tokens: np.ndarray) -> int:
    """A non-negative 63-bit digest of a sorted set."""
    h = pretokens.coded_span_hashes(tokens, np.array([0]), np.array([len(tokens)]))[0]
    return int(h >> np.uint64(1))


def _bits_for(n: int) -> int:
    """Four to eight bits per shingle: sets that share 60 % of their shingles then
    differ in enough bits for the bound to rule them out."""
    return max(256, 1 << (4 * n - 1).bit_length())


def _bitmap(tokens: np.ndarray) -> bytes:
    bits = np.zeros(_bits_for(len(tokens)), dtype=np.uint8)
    bits[(tokens >> np.uint64(20)) & np.uint64(len(bits) - 1)] = 1
    return np.packbits(bits).tobytes()


def _rows(batch: pa.RecordBatch, text: int) -> Iterator[np.ndarray]:
    for _, _, data, bounds in wordscan.text_steps(batch.column(text)):
        yield from wordscan.shingle_sets(data, bounds)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, row, n, ref, bitmap, its folded quarter (small) and, once per scan window, its
    hot shingles."""
    for batch in batches:
        sizes, refs, maps, halves, hot, known = [], [], [], [], [], {}
        seen: dict[int, np.ndarray] = {}
        held = 0

        def frequent(sets: list[np.ndarray]) -> list[dict]:
            values, counts = np.unique(np.concatenate(sets), return_counts=True)
            often = counts >= HOT_IN_BATCH
            return [{"token": int(t), "n": int(c)} for t, c in zip(values[often].view(np.int64), counts[often])]

        for tokens in _rows(batch, 2):
            sizes.append(len(tokens))
            hot.append(None)
            if not len(tokens):
                refs.append(None)
                maps.append(None)
                halves.append(None)
                continue
            ref = _class_ref(tokens)
            if ref not in known:
                wide = _bitmap(tokens)
                known[ref] = wide, _fold(np.frombuffer(wide, np.uint8), max(32, len(wide) // 4)).tobytes()
                seen[ref] = tokens
                held += len(tokens)
            refs.append(ref)
            maps.append(known[ref][0])
            halves.append(known[ref][1])
            if held >= HOT_WINDOW:
                hot[-1] = frequent(list(seen.values()))
                seen, held = {}, 0
        if seen:
            hot[-1] = frequent(list(seen.values()))
        pair = pa.list_(pa.struct([("token", pa.int64()), ("n", pa.int32())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(refs, pa.int64()),
             pa.array(maps, pa.binary()), pa.array(halves, pa.binary()), pa.array(hot, pair)],
            names=["doc_id", "row", "n", "ref", "bitmap", "small", "hot"])


def _hot_tokens(base: DataFrame) -> np.ndarray:
    """Sorted hot shingles: those most often seen, at most ``HOT_TOKENS``."""
    total = base.agg(F.sum("n")).first()[0] or 0
    least = max(24, total // HOT_TOKENS + 1)       # at most HOT_TOKENS shingles reach it
    found = (base.where("hot is not null").select(F.explode("hot").alias("h"))
             .groupBy("h.token").agg(F.sum("h.n").alias("n")).where(F.col("n") >= least).select("token"))
    table = found.toArrow()
    return np.sort(table.column("token").to_numpy().astype(np.int64).view(np.uint64))


def _in_sorted(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), dtype=bool)
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return sorted_values[at] == x


def _shared_members(src: DataFrame, base: DataFrame) -> DataFrame:
    """(token, ref): classes in prefix tiles, without the tiles of one class."""
    spark = src.sparkSession
    hot_list = _hot_tokens(base)
    hot_shared = spark.sparkContext.broadcast(hot_list)
    entries = base.where("n > 0").agg(F.sum(
        F.col("n") - F.floor((F.col("n") * PERCENT + 99) / 100) + 1)).first()[0] or 0
    buckets = max(MIN_BUCKETS, int(entries) * 16 // BUCKET_BYTES)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = hot_shared.value
        for batch in batches:
            seen, tokens_out, refs_out = set(), [], []
            for tokens in _rows(batch, 2):
                if not len(tokens):
                    continue
                ref = _class_ref(tokens)
                if ref in seen:
                    continue
                seen.add(ref)
                size = _prefix_length(len(tokens))
                mask = _in_sorted(hot, tokens)
                if mask.any():
                    tokens = np.concatenate([tokens[~mask], tokens[mask]])
                tokens_out.append(tokens[:size])
                refs_out.append(np.full(size, ref, dtype=np.int64))
            if not tokens_out:
                continue
            tokens, refs = np.concatenate(tokens_out), np.concatenate(refs_out)
            # tiles of hot shingles can be of any size: their entries pass through any bucket
            spread = _in_sorted(hot, tokens)
            bucket = np.where(spread, refs.view(np.uint64), tokens) % np.uint64(buckets)
            kind = bucket.astype(np.int64) * 2 + spread
            order = np.argsort(kind, kind="stable")
            kind, tokens, refs = kind[order], tokens[order], refs[order]
            cuts = np.flatnonzero(np.diff(kind)) + 1
            at = np.concatenate([[0], cuts])
            to = np.concatenate([cuts, [len(kind)]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind[at] // 2), pa.array((kind[at] % 2).astype(bool)),
                 pa.array([tokens[i:j].tobytes() for i, j in zip(at, to)], pa.binary()),
                 pa.array([refs[i:j].tobytes() for i, j in zip(at, to)], pa.binary())],
                names=["bucket", "hot", "tokens", "refs"])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["token", "ref"]
        cold: dict[int, list] = {}
        for batch in batches:
            for bucket, hot, tokens, refs in zip(*(c.to_pylist() for c in batch.columns)):
                tokens, refs = np.frombuffer(tokens, np.int64), np.frombuffer(refs, np.int64)
                if hot:
                    yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(refs)], names=names)
                else:
                    cold.setdefault(bucket, []).append((tokens, refs))
        for parts in cold.values():
            tokens = np.concatenate([t for t, _ in parts])
            refs = np.concatenate([r for _, r in parts])
            order = np.lexsort((refs, tokens))
            tokens, refs = tokens[order], refs[order]
            new_token = np.concatenate([[True], tokens[1:] != tokens[:-1]])
            distinct = new_token | np.concatenate([[True], refs[1:] != refs[:-1]])
            tokens, refs, new_token = tokens[distinct], refs[distinct], new_token[distinct]
            at = np.flatnonzero(new_token)
            size = np.diff(np.append(at, len(tokens)))
            many = np.repeat(size > 1, size)
            tokens, refs = tokens[many], refs[many]
            for i in range(0, len(tokens), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[i:i + 100_000]) for x in (tokens, refs)], names=names)

    packed = src.mapInArrow(releasing(pack), "bucket bigint, hot boolean, tokens binary, refs binary")
    # a hot shingle's class may come from several buckets
    members = packed.repartition(buckets, "bucket").mapInArrow(releasing(unpack), "token bigint, ref bigint")
    return written(members, "jaccard-members")


def _fold(bitmap: np.ndarray, size: int) -> np.ndarray:
    """A bitmap of fewer bytes: the positions are taken modulo its width."""
    return np.bitwise_or.reduce(bitmap.reshape(-1, size), axis=0)


def may_link(n1: int, n2: int, b1: np.ndarray, b2: np.ndarray) -> bool:
    """Whether size ratio and bit counts leave the pair possible."""
    if 100 * min(n1, n2) < PERCENT * max(n1, n2):
        return False
    size = min(len(b1), len(b2))
    apart = int(np.bitwise_count(_fold(b1, size) ^ _fold(b2, size)).sum())
    most = (n1 + n2 - apart) // 2
    return 100 * most >= PERCENT * (n1 + n2 - most)


def _possible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) that sizes and bit counts do not rule out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n1, n2, m1, m2 = (c.to_pylist() for c in batch.columns)
            keep = [may_link(p, q, np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8))
                    for p, q, x, y in zip(n1, n2, m1, m2)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    left = classes.select(F.col("ref").alias("a"), F.col("n").alias("n1"), F.col("bitmap").alias("m1"))
    right = classes.select(F.col("ref").alias("b"), F.col("n").alias("n2"), F.col("bitmap").alias("m2"))
    full = pairs.join(left, "a").join(right, "b").select("a", "b", "n1", "n2", "m1", "m2")
    return full.mapInArrow(releasing(run), "a bigint, b bigint")


def _sets(needed: DataFrame, src: DataFrame, classes: DataFrame) -> DataFrame:
    """(ref, tokens): the sorted shingles of the needed classes, from the text of one row
    of each."""
    rows = written(classes.select("ref", "row").join(needed, "ref"), "jaccard-rows")
    texts = src.join(sized_broadcast(rows, rows.count()), "row")

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # rows are found by hash: another row of the same hash has another set
            found = [(r, s) for r, s in zip(batch.column(0).to_pylist(), _rows(batch, 1)) if len(s) and _class_ref(s) == r]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r for r, _ in found], pa.int64()), pa.array([s.tobytes() for _, s in found], pa.binary())],
                names=["ref", "tokens"])

    return written(texts.select("ref", "text").mapInArrow(releasing(arrays), "ref bigint, tokens binary")
                   .dropDuplicates(["ref"]), "jaccard-sets")


def _linked(pairs: DataFrame, src: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose sorted shingle arrays really link."""
    sets = _sets(pairs.select(F.col("a").alias("ref")).union(pairs.select("b")).distinct(), src, classes)

    def intersect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                shared = int(_in_sorted(y, x).sum())
                keep.append(100 * shared >= PERCENT * (len(x) + len(y) - shared))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    full = (pairs.join(sets.select(F.col("ref").alias("b"), F.col("tokens").alias("t2")), "b")
            .join(sets.select(F.col("ref").alias("a"), F.col("tokens").alias("t1")), "a").select("a", "b", "t1", "t2"))
    return full.mapInArrow(releasing(intersect), "a bigint, b bigint")


def _live_tiles(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    """(token, ref, root, m) of tiles that hold two components or more."""
    d = members.select("token", "ref")
    if roots is None:
        d = d.withColumn("root", F.col("ref"))
    else:
        named = roots.withColumnRenamed("node", "ref")
        d = d.join(sized_broadcast(named, named.count()), "ref", "left").withColumn("root", F.coalesce("root", "ref"))
    sizes = d.groupBy("token").agg(
        F.count(F.lit(1)).alias("m"), F.min("root").alias("lo"), F.max("root").alias("hi"),
        F.bit_xor(F.xxhash64("ref")).alias("same")).where("lo <> hi")
    # shingles of one shared passage have the same classes: one tile stands for all
    sizes = written(sizes.groupBy("same", "m", "lo", "hi").agg(F.min("token").alias("token")).select("token", "m"),
                    "jaccard-tiles")
    return written(d.join(sized_broadcast(sizes, sizes.count()), "token").select("token", "ref", "root", "m"),
                   "jaccard-live")


def _star_pairs(live: DataFrame, score: Column) -> DataFrame:
    """(a, b): for every class b one class a of another component, the one of
    highest score that tops one of b's tiles (or is second to its own
    component there)."""
    best = written(live.withColumn("score", score).groupBy("token", "root").agg(
        F.max(F.struct("score", "ref")).alias("top")), "jaccard-tops")
    first = written(best.groupBy("token").agg(F.max(F.struct("top", "root")).alias("f")), "jaccard-first")
    n = first.count()
    rest = best.join(sized_broadcast(first, n), "token").where(F.col("root") != F.col("f.root"))
    second = rest.groupBy("token").agg(F.max("top").alias("s"))
    tops = written(first.join(second, "token", "left").select("token", "f", "s"), "jaccard-second")
    d = live.join(sized_broadcast(tops, n), "token")
    other = F.when(F.col("f.root") != F.col("root"), F.col("f.top")).otherwise(F.col("s"))
    pick = d.groupBy(F.col("ref").alias("b")).agg(F.max(other).alias("p")).where("p is not null")
    return pick.select(F.col("p.ref").alias("a"), "b")


def _candidates(n: np.ndarray, roots: np.ndarray, own: np.ndarray, block: np.ndarray, maps: list[np.ndarray],
                band: int, i: int, j: int) -> Iterator[tuple[int, np.ndarray]]:
    """(x, later rows that may link with it) for the rows of one tile, sorted by size."""
    width = np.array([len(m) for m in maps])
    for size in np.unique(width).tolist():
        low, high = np.searchsorted(width, size), np.searchsorted(width, size, side="right")
        # the larger sets that these can link with, their bitmaps folded to the same width
        to = int(np.searchsorted(PERCENT * n, 100 * n[high - 1], side="right"))
        bits = np.stack([_fold(m, size) for m in maps[low:to]]).view(np.uint64)
        for x in range(low, high):
            rest = slice(x + 1, int(np.searchsorted(PERCENT * n, 100 * n[x], side="right")))
            # each pair belongs to one tile: the band of the larger set, the blocks of the two
            ok = (roots[rest] != roots[x]) & ((band < 0) | (np.maximum(own[x], own[rest]) == band)) \
                & (np.minimum(block[x], block[rest]) == i) & (np.maximum(block[x], block[rest]) == j)
            at = np.flatnonzero(ok) + x + 1
            if not len(at):
                continue
            apart = np.bitwise_count(bits[at - low] ^ bits[x - low]).sum(axis=1, dtype=np.int64)
            total = n[at] + n[x]
            most = (total - apart) // 2
            at = at[100 * most >= PERCENT * (total - most)]
            if len(at):
                yield x, at


def _by_tile(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of one tile at a time, smallest set first; rows come sorted by tile,
    their first column."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and held[0][0] != row[0]:
                yield sorted(held, key=lambda r: r[2])
                held = []
            held.append(row)
    if held:
        yield sorted(held, key=lambda r: r[2])


def _columns(rows: list[tuple]) -> tuple[np.ndarray, ...]:
    """ref, n, root, own and block of the rows of a tile."""
    return tuple(np.array([r[k] for r in rows], dtype=np.int64) for k in range(1, 6))


def _before(tile: int, firsts: list[list[int] | None]) -> np.ndarray:
    """Bits per row of a tile: the tiles named by it that come before this one.  ``firsts``
    are the first uncut tiles of each row's class in one order of all tiles, so all of
    them come before a tile that is not named."""
    before = [f[:f.index(tile)] if tile in f else f for f in (f or [] for f in firsts)]
    often = Counter(t for f in before for t in f)
    number = {t: k for k, t in enumerate(t for t, c in often.items() if c > 1)}
    bits = np.zeros((len(before), len(number) // 8 + 1), dtype=np.uint8)
    for row, named in enumerate(before):
        for k in (number[t] for t in named if t in number):
            bits[row, k // 8] |= 1 << k % 8
    return bits


def _spanning_links(rows: list[tuple]) -> list[tuple[int, int]]:
    """Links between components that meet in one tile: every pair that may link is
    intersected exactly unless links found before already join its two components,
    so a tile gives fewer links than it has components."""
    ref, n, roots, own, block = _columns(rows)
    sets = [np.frombuffer(r[9], np.uint64) for r in rows]
    at = np.concatenate([[0], np.cumsum([len(t) for t in sets])])
    words, ids = np.unique(np.concatenate(sets), return_inverse=True)
    member = np.zeros(len(words), dtype=bool)
    parent = {int(r): int(r) for r in roots}

    def top(r: int) -> int:
        while parent[r] != r:
            parent[r] = parent[parent[r]]
            r = parent[r]
        return r

    out = []
    for x, others in _candidates(n, roots, own, block, [np.frombuffer(_bitmap(t), np.uint8) for t in sets], *rows[0][6:9]):
        mine = ids[at[x]:at[x + 1]]
        member[mine] = True
        for y in others.tolist():
            p, q = top(int(roots[x])), top(int(roots[y]))
            if p == q:
                continue
            shared = int(np.count_nonzero(member[ids[at[y]:at[y + 1]]]))
            if 100 * shared >= PERCENT * (int(n[x]) + int(n[y]) - shared):
                parent[p] = q
                out.append((int(ref[x]), int(ref[y])))
        member[mine] = False
    return out


def _tile_links(live: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): links that join all components whose classes link in a tile.  ``live``:
    (token, ref, root, m).

    First the bitmaps, the small ones and for the rest the whole ones: of every tile only classes that may link with another one there
    go on, and of tiles left with the same classes one.  Then their shingle sets are
    sent to the tiles.  Both steps put out at most one row per class and tile, however
    many pairs they compare."""
    long = live.join(classes.where(F.col("n") > LONG_SET).select("ref", "n"), "ref")
    heavy = written(long.groupBy("token").agg(F.sum("n").alias("heavy")), "jaccard-heavy")
    d = live.join(sized_broadcast(heavy, heavy.count()), "token", "left")
    blocks = F.ceil(F.col("m") / F.lit(TILE_ROWS)) + F.floor(F.coalesce("heavy", F.lit(0)) / F.lit(TILE_ROWS * LONG_SET))
    d = d.withColumn("blocks", blocks.cast("int")).join(classes.select("ref", "n", "small"), "ref")
    # a set of band k can link with bands k and k + 1 only; where a tile is cut into bands it
    # is sent to both k and k + 1
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / PERCENT)) + 1e-9).cast("int")
    d = d.withColumn("block", F.pmod(F.xxhash64("ref"), F.col("blocks")).cast("int"))
    bands = F.when(F.col("blocks") > 1, F.array(band, band + 1)).otherwise(F.array(F.lit(-1)))
    d = d.withColumn("own", band).withColumn("band", F.explode(bands))
    d = d.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    d = d.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    d = d.withColumn("tile", F.xxhash64("token", "band", "i", "j"))
    cols = ["tile", "ref", "n", "root", "own", "block", "band", "i", "j"]
    schema = "tile bigint, ref bigint, n bigint, root bigint, own int, block int, band int, i int, j int"

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64()] * 4 + [pa.int32()] * 5
        for rows in _by_tile(batches):
            ref, n, roots, own, block = _columns(rows)
            keep = np.zeros(len(rows), dtype=bool)
            if len(rows) > 1:
                before = _before(rows[0][0], [r[10] for r in rows])
                for x, at in _candidates(n, roots, own, block, [np.frombuffer(r[9], np.uint8) for r in rows], *rows[0][6:9]):
                    at = at[~(before[at] & before[x]).any(axis=1)]      # the others meet in a tile before
                    keep[x] |= len(at) > 0
                    keep[at] = True
            kept = [r for r, k in zip(rows, keep) if k]
            if kept:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[c] for r in kept], t) for c, t in enumerate(types)], names=cols)

    def staying(rows: DataFrame, bitmap: str) -> DataFrame:
        """Rows of classes that may link by this bitmap with another one of their tile that
        they do not meet in a tile before, the largest being the first.  Pairs share
        many shingles: of tiles left with the same classes one stays."""
        named = F.array_sort(F.collect_list(F.struct((-F.col("m")).alias("less"), "tile")))
        firsts = rows.where("band < 0").groupBy("ref").agg(F.slice(named, 1, FIRST_TILES)["tile"].alias("firsts"))
        rows = rows.join(firsts, "ref", "left")
        rest = written(rows.select(*cols, bitmap, "firsts").repartition("tile").sortWithinPartitions("tile")
                       .mapInArrow(releasing(possible), schema), "jaccard-possible")
        tiles = rest.groupBy("tile", "band", "i", "j").agg(
            F.bit_xor(F.xxhash64("ref", "block")).alias("s1"), F.bit_xor(F.xxhash64("block", "ref")).alias("s2"),
            F.count(F.lit(1)).alias("m"))
        tiles = written(tiles.groupBy("s1", "s2", "m", "band", "i", "j").agg(F.min("tile").alias("tile"))
                        .select("tile", "m"), "jaccard-kept")
        return rest.join(sized_broadcast(tiles, tiles.count()), "tile").select(*cols, "m")

    left = staying(d, "small")
    left = written(staying(left.join(classes.select("ref", "bitmap"), "ref"), "bitmap"), "jaccard-left")
    sets = _sets(left.select("ref").distinct(), texts, classes)

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_tile(batches):
            found = _spanning_links(rows) if len(rows) > 1 else []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)],
                                                 names=["a", "b"])

    full = left.join(sets, "ref").select(*cols, "tokens")
    return full.repartition("tile").sortWithinPartitions("tile").mapInArrow(releasing(links), "a bigint, b bigint")


def link_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, row, n, root) of every row: ``row`` is a hash of key and text,
    ``root`` names the component (null for empty sets)."""
    src = docs.select(F.col(key).alias("doc_id"), F.xxhash64(F.col(key), F.col(text)).alias("row"),
                      F.col(text).cast("string").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    base = written(src.mapInArrow(
        releasing(_describe), f"doc_id {kind}, row bigint, n bigint, ref bigint, bitmap binary, small binary, "
                   "hot array<struct<token:bigint,n:int>>"), "jaccard-base")
    members = written(_shared_members(src, base).distinct(), "jaccard-distinct")
    weights = members.groupBy("ref").agg(F.count(F.lit(1)).alias("w"))
    classes = written(base.where("ref is not null").groupBy("ref").agg(
        F.max("n").alias("n"), F.max("bitmap").alias("bitmap"), F.max("small").alias("small"), F.min("row").alias("row")).join(weights, "ref"),
        "jaccard-classes")
    texts = src.select("row", "text")
    # stars: an original shares more shingles than its edited copies do, so the
    # class in most tiles is tried first, then others at random
    live, roots, links = _live_tiles(members, None), None, None
    weigh = classes.select("ref", "w")
    n_classes = classes.count()
    for k in range(STAR_ROUNDS):
        if live.limit(1).count() == 0:
            break
        if k == 0:
            scored = live.join(sized_broadcast(weigh, n_classes), "ref")
            pairs = _star_pairs(scored, F.col("w"))
        else:
            pairs = _star_pairs(live, F.xxhash64("ref", F.lit(k)))
        pairs = written(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
                        "jaccard-picked")
        tried = written(_possible(pairs, classes), "jaccard-possible")
        found = written(_linked(tried, texts, classes), "jaccard-links")
        links = found if links is None else links.unionByName(found)
        roots = written(connected_components(links), "jaccard-roots")
        live = _live_tiles(live, roots)
        if found.count() * STAR_SHARE < pairs.count():  # stars hardly link any more
            break
    # whatever is still apart: every pair of every tile
    if live.limit(1).count():
        links = links.unionByName(written(_tile_links(live, classes, texts), "jaccard-links"))
        roots = written(connected_components(links), "jaccard-roots")
    if roots is None:
        roots = members.select(F.col("ref").alias("node"), F.col("ref").alias("root")).limit(0)
    named = roots.withColumnRenamed("node", "ref")
    return base.select("doc_id", "row", "n", "ref").join(sized_broadcast(named, named.count()), "ref", "left") \
        .select("doc_id", "row", "n", F.coalesce("root", "ref").alias("root"))


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    linked = written(link_classes(docs, key, text), "jaccard-rows")
    least = written(linked.where("root is not null").groupBy("root").agg(
        F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("m")).where("m > 1").drop("m"), "jaccard-least")
    out = linked.join(sized_broadcast(least, least.count()), "root", "left")
    own: Column = F.coalesce("component_id", "doc_id")
    return out.select(F.col("doc_id").alias(key), F.col("n").alias("n_shingles"), own.alias("component_id"))


def keep_one_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the smallest key (nulls last),
    then the smallest row hash.  Rows without shingles all stay; of rows that
    repeat key and text in one component one stays."""
    linked = written(link_classes(docs.select(key, text), key, text), "jaccard-rows")
    order = F.struct(F.col("doc_id").isNull().alias("late"), F.col("doc_id"), F.col("row"))
    heads = written(linked.where("root is not null").groupBy("root").agg(
        F.min(order).alias("head"), F.count(F.lit(1)).alias("m")
        ).where("m > 1").select("root", F.col("head.row").alias("head")), "jaccard-heads")
    n_heads = heads.count()
    grouped = linked.join(sized_broadcast(heads, n_heads), "root")
    dropped = written(grouped.where("row <> head").select("row", "doc_id").distinct(), "jaccard-dropped")
    again = written(grouped.where("row = head").groupBy("row", "doc_id").agg(F.count(F.lit(1)).alias("m"))
                    .where("m > 1").select("row", "doc_id"), "jaccard-again")
    mark = fresh(docs.columns, "_row")
    marked = docs.withColumn(mark, F.xxhash64(F.col(key), F.col(text)))

    def among(rows: DataFrame, known: DataFrame, size: int, how: str) -> DataFrame:
        """Rows are the same when hash and key are."""
        r, k = fresh(rows.columns, "_r"), fresh(rows.columns, "_k")
        known = sized_broadcast(known.select(F.col("row").alias(r), F.col("doc_id").alias(k)), size)
        return rows.join(known, (F.col(mark) == F.col(r)) & F.col(key).eqNullSafe(F.col(k)), how)

    rest = among(marked, dropped, dropped.count(), "left_anti")
    n_again = again.count()
    if n_again:
        repeated = among(rest, again, n_again, "left_semi").dropDuplicates([mark, key])
        rest = among(rest, again, n_again, "left_anti").unionByName(repeated)
    return rest.select(*docs.columns)
