"""Removal of every byte that a repeated 400-byte string covers, by suffix arrays.

All texts together do not fit one suffix array, so equal strings are first brought
into one shard:

1. Every 400-byte string has an anchor, the leftmost least hash among its 128-byte
   grams, so equal strings have equal anchors.
   Neighbouring strings share an anchor: a stretch of text is a list of contexts,
   each the strings of one anchor, and every string lies in exactly one context.
   One narrow row per context: text id, place, anchor hash, digest of its bytes.
2. Anchors that occur once end here.  Where all contexts of an anchor are the same
   bytes, all their strings repeat.  Otherwise one context of each content is
   fetched from one of the equal texts that hold it and sent to the anchor's shard.
3. A shard (bounded in bytes) sorts the suffixes of its contexts, some anchors at a
   time, by prefix doubling, with permuted common prefixes.  Strings of neighbouring
   suffixes that share 400 bytes are equal; a string met twice repeats.
4. The contexts of a very frequent anchor are dealt to several shards; those give
   one digest for each distinct string (packed by bucket), and strings that two shards
   have in common repeat.
5. Per text, the repeated strings' bytes are joined into spans and taken out.

Texts are known by 128 bits of their SHA-256, contexts by anchor and 64-bit digest,
strings between the shards of one anchor by 128 bits; inside a shard bytes are compared.

Defined results: a null text is empty; texts of fewer bytes than a string lose nothing;
equal texts repeat each other; repeated rows are all reported; a cut may fall inside a
character, so what is kept is bytes.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pretokens, wordscan
from .common import written
from .suffix_array import common_prefixes, suffix_array

LENGTH = 400
GRAM = 128
WINDOW = LENGTH - GRAM + 1          # grams of a string
SHARD_BYTES = 2_000_000
RUN_BYTES = 128_000                 # contexts of whole anchors that are sorted together
SCAN = 1 << 15                      # strings whose anchors are found at a time
FETCH_BYTES = 4_000_000             # contexts sent at a time
PIECE_BYTES = 4_000_000             # a longer text is scanned in overlapping pieces
BUCKET_BYTES = 8_000_000            # digests of the strings of split anchors in one task
PLACE = 512                         # place = start * PLACE + number of strings


def _pieces(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, offset in it, bytes, row boundaries): runs of rows, or pieces of a
    long one that share ``LENGTH`` - 1 bytes."""
    for at, to, data, bounds in wordscan.text_steps(column):
        if to - at > 1 or len(data) <= PIECE_BYTES:
            yield at, 0, data, bounds
            continue
        for low in range(0, max(1, len(data) - LENGTH + 1), PIECE_BYTES):
            part = data[low:low + PIECE_BYTES + LENGTH - 1]
            yield at, low, part, np.array([0, len(part)])


def _codes(seed: int) -> np.ndarray:
    return pretokens.mix(np.arange(256, dtype=np.uint64) + np.uint64(seed))


_GRAM_CODES, _CONTEXT_CODES, _STRING_CODES = _codes(0x2545F491), _codes(0x6C62272E), _codes(0x1B873593)


def _anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every gram, anchor of every string): the leftmost gram with the least hash
    (of which the low bits give way to the place), by doubling windows."""
    h = np.empty(len(data) - GRAM + 1, dtype=np.uint64)
    anchor = np.empty(len(data) - LENGTH + 1, dtype=np.int64)
    places = np.arange(SCAN + WINDOW - 1, dtype=np.uint64)
    low_bits = np.uint64((1 << len(places).bit_length()) - 1)
    for low in range(0, len(anchor), SCAN):
        part = pretokens.coded_window_hashes(_GRAM_CODES[data[low:low + SCAN + LENGTH - 1]], GRAM)
        h[low:low + len(part)] = part
        least, width = (part & ~low_bits) | places[:len(part)], 1
        while 2 * width <= WINDOW:
            least, width = np.minimum(least[:-width], least[width:]), 2 * width
        least = np.minimum(least[:len(least) - (WINDOW - width)], least[WINDOW - width:])
        anchor[low:low + len(least)] = (least & low_bits).astype(np.int64) + low
    return h, anchor


def contexts_of(data: np.ndarray, bounds: np.ndarray):
    """(row, start, strings, anchor hash, digest) of the contexts of all rows, by start."""
    long = np.flatnonzero(np.diff(bounds) >= LENGTH)
    if not len(long):
        return tuple(np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    h, anchor = _anchors(data)
    whole = np.zeros(len(anchor), dtype=bool)               # strings that do not cross rows
    for low, high in zip(bounds[long].tolist(), bounds[long + 1].tolist()):
        whole[low:high - LENGTH + 1] = True
    anchor[~whole] = -1
    cut = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    low, high = cut, np.append(cut[1:], len(anchor)) - 1
    held = anchor[low] >= 0
    low, high = low[held], high[held]
    row = np.searchsorted(bounds, low, side="right") - 1
    digest = pretokens.coded_span_hashes(_CONTEXT_CODES[data], low, high + LENGTH)
    return row, low - bounds[row], high - low + 1, h[anchor[low]], digest


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """uid, place, anchor hash, digest of every context."""
    for batch in batches:
        for first, offset, data, bounds in _pieces(batch.column(1)):
            row, start, count, key, digest = contexts_of(data, bounds)
            if len(row):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row + first)), pa.array((start + offset) * PLACE + count),
                     pa.array(key.view(np.int64)), pa.array(digest.view(np.int64))],
                    names=["uid", "place", "key", "digest"])


def _context_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted contexts of each text."""
    for batch in batches:
        texts = [memoryview(t.as_buffer()) for t in batch.column(1)]
        wants = batch.column(2).flatten()
        row = np.repeat(np.arange(batch.num_rows), batch.column(2).value_lengths())
        place = wants.field("place").to_numpy()
        start, end = place // PLACE, place // PLACE + place % PLACE + LENGTH - 1
        cuts = np.flatnonzero(np.diff(np.cumsum(end - start) // FETCH_BYTES)) + 1
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(row)]):
            some = zip(row[low:high].tolist(), start[low:high].tolist(), end[low:high].tolist())
            yield pa.RecordBatch.from_arrays(
                [wants.field("shard")[low:high], wants.field("key")[low:high], batch.column(0).take(pa.array(row[low:high])),
                 wants.field("place")[low:high], wants.field("single")[low:high], wants.field("split")[low:high],
                 pa.array([bytes(texts[r][s:e]) for r, s, e in some], pa.binary())],
                names=["shard", "key", "uid", "place", "single", "split", "bytes"])


_FOUND = "uid binary, low bigint, high bigint, bucket int, packed binary"
#: A string of a split anchor: 128-bit digest, start (-1 where it is known to repeat), text id.
_STRING = np.dtype([("a", "<u8"), ("b", "<u8"), ("low", "<i8"), ("uid", "<u8", 2)])


class _Run:
    """The strings of some contexts (``sizes`` bytes and ``count`` strings each) in order."""

    def __init__(self, data: np.ndarray, sizes: np.ndarray, count: np.ndarray, single: np.ndarray) -> None:
        self.data, self.count, self.first = data, count, np.cumsum(sizes) - sizes
        sa = suffix_array(data, 256)
        shared = common_prefixes(data, sa)[sa]
        run = np.cumsum(shared < LENGTH)                # suffixes with the same 400 bytes
        context = np.repeat(np.arange(len(sizes)), sizes)[sa]
        inside = sa - self.first[context]
        string = np.flatnonzero(inside < count[context])    # the others are tails of contexts
        run, self.context, self.inside = run[string], context[string], inside[string]
        self.new = np.append(True, run[1:] != run[:-1])
        run = np.cumsum(self.new) - 1
        # a context that stands for several copies counts twice
        self.again = np.bincount(run, np.where(single[self.context], 1, 2))[run] > 1

    def stretches(self, mask: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(context, first, last) of the chosen strings that follow each other."""
        first, count = self.first, self.count
        at = np.sort(first[self.context[mask]] + self.inside[mask])
        cut = np.flatnonzero(np.append(True, at[1:] != at[:-1] + 1)) if len(at) else np.zeros(0, np.int64)
        low, high = at[cut], at[np.append(cut[1:], len(at)).astype(np.int64) - 1] if len(at) else at
        # contexts that touch are told apart
        c1, c2 = (np.searchsorted(first, x, side="right") - 1 for x in (low, high))
        for a, b, p, q in zip(low.tolist(), high.tolist(), c1.tolist(), c2.tolist()):
            for c in range(p, q + 1):
                lo, hi = max(a, int(first[c])), min(b, int(first[c] + count[c]) - 1)
                if lo <= hi:
                    yield c, lo - int(first[c]), hi - int(first[c])


def _shard(table: pa.Table, buckets: int) -> pa.Table:
    """Repeated strings of the contexts of one shard: (uid, first start, last start) of the
    contexts that occur once, and the distinct strings of split anchors, packed by
    bucket of their digest."""
    table = table.sort_by("key").combine_chunks()
    parts, uids = table.column("bytes").to_pylist(), table.column("uid").to_pylist()
    place, keys = table.column("place").to_numpy(), table.column("key").to_numpy()
    single = table.column("single").to_numpy(zero_copy_only=False)
    split = table.column("split").to_numpy(zero_copy_only=False)
    count, start = place % PLACE, place // PLACE
    sizes = np.array([len(p) for p in parts])
    # equal strings have equal anchors: a run ends with an anchor
    ends, done = np.append(np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(parts)), np.cumsum(sizes)
    cuts = ends[np.append(np.diff(done[ends - 1] // RUN_BYTES) > 0, True)]
    uid, low, high, strings = [], [], [], []
    for i, j in zip([0, *cuts[:-1].tolist()], cuts.tolist()):
        run = _Run(np.frombuffer(b"".join(parts[i:j]), dtype=np.uint8), sizes[i:j], count[i:j], single[i:j])
        for c, a, b in run.stretches(run.again & single[i:j][run.context]):
            uid.append(uids[i + c])
            low.append(int(start[i + c]) + a)
            high.append(int(start[i + c]) + b)
        head = np.flatnonzero(split[i:j][run.context] & (run.new | ~run.again))
        if len(head):
            context, inside = run.context[head], run.inside[head]
            at = run.first[context] + inside
            out = np.zeros(len(head), dtype=_STRING)
            out["a"], out["b"] = (pretokens.coded_span_hashes(codes[run.data], at, at + LENGTH)
                                  for codes in (_CONTEXT_CODES, _STRING_CODES))
            out["low"] = np.where(single[i:j][context] & ~run.again[head], start[i:j][context] + inside, -1)
            out["uid"] = np.frombuffer(b"".join(uids[i:j]), dtype="<u8").reshape(-1, 2)[context]
            strings.append(out)
    bucket, packed = [None] * len(uid), [None] * len(uid)
    if strings:
        out = np.concatenate(strings)
        of = out["a"] % np.uint64(buckets)
        for k in np.unique(of).tolist():
            bucket.append(k)
            packed.append(out[of == k].tobytes())
        more = [None] * (len(bucket) - len(uid))
        uid, low, high = uid + more, low + more, high + more
    return pa.Table.from_arrays([pa.array(uid, pa.binary()), pa.array(low, pa.int64()), pa.array(high, pa.int64()),
                                 pa.array(bucket, pa.int32()), pa.array(packed, pa.binary())],
                                names=["uid", "low", "high", "bucket", "packed"])


def _met(table: pa.Table) -> pa.Table:
    """Starts of the strings that two shards have in common, of one bucket."""
    every = np.concatenate([np.frombuffer(p, dtype=_STRING) for p in table.column("packed").to_pylist()])
    order = np.lexsort((every["b"], every["a"]))
    every = every[order]
    new = np.concatenate([[True], (every["a"][1:] != every["a"][:-1]) | (every["b"][1:] != every["b"][:-1])])
    run = np.cumsum(new) - 1
    hit = every[(np.bincount(run)[run] > 1) & (every["low"] >= 0)]
    hit = hit[np.lexsort((hit["low"], hit["uid"][:, 1], hit["uid"][:, 0]))]
    if len(hit):
        cut = np.flatnonzero(np.concatenate([[True], (hit["low"][1:] != hit["low"][:-1] + 1)
                                             | (hit["uid"][1:] != hit["uid"][:-1]).any(axis=1)]))
        high = hit["low"][np.append(cut[1:], len(hit)) - 1]
        uid, low = [u.tobytes() for u in hit["uid"][cut]], hit["low"][cut]
    else:
        uid, low, high = [], [], []
    return pa.Table.from_arrays([pa.array(uid, pa.binary()), pa.array(low, pa.int64()), pa.array(high, pa.int64())],
                                names=["uid", "low", "high"])


def _identified(docs: DataFrame, text: str, *columns) -> DataFrame:
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.substring(F.unhex(F.sha2(body, 256)), 1, 16).alias("uid"), body.alias("text"), *columns)


def _fetched(source: DataFrame, lists: DataFrame) -> DataFrame:
    """The wanted contexts (``lists``: wants of each uid), each from one of the equal texts
    of ``source``."""
    texts = source.dropDuplicates(["uid"]).join(lists, "uid").select(
        "uid", F.col("text").cast("binary").alias("text"), "wants")
    return texts.mapInArrow(_context_rows, "shard bigint, key bigint, uid binary, place bigint, single boolean, "
                                           "split boolean, bytes binary")


def repeated_starts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(uid, spans): per text that holds repeated strings, the first and last starts of
    stretches of them."""
    source = _identified(docs, text)
    contexts = written(source.mapInArrow(_anchor_rows, "uid binary, place bigint, key bigint, digest bigint"),
                       "strings-contexts")
    keys = written(contexts.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("digest").alias("lo"),
                                               F.max("digest").alias("hi")).where("m > 1")
                   .select("key", (F.col("lo") != F.col("hi")).alias("mixed")), "strings-anchors")
    shared = written(contexts.join(keys, "key"), "strings-shared")
    mixed = shared.where("mixed")
    size = F.pmod("place", F.lit(PLACE)) + LENGTH - 1
    classes = written(mixed.groupBy("key", "digest").agg(
        F.count(F.lit(1)).alias("m"), F.min(F.struct("uid", "place")).alias("one")), "strings-classes")
    # an anchor all of whose contexts have copies is settled
    open_keys = written(classes.groupBy("key").agg(
        F.min("m").alias("least"), F.sum(F.pmod("one.place", F.lit(PLACE)) + LENGTH - 1).alias("bytes"))
        .where("least = 1").select("key", "bytes"), "strings-open")
    total, crowded = open_keys.agg(F.coalesce(F.sum("bytes"), F.lit(0)),
                                   F.coalesce(F.sum(F.when(F.col("bytes") > SHARD_BYTES, F.col("bytes"))), F.lit(0))).first()
    shards = max(1, -(-total // SHARD_BYTES))
    buckets = max(1, -(-crowded * _STRING.itemsize // (4 * BUCKET_BYTES)))
    blocks = F.ceil(F.col("bytes") / SHARD_BYTES)
    wanted = classes.join(open_keys, "key").select(
        "key", F.col("one.uid").alias("uid"), F.col("one.place").alias("place"), (F.col("m") == 1).alias("single"),
        (F.col("bytes") > SHARD_BYTES).alias("split"),
        F.pmod(F.xxhash64("key", F.pmod(F.xxhash64("digest"), blocks)), F.lit(shards)).alias("shard"))
    lists = written(wanted.groupBy("uid").agg(F.collect_list(
        F.struct("key", "place", "single", "split", "shard")).alias("wants")), "strings-wanted")
    # a task for each shard: they take long by their bytes, so small ones are not put together
    found = written(_fetched(source, lists).repartition(int(shards), "shard").groupBy("shard")
                    .applyInArrow(lambda table: _shard(table, buckets), _FOUND), "strings-found")
    # strings that several shards of one anchor have
    crossing = found.where("bucket is not null").select("bucket", "packed").groupBy("bucket").applyInArrow(
        _met, "uid binary, low bigint, high bigint")
    copied = classes.where("m > 1").select("key", "digest")
    repeated = written(mixed.select("uid", "place", "key", "digest").join(copied, ["key", "digest"])
                       .select("uid", "place"), "strings-copied")
    whole = shared.where("NOT mixed").select("uid", "place").unionByName(repeated)
    start = F.floor(F.col("place") / PLACE)
    spans = whole.select("uid", start.alias("low"), (start + F.pmod("place", F.lit(PLACE)) - 1).alias("high")) \
        .unionByName(found.where("bucket is null").select("uid", "low", "high")).unionByName(crossing).distinct()
    return written(spans.groupBy("uid").agg(F.collect_list(F.struct("low", "high")).alias("spans")), "strings-spans")


def merged_spans(starts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal removed runs [from, to) of the strings that start in the given stretches."""
    out: list[list[int]] = []
    for low, high in sorted(starts):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high + LENGTH)
        else:
            out.append([low, high + LENGTH])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", with_kept: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row (and the kept bytes)."""
    spans = repeated_starts(docs, text)
    rows = _identified(docs, text, F.col(key).alias("doc"))
    both = rows.join(spans, "uid", "left") \
        .select("doc", F.col("text").cast("binary").alias("text"), "spans")
    kind = rows.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, numbers, digests, kept = [], [], [], [], []
            starts = batch.column(2).to_pylist()
            for row in range(batch.num_rows):
                data = memoryview(batch.column(1)[row].as_buffer())
                cuts = merged_spans([(s["low"], s["high"]) for s in starts[row] or []])
                digest, at, rest = hashlib.sha256(), 0, []
                for low, high in [*cuts, (len(data), len(data))]:
                    digest.update(data[at:low])
                    if with_kept:
                        rest.append(bytes(data[at:low]))
                    at = high
                sizes.append(len(data))
                removed.append(sum(b - a for a, b in cuts))
                numbers.append(len(cuts))
                digests.append(digest.hexdigest())
                kept.append(b"".join(rest))
            arrays = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                      pa.array(numbers, pa.int64()), pa.array(digests, pa.string())]
            names = ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_kept:
                arrays, names = [*arrays, pa.array(kept, pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = f"doc {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return both.mapInArrow(run, schema + (", kept binary" if with_kept else "")).withColumnRenamed("doc", key)
