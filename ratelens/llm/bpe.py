"""Byte-level BPE by a global shuffle of distinct words.

Encoding.  Texts are cut into pre-tokens with their positions in blocks of
about ``BLOCK_CHARS`` characters (whole texts; a longer text is a block of its
own).  Within a block every distinct word stands for its positions: the
texts become sequences of word codes, most frequent first.  The distinct words
of all blocks are shuffled by a hash of the word, packed by (block, bucket); a
word meets all its blocks in one bucket, where it is encoded once, and its ids
go back to the blocks that asked, where the texts are reassembled by position.
What moves is each block's distinct words, their ids and the compressed code
sequences, not a row per token.  A word in every block costs one entry per block.

Decoding looks ids up in the token-byte table (bounded by the vocabulary).

The blocks are cut while scanning and identified by a hash of their content
and place, on both sides of the join; if a scan were recomputed with other
splits, ids would be missing and the job fails rather than mixing texts.

Defined results: null and empty texts have no ids and decode to no bytes;
repeated rows are encoded each; special tokens are not recognised; an empty
table gives an empty result.  Extra columns of the input are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import pretokens
from .common import releasing, releasing_group

BLOCK_CHARS = 8_000_000
MIN_BUCKETS = 96
BUCKET_BYTES = 32_000_000   # of text per bucket
STEP_CHARS = 500_000
DECODE_ROWS = 200


def load_ranks(path: str) -> dict[bytes, int]:
    """Rank file: base64 token and rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


def _squeeze(*parts: bytes) -> bytes:
    import zstandard
    head = np.array([len(parts), *map(len, parts)], dtype="<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(parts))


def _unsqueeze(blob: bytes) -> list[bytes]:
    import zstandard
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw[:8], "<i8")[0])
    ends = np.cumsum(np.frombuffer(raw[8:8 + 8 * n], "<i8")) + 8 + 8 * n
    return [raw[low:high] for low, high in zip([8 + 8 * n, *ends[:-1].tolist()], ends.tolist())]


def _planes(values: np.ndarray) -> bytes:
    """32-bit values as byte planes, which compress well when values are small."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _values(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).reshape(-1).view("<u4")


class _Block:
    """Texts gathered until the block is full, as hashes of their words."""

    def __init__(self) -> None:
        self.keys: list[int | None] = []
        self.lengths: list[np.ndarray] = []
        self.words: list[str] = []
        self.hashes: list[np.ndarray] = []
        self.codes: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.chars = 0

    def add(self, keys: list, texts: list[str]) -> None:
        cp, bounds = pretokens.code_points(texts)
        starts = pretokens.token_starts(cp, bounds)
        ends = np.append(starts[1:], len(cp)) if len(starts) else starts
        hashes = pretokens.span_hashes(cp, starts, ends)
        unique, at, codes, counts = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
        whole = "".join(texts)
        self.words += [whole[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist())]
        self.hashes.append(unique)
        self.codes.append(codes.astype(np.uint32))
        self.counts.append(counts)
        self.lengths.append(np.diff(np.searchsorted(starts, bounds)))
        self.keys += keys
        self.chars += len(cp)

    def close(self) -> tuple[int, list[str], np.ndarray, list, np.ndarray, np.ndarray]:
        """Block hash, words and word hashes by code, keys, tokens per text, codes."""
        hashes = np.concatenate(self.hashes) if self.hashes else np.zeros(0, np.uint64)
        unique, at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        counts = np.bincount(inverse, weights=np.concatenate(self.counts) if self.counts else None,
                             minlength=len(unique))
        order = np.lexsort((unique, -counts))
        rank = np.empty(len(order), dtype=np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        codes, offset = [], 0
        for part, local in zip(self.hashes, self.codes):
            codes.append(rank[inverse[offset:offset + len(part)]][local])
            offset += len(part)
        codes = np.concatenate(codes) if codes else np.zeros(0, np.uint32)
        lengths = np.concatenate(self.lengths) if self.lengths else np.zeros(0, np.int64)
        content = pretokens.mix(np.concatenate([unique, lengths.astype(np.uint64), codes[:1].astype(np.uint64)]))
        words = [self.words[i] for i in at[order].tolist()]
        return int(content.sum(dtype=np.uint64)), words, unique[order], self.keys, lengths, codes


def _blocks(batches: Iterator[pa.RecordBatch]):
    """(block id, words, word hashes, keys, lengths, codes) of one partition's texts."""
    from pyspark import TaskContext
    place, number = TaskContext.get().partitionId(), 0
    block, keys, texts, size = _Block(), [], [], 0

    def finish():
        content, *rest = block.close()
        seed = np.array([content, place, number], dtype=np.uint64)
        return int(pretokens.span_hashes(seed, np.array([0]), np.array([3]))[0] >> np.uint64(1)), *rest

    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py() or ""
            if size and size + len(text) > STEP_CHARS:
                block.add(keys, texts)
                keys, texts, size = [], [], 0
                if block.chars >= BLOCK_CHARS:
                    yield finish()
                    block, number = _Block(), number + 1
            keys.append(key)
            texts.append(text)
            size += len(text)
    if keys:
        block.add(keys, texts)
    if block.keys:
        yield finish()


def _words(buckets: int):
    """Each block's distinct words, packed by bucket: codes, lengths, UTF-8."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, words, hashes, *_ in _blocks(batches):
            bucket = (hashes % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            places, blobs = [], []
            for part in np.split(order, cuts) if len(order) else []:
                raw = [words[i].encode() for i in part.tolist()]
                sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
                places.append(int(bucket[part[0]]))
                blobs.append(_squeeze(_planes(np.diff(part, prepend=0)), _planes(sizes), b"".join(raw)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * len(places), pa.int64()), pa.array(places, pa.int64()), pa.array(blobs, pa.binary())],
                names=["block", "bucket", "words"])
    return run


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block, _, _, keys, lengths, codes in _blocks(batches):
        ends = np.cumsum(lengths)
        for at in range(0, len(keys), 200):
            to = min(at + 200, len(keys))
            low, high = (ends[at - 1] if at else 0), ends[to - 1]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([keys[at:to]], pa.list_(pa.int64())),
                 pa.array([lengths[at:to].tolist()], pa.list_(pa.int32())),
                 pa.array([_squeeze(_planes(codes[low:high]))], pa.binary())],
                names=["block", "keys", "lengths", "codes"])


def encode_texts(docs: DataFrame, ranks: dict[bytes, int], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every row; ``key`` must be integral."""
    import tiktoken
    spark = docs.sparkSession
    src = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    shared = spark.sparkContext.broadcast(ranks)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # one pattern match per word, so that merges never cross its ends
        bpe = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=shared.value, special_tokens={})
        known: dict[int, dict[bytes, bytes]] = {}      # ids as bytes: an array of a few numbers takes three times as much
        for batch in batches:
            out = []
            for bucket, blob in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                memo = known.setdefault(bucket, {})
                steps, sizes, flat = _unsqueeze(blob)
                ids, at = [], 0
                for size in _values(sizes).tolist():
                    word = flat[at:at + size]
                    at += size
                    found = memo.get(word)
                    if found is None:
                        found = memo[word] = np.array(bpe.encode_ordinary(word.decode()), dtype="<u4").tobytes()
                    ids.append(found)
                counts = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
                out.append(_squeeze(steps, _planes(counts), _planes(np.frombuffer(b"".join(ids), "<u4"))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["block", "ids"])

    volume = src.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    buckets = max(MIN_BUCKETS, int(volume) // BUCKET_BYTES)
    words = src.mapInArrow(releasing(_words(buckets)), "block bigint, bucket bigint, words binary")
    coded = words.repartition(buckets, "bucket").mapInArrow(releasing(encode), "block bigint, ids binary")
    sequences = src.mapInArrow(releasing(_sequences), "block bigint, keys array<bigint>, lengths array<int>, codes binary")

    def reassemble(left: pa.Table, right: pa.Table) -> pa.Table:
        codes_at, sizes, flats = [], [], []
        for blob in right.column("ids"):
            steps, counts, flat = _unsqueeze(blob.as_py())
            codes_at.append(np.cumsum(_values(steps), dtype=np.int64))
            sizes.append(_values(counts).astype(np.int64))
            flats.append(_values(flat))
        none = np.zeros(0, np.int64)
        code, count = np.concatenate([none, *codes_at]), np.concatenate([none, *sizes])
        flat = np.concatenate([np.zeros(0, "<u4"), *flats])
        start, size = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
        start[code] = np.cumsum(count) - count
        size[code] = count
        keys, values, ends, total = [], [], [np.zeros(1, np.int64)], 0
        for row_keys, row_lengths, row_codes in zip(left.column("keys"), left.column("lengths"), left.column("codes")):
            codes = _values(_unsqueeze(row_codes.as_py())[0])
            if len(codes) and (len(code) == 0 or codes.max() >= len(code)):
                raise ValueError("a block's words are incomplete")
            n = size[codes]
            at = np.cumsum(n)
            span = np.arange(at[-1] if len(at) else 0, dtype=np.int64)
            span += np.repeat(start[codes] - (at - n), n)
            values.append(flat[span].astype(np.int32))
            ends.append(total + np.concatenate([[0], at])[np.cumsum(row_lengths.values.to_numpy())])
            total += len(span)
            keys.append(row_keys.values)
        ids = pa.ListArray.from_arrays(pa.array(np.concatenate(ends).astype(np.int32)), pa.array(np.concatenate(values)))
        return pa.table({"doc_id": pa.concat_arrays(keys), "ids": ids})

    return (sequences.groupBy("block").cogroup(coded.groupBy("block"))
            .applyInArrow(releasing_group(reassemble), "doc_id bigint, ids array<int>"))


def decode_ids(encoded: DataFrame, ranks: dict[bytes, int], ids: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded`` binary: the tokens' bytes in order."""
    top = max(ranks.values()) + 1
    table = [b""] * top
    for token, rank in ranks.items():
        table[rank] = token
    sizes = np.fromiter(map(len, table), dtype=np.int64, count=top)
    shared = encoded.sparkSession.sparkContext.broadcast((b"".join(table), sizes))
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])
    position = encoded.columns.index(ids)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = np.frombuffer(shared.value[0], dtype=np.uint8)
        size = shared.value[1]
        start = np.cumsum(size) - size
        for whole in batches:
            for low in range(0, whole.num_rows, DECODE_ROWS):
                batch = whole.slice(low, DECODE_ROWS)
                out = []
                for row in batch.column(position):
                    one = row.values.to_numpy() if row.is_valid else np.zeros(0, np.int32)
                    n = size[one]
                    at = np.cumsum(n)
                    span = np.arange(at[-1] if len(at) else 0, dtype=np.int64) + np.repeat(start[one] - (at - n), n)
                    out.append(flat[span].tobytes())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())],
                                                 names=[*batch.schema.names, "decoded"])
            pa.default_memory_pool().release_unused()

    return encoded.mapInArrow(releasing(decode), schema)


def round_trip_report(docs: DataFrame, ranks: dict[bytes, int], with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, [ids,] ids_sha256, decoded_sha256 of every row."""
    both = decode_ids(encode_texts(docs, ranks), ranks)
    return both.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), *(["ids"] if with_ids else []),
        F.sha2(F.encode(F.array_join(F.col("ids").cast("array<string>"), " "), "UTF-8"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
