"""Ranked search, conversation repair and suffix-array dedup against brute force."""

from __future__ import annotations

import collections
import functools
import glob
import hashlib
import math
import random
import re
import sys
import zlib

import numpy as np
import pytest

from ratelens.llm import lexical_search, repeated_strings, turn_repair
from ratelens.llm.suffix_array import _dealt, common_prefixes, suffix_array

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ------------------------------------------------------------ 11 ranked lexical search
def ranked(docs, items, top):
    terms = [(k, TERM.findall((t or "").translate(FOLD))) for k, t in docs]
    n_docs, n_terms = sum(1 for _, t in terms if t), sum(len(t) for _, t in terms)
    df = collections.Counter(x for _, t in terms for x in set(t))
    out = set()
    for item, text in set(items):
        scored = []
        for k, t in terms:
            tf = collections.Counter(t)
            score = 0
            for x in set(TERM.findall((text or "").translate(FOLD))):
                if tf[x]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                    m = 100 - 90 + 90 * len(t) * n_docs // n_terms
                    score += w * (1_000_000_000 * tf[x] // (1000 * tf[x] + 8 * m))
            if score > 0:
                scored.append((-score, k is None, k))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out |= {(item, r + 1, k, -s) for r, (s, _, k) in enumerate(scored[:top])}
    return out


@pytest.mark.parametrize("index_bytes,cells,postings", [(32_000_000, 2_000_000, 4_000_000), (1500, 30, 7)])
def test_search_equals_brute_force(spark, monkeypatch, index_bytes, cells, postings):
    rnd = random.Random(3)
    words = ["Añb", "x9", "straße", "İx", "zoo", "Q"] + [f"w{i}" for i in range(60)]
    docs = [(i, " -".join(rnd.choice(words) for _ in range(rnd.randrange(1, 40)))) for i in range(150)]
    docs += [(1000, docs[3][1]), (999, docs[3][1]), (998, docs[3][1]), (None, docs[3][1]), (5000, None), (5001, ""),
             (5002, " .,;"), (5003, " ".join(words) + " y" * 300_000)]
    items = [(i, " ".join(rnd.choice(words) for _ in range(6))) for i in range(12)]
    items += [(40, None), (41, ""), (42, "not_there"), (None, "zoo x9"), (0, items[0][1]), (43, docs[3][1])]
    monkeypatch.setattr(lexical_search, "INDEX_BYTES", index_bytes)
    d = spark.createDataFrame([(k, t, "x") for k, t in docs], "doc_id bigint, text string, term string").repartition(5)
    q = spark.createDataFrame([(k, t, 1) for k, t in items], "item_id bigint, text string, doc bigint")
    got = lexical_search.search(d, q)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert {tuple(r) for r in got.collect()} == ranked(docs, items, 10)


def test_search_of_empty_tables_and_string_keys(spark):
    d = spark.createDataFrame([("b", "one two"), ("a", "one two"), ("c", "two")], "doc_id string, text string")
    q = spark.createDataFrame([("i", "one")], "item_id string, text string")
    assert [(r.rank, r.doc_id) for r in lexical_search.search(d, q).orderBy("rank").collect()] == [(1, "a"), (2, "b")]
    assert lexical_search.search(d.limit(0), q).count() == 0
    assert lexical_search.search(d, q.limit(0)).count() == 0


# ------------------------------------------------------------ 12 conversation repair
NAMES = {2: "user", 3: "assistant"}


def cheapest(rows):
    """Least (cost, audit, lines) by a plain recursion over rows and states."""
    sys.setrecursionlimit(20_000)

    @functools.lru_cache(maxsize=None)
    def best(i, state, inserted):
        options = []
        if i == len(rows) and state in (0, 3):
            options.append((0, "", ()))
        if inserted < 2:
            to = turn_repair.NEXT[state]
            c, a, lines = best(i, to, inserted + 1)
            options.append((c + 5, "I" + a, (f"{NAMES[to]}:",) + lines))
        if i < len(rows):
            role, text, fault = rows[i]
            c, a, lines = best(i + 1, state, 0)
            options.append((c + 2, "D" + a, lines))
            if fault not in (1, 2):
                extra = 5 if fault == 3 else 0
                to = turn_repair.NEXT[state]
                c, a, lines = best(i + 1, to, 0)
                options.append((c + 1 + extra, "R" + a, (f"{NAMES[to]}:{text}",) + lines))
                to = turn_repair.FOLLOW.get((state, role[:1]))
                if to is not None:
                    c, a, lines = best(i + 1, to, 0)
                    options.append((c + extra, "K" + a, (f"{role}:{text}",) + lines))
        return min(options, default=(1 << 40, "", ()))
    return best(0, 0, 0)


def report(table):
    """The whole contract in plain Python."""
    plain = lambda x: " " if x is None else str(x)
    convs = collections.defaultdict(list)
    for conv, turn, role, text in table:
        convs[conv]
        k = zlib.crc32(f"{plain(conv)}:{plain(turn)}".encode()) % 20
        if not k:
            continue
        role, text = plain(role), plain(text)
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        convs[conv] += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    out = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in rows:
            solid = text.strip(" \t\n\x0b\f\r")
            faults.append(1 if not solid else 2 if (role, text) in seen else 3 if solid[-1] not in ".!?" else 0)
            seen.add((role, text))
        cost, audit, lines = cheapest(tuple((r, t, f) for (_, r, t), f in zip(rows, faults)))
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        out[conv] = (gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def conversation_rows():
    rnd = random.Random(8)
    rows = []
    for conv in list(range(60)) + [None, -7]:
        for turn in range(rnd.randrange(1, 9)):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "unknown", None, ""])
            text = rnd.choice(["Yes.", "No!", "why", "Is it? ", "", None, "a. b", " \t\n", "été.", "one. ", "2!"])
            rows.append((conv, turn if rnd.random() > 0.1 else None, role, text))
    rows += [(500, t, rnd.choice(["user", "assistant"]), f"text {t}." if t % 7 else "same") for t in range(400)]
    rows += [(501, 3, "user", "again.")] * 150 + [(502, None, None, None)]
    return rows


@pytest.mark.parametrize("partitions", [None, 9])
def test_repair_equals_brute_force(spark, partitions):
    rows = conversation_rows()
    frame = spark.createDataFrame([(*r, 1) for r in rows],
                                  "conv_id bigint, turn bigint, role string, text string, fault int").repartition(4)
    got = turn_repair.damage_and_repair(frame, partitions)
    found = {r.conv_id: tuple(r)[1:] for r in got.collect()}
    assert found == report(rows)
    assert got.columns[0] == "conv_id" and len(found) == got.count()


def test_repair_of_empty_table_and_auction(spark):
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert turn_repair.damage_and_repair(empty).count() == 0
    rnd = random.Random(2)
    for _ in range(300):
        kinds = bytes(rnd.randrange(9) for _ in range(rnd.randrange(0, 90)))
        rows = tuple((turn_repair.INITIALS[(k - 1) // 2] if k else "u", "", 1 if not k else 3 * ((k - 1) % 2)) for k in kinds)
        assert turn_repair.solve(kinds) == cheapest(rows)[:2]


# ------------------------------------------------------------ 13 suffix arrays
def test_induced_sorting_equals_plain_sorting():
    rnd = random.Random(6)
    texts = [bytes(rnd.randrange(a) for _ in range(rnd.randrange(1, 70))) for a in (1, 2, 3, 250) for _ in range(150)]
    texts += [b"a" * 9000, b"ab" * 5000, b"abcabd" * 900 + bytes(range(256)) * 8]
    for text in texts:
        x = np.frombuffer(text, np.uint8)
        sa = suffix_array(x, 256)
        assert sa.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        if len(text) < 100:
            shared = common_prefixes(x, sa)
            for a, b in zip(sa[1:].tolist(), sa.tolist()):
                k = 0
                while a + k < len(text) and b + k < len(text) and text[a + k] == text[b + k]:
                    k += 1
                assert shared[a] == k


def test_keys_too_wide_for_one_integer_are_dealt_alike():
    rnd = np.random.default_rng(5)
    key, at = rnd.integers(0, 50, 3000) << 20, np.arange(3000)
    for a, b in zip(_dealt(key, at, 12, 26), _dealt(key, at, 12, 60)):
        assert a.tolist() == b.tolist()


def without_repeats(texts):
    size = repeated_strings.LENGTH
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[i:i + size] for b in data for i in range(len(b) - size + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if seen[b[i:i + size]] > 1:
                gone[i:i + size] = b"\1" * size
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def repeated_texts():
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abcdeéfghi") for _ in range(rnd.randrange(2, 8))) for _ in range(500)]
    say = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    passage, base = say(120), say(300)
    texts = [say(rnd.randrange(0, 200)) for _ in range(40)] + [say(50) + passage + say(60) for _ in range(25)]
    for _ in range(25):
        w = base.split()
        for _ in range(3):
            w[rnd.randrange(len(w))] = "zz"
        texts.append(" ".join(w))
    # just 400 and just 399 shared bytes; runs; periods; copies
    edge = "".join(rnd.choice("klmnop") for _ in range(400))
    texts += ["1" + edge + "2", "3" + edge + "4", "5" + edge[1:] + "6" * 500, "a" * 3000, "a" * 450, "ab" * 900,
              (say(6) + "\n") * 60, None, "", texts[3], texts[45], texts[45], passage, "x y z " * 300 + say(100)]
    return texts


@pytest.mark.parametrize("shard_bytes", [2_000_000, 3_000])
def test_suffix_dedup_equals_brute_force(spark, monkeypatch, shard_bytes):
    monkeypatch.setattr(repeated_strings, "SHARD_BYTES", shard_bytes)
    texts = repeated_texts()
    frame = spark.createDataFrame([(i, t, "u") for i, t in enumerate(texts)],
                                  "doc_id bigint, text string, uid string").repartition(5)
    got = repeated_strings.remove_repeats(frame, with_kept=True)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    assert {r.doc_id: (*tuple(r)[1:5], bytes(r.kept)) for r in got.collect()} == dict(enumerate(without_repeats(texts)))


def test_suffix_dedup_of_few_rows(spark):
    frame = spark.createDataFrame([(None, None), (1, "x" * 400), (1, "x" * 400)], "doc_id bigint, text string")
    rows = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in repeated_strings.remove_repeats(frame).collect())
    assert rows == [(0, 0, 0), (1, 400, 400), (1, 400, 400)]
    assert repeated_strings.remove_repeats(frame.limit(0)).count() == 0


def test_contexts_cover_every_string_once_and_pieces_agree():
    rnd = random.Random(9)
    text = bytes(rnd.choice(b"abc") for _ in range(5000)) + b"q" * 900 + b"pq" * 700
    data = np.frombuffer(text, np.uint8)
    row, start, count, key, _ = repeated_strings.contexts_of(data, np.array([0, len(text)]))
    covered = np.concatenate([np.arange(s, s + c) for s, c in zip(start, count)])
    assert sorted(covered.tolist()) == list(range(len(text) - repeated_strings.LENGTH + 1))
    # the anchor of a string does not depend on what surrounds it
    whole = dict(zip(covered.tolist(), np.repeat(key, count).tolist()))
    for low in (0, 700, 4800):
        part = data[low:low + 1300]
        _, s2, c2, k2, _ = repeated_strings.contexts_of(part, np.array([0, len(part)]))
        for s, c, k in zip(s2, c2, k2):
            assert all(whole[low + i] == k for i in range(s, s + c))


def test_suffix_dedup_fetches_copies_once(spark):
    rnd = random.Random(12)
    texts = ["".join(rnd.choice("abcdefgh") for _ in range(n)) for n in (1500, 700)]
    source = repeated_strings._identified(spark.createDataFrame([(t,) for t in texts * 40], "text string").repartition(4), "text")
    kind = "array<struct<key bigint, place bigint, single boolean, split boolean, shard bigint>>"
    wants = {t: [(i, 300 * i * repeated_strings.PLACE + 20 + i, False, i == 0, 9) for i in range(k)] for t, k in zip(texts, (3, 1))}
    uid = {t: hashlib.sha256(t.encode()).digest()[:16] for t in texts}
    lists = spark.createDataFrame([(bytearray(uid[t]), w) for t, w in wants.items()], f"uid binary, wants {kind}")
    got = sorted((bytes(r.uid), r.shard, r.key, r.place, r.single, r.split, bytes(r.bytes).decode())
                 for r in repeated_strings._fetched(source, lists).collect())
    assert got == sorted((uid[t], 9, i, p, False, i == 0, t[300 * i:300 * i + 419 + i])
                         for t, w in wants.items() for i, p, *_ in w)


def test_suffix_dedup_sorts_shards_in_tasks_of_their_own(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(repeated_strings, "SHARD_BYTES", 20_000)
    monkeypatch.setattr(repeated_strings, "written", lambda df, name: spark.read.schema(df.schema).parquet(
        (df.write.parquet(f"{tmp_path}/{name}"), f"{tmp_path}/{name}")[1]))
    texts = repeated_texts()
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: tuple(r)[1:5] for r in repeated_strings.remove_repeats(frame).collect()}
    assert got == {i: r[:4] for i, r in enumerate(without_repeats(texts))}
    assert len(glob.glob(f"{tmp_path}/strings-found/part-*")) > 3
