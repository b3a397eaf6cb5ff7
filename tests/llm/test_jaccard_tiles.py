"""Exact links inside tiles: families of edited copies that nearly link, hot shingles."""

from __future__ import annotations

import random

import pytest

from ratelens.llm import ngram_jaccard


def _shingles(text: str) -> set:
    words = text.lower().split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def _brute(docs: list[tuple[int, str]]) -> dict[int, int]:
    sets = [(d, _shingles(t)) for d, t in docs]
    parent = {d: d for d, _ in docs}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, (a, x) in enumerate(sets):
        for b, y in sets[i + 1:]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((top(a), top(b)))
                parent[q] = p
    return {d: top(d) for d, _ in docs}


def _family(n: int, edits: int, seed: int, first: int = 0) -> list[tuple[int, str]]:
    """Copies of one text of 200 words, each with its own ``edits`` changed words."""
    rng = random.Random(seed)
    words = [f"w{seed}x{i}" for i in range(200)]
    out = []
    for k in range(n):
        mine = list(words)
        for at in rng.sample(range(200), edits):
            mine[at] = f"e{seed}x{k}x{at}"
        out.append((first + k, " ".join(mine)))
    return out


@pytest.mark.parametrize("rows, long", [(2048, 2048), (16, 10)])
def test_families_that_nearly_link(spark, monkeypatch, rows, long):
    monkeypatch.setattr(ngram_jaccard, "TILE_ROWS", rows)
    monkeypatch.setattr(ngram_jaccard, "LONG_SET", long)
    docs = _family(40, 4, 1) + _family(40, 8, 2, 100) + _family(20, 3, 3, 200) + _family(10, 1, 4, 300)
    docs += [(400 + k, t + " and a tail of words") for k, (_, t) in enumerate(_family(10, 4, 1))]
    random.Random(9).shuffle(docs)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    got = {r["doc_id"]: r["component_id"] for r in ngram_jaccard.jaccard_components(frame).collect()}
    assert got == _brute(docs)


def test_hot_shingles(spark):
    """A passage in more than 24 documents of a window, alone and with own words."""
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(60))
    docs = [(k, passage + " " + " ".join(f"o{k}x{i}" for i in range(rng.choice([0, 3, 8, 14, 25, 60])))) for k in range(120)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(2)
    got = {r["doc_id"]: r["component_id"] for r in ngram_jaccard.jaccard_components(frame).collect()}
    assert got == _brute(docs)


def test_a_tile_gives_fewer_links_than_components():
    import numpy as np
    rng = np.random.default_rng(1)
    base = np.arange(1, 301, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    rows = []
    for k in range(60):
        mine = base.copy()
        mine[rng.choice(300, 12 if k % 2 else 60, replace=False)] = rng.integers(1, 1 << 63, 12 if k % 2 else 60, dtype=np.uint64)
        mine = np.sort(mine)
        rows.append((7, k, len(mine), k, 0, 0, -1, 0, 0, mine.tobytes()))
    links = ngram_jaccard._spanning_links(sorted(rows, key=lambda r: r[2]))
    sets = [set(np.frombuffer(r[9], np.uint64).tolist()) for r in rows]
    assert all(4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b]) for a, b in links)
    assert 0 < len(links) < len(rows)


def test_pairs_are_met_in_one_tile(spark, monkeypatch):
    """Copies that nearly link share many tiles; their sets go to few of them."""
    sent = []
    write = ngram_jaccard.written

    def spy(df, name):
        out = write(df, name)
        if name == "jaccard-left":
            sent.append((out.count(), out.select("ref").distinct().count()))
        return out
    monkeypatch.setattr(ngram_jaccard, "written", spy)
    docs = [d for k in range(6) for d in _family(12, 4, 20 + k, 100 * k)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    got = {r["doc_id"]: r["component_id"] for r in ngram_jaccard.jaccard_components(frame).collect()}
    assert got == _brute(docs)
    (rows, classes), = sent
    assert 0 < classes and rows <= 4 * classes


def test_tiles_before():
    bits = ngram_jaccard._before(7, [[5, 7, 9], [5, 6, 8], [6, 7], None, [7, 5]])
    met = [[bool((a & b).any()) for b in bits] for a in bits]
    assert met[0][1] and met[1][2] and not met[0][2] and not met[0][4] and not any(met[3])
