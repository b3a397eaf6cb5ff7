"""F23 near titles: recall on planted edits, hot titles, awkward rows."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from ratelens.operators import graph
from ratelens.operators import near_titles as nt


def grams(title):
    return {title[i:i + 3] for i in range(max(1, len(title) - 2))}


def test_recall_on_planted_edits(spark):
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdeghilmnoprstué") for _ in range(rnd.randrange(3, 9))) for _ in range(900)]
    rows, truth = [], []
    for k in range(150):
        base = " ".join(rnd.choice(words) for _ in range(rnd.randrange(6, 12)))
        rows.append((10 * k, base))
        for j in range(1, 4):
            at = rnd.randrange(len(base))
            edited = base[:at] + rnd.choice("xyz") + base[at + 1:]
            rows.append((10 * k + j, edited.upper() + " !"))
            a, b = grams(base), grams(edited)
            if 100 * len(a & b) >= 75 * len(a | b):
                truth.append((10 * k, 10 * k + j))
    got = {r.id: r.group_id for r in nt.near_titles(
        spark.createDataFrame(rows, "id bigint, title string"), "id", "title").collect()}
    found = sum(got[a] == got[b] for a, b in truth)
    assert len(truth) > 300 and found >= 0.9 * len(truth)
    assert all(group // 10 == i // 10 for i, group in got.items())       # nothing unrelated is joined


def test_hot_title_is_one_row_and_awkward_rows(spark):
    hot = [(i, "Home page of the site") for i in range(400)]
    rows = hot + [(900, "Home page of the site!"), (901, "Home page of the sites"), (902, None), (903, ""), (904, " .. "),
                  (None, "home page of the site"), (None, "nobody has this one"), (905, "ab"), (906, "AB")]
    frame = spark.createDataFrame([(i, t, 1) for i, t in rows], "id bigint, title string, node int")
    got = [(r.id, r.group_id, r.exact) for r in nt.near_titles(frame, "id", "title").collect()]
    assert len(got) == 400 + 2 + 1 + 2
    assert {g for i, g, _ in got if i is None or i < 902} == {0}
    assert [e for i, _, e in got if i == 901] == [False] and {g for i, g, _ in got if i in (905, 906)} == {905}
    assert nt.near_titles(frame.limit(0), "id", "title").count() == 0


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (200, 200)]
    got = {r.node: r.label for r in graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert graph.components(spark.range(0).select(F.col("id").alias("a"), F.col("id").alias("b"))).count() == 0
