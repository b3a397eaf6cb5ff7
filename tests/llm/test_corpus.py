"""Corpus operators against brute force, round trips and awkward rows."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ratelens.llm import (bpe, chat_format, decontaminate, language_id, ngram_jaccard, pretokens, quality_rules,
                          sharding, substring_dedup, token_files, warc, wordscan)
from ratelens.llm.components import connected_components

tiktoken = pytest.importorskip("tiktoken")
public_tokenizers = pytest.importorskip("public_tokenizers")

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i}" for i in range(30_000)) + " " + "x" * 100_000


def vocabulary(n, seed=5):
    rnd = random.Random(seed)
    return ["".join(rnd.choice("abcdefghilmnoprstu") for _ in range(rnd.randrange(2, 9))) for _ in range(n)]


def text_of(rnd, words, n):
    return " ".join(rnd.choice(words) for _ in range(n))


def awkward(spark):
    """Nulls, empty and long texts, repeated rows, a clashing extra column."""
    return spark.createDataFrame(
        [(1, None, "en", "a"), (2, "", None, "b"), (2, "", None, "b"), (None, "one two three four five six", "en", "c"),
         (3, LONG, "fr", "d"), (4, " \n\t ", "en", "e"), (5, "one two three four five six", "en", "f")],
        "doc_id bigint, text string, lang string, ref string")


@pytest.fixture(scope="module")
def corpus(spark):
    """Distinct texts, exact and near copies, chains, shared passages and benchmark passages."""
    rnd, words = random.Random(11), vocabulary(3000)
    passage = text_of(rnd, words, 60)
    leak = "Which number follows " + text_of(rnd, words, 20)
    rows, k = [], 0
    for _ in range(60):
        rows.append((k, text_of(rnd, words, rnd.randrange(3, 160))))
        k += 1
    base = text_of(rnd, words, 120).split()
    chain = list(base)
    for _ in range(25):                       # a chain: neighbours link, ends do not
        at = rnd.randrange(len(chain))
        chain = chain[:at] + [rnd.choice(words)] + chain[at + 1:]
        rows.append((k, " ".join(chain)))
        k += 1
    for _ in range(12):
        rows.append((k, text_of(rnd, words, 40) + " " + passage + " " + text_of(rnd, words, 40)))
        k += 1
    for _ in range(6):
        rows.append((k, rows[3][1].upper() if k % 2 else rows[3][1]))
        k += 1
    for _ in range(4):
        rows.append((k, text_of(rnd, words, 50) + ". " + leak + " " + text_of(rnd, words, 30)))
        k += 1
    return {"frame": spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), "texts": dict(rows),
            "passage": passage, "leak": leak}


# ------------------------------------------------------------ 1 token counts
def test_separator_scan_counts_tokens(spark, corpus):
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for block in (97, 2_000_000):
        got = token_files.count_tokens(corpus["frame"], ranks, public_tokenizers.PATTERN, 50256, block_tokens=block)
        assert {tuple(r) for r in got.collect()} == {(k, len(enc.encode_ordinary(t))) for k, t in corpus["texts"].items()}


def test_separator_scan_of_awkward_rows_and_open_files(spark, tmp_path):
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rows = awkward(spark)
    got = token_files.count_tokens(rows, ranks, public_tokenizers.PATTERN, 50256).collect()
    assert len(got) == 7 and sorted(r["n_tokens"] for r in got)[:3] == [0, 0, 0]
    assert token_files.count_tokens(rows.where("false"), ranks, public_tokenizers.PATTERN, 50256).count() == 0
    np.array([5, 9, 9, 7, 1, 9, 4], dtype="<u2").tofile(tmp_path / "a.bin")
    blocks = token_files.separator_positions(spark, str(tmp_path), 9, block_tokens=2)
    got = token_files.document_spans(blocks).orderBy("ordinal").collect()
    assert [(r["ordinal"], r["token_start"], r["n_tokens"], r["terminated"]) for r in got] == \
        [(0, 0, 1, True), (1, 2, 0, True), (2, 3, 2, True), (3, 6, 1, False)]


# ----------------------------------------------------------------- 2 shards
def test_shards_have_exact_sizes_and_gapless_slots(spark):
    rows = spark.range(1003).select(F.col("id").alias("doc_id"), F.lit("same").alias("text")).repartition(7)
    out = sharding.shard_documents(rows, 16).toPandas()
    sizes = out.groupby("shard").slot.agg(["count", "max", "nunique"])
    assert len(out) == 1003 and sizes["count"].max() - sizes["count"].min() <= 1
    assert (sizes["max"] + 1 == sizes["count"]).all() and (sizes["nunique"] == sizes["count"]).all()
    assert out.doc_id.nunique() == 1003 and (out["size"] == 5).all()


def test_shards_of_awkward_rows(spark):
    out = sharding.shard_documents(awkward(spark), 16).collect()
    assert len(out) == 7 and {r["shard"] for r in out} == set(range(7)) and {r["slot"] for r in out} == {0}
    assert sharding.shard_documents(awkward(spark).where("false"), 16).count() == 0
    kept = sharding.shuffle_into_shards(awkward(spark).withColumn("shard", F.lit("x")), 2)
    assert kept.columns == ["doc_id", "text", "lang", "ref", "shard", "slot"]


def test_hypergeometric_draw_follows_the_law(spark):
    from math import comb
    n = 4000
    u = sharding._uniform(3, F.col("id"))
    got = spark.range(n).select(sharding.hypergeometric(F.lit(60), F.lit(20), F.lit(15), u).alias("x")).toPandas().x
    seen = collections.Counter(got)
    law = {k: comb(20, k) * comb(40, 15 - k) / comb(60, 15) for k in range(16)}
    chi = sum((seen[k] - n * p) ** 2 / (n * p) for k, p in law.items() if n * p > 5)
    assert chi < 35


# ------------------------------------------------------ 3 decontamination
def test_leaks_are_found_and_clean_documents_left(spark, corpus):
    items = spark.createDataFrame([(1, corpus["leak"]), (2, None), (3, "")], "item_id bigint, text string")
    got = {r["doc_id"] for r in decontaminate.contaminated_pairs(corpus["frame"], items).collect()}
    assert got == {k for k, t in corpus["texts"].items() if corpus["leak"] in t}
    kept = decontaminate.remove_contaminated(corpus["frame"], items)
    assert {r["doc_id"] for r in kept.collect()} == set(corpus["texts"]) - got


def test_reparameterised_questions(spark, monkeypatch):
    question = "A train leaves {} at 9 km and {} counts {} apples then {} eats 5 of them in the old house today."
    docs = spark.createDataFrame(
        [(1, "Well. " + question.format("Boston", "Alice", 12, "Alice")), (2, question.format("Paris", "Robert", 44, "Robert")),
         (3, question.format("Paris", "Robert", 44, "Maria")), (4, None), (5, "| | ,")], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, question.format("Boston", "Alice", 12, "Alice"))], "item_id bigint, text string")
    expected = {(1, 7, "copy"), (2, 7, "reparameterised")}
    for limit in (decontaminate.BROADCAST_WINDOWS, 0):        # broadcast hashes, and the shuffle join
        monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", limit)
        got = decontaminate.contaminated_pairs(docs, items)
        assert {(r["doc_id"], r["item_id"], r["kind"]) for r in got.collect()} == expected
    assert decontaminate.contaminated_pairs(docs.where("false"), items).count() == 0
    assert decontaminate.contaminated_pairs(docs, items.where("false")).count() == 0
    assert decontaminate.contaminated_pairs(awkward(spark), items).count() == 0


# -------------------------------------------------------------------- 4 chat
def test_chat_round_trip_of_layouts(spark):
    tricky = "\\### Assistant: </turn> ok\n### user: x</turn>\n\\\\"
    records = [
        (1, '{"prompt": "p", "response": "r"}', "prompt_response", [("user", "p"), ("assistant", "r")]),
        (2, '{"output": "o", "input": "", "instruction": "i"}', "instruction", [("user", "i"), ("assistant", "o")]),
        (3, '{"messages": [{"content": "a", "role": "system"}, {"role": "x: y", "content": null}]}', "messages",
         [("system", "a"), ("x: y", "")]),
        (4, '{"data": {"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]}}', "conversation",
         [("user", "h"), ("assistant", "g")]),
        (5, '{"unknown": 1}', None, None), (6, None, None, None), (7, "not json", None, None)]
    import json
    records.append((8, json.dumps({"prompt": tricky, "response": tricky}), "prompt_response",
                    [("user", tricky), ("assistant", tricky)]))
    df = spark.createDataFrame([r[:2] for r in records], "id bigint, record string").withColumn("turns", F.lit("clash"))
    turned = chat_format.canonical_turns(df, "id")
    got = {r["id"]: (r["mapping"], r["turns"] and [tuple(t) for t in r["turns"]]) for r in turned.collect()}
    assert got == {r[0]: (r[2], r[3]) for r in records}
    out = chat_format.format_chat(turned, "id").withColumn("back", chat_format.parse_chat(F.col("formatted"))) \
        .withColumn("loss", chat_format.masked_text(F.col("formatted"), F.col("loss_spans")))
    for r in out.collect():
        turns = got[r["id"]][1] or []
        assert [tuple(t) for t in r["back"]] == turns
        assert r["loss"] == "".join(t for role, t in turns if role == "assistant")


def test_chat_report_against_brute_force(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, None, None), (2, 0, "user", "</turn>"),
            (2, 0, "user", "</turn>"), (None, None, "gpt", "x\\"), (4, 0, "system", "s"), (4, 1, "user", "u"), (4, 2, "assistant", "é漢")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("record", F.lit(1))
    groups = collections.defaultdict(list)
    for c, t, role, text in rows:
        groups[c].append((t is None, t or 0, role or "", text or ""))
    for r in chat_format.chat_report(df).collect():
        g = sorted(groups[r["conv_id"]])
        loss = "".join(x[3] for x in g if x[2] == "assistant")
        assert (r["n_turns"], r["loss_chars"]) == (len(g), len(loss))
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{x[2]}\n{x[3]}\n" for x in g).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert chat_format.chat_report(df.where("false")).count() == 0


# ---------------------------------------------------------------- 5 language
def test_languages_are_told_apart(spark):
    rnd = random.Random(3)
    lists = {"aa": vocabulary(150, 1), "bb": vocabulary(150, 2), "cc": [w + "é" for w in vocabulary(150, 3)]}
    rows = [(k, text_of(rnd, lists[lang], 60), lang) for k, lang in enumerate(list(lists) * 60)]
    out = language_id.language_report(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).toPandas()
    truth = {k: lang for k, _, lang in rows}
    held = out[out.held_out]
    assert len(held) > 20 and (held.lang_pred == held.doc_id.map(truth)).mean() > 0.95
    assert out.score.between(0, 1).all()


def test_language_of_awkward_rows(spark):
    got = language_id.language_report(awkward(spark)).collect()
    assert len(got) == 7 and all(r["lang_pred"] == "und" and r["score"] == 0 for r in got if r["doc_id"] in (1, 2, 4))
    assert language_id.language_report(awkward(spark).where("false")).count() == 0
    none = language_id.classify(spark.createDataFrame([(1, "abc")], "doc_id bigint, text string"), {})
    assert none.first()["lang_pred"] == "und"


# --------------------------------------------------------------------- 6 BPE
def test_pretokens_equal_the_pattern():
    import regex
    rx, rnd = regex.compile(public_tokenizers.PATTERN), random.Random(1)
    alphabet = " '  \n\t strevlmdaSé1²½٣.!#\x1c\x85 ’漢\U0001F600́x"
    for _ in range(3000):
        texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(0, 14))) for _ in range(3)]
        cp, bounds = pretokens.code_points(texts)
        at = pretokens.token_starts(cp, bounds)
        whole = "".join(texts)
        got = [whole[i:j] for i, j in zip(at, np.append(at[1:], len(cp)))]
        assert got == [x for t in texts for x in rx.findall(t)]


def test_bpe_round_trip(spark, corpus):
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = corpus["frame"].unionByName(awkward(spark).select("doc_id", "text"))
    out = bpe.decode_ids(bpe.encode_texts(rows.withColumn("block", F.lit("clash")), ranks), ranks).collect()
    expected = sorted((str(r["doc_id"]), enc.encode_ordinary(r["text"] or ""), (r["text"] or "").encode()) for r in rows.collect())
    assert sorted((str(r["doc_id"]), list(r["ids"]), bytes(r["decoded"])) for r in out) == expected
    assert bpe.encode_texts(rows.where("false"), ranks).count() == 0


# --------------------------------------------------------- 7 substring dedup
def brute_chunks(text):
    words = [m[0].encode() for m in WORD.finditer(text or "")]
    if not words:
        return []
    data = np.frombuffer(b" ".join(words), np.uint8)
    sizes = np.array([len(w) for w in words])
    at = np.cumsum(sizes + 1) - sizes - 1
    g = [int(x) for x in pretokens.mix(wordscan.word_hashes(data, at, at + sizes, fold=False) ^ np.uint64(0x2545F4914F6CDD1D))]
    full = (1 << 64) - 1
    h = [0] + [int(pretokens.mix(np.array([sum(g[i - a] << (16 * a) for a in range(4) if i >= a) & full], np.uint64))[0])
               for i in range(len(g) - 1)]
    cuts = {0, len(g)}
    for i in range(len(g) - substring_dedup.CUT_WINDOW + 1):
        part = h[i:i + substring_dedup.CUT_WINDOW]
        cuts.add(i + part.index(min(part)))
    cuts = sorted(cuts)
    pairs = [(i, next((c for c in cuts if c >= i + substring_dedup.MIN_WORDS), None)) for i in cuts[:-1]]
    return [(i, j, tuple(words[i:j])) for i, j in pairs if j is not None]


def test_substring_dedup_against_brute_force(spark, corpus):
    seen, expected = set(), collections.defaultdict(set)
    for k, t in sorted(corpus["texts"].items()):
        for i, j, chunk in brute_chunks(t):
            if chunk in seen:
                expected[k] |= set(range(i, j))
            seen.add(chunk)
    got = collections.defaultdict(set)
    for r in substring_dedup.repeat_report(corpus["frame"]).collect():
        raw = corpus["texts"][r["doc_id"]].encode()
        first = len(raw[:r["span_start"]].split())
        got[r["doc_id"]] |= set(range(first, first + r["n_words"]))
    assert got == expected
    holders = sorted(k for k, t in corpus["texts"].items() if corpus["passage"] in t)
    assert all(got[k] for k in holders[1:]) and not got[holders[0]]


def test_substring_dedup_of_awkward_rows(spark):
    rows = awkward(spark).unionByName(awkward(spark).where("doc_id = 3"))
    out = substring_dedup.dedup_documents(rows)
    assert out.columns == rows.columns
    kept = collections.Counter(r["doc_id"] for r in out.collect())
    assert kept == {1: 1, 2: 2, None: 1, 3: 1, 4: 1, 5: 1}      # the long text's copy is emptied and goes
    assert substring_dedup.repeat_report(rows.where("false")).count() == 0


# ----------------------------------------------------------- 8 Jaccard join
def brute_sets(texts):
    out = {}
    for k, t in texts.items():
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out[k] = ({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}) if w else set()
    return out


def brute_components(sets):
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in sets}


@pytest.mark.parametrize("small", [False, True])
def test_jaccard_components_against_brute_force(spark, corpus, monkeypatch, small):
    if small:                # many tiles and blocks, hot shingles, no star rounds but one
        monkeypatch.setattr(ngram_jaccard, "TILE_ROWS", 3)
        monkeypatch.setattr(ngram_jaccard, "STAR_ROUNDS", 1)
    sets = brute_sets(corpus["texts"])
    root = brute_components(sets)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in
           ngram_jaccard.jaccard_components(corpus["frame"].withColumn("ref", F.lit(0))).collect()}
    assert got == {k: (len(sets[k]), root[k]) for k in sets}


def test_jaccard_of_awkward_rows(spark):
    got = collections.Counter((r["doc_id"], r["component_id"]) for r in ngram_jaccard.jaccard_components(awkward(spark)).collect())
    assert got == {(1, 1): 1, (2, 2): 2, (None, 5): 1, (3, 3): 1, (4, 4): 1, (5, 5): 1}
    assert ngram_jaccard.jaccard_components(awkward(spark).where("false")).count() == 0
    kept = ngram_jaccard.keep_one_each(awkward(spark).unionByName(awkward(spark)))
    assert collections.Counter(r["doc_id"] for r in kept.collect()) == {1: 2, 2: 4, 3: 1, 4: 2, 5: 1}


def test_bit_counts_never_rule_out_a_link():
    rnd = random.Random(4)
    for _ in range(300):
        n = rnd.randrange(1, 400)
        a = {rnd.getrandbits(64) for _ in range(n)}
        b = {x for x in a if rnd.random() > 0.15} | {rnd.getrandbits(64) for _ in range(rnd.randrange(0, n // 6 + 2))}
        if not b or 100 * len(a & b) < 75 * len(a | b):
            continue
        maps = [np.frombuffer(ngram_jaccard._bitmap(np.array(sorted(s), dtype=np.uint64)), np.uint8) for s in (a, b)]
        assert ngram_jaccard.may_link(len(a), len(b), *maps)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 40)] + [(7, 7)]
    rnd = random.Random(2)
    rnd.shuffle(edges)
    out = connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    groups = collections.defaultdict(set)
    for r in out:
        groups[r["root"]].add(r["node"])
    assert sorted(map(sorted, groups.values())) == [list(range(61)), list(range(1000, 1040))]
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# ------------------------------------------------------------------ 9 quality
def test_quality_counts_against_brute_force(spark, corpus):
    extra = spark.createDataFrame([(900, "a b c\na b c\n\n a b c\n# $ % a b c"), (901, "x y z x y z x y z")],
                                  "doc_id bigint, text string")
    rows = corpus["frame"].unionByName(extra).withColumn("lang", F.lit("en")).withColumn("kept", F.lit("clash"))
    for r in quality_rules.quality_report(rows).collect():
        t = corpus["texts"].get(r["doc_id"]) or {x["doc_id"]: x["text"] for x in extra.collect()}[r["doc_id"]]
        w = WORD.findall(t)
        seen = collections.Counter(zip(w, w[1:], w[2:]))
        cover = {i + o for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for o in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(cover))
        assert r["base_failed"] == (len(w) < 50 or 100 * len(cover) > 50 * len(w))
        assert not (r["base_failed"] and r["kept"])


def test_divergent_documents_are_rejected(spark):
    rnd, words = random.Random(8), vocabulary(400) + ["the", "of", "and", "to", "in"] * 60
    rows = [(k, text_of(rnd, words, 300) + ".", "en") for k in range(40)]
    rows.append((100, " ".join(f"{w}###$$$" for w in text_of(rnd, words, 300).split()), "en"))
    rows.append((101, text_of(rnd, words, 300).upper(), "en"))
    got = {r["doc_id"]: r["kept"] for r in quality_rules.quality_report(
        spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert [k for k, kept in got.items() if not kept] == [100, 101]


def test_quality_of_awkward_rows(spark):
    got = {r["doc_id"]: r for r in quality_rules.quality_report(awkward(spark)).collect()}
    assert got[1]["n_words"] == 0 and got[1]["base_failed"] and got[3]["n_words"] == 30_001
    assert quality_rules.quality_report(awkward(spark).where("false")).count() == 0
    assert quality_rules.quality_filter(awkward(spark)).columns == awkward(spark).columns


# -------------------------------------------------------------------- 10 WARC
def test_archives_round_trip(spark, tmp_path):
    body = "<html>" + "é" * 120 + "\r\n\r\nWARC/1.1\r\n</html>"
    rows = [(3, "http://a", body), (1, "http://b", body), (2, None, body), (4, "http://c\r\nX: y", "short"), (5, "u", "short"),
            (6, "u", None), (7, "u", ""), (None, "u", body), (8, "u", body + "x")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("payload_bytes", F.lit("clash"))
    warc.write_archives(df, str(tmp_path / "w"))
    read = warc.read_archives(spark, str(tmp_path / "w")).collect()
    assert len(read) == len(rows)
    stored = {r["page_id"]: bytes(r["payload"]) for r in read if r["record_type"] == "response"}
    assert stored == {1: body.encode(), 4: b"short", 5: b"short", 6: b"", 7: b"", 8: (body + "x").encode()}
    digest = hashlib.sha256(body.encode()).hexdigest()
    report = {r["page_id"]: r for r in warc.archive_report(spark, str(tmp_path / "w")).collect()}
    for k in (2, 3, None):
        assert (report[k]["record_type"], report[k]["refers_to"], report[k]["payload_digest"], report[k]["payload_bytes"]) == \
            ("revisit", 1, digest, len(body.encode()))
    assert report[1]["record_type"] == "response" and report[1]["refers_to"] is None
    assert warc.archive_pages(df.where("false")).count() == 0


# ------------------------------------------------------------- word scanning
def test_shingle_sets_equal_brute_force():
    rnd = random.Random(2)
    for _ in range(400):
        texts = ["".join(rnd.choice("aAb \n\té漢") for _ in range(rnd.randrange(0, 40))) if rnd.random() > .1 else None
                 for _ in range(4)]
        sets = [s for _, _, data, bounds in wordscan.text_steps(pa.array(texts, pa.string()))
                for s in wordscan.shingle_sets(data, bounds)]
        brute = brute_sets(dict(enumerate(texts)))
        assert [len(s) for s in sets] == [len(brute[i]) for i in range(4)]
        assert all(len(np.intersect1d(sets[i], sets[j])) == len(brute[i] & brute[j]) for i in range(4) for j in range(i))


# ------------------------------------------------------------------ pipeline
def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline
    from ratelens.llm.common import table, written
    sf = "/root/testdata/sf0.001"
    docs, before = table(spark, sf, "documents"), None
    columns = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs, written(stage(spark, docs, sf), f"test-{k}")
        if k < 4:
            assert docs.columns == columns and docs.count() <= before.count()
    assert docs.count() == before.count() > 0
    assert docs.join(before, "doc_id").where(F.sha2("text", 256) != F.col("decoded_sha256")).count() == 0
