"""Conversations with unusual roles, and user columns named like working columns."""

from __future__ import annotations

from ratelens.llm import chat_format, decontaminate, language_id, ngram_jaccard


def test_roles_with_commas_lose_nothing(spark):
    rows = [(1, 0, "user,assistant", "one"), (2, 0, "system,user", "two"), (2, 1, "assistant", "three"),
            (3, 0, "user", "a"), (3, 1, "assistant", "b"), (4, 0, "system", "s"), (4, 1, "user,assistant", "t")]
    got = {r.conv_id: (r.n_turns, r.loss_chars) for r in chat_format.chat_report(
        spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()}
    assert got == {1: (1, 0), 2: (2, 5), 3: (2, 1), 4: (2, 0)}


def test_user_columns_keep_their_values(spark):
    text = " ".join(f"word{i}" for i in range(30))
    rows = [(1, text, 7, 8, 9), (2, text, 17, 18, 19), (3, "something else that is said here only once today", 27, 28, 29)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _row bigint, _mark bigint, _text bigint")
    kept = {tuple(r) for r in ngram_jaccard.keep_one_each(docs).collect()}
    assert kept == {rows[0], rows[2]}
    items = spark.createDataFrame([(1, text, 5)], "item_id bigint, text string, _mark bigint")
    assert {tuple(r) for r in decontaminate.remove_contaminated(docs, items).collect()} == {rows[2]}
    out = language_id.classify(docs, {"en": b"something else that is said"}).collect()
    assert {(r.doc_id, r._text) for r in out} == {(1, 9), (2, 19), (3, 29)}
