"""Decontamination: affixes of numbers, sentence openers, broken alignments, readings."""

from __future__ import annotations

import numpy as np
import pytest

from ratelens.llm import decontaminate, wordscan


def found(spark, docs, items):
    docs = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    items = spark.createDataFrame([(k + 70, t) for k, t in enumerate(items)], "item_id bigint, text string")
    return {(r["doc_id"], r["item_id"] - 70, r["kind"]) for r in decontaminate.contaminated_pairs(docs, items).collect()}


PRICES = ("one of the old shops in our street sells a bag of apples for {} and another "
          "shop sells the very same bag of apples for {} on the next morning")


@pytest.mark.parametrize("old,new", [(("$5", "$9"), ("$7", "$4")), (("50%", "20%"), ("35%", "15%")),
                                     (("5km", "9km"), ("7km", "3km")), (("3rd", "5th"), ("1st", "2nd"))])
def test_affixes_are_split_off_the_number(spark, old, new):
    got = found(spark, [PRICES.format(*new)], [PRICES.format(*old)])
    assert got == {(0, 0, "reparameterised")}


def test_names_that_open_sentences(spark):
    text = ("{0} buys three red apples at the market. {0} gives two of them to a friend. "
            "{0} eats the last one at home. The house is quiet.")
    docs = [text.format("Ann"), text.format("Tom"), "well, " + text.format("Ann").replace("home. The", "home, the")]
    assert found(spark, docs, [text.format("Tom")]) == {
        (0, 0, "reparameterised"), (1, 0, "copy"), (2, 0, "reparameterised")}


def test_openers_that_contradict_keep_the_other_windows(spark):
    text = ("{} train leaves the old city at nine in the dark morning and runs along the wide river. "
            "{} driver sees the long red bridge before the sun is up and he stops at once.")
    assert found(spark, [text.format("A", "One")], [text.format("The", "The")]) == {(0, 0, "reparameterised")}


def test_items_of_amounts_only_are_found_verbatim(spark):
    prices = "$5 50% 7km $9 20% 3km $8 40%"
    assert found(spark, ["now " + prices, prices.replace("7", "6")], [prices]) == {(0, 0, "copy")}


WORDS = ("every morning our old teacher walks along the quiet river and counts seven white birds before she "
         "opens her small school where many children wait for their very first lesson about stars and far planets").split()


def test_inserted_dropped_and_run_matches(spark):
    item = " ".join(WORDS)
    half = len(WORDS) // 2
    docs = [" ".join(WORDS[:half] + ["really"] + WORDS[half:]), " ".join(WORDS[:half] + WORDS[half + 1:]),
            "so " + " ".join(WORDS[:14]) + " but not the rest", "so " + " ".join(WORDS[:13]) + " but not the rest"]
    assert found(spark, docs, [item]) == {(0, 0, "copy"), (1, 0, "copy"), (2, 0, "copy")}


def test_two_insertions_leave_short_runs(spark):
    parts = [WORDS[:12], WORDS[12:24], WORDS[24:]]
    chained = " also ".join(" ".join(p) for p in parts)
    apart = (" also " + "filler " * 60).join(" ".join(p) for p in parts)
    assert found(spark, [chained, apart], [" ".join(WORDS)]) == {(0, 0, "copy")}


def test_short_item_with_a_changed_middle_word(spark):
    item = WORDS[:15]
    assert found(spark, [" ".join(item[:7] + ["slowly"] + item[8:]), " ".join(item[:5]) + " and more"],
                 [" ".join(item)]) == {(0, 0, "copy")}


def template(*texts):
    raw = [t.encode() for t in texts]
    bounds = np.cumsum([0] + [len(r) for r in raw])
    return decontaminate.Template(np.frombuffer(b"".join(raw), np.uint8), bounds)


OPENING = ("The cat. Sees one dog. Now it runs. Away from here. Then the dog. Sleeps.", "Old men say so: The cat. Sees",
           "", "now It runs. Away In 5 km from here. Then The dog. Sleeps. A. B. C. D. E. F. G. H. I")


def plain_readings(one, size, pairs=None):
    """All readings of all windows one by one, without those that have a foreign pair."""
    out = set()
    for begin, end in zip(one.rows[:-1].tolist(), one.rows[1:].tolist()):
        for at in range(begin, end - size + 1):
            spots = np.flatnonzero(one.openers[at:at + size]).tolist()
            for names in range(1 << len(spots)):
                if (one.kind[at:at + size] == 0).sum() - names.bit_count() < decontaminate.MIN_LITERALS:
                    continue
                words = one.form[at:at + size].copy()
                words[[p for k, p in enumerate(spots) if names >> k & 1]] = decontaminate._NAME_FORM
                if pairs is None or np.isin(wordscan.window_hashes(words, 2), pairs).all():
                    window = decontaminate._sized(wordscan.window_hashes(words, size), size)
                    out.add((at, int(window[0]), names))
    return out


def assert_readings(docs, pairs=None):
    """Number of readings, after a comparison with the plain ones."""
    n = 0
    for size in (5, 8):
        got = [(a, h, k) for part in docs.readings(size) for a, h, k in zip(*(x.tolist() for x in part))]
        assert len(got) == len(set(got)) and set(got) == plain_readings(docs, size, pairs)
        n += len(got)
    return n


@pytest.mark.parametrize("step", [1, 40, 500_000])
def test_readings_with_a_foreign_pair_are_not_hashed(monkeypatch, step):
    monkeypatch.setattr(decontaminate, "STEP_READINGS", step)
    docs = template(*OPENING)
    items = template("Ann said so. The cat. Sees one Dog. Ann it runs. Away from here. Then the dog.", "now it runs. The end")
    assert_readings(docs)
    docs.only(decontaminate.Known(items.pairs()))
    assert 0 < assert_readings(docs, items.pairs())


def test_openers_with_one_known_reading_are_read_once():
    docs = template("so they see. Dogs run. Cats run. Birds run. Fish swim.")
    item = template("so they see Ann run Tom run Ann run Tom swim")      # names inside a sentence
    assert assert_readings(docs) == 70
    docs.only(decontaminate.Known(item.pairs()))
    assert assert_readings(docs, item.pairs()) == 5         # before, all 70 were hashed


def test_known_hashes_with_equal_low_bits():
    hashes = np.array([1, 1 << 40 | 1, 7, 0, 2 ** 64 - 1], dtype=np.uint64)
    for some in (hashes[:0], hashes[:1], hashes[1:4], hashes):
        assert decontaminate.Known(some).among(hashes).tolist() == np.isin(hashes, some).tolist()
    assert decontaminate.Known(hashes).among(hashes[:0]).tolist() == []
