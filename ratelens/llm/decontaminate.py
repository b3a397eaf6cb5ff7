"""Benchmark decontamination by template canonicalisation.

Words lose their outer punctuation, numbers their currency, percent, unit and
ordinal affixes, which become words of their own; numbers, names (capitalised
inside a sentence) and units become typed placeholders, other words their lower
case.  A capitalised word that opens a sentence is read both ways, as a name and
as a literal, in documents and items alike.
The result is a template that a re-parameterised question shares with the
original.  Windows of ``WINDOW`` template words (for items under 23 words also
shorter ones) are hashed and joined between documents and benchmark items.
Matches of one (document, item) pair are gathered per alignment; alignments that
follow one another in item and document (inserted or dropped words) are chained.
The values in the placeholder slots are compared:
equal values are a literal copy; a one-to-one replacement (the same item value
always replaced by the same document value, different ones by different ones)
is a re-parameterised copy; anything else is a chance likeness of templates and
not reported.

A pair is reported when at least ``MIN_SHARE`` of the item's windows match on
consistent slots, or a run of more than ``RUN_WORDS`` words on one alignment.
Where the slots contradict, the windows with equal values count alone.

The distinct window hashes of the benchmark are broadcast when they are fewer
than ``BROADCAST_WINDOWS``, so that documents send only windows that can match;
otherwise all windows are shuffled.  Windows with fewer than ``MIN_LITERALS``
literal words say nothing and are left out on both sides; an item that has no
other windows is compared by its values instead (verbatim only).

Defined results: null, empty and punctuation-only texts and items match
nothing; items of fewer than ``MIN_LITERALS`` words cannot be found; repeated
document rows are reported once per key; repeated items each; null keys are
reported as null.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pretokens, wordscan
from .common import fresh, releasing, sized_broadcast, written

WINDOW = 8
MIN_LITERALS = 4
MIN_SHARE = 0.5
RUN_WORDS = 13      # a longer consistent run is reported whatever its share of the item
BROADCAST_WINDOWS = 2_000_000
STEP_BYTES = 2_000_000      # many window sizes are worked off once a step
STEP_READINGS = 500_000     # of the windows worked off at once

#: Unit words and symbols.
UNITS = ["mm", "cm", "m", "km", "in", "ft", "yd", "mi", "mg", "g", "kg", "lb", "oz", "t", "ml", "cl", "l", "gal",
         "ms", "s", "min", "h", "hr", "hrs", "day", "days", "week", "weeks", "month", "months", "year", "years",
         "second", "seconds", "minute", "minutes", "hour", "hours", "meter", "meters", "metre", "metres",
         "kilometer", "kilometers", "kilometre", "kilometres", "mile", "miles", "inch", "inches", "foot", "feet",
         "gram", "grams", "kilogram", "kilograms", "pound", "pounds", "liter", "liters", "litre", "litres",
         "dollar", "dollars", "euro", "euros", "cent", "cents", "percent", "%", "$", "°c", "°f", "mph", "km/h",
         "€", "£", "¥", "us$", "usd", "eur", "gbp"]
#: Written on to a number besides units: ordinals, and parts that stay literal.
ORDINALS = ["th", "st", "nd", "rd"]
AFFIXES = ["am", "pm", "k", "bn", "x", "°"]
LITERAL, NUMBER, NAME, UNIT = 0, 1, 2, 3
#: Words that are units only next to a number (also ordinary words).
_AMBIGUOUS = ["in", "m", "s", "t", "g", "l", "h", "min", "day", "second", "foot", "pound", "cent"]


def _classes() -> np.ndarray:
    """Per byte: 0 punctuation, 1 digit, 2 upper-case letter, 3 other word byte."""
    table = np.full(256, 3, dtype=np.uint8)
    table[[c for c in range(128) if not chr(c).isalnum() and chr(c) not in "%$"]] = 0
    table[48:58] = 1
    table[65:91] = 2
    return table


_CLASS = _classes()


def _word_hash(word: str) -> int:
    data = np.frombuffer(word.lower().encode(), np.uint8)
    return int(wordscan.word_hashes(data, np.array([0]), np.array([len(data)]))[0])


class Known:
    """A set of hashes: most others are told by a table of the low bits, the rest by search."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes = np.unique(hashes)
        bits = min(24, max(16, len(self.hashes).bit_length() + 4))
        self.low = np.uint64((1 << bits) - 1)
        self.table = np.zeros(1 << bits, dtype=bool)
        self.table[(self.hashes & self.low).view(np.int64)] = True

    def among(self, hashes: np.ndarray) -> np.ndarray:
        """Which ``hashes`` are in the set."""
        out = self.table[(hashes & self.low).view(np.int64)]
        some = np.flatnonzero(out)
        if len(some):
            at = np.minimum(np.searchsorted(self.hashes, hashes[some]), len(self.hashes) - 1)
            out[some] = self.hashes[at] == hashes[some]
        return out


_UNITS_KNOWN, _AMBIGUOUS_KNOWN, _ORDINALS_KNOWN, _AFFIXES_KNOWN = (
    Known(np.array([_word_hash(w) for w in words], dtype=np.uint64))
    for words in (UNITS, _AMBIGUOUS, ORDINALS, UNITS + ORDINALS + AFFIXES))
_NAME_FORM = pretokens.mix(np.array([NAME + 7], dtype=np.uint64))[0]
_FORMS = pretokens.mix(np.arange(4, dtype=np.uint64) + np.uint64(7))       # of the placeholders, by kind


class Template:
    """Template words of many texts: kind, hash of the shared form, hash of the
    value, first word of each text.  A word of digits and letters is split where
    its letters are known affixes of a number ($5, 50%, 5km, 3rd) or set off by
    punctuation (5-year-old); else it stays whole (B12)."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray) -> None:
        starts, ends, rows = wordscan.word_spans(data, bounds)
        cls = _CLASS[data]
        solid = np.flatnonzero(cls != 0)           # words that are only punctuation have none
        begun = np.zeros(len(data), dtype=np.int32)
        begun[starts] = 1
        word, digit = np.cumsum(begun, dtype=np.int32)[solid].astype(np.int64) - 1, cls[solid] == 1
        edge = np.ones(len(solid), dtype=bool)
        edge[1:] = (word[1:] != word[:-1]) | (digit[1:] != digit[:-1])
        at = np.flatnonzero(edge)
        low, owner, number = solid[at], word[at], digit[at]
        high = solid[np.append(at[1:], len(solid)) - 1] + 1 if len(at) else low
        first = np.ones(len(at), dtype=bool)       # begins a word
        first[1:] = owner[1:] != owner[:-1]
        hashes = wordscan.word_hasher(data)
        tight = np.zeros(len(at), dtype=bool)      # touches a neighbour of the same word
        touch = ~first[1:] & (low[1:] == high[:-1])
        tight[1:] |= touch
        tight[:-1] |= touch
        parts = np.flatnonzero(~number & tight)
        whole = np.zeros(len(starts), dtype=bool)
        whole[owner[parts[~_AFFIXES_KNOWN.among(hashes(low[parts], high[parts]))]]] = True
        whole = np.flatnonzero(whole[owner])       # these words have several parts and become one
        if len(whole):
            high[whole] = high[np.searchsorted(owner, owner[whole], side="right") - 1]
            number[whole] = False
            keep = np.ones(len(at), dtype=bool)
            keep[whole] = first[whole]
            low, high, owner, number, first = low[keep], high[keep], owner[keep], number[keep], first[keep]
        # a sentence begins after a word that ends with . ! ? or :
        stop = np.isin(data[ends - 1], [46, 33, 63, 58]) if len(ends) else np.zeros(0, bool)
        opens = np.concatenate([[True], stop[:-1]]) if len(stop) else stop
        opens[rows[:-1][rows[:-1] < len(opens)]] = True
        opens = opens[owner] & first
        self.rows = np.searchsorted(owner, rows)
        plain = hashes(low, high)
        kind = np.zeros(len(low), dtype=np.int8)
        head = cls[low] if len(low) else np.zeros(0, np.uint8)
        # one upper-case letter, then lower case: a name unless it opens a sentence
        title = np.flatnonzero((head == 2) & ~opens)
        capitals = np.zeros(len(cls) + 1, dtype=np.int32)
        np.cumsum(cls == 2, out=capitals[1:])
        kind[title[capitals[high[title]] - capitals[low[title]] == 1]] = NAME
        begins = np.zeros(len(low) + 1, dtype=bool)
        begins[self.rows] = True
        beside = np.zeros(len(low), dtype=bool)
        beside[1:] |= number[:-1] & ~begins[1:-1]
        beside[:-1] |= number[1:] & ~begins[1:-1]
        unit = np.flatnonzero(_UNITS_KNOWN.among(plain))
        kind[unit[beside[unit] | ~_AMBIGUOUS_KNOWN.among(plain[unit])]] = UNIT
        kind[number] = NUMBER
        ordinal = np.flatnonzero(~first)           # 1st and 5th differ in the number only
        ordinal = ordinal[_ORDINALS_KNOWN.among(plain[ordinal])]
        kind[ordinal] = LITERAL
        self.kind, self.value, self.first = kind, plain, first
        self.openers = opens & (head == 2) & (kind == LITERAL)
        self.form = plain.copy()
        slot = np.flatnonzero(kind != LITERAL)
        self.form[slot] = _FORMS[kind[slot]]
        self.form[ordinal] = _word_hash(ORDINALS[0])
        self.literals = np.concatenate([[0], np.cumsum(kind == LITERAL)])
        self.seen = np.concatenate([[0], np.cumsum(self.openers)])
        self.cuts = np.zeros(max(0, len(low) - 1), dtype=bool)      # a text ends between two words
        self.cuts[self.rows[(self.rows > 0) & (self.rows < len(low))] - 1] = True
        self.known: np.ndarray | None = None
        self.unbroken = self.linked = np.concatenate([[0], np.cumsum(self.cuts)])

    def windows(self, size: int, linked: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """First words of the windows of ``size`` inside one text, and their
        literal words; ``linked``: only those that ``only`` left."""
        n = len(self.kind) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        passed = self.linked if linked else self.unbroken
        at = np.flatnonzero(passed[size - 1:] == passed[:n])
        return at, self.literals[at + size] - self.literals[at]

    def pairs(self) -> np.ndarray:
        """Hashes of all neighbouring words, in all readings."""
        if len(self.form) < 2:
            return np.zeros(0, dtype=np.uint64)
        both = self.form, np.where(self.openers, _NAME_FORM, self.form)
        return np.unique(np.concatenate([wordscan.combined((a[:-1], b[1:]).__getitem__, 2, len(self.form) - 1)
                                         for a in both for b in both]))

    def only(self, pairs: Known) -> None:
        """Leave readings with neighbouring words that are none of ``pairs`` out.
        ``known`` tells the four readings of a word and the next one: row 2 with the word,
        1 with the next one, 3 with both as names, else row 0."""
        self.known = np.zeros((4, len(self.cuts)), dtype=bool)
        if not len(self.cuts):
            return
        self.known[0] = pairs.among(wordscan.window_hashes(self.form, 2))
        for names in (1, 2, 3):
            at = np.flatnonzero((self.openers[1:] | (names & 1 == 0)) & (self.openers[:-1] | (names & 2 == 0)))
            words = (np.full(len(at), _NAME_FORM) if names & 2 else self.form[at],
                     np.full(len(at), _NAME_FORM) if names & 1 else self.form[at + 1])
            self.known[names, at] = pairs.among(wordscan.combined(words.__getitem__, 2, len(at)))
        self.linked = np.concatenate([[0], np.cumsum(self.cuts | ~self.known.any(axis=0))])

    def readings(self, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(first words, hashes, names) of all windows with enough literals, once
        per reading of the capitalised sentence openers in a window: bit k of
        ``names`` reads its k-th opener as a name.  A negative size gives the
        windows with too few literals, by their values."""
        if size < 0:
            at, literals = self.windows(-size)
            at = at[literals < MIN_LITERALS]
            yield at, _sized(wordscan.combined(lambda i: self.value[at + i], -size, len(at)), size), np.zeros(len(at), np.int64)
            return
        at, literals = self.windows(size, linked=True)
        at, literals = at[literals >= MIN_LITERALS], literals[literals >= MIN_LITERALS]
        most = np.cumsum(np.int64(1) << (self.seen[at + size] - self.seen[at]))     # readings
        low = 0
        while low < len(at):
            high = max(low + 1, int(np.searchsorted(most, (most[low - 1] if low else 0) + STEP_READINGS, side="right")))
            yield self._read(at[low:high], literals[low:high] - MIN_LITERALS, size)
            low = high

    def _read(self, at: np.ndarray, spare: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``readings`` of the windows ``at``, which may lose ``spare`` literals to names:
        all are extended word by word, at an opener in both ways."""
        names, total, before = (np.zeros(len(at), dtype=t) for t in (np.int64, np.uint64, np.int8))
        for i in range(size):
            named = np.zeros(len(at), dtype=np.int8)
            both = np.flatnonzero(self.openers[at + i] & (spare > 0))
            if len(both):
                first = at[both]
                bit = np.int64(1) << (self.seen[first + i] - self.seen[first])
                at, total, before = (np.concatenate([x, x[both]]) for x in (at, total, before))
                names = np.concatenate([names, names[both] | bit])
                spare = np.concatenate([spare, spare[both] - 1])
                named = np.concatenate([named, np.ones(len(both), np.int8)])
            if i and self.known is not None:
                live = self.known[2 * before + named, at + i - 1]
                if not live.all():
                    at, spare, names, total, named = (x[live] for x in (at, spare, names, total, named))
            total = wordscan.extended(total, np.where(named, _NAME_FORM, self.form[at + i]))
            before = named
        return at, _sized(wordscan.finished(total), size), names

    def slots(self, at: int, size: int, names: int) -> np.ndarray:
        """Places in one window that are placeholders in a reading."""
        if size < 0:
            return np.zeros(0, np.int64)
        kind = self.kind[at:at + size] != LITERAL
        for k, i in enumerate(np.flatnonzero(self.openers[at:at + size]).tolist()):
            kind[i] = names >> k & 1
        return np.flatnonzero(kind)


WINDOW_SCHEMA = "row bigint, text_id bigint, window bigint, pos bigint, slots array<bigint>, renamed boolean"


def _window_rows(template: Template, at: np.ndarray, hashes: np.ndarray, size: int, names: np.ndarray) -> list[pa.Array]:
    """window, pos, slots; the text's number comes from ``_text_of``."""
    values = [template.value[i:i + abs(size)][template.slots(i, size, k)].view(np.int64).tolist()
              for i, k in zip(at.tolist(), names.tolist())]
    return [pa.array(hashes.view(np.int64)), pa.array(at - template.rows[_text_of(template, at)]),
            pa.array(values, pa.list_(pa.int64()))]


def _text_of(template: Template, at: np.ndarray) -> np.ndarray:
    return np.searchsorted(template.rows, at, side="right") - 1


def _sized(window: np.ndarray, size: int) -> np.ndarray:
    return pretokens.mix(window ^ np.uint64(size & 0xFFFF))


def item_sizes(one: Template) -> list[tuple[int, int]]:
    """(size, number) of the windows of an item.  Where one changed word could
    touch more than half of them, shorter windows are taken besides, and these
    are counted with those of too few literals."""
    size = min(WINDOW, len(one.kind))
    places, literals = one.windows(size)
    n = int((literals >= MIN_LITERALS).sum())
    out = [(size, n) if n else (-size, len(places))]
    short = max(MIN_LITERALS, (len(one.kind) + 1) // 3)
    return out + [(short, len(one.windows(short)[0]))] if n and short < size else out


def benchmark_windows(items: DataFrame, key: str, text: str) -> DataFrame:
    """(item, window, pos, slots, renamed, size, n_windows): all windows of every
    item (the whole of a short one) in all their readings.  An item without a
    window of enough literals gets windows by value, of negative size."""
    src = items.select(F.col(key).cast("bigint"), F.col(text).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, _, data, bounds in wordscan.text_steps(batch.column(1)):
                for k in range(len(bounds) - 1):
                    one = Template(data[bounds[k]:bounds[k + 1]], bounds[k:k + 2] - bounds[k])
                    if one.first.sum() < MIN_LITERALS:
                        continue
                    for size, n in item_sizes(one):
                        for at, hashes, names in one.readings(size):
                            # the first word as a name is no change: the document may begin before it
                            renamed = (names > 0) & ((at > 0) | (names > 1))
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([ids[first + k]] * len(at), pa.int64()),
                                 *_window_rows(one, at, hashes, size, names), pa.array(renamed),
                                 pa.array([size] * len(at), pa.int32()), pa.array([n] * len(at), pa.int64())],
                                names=["item", "window", "pos", "slots", "renamed", "size", "n_windows"])

    return src.mapInArrow(releasing(run), "item bigint, window bigint, pos bigint, slots array<bigint>, renamed boolean, "
                               "size int, n_windows bigint")


def benchmark_pairs(items: DataFrame, text: str) -> np.ndarray:
    """Sorted hashes of the neighbouring words of all items: at most four a word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, bounds in wordscan.text_steps(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(Template(data, bounds).pairs().view(np.int64))], names=["pair"])

    found = items.select(F.col(text).cast("string")).mapInArrow(releasing(run), "pair bigint").distinct().toArrow()
    return np.sort(found.column("pair").to_numpy().astype(np.int64).view(np.uint64))


def document_windows(docs: DataFrame, sizes: list[int], wanted: np.ndarray | None,
                     pairs: np.ndarray | None = None) -> DataFrame:
    """``WINDOW_SCHEMA`` of ``docs`` (row, text, text_id): all windows of the
    given sizes in all their readings, or only those with a hash in ``wanted``.
    Windows, and readings of them, with a pair of neighbouring words that no item has
    (not in ``pairs``) cannot be among them and are not hashed."""
    shared = docs.sparkSession.sparkContext.broadcast((wanted, pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, items_pairs = (None if x is None else Known(x) for x in shared.value)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(2)
            for first, _, data, bounds in wordscan.text_steps(batch.column(1), STEP_BYTES):
                template = Template(data, bounds)
                if items_pairs is not None:
                    template.only(items_pairs)
                for size in sizes:
                    for at, hashes, names in template.readings(size):
                        if known is not None:
                            hit = known.among(hashes)
                            at, hashes, names = at[hit], hashes[hit], names[hit]
                        for i in range(0, len(at), 20_000):
                            part = at[i:i + 20_000]
                            text = pa.array(first + _text_of(template, part))
                            named = names[i:i + 20_000]
                            yield pa.RecordBatch.from_arrays(
                                [ids.take(text), texts.take(text), *_window_rows(template, part, hashes[i:i + 20_000], size, named),
                                 pa.array(named > 0)],
                                names=["row", "text_id", "window", "pos", "slots", "renamed"])

    return docs.mapInArrow(releasing(run), WINDOW_SCHEMA)


def _run_words(places: list[tuple[int, int]], size: int) -> int:
    """Longest run of words covered without a hole by windows (shift, place) of
    one alignment."""
    longest, begin, before = 0, None, None
    for at in sorted(places):
        if before is None or at[0] != before[0] or at[1] > before[1] + size:
            begin = at
        longest, before = max(longest, at[1] - begin[1] + size), at
    return longest


def _report(windows: dict, size: int, need: int) -> tuple[int, bool] | None:
    """(matched places of the item, whether a copy) of the windows
    {(shift, place): (pairs, renamed)}, if these are enough: together, without
    openers read as names, or only those with equal values."""
    for part in (windows, {k: w for k, w in windows.items() if not w[1]},
                 {k: w for k, w in windows.items() if all(a == b for a, b in w[0])}):
        pairs = {p for w in part.values() for p in w[0]}
        if len({a for a, _ in pairs}) < len(pairs) or len({b for _, b in pairs}) < len(pairs):
            continue
        n = len({place for _, place in part})
        if part and (n >= need or _run_words(list(part), size) > RUN_WORDS):
            changed = part is not windows and any(w[1] for w in windows.values())
            return n, not changed and all(a == b for a, b in pairs)
    return None


def _chain(windows: dict, size: int, reach: int) -> dict:
    """The windows of the best chain of alignments: runs that follow one another
    in the item and, within ``reach`` words, in the document."""
    runs: list[list] = []
    for at in sorted(windows):
        if runs and runs[-1][-1][0] == at[0] and at[1] <= runs[-1][-1][1] + size:
            runs[-1].append(at)
        else:
            runs.append([at])
    runs.sort(key=lambda r: (r[0][0] + r[0][1], r[0][1]))
    low, high = (np.array([r[k][1] for r in runs]) for k in (0, -1))
    shift, length = np.array([r[0][0] for r in runs]), np.array([len(r) for r in runs])
    score, prior = length.copy(), np.full(len(runs), -1)
    for j in range(1, len(runs)):
        # places of run j that its predecessor has passed in the item or the document
        lost = np.maximum(0, high[:j] + 1 + np.maximum(0, shift[:j] - shift[j]) - low[j])
        gain = score[:j] + length[j] - lost
        gain[(lost >= length[j]) | (low[j] + shift[j] - high[:j] - shift[:j] > reach)] = 0
        i = int(gain.argmax())
        if gain[i] > score[j]:
            score[j], prior[j] = gain[i], i
    out, j = {}, int(score.argmax())
    while j >= 0:
        out.update({at: windows[at] for at in runs[j]})
        j = int(prior[j])
    return out


def _judge(matches: list[dict], size: int, n_windows: int) -> tuple[int, bool] | None:
    """What one document reports of one item: every alignment alone, else the
    chains of alignments."""
    size, need = abs(size), int(np.ceil(n_windows * MIN_SHARE))
    windows: dict[tuple[int, int], tuple] = {}
    for m in matches:       # of the readings of one window the most literal one that matches
        key, found = (m["shift"], m["item_pos"]), ([(p["item_slots"], p["slots"]) for p in m["pairs"]], m["renamed"])
        if key not in windows or (len(found[0]), found[1]) < (len(windows[key][0]), windows[key][1]):
            windows[key] = found
    alone: dict[int, dict] = {}
    for key, found in windows.items():
        alone.setdefault(key[0], {})[key] = found
    reports = [r for r in (_report(w, size, need) for w in alone.values()) if r]
    if reports:
        return max(n for n, _ in reports), any(copy for _, copy in reports)
    while len({place for _, place in windows}) >= need and len(windows) > 1:
        chain = _chain(windows, size, n_windows + size)
        if len({place for _, place in chain}) < need:
            return None
        if report := _report(chain, size, need):
            return report
        windows = {k: w for k, w in windows.items() if k not in chain}
    return None


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for k in range(batch.num_rows):
            row, _, item, size, n_windows = (batch.column(c)[k].as_py() for c in range(5))
            report = _judge(batch.column(5)[k].as_py(), size, n_windows)
            if report:
                out.append((row, item, size, report[0], n_windows, report[1]))
        cols = list(zip(*out)) if out else [()] * 6
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                         names=["row", "item", "size", "n_matched", "n_windows", "copy"])


def contaminated_pairs(docs: DataFrame, items: DataFrame, doc_key: str = "doc_id", item_key: str = "item_id",
                       text: str = "text") -> DataFrame:
    """(doc_key, item_key, n_matched, n_windows, kind) for every document that
    holds a benchmark item; kind: copy or reparameterised."""
    bench = written(benchmark_windows(items, item_key, text), "bench-windows")
    sizes = sorted(r["size"] for r in bench.select("size").distinct().collect())
    distinct = bench.select("window").distinct()
    n = distinct.count()
    wanted = pairs = None
    if n <= BROADCAST_WINDOWS:              # then the pairs, at most four a word, are bounded too
        pairs = benchmark_pairs(items, text)
        wanted = np.sort(distinct.toArrow().column("window").to_numpy().astype(np.int64).view(np.uint64))
    src = docs.select(F.col(doc_key).cast("bigint").alias("row"), F.col(text).cast("string").alias("text")) \
        .withColumn("text_id", F.xxhash64("text"))
    found = written(document_windows(src, sizes, wanted, pairs), "doc-windows")
    b = bench.select("item", "window", F.col("pos").alias("item_pos"), F.col("slots").alias("item_slots"),
                     F.col("renamed").alias("item_renamed"), "size", "n_windows")
    both = found.join(sized_broadcast(b, n, 200_000), "window")
    d = both.select("row", "text_id", "item", "size", "item_pos", "n_windows", (F.col("pos") - F.col("item_pos")).alias("shift"),
                    F.arrays_zip("item_slots", "slots").alias("pairs"),
                    (F.col("renamed") | F.col("item_renamed")).alias("renamed"))
    groups = d.groupBy("row", "text_id", "item", "size").agg(
        F.max("n_windows").alias("n_windows"),
        F.collect_list(F.struct("shift", "item_pos", "pairs", "renamed")).alias("matches"))
    kept = groups.mapInArrow(releasing(_judged), "row bigint, item bigint, size int, n_matched bigint, n_windows bigint, copy boolean")
    return kept.groupBy("row", "item").agg(
        F.max_by(F.struct("n_matched", "n_windows"), F.struct("size", "n_matched")).alias("m"),
        F.when(F.bool_or("copy"), "copy").otherwise("reparameterised").alias("kind")) \
        .select("row", "item", "m.n_matched", "m.n_windows", "kind") \
        .withColumnsRenamed({"row": doc_key, "item": item_key})


def remove_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                        item_key: str = "item_id") -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item.  Rows are
    told apart by a hash of key and text, not by the key alone."""
    mark = fresh([*docs.columns, *items.columns], "_mark")
    marked = docs.withColumn(mark, F.xxhash64(F.col(key), F.col(text)))
    found = contaminated_pairs(marked.select(mark, text), items, mark, item_key, text)
    bad = written(found.select(mark).distinct(), "contaminated")
    return marked.join(sized_broadcast(bad, bad.count()), mark, "left_anti").select(*docs.columns)
