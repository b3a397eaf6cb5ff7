"""Conversation structure repair as an integer-cost shortest path, solved by the
auction algorithm.

Rows of a conversation are kept, given another role, deleted, or joined by
inserted empty rows, at least total cost, so that the role initials read
``(s?(ua)+)?``.  The lattice has one layer per row and one node per layer and state
(start, after system, after user, after assistant); an arc takes one row, after
up to two insertions.  Costs: keep 0, rerole 1, delete 2, insert 5; a truncated row
that stays adds 5; blank and duplicate rows must go.

The auction algorithm holds a path from the origin and a price per node with
``price(i) <= cost(i, j) + price(j)`` on every arc.  The last node of the path either
raises its price to its cheapest arc and leaves the path (contraction), or takes that
arc (extension).  Prices start at the least cost of the rows still to come.  On
arrival the origin's price is the least cost, every cheapest path has tight arcs only,
and of those the trace takes the least label at each node.  The labels of one node's
arcs end with the letter that takes the row, so none is a prefix of another and the
trace gives the ASCII-least audit.

A conversation of any length is split: rows are range-partitioned and sorted by
conversation and turn, so that a long one lies in several partitions.  A conversation
inside one partition is solved there.  A piece of one that crosses partitions gives
its 4 x 4 least costs and the order of their audits (groups of rows are merged by the
same algorithm); pieces are chained over those narrow rows, then rendered.

Defined results: a null role or text counts as one space, in the damage key a null
conversation or turn too; a null conversation is one conversation; rows of equal turn
are ordered by role, then by the SHA-256 of their text; a role's initial is its first
character, and a role without one, or with another initial than s, u or a, can only be
given a new role or deleted; repeated rows count as duplicates.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_SPACE, WORD_SPACE_CLASS, written

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = 0, 1, 2, 3
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: The state after an inserted or reroled row.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: The state after a kept row, by state and initial.
FOLLOW = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
GONE = 0                    # kind of a row that must be deleted; others: 1 + 2 * initial + truncated
INITIALS = "sua?"
GROUP = 32                  # layers solved at once; longer runs are merged in groups
NEVER = 1 << 60             # price of a node that cannot reach the destination


def _openings(state: int) -> list[tuple[str, int, int]]:
    """(label, cost, state) of the insertions before a row, each state once."""
    out, seen, label, cost = [], set(), "", 0
    while state not in seen:
        seen.add(state)
        out.append((label, cost, state))
        label, cost, state = label + "I", cost + INSERT, NEXT[state]
    return out


def _row_arcs(kind: int) -> list[list[tuple[str, int, int]]]:
    """Per state the arcs (label, cost, next state) over a row of this kind."""
    initial, extra = INITIALS[(kind - 1) // 2], TRUNCATED * ((kind - 1) % 2)
    table = []
    for state in range(4):
        arcs = []
        for label, cost, at in _openings(state):
            arcs.append((label + "D", cost + DELETE, at))
            if kind != GONE:
                arcs.append((label + "R", cost + REROLE + extra, NEXT[at]))
                if (at, initial) in FOLLOW:
                    arcs.append((label + "K", cost + KEEP + extra, FOLLOW[at, initial]))
        table.append(arcs)
    return table


ROW_ARCS = [_row_arcs(kind) for kind in range(9)]
#: After the last row: insertions that end the conversation.
CLOSING = [[next((label, cost, START) for label, cost, at in _openings(s) if at in (START, ASSISTANT))]
           for s in range(4)]


def auction(layers: list, origins: list[int], destination: int) -> dict[int, tuple[int, str]]:
    """origin: (least cost, least label of the cheapest paths) from each origin
    to the destination's state behind the last layer; unreachable ones are left
    out.  Prices are kept from one origin to the next."""
    n = len(layers)
    price = [[0] * 4 for _ in range(n + 1)]
    price[n] = [0 if s == destination else NEVER for s in range(4)]
    rest = 0
    for i in range(n - 1, -1, -1):
        rest += min(cost for arcs in layers[i] for _, cost, _ in arcs)
        price[i] = [rest] * 4
    out = {}
    for origin in origins:
        path = [origin]
        while len(path) <= n:
            i, state = len(path) - 1, path[-1]
            ahead, best, to = price[i + 1], NEVER, START
            for _, cost, nxt in layers[i][state]:
                if cost + ahead[nxt] < best:
                    best, to = cost + ahead[nxt], nxt
            if price[i][state] < best:              # contraction
                price[i][state] = best
                if i:
                    path.pop()
                elif best >= NEVER:
                    break
            elif best >= NEVER:
                if not i:
                    break
                path.pop()
            else:                                   # extension
                path.append(to)
        if len(path) == n + 1:
            out[origin] = price[0][origin], _trace(layers, price, origin, destination)
    return out


def _trace(layers: list, price: list, origin: int, destination: int) -> str:
    """The least label over tight arcs from ``origin`` to the destination."""
    n = len(layers)
    alive = [set() for _ in range(n)] + [{destination}]
    for i in range(n - 1, -1, -1):
        for state in range(4):
            if any(price[i][state] == cost + price[i + 1][nxt] and nxt in alive[i + 1]
                   for _, cost, nxt in layers[i][state]):
                alive[i].add(state)
    labels, state = [], origin
    for i in range(n):
        label, state = min((label, nxt) for label, cost, nxt in layers[i][state]
                           if price[i][state] == cost + price[i + 1][nxt] and nxt in alive[i + 1])
        labels.append(label)
    return "".join(labels)


def _merged(layers: list) -> list[list[tuple[str, int, int]]]:
    """One layer that stands for all of ``layers``: the best arc between each two states."""
    table = [[] for _ in range(4)]
    for destination in range(4):
        for origin, (cost, label) in auction(layers, [0, 1, 2, 3], destination).items():
            table[origin].append((label, cost, destination))
    return table


@lru_cache(maxsize=1 << 14)
def _group(kinds: bytes) -> list:
    return _merged([ROW_ARCS[k] for k in kinds])


def layers_of(kinds: bytes) -> list:
    """At most ``GROUP`` layers that stand for the rows."""
    if len(kinds) <= GROUP:
        return [ROW_ARCS[k] for k in kinds]
    layers = [_group(kinds[i:i + GROUP]) for i in range(0, len(kinds), GROUP)]
    while len(layers) > GROUP:
        layers = [_merged(layers[i:i + GROUP]) for i in range(0, len(layers), GROUP)]
    return layers


@lru_cache(maxsize=1 << 14)
def _solve_short(kinds: bytes) -> tuple[int, str]:
    return auction([ROW_ARCS[k] for k in kinds] + [CLOSING], [START], START)[START]


def solve(kinds: bytes) -> tuple[int, str]:
    """(cost, audit) of a whole conversation."""
    if len(kinds) <= GROUP:
        return _solve_short(kinds)
    return auction(layers_of(kinds) + [CLOSING], [START], START)[START]


def repaired_lines(state: int, audit: str, rows) -> Iterator[str]:
    """``role:text`` of the repaired rows, from the state before them."""
    at = 0
    for letter in audit:
        if letter == "K":
            role, text = rows[at]
            state = FOLLOW[state, role[0]]
            yield f"{role}:{text}"
        elif letter != "D":
            state = NEXT[state]
            yield f"{NAMES[state]}:{rows[at][1] if letter == 'R' else ''}"
        if letter != "I":
            at += 1


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """(conv, turn, role, text) after the damage that the CRC-32 of the row's key prescribes."""
    def plain(column: Column) -> Column:
        return F.coalesce(column.cast("string"), F.lit(" "))

    d = rows.select(F.col(conv).alias("conv"), F.col(turn).cast("bigint").alias("turn"),
                    plain(F.col(role)).alias("role"), plain(F.col(text)).alias("text"),
                    (F.crc32(F.concat(plain(F.col(conv)), F.lit(":"), plain(F.col(turn)))) % 20).alias("k"))
    d = d.where("k <> 0").withColumn("text", F.when(F.col("k") == 1, "").when(
        F.col("k") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    d = d.withColumn("role", F.when(F.col("k") == 4, "user").otherwise(F.col("role")))
    copies = F.when(F.col("k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return d.withColumn("copy", F.explode(copies)).select("conv", "turn", "role", "text")


def faulted(rows: DataFrame) -> DataFrame:
    """The rows with ``fault`` (0 none, 1 blank, 2 duplicate, 3 truncated), the
    digest of the text and a number ``uid`` that orders equal rows."""
    d = written(rows.withColumn("uid", F.monotonically_increasing_id()).withColumn("digest", F.sha2("text", 256)),
                "repair-rows")
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "uid")
    first = written(d.groupBy("conv", "role", "digest").agg(
        F.count(F.lit(1)).alias("m"), F.min(order).alias("o")).where("m > 1").select(
        F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("g"), F.col("o.uid").alias("head")),
        "repair-first")
    same = d.conv.eqNullSafe(first.c) & (d.role == first.r) & (d.digest == first.g)
    last = F.substring(F.rtrim("text", F.lit(WORD_SPACE)), -1, 1)
    fault = F.when(~F.col("text").rlike(WORD_SPACE_CLASS.replace("[", "[^")), 1) \
        .when(F.col("head").isNotNull() & (F.col("head") != F.col("uid")), 2) \
        .when(~last.isin(".", "!", "?"), 3).otherwise(0)
    return d.join(first, same, "left").withColumn("fault", fault).select(*d.columns, "fault")


def _kind(initial: str, fault: int) -> int:
    if fault in (1, 2):
        return GONE
    return 1 + 2 * max(0, INITIALS.find(initial) if initial and initial in "sua" else 3) + (fault == 3)


def _illegal(a: str, b: str) -> bool:
    return a + b not in ("su", "ua", "au")


_COUNTS = ["blank", "duplicate", "truncated", "illegal", "cost"]
_PIECE = ("piece int, open boolean, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
          "cost bigint, audit string, repaired_sha256 string, turns bigint, low bigint, high bigint, head string, "
          "tail string, kinds binary, costs array<bigint>, ranks array<int>, roles array<string>, texts array<string>")


def _describe_run(rows: list[tuple], open_run: bool) -> dict:
    """One conversation's rows of a partition: solved, or with what the chain needs."""
    initials = [role[:1] for _, role, _, _ in rows]
    faults = [fault for _, _, _, fault in rows]
    known = [t for t, *_ in rows if t is not None]
    distinct = sum(1 for i, t in enumerate(known) if not i or t != known[i - 1])
    kinds = bytes(_kind(i, f) for i, f in zip(initials, faults))
    out = {"open": open_run, "blank": faults.count(1), "duplicate": faults.count(2), "truncated": faults.count(3),
           "illegal": sum(map(_illegal, initials, initials[1:])), "turns": distinct,
           "low": known[0] if known else None, "high": known[-1] if known else None,
           "head": initials[0], "tail": initials[-1]}
    if not open_run:
        cost, audit = solve(kinds)
        lines = "\n".join(repaired_lines(START, audit, [(r, t) for _, r, t, _ in rows]))
        return out | {"cost": cost, "audit": audit, "gaps": known[-1] - known[0] + 1 - distinct if known else 0,
                      "repaired_sha256": hashlib.sha256(lines.encode("utf-8", "surrogatepass")).hexdigest()}
    costs, ranks = [-1] * 16, [0] * 16
    for state, arcs in enumerate(_merged(layers_of(kinds))):
        for rank, (_, cost, to) in enumerate(sorted(arcs)):
            costs[4 * state + to], ranks[4 * state + to] = cost, rank
    return out | {"kinds": kinds, "costs": costs, "ranks": ranks, "roles": [r for _, r, _, _ in rows],
                  "texts": [t for _, _, t, _ in rows]}


def _pieces(rows: DataFrame, partitions: int | None) -> DataFrame:
    """One row per conversation and partition."""
    kind = rows.schema["conv"].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    schema = StructType.fromDDL(f"conv {kind}, {_PIECE}")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = TaskContext.get().partitionId()
        out, held, now, first, size = [], [], None, True, 0

        def flush():
            columns = {f.name: [r.get(f.name) for r in out] for f in arrow}
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in arrow], schema=arrow)

        for batch in batches:
            for conv, turn, role, text, fault in zip(*(c.to_pylist() for c in batch.columns)):
                if held and conv != now:
                    out.append({"conv": now, "piece": piece} | _describe_run(held, first))
                    first, held = False, []
                    if len(out) >= 4096:
                        yield flush()
                now = conv
                held.append((turn, role, text, fault))
        if held:                                    # the last run may go on in the next partition
            out.append({"conv": now, "piece": piece} | _describe_run(held, True))
        if out:
            yield flush()

    keys = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), "role", "digest", "uid"]
    ranged = rows.repartitionByRange(partitions, *keys) if partitions else rows.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys).select("conv", "turn", "role", "text", "fault").mapInArrow(run, schema)


def _chain(pieces: pd.DataFrame) -> pd.DataFrame:
    """Entry and exit states of the pieces of one conversation, and its counts.
    Rows are narrow, one per partition that the conversation touches."""
    pieces = pieces.sort_values("piece")
    tables = [[[(chr(65 + r[4 * s + t]), c[4 * s + t], t) for t in range(4) if c[4 * s + t] >= 0] for s in range(4)]
              for c, r in zip(pieces["costs"], pieces["ranks"])]
    # one character, the order of the audits of one piece and state, stands for the audit
    cost, ranks = _chained(tables)
    entries, exits, state = [], [], START
    for table, rank in zip(tables, ranks):
        to = next(t for label, _, t in table[state] if label == rank)
        entries.append(state)
        exits.append(to)
        state = to
    heads, tails = list(pieces["head"]), list(pieces["tail"])
    lows = [None if pd.isna(x) else int(x) for x in pieces["low"]]
    highs = [None if pd.isna(x) else int(x) for x in pieces["high"]]
    known_low = [x for x in lows if x is not None]
    turns = int(pieces["turns"].sum()) - sum(a is not None and a == b for a, b in zip(highs, lows[1:]))
    gaps = max(x for x in highs if x is not None) - min(known_low) + 1 - turns if known_low else 0
    illegal = int(pieces["illegal"].sum()) + sum(map(_illegal, tails, heads[1:]))
    out = pieces[["conv", "piece"]].copy()
    out["entry"], out["exit"] = entries, exits
    out["final"] = [False] * (len(out) - 1) + [True]
    out["gaps"], out["illegal"], out["cost"] = gaps, illegal, cost
    for name in ("blank", "duplicate", "truncated"):
        out[name] = int(pieces[name].sum())
    return out


def _chained(tables: list) -> tuple[int, str]:
    """Cost and one label per layer of the best chain."""
    closing = [[("", cost, to) for _, cost, to in arcs] for arcs in CLOSING]
    layers = tables
    while len(layers) > GROUP:
        layers = [_merged(layers[i:i + GROUP]) for i in range(0, len(layers), GROUP)]
    return auction(layers + [closing], [START], START)[START]


def _rendered(pieces: DataFrame, chain: DataFrame) -> DataFrame:
    """(conv, piece, audit, lines, counts) of the pieces of crossing conversations."""
    kind = pieces.schema["conv"].dataType.simpleString()
    counts = ["gaps", *_COUNTS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part = batch.slice(row, 1)
                kinds, roles, texts, entry, to, final = (part.column(i)[0].as_py() for i in range(2, 8))
                audit = auction(layers_of(kinds), [entry], to)[entry][1]
                audit += CLOSING[to][0][0] if final else ""
                lines = list(repaired_lines(entry, audit, list(zip(roles, texts))))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([audit]), pa.array([lines], pa.list_(pa.string())),
                     *(part.column(8 + i) for i in range(len(counts)))],
                    names=["conv", "piece", "audit", "lines", *counts])

    c = chain.select(F.col("conv").alias("c"), F.col("piece").alias("p"), "entry", "exit", "final", *counts)
    both = pieces.where("open").select("conv", "piece", "kinds", "roles", "texts").join(
        c, F.col("conv").eqNullSafe(F.col("c")) & (F.col("piece") == F.col("p")))
    return both.select("conv", "piece", "kinds", "roles", "texts", "entry", "exit", "final", *counts).mapInArrow(
        run, f"conv {kind}, piece int, audit string, lines array<string>, " + ", ".join(f"{x} bigint" for x in counts))


def _digested(rendered: DataFrame) -> DataFrame:
    """One row per conversation: its pieces' lines run through one SHA-256 in order."""
    kind = rendered.schema["conv"].dataType.simpleString()
    counts = ["gaps", *_COUNTS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, any_line, audit, tail = None, None, False, [], None

        def done():
            return pa.RecordBatch.from_arrays(
                [tail.column(0), pa.array(["".join(audit)]), pa.array([digest.hexdigest()]),
                 *(tail.column(4 + i) for i in range(len(counts)))],
                names=["conv", "audit", "repaired_sha256", *counts])

        for batch in batches:
            for row in range(batch.num_rows):
                part = batch.slice(row, 1)
                conv = part.column(0)[0].as_py()
                if digest is None or conv != now:
                    if digest is not None:
                        yield done()
                    now, digest, any_line, audit = conv, hashlib.sha256(), False, []
                tail = part
                audit.append(part.column(2)[0].as_py())
                for line in part.column(3)[0].as_py():
                    digest.update((("\n" if any_line else "") + line).encode("utf-8", "surrogatepass"))
                    any_line = True
        if digest is not None:
            yield done()

    return rendered.repartition("conv").sortWithinPartitions("conv", "piece").mapInArrow(
        run, f"conv {kind}, audit string, repaired_sha256 string, " + ", ".join(f"{x} bigint" for x in counts))


def repair(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """Per conversation of ``rows`` (conv, turn, role, text): gaps, faults, cost, audit
    and digest of the repaired rows."""
    pieces = written(_pieces(faulted(rows), partitions), "repair-pieces")
    columns = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    kind = pieces.schema["conv"].dataType.simpleString()
    narrow = pieces.where("open").drop("roles", "texts", "kinds", "audit", "repaired_sha256", "cost", "gaps", "open")
    chain = written(narrow.groupBy("conv").applyInPandas(
        _chain, f"conv {kind}, piece int, entry int, exit int, final boolean, gaps bigint, illegal bigint, cost bigint, "
                "blank bigint, duplicate bigint, truncated bigint"), "repair-chain")
    crossing = _digested(_rendered(pieces, chain))
    return pieces.where("NOT open").select(*columns).unionByName(crossing.select(*columns))


def damage_and_repair(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """The repair report of every conversation id, those without rows after damage included."""
    found = written(repair(damaged(rows), partitions), "repair-report")
    ids = rows.select(F.col("conv_id").alias("id")).distinct()
    both = ids.join(found, ids.id.eqNullSafe(found.conv), "left")
    zero = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
            for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return both.select(F.col("id").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
