"""Repair of a conversation's structure: the cheapest edits that make its roles read (s?(ua)+)?.

States are what has been read so far: nothing, a system turn, a user turn, an assistant turn. A turn is a 4 x 4
matrix whose element (i, j) is the least (cost, audit) of the edits that lead from i to j, turns inserted before it
included (the insert closure). Matrices multiply in the (min, +) semiring of such pairs, least cost first, then the
audit that comes first in ASCII. The product is associative, so the turns of a block, the blocks of a partition and
the partitions of a conversation are multiplied as a tree, and the states between them found on the way back.

Audits needn't travel: a matrix holds costs and, in each row, the order of its audits. Two audits of one row and of
equal cost are never one the beginning of the other (each ends with the edit of the last turn, and letters fix the
states), so their order decides wherever they are continued. Matrices have a fixed size for any number of turns.

Rows are range-sorted by conversation and turn, equal rows counted once with their number. What an Arrow batch holds
of a conversation is a block; most conversations are one block and are done on the spot.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import partitions, sized_join, small_batches, stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Partitions of a conversation that are multiplied in one task.
FAN = 64
FAR = 1 << 40
START, SYSTEM, USER, ASSISTANT = range(4)
CLASSES = {"s": 0, "u": 1, "a": 2}
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_SPELLED = {USER: "user", ASSISTANT: "assistant"}
_FOLLOWS = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (ASSISTANT, 1): USER, (USER, 2): ASSISTANT}
#: Role initials that may stand next to each other, by class.
_LEGAL = np.zeros((4, 4), bool)
_LEGAL[[0, 1, 2], [1, 2, 1]] = True

Element = tuple[int, str]


def _closure() -> dict[tuple[int, int], Element]:
    """The least (cost, audit) of inserts alone between states."""
    found = {}
    for i in range(4):
        at, element = i, (0, "")
        while (i, at) not in found:
            found[i, at] = element
            at, element = _NEXT[at], (element[0] + INSERT, element[1] + "I")
    return found


CLOSURE = _closure()


def _matrix(role: int, truncated: bool, delete: bool) -> dict[tuple[int, int], Element]:
    edits: list[tuple[int, int, Element]] = [(i, i, (DELETE, "D")) for i in range(4)]
    if not delete:
        more = TRUNCATED if truncated else 0
        edits += [(i, _FOLLOWS[i, role], (KEEP + more, "K")) for i in range(4) if (i, role) in _FOLLOWS]
        edits += [(i, _NEXT[i], (REROLE + more, "R")) for i in range(4)]
    found: dict[tuple[int, int], Element] = {}
    for (i, k), (cost, audit) in CLOSURE.items():
        for a, j, (c, letter) in edits:
            if a == k:
                found[i, j] = min(found.get((i, j), (FAR, "")), (cost + c, audit + letter))
    return found


#: Matrices by kind: 2 * class + truncated for turns that may stay, GONE for those that must go.
GONE = 8
_KINDS = [_matrix(c, t, False) for c in range(4) for t in (False, True)] + [_matrix(3, False, True)]
COST = np.full((9, 4, 4), FAR)
RANK = np.zeros((9, 4, 4), np.int64)
for _kind, _m in enumerate(_KINDS):
    for _i in range(4):
        _row = sorted((audit, j) for (i, j), (_, audit) in _m.items() if i == _i)
        for _at, (_, _j) in enumerate(_row):
            COST[_kind, _i, _j], RANK[_kind, _i, _j] = _m[_i, _j][0], _at
IDENTITY = np.where(np.eye(4, dtype=bool), 0, FAR)


def times(a: np.ndarray, ra: np.ndarray, b: np.ndarray, rb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Costs and ranks of the products of (n, 4, 4) matrices."""
    key = (a[:, :, :, None] + b[:, None]) * 16 + ra[:, :, :, None] * 4 + rb[:, None]
    least = key.min(axis=2)
    return np.minimum(least >> 4, FAR), (least & 15).argsort(axis=2, kind="stable").argsort(axis=2, kind="stable")


def middle(a: np.ndarray, ra: np.ndarray, b: np.ndarray, rb: np.ndarray, entry: np.ndarray, exit_: np.ndarray) -> np.ndarray:
    """The states between pairs of matrices, on the best way from entry to exit."""
    n = np.arange(len(a))
    key = (a[n, entry] + b[n, :, exit_]) * 16 + ra[n, entry] * 4 + rb[n, :, exit_]
    return key.argmin(axis=1)


class Tree:
    """Products of the matrices of each run (equal neighbours in `run`), and the states on the way back."""

    def __init__(self, cost: np.ndarray, rank: np.ndarray, run: np.ndarray):
        self.levels = []
        while len(run) and (run[1:] == run[:-1]).any():
            first = np.r_[True, run[1:] != run[:-1]]
            starts = np.flatnonzero(first)
            at = np.arange(len(run)) - starts[np.cumsum(first) - 1]
            left = np.flatnonzero(at % 2 == 0)
            paired = np.r_[run[1:] == run[:-1], False][left]
            self.levels.append((cost, rank, left, paired))
            some = left[paired]
            up, up_rank = cost[left], rank[left]
            up[paired], up_rank[paired] = times(cost[some], rank[some], cost[some + 1], rank[some + 1])
            cost, rank, run = up, up_rank, run[left]
        self.cost, self.rank, self.run = cost, rank, run

    def states(self, entry: np.ndarray, exit_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and exit of every matrix, from those of the runs."""
        for cost, rank, left, paired in reversed(self.levels):
            some = left[paired]
            between = middle(cost[some], rank[some], cost[some + 1], rank[some + 1], entry[paired], exit_[paired])
            below, above = np.zeros(len(cost), np.int64), np.zeros(len(cost), np.int64)
            below[left], above[left] = entry, exit_
            above[some], below[some + 1], above[some + 1] = between, between, exit_[paired]
            entry, exit_ = below, above
        return entry, exit_


def ending(cost: np.ndarray, rank: np.ndarray) -> tuple[int, int, int]:
    """(cost, state, turns to insert behind) of the best end for a product: nothing at all, or an assistant's turn."""
    found = []
    for (j, end), (more, audit) in CLOSURE.items():
        if end in (START, ASSISTANT) and cost[START, j] < FAR:
            found.append((int(cost[START, j]) + more, int(rank[START, j]), len(audit), j))
    total, _, tail, state = min(found)
    return total, state, tail


class Summary(NamedTuple):
    """What a stretch of a conversation adds up to; first and last are classes of roles, -1 if it has no turns."""

    blank: int
    duplicate: int
    truncated: int
    illegal: int
    first: int
    last: int
    low: int | None
    high: int | None
    turns: int

    def then(self, other: Summary) -> Summary:
        met = self.last >= 0 and other.first >= 0 and not _LEGAL[self.last, other.first]
        same = self.high is not None and self.high == other.low
        return Summary(
            self.blank + other.blank, self.duplicate + other.duplicate, self.truncated + other.truncated, self.illegal + other.illegal + met,
            self.first if self.first >= 0 else other.first, other.last if other.last >= 0 else self.last,
            other.low if self.low is None else self.low, self.high if other.high is None else other.high, self.turns + other.turns - same,
        )


_SUMMARY = "blank long, duplicate long, truncated long, illegal long, first int, last int, low long, high long, turns long"
_MATRIX = "cost array<long>, rank array<long>"
_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal"]
_ROWS = "roles array<string>, texts array<string>, faults array<byte>, copies array<long>"
OK, SHORT, REPEAT, BLANK = range(4)


def _lists(values: np.ndarray) -> pa.Array:
    """(n, 4, 4) as lists of 16."""
    return pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, 16), pa.int32()), pa.array(values.reshape(-1), pa.int64()))


def _stack(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.array(column.to_pylist(), np.int64).reshape(-1, 4, 4)


def _class(roles: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.array([CLASSES.get(r[:1], 3) for r in roles.to_pylist()], np.int64)


def _elements(role: np.ndarray, fault: np.ndarray, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, kind, number) of a matrix for each row that is there, and of one more for copies that must go."""
    behind = (fault < REPEAT) & (copies > 1)
    row = np.repeat(np.arange(len(role)), (copies > 0).astype(int) + behind)
    second = np.r_[False, row[1:] == row[:-1]] if len(row) else np.zeros(0, bool)
    gone = second | (fault[row] >= REPEAT)
    return row, np.where(gone, GONE, 2 * role[row] + (fault[row] == SHORT)), np.where(gone, copies[row] - second, 1)


def _matrices(kind: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    # number deletions in a row: inserts stand before the last of them, "D" being less than "I"
    return np.minimum(COST[kind] + DELETE * (number - 1)[:, None, None], FAR), RANK[kind]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, block = TaskContext.get().partitionId(), 0
    for b in batches:
        if not b.num_rows:
            continue
        key = b["key"].dictionary_encode().indices.to_numpy()
        first = np.r_[True, key[1:] != key[:-1]]
        run, starts = np.cumsum(first) - 1, np.flatnonzero(first)
        n = len(starts)
        copies, fault = b["copies"].to_numpy(), b["fault"].to_numpy(zero_copy_only=False).astype(np.int64)
        role = _class(b["role"])
        row, kind, number = _elements(role, fault, copies)
        tree = Tree(*_matrices(kind, number), run[row])
        cost, rank = np.broadcast_to(IDENTITY, (n, 4, 4)).copy(), np.zeros((n, 4, 4), np.int64)
        cost[tree.run], rank[tree.run] = tree.cost, tree.rank

        count = lambda at, weight: np.bincount(run[at], weight[at], minlength=n).astype(np.int64)  # noqa: E731, B023
        there = copies > 0
        more = np.where(fault < REPEAT, np.maximum(copies - 1, 0), 0)
        live = np.flatnonzero(there)
        a, z = live[:-1], live[1:]
        bad = (run[a] == run[z]) & ~_LEGAL[role[a], role[z]]
        head, last = np.full(n, -1), np.full(n, -1)
        head[run[live[::-1]]], last[run[live]] = role[live[::-1]], role[live]
        known = live[b["turn"].is_valid().to_numpy(zero_copy_only=False)[live]]
        turn = b["turn"].fill_null(0).to_numpy()
        low, high = np.zeros(n, np.int64), np.zeros(n, np.int64)
        low[run[known[::-1]]], high[run[known]] = turn[known[::-1]], turn[known]
        fresh = np.r_[True, (turn[known[1:]] != turn[known[:-1]]) | (run[known[1:]] != run[known[:-1]])][: len(known)]
        turns = np.bincount(run[known[fresh]], minlength=n)
        none = turns == 0
        offsets = pa.array(np.r_[starts, b.num_rows], pa.int32())
        nested = lambda x: pa.ListArray.from_arrays(offsets, x)  # noqa: E731, B023
        columns = {
            "conv": b["conv"].take(pa.array(starts)), "key": b["key"].take(pa.array(starts)), "part": np.full(n, part, np.int32), "block": np.arange(block, block + n),
            "roles": nested(b["role"]), "texts": nested(b["text"]), "faults": nested(b["fault"]), "copies": nested(b["copies"]), "cost": _lists(cost), "rank": _lists(rank),
            "blank": count(fault == BLANK, copies), "duplicate": count(fault == REPEAT, copies) + count(there, more), "truncated": count(there & (fault == SHORT), np.ones(len(copies))),
            "illegal": np.bincount(run[a[bad]], minlength=n) + count(there, np.maximum(copies - 1, 0)), "first": head.astype(np.int32), "last": last.astype(np.int32),
            "low": pa.array(low, mask=none), "high": pa.array(high, mask=none), "turns": turns,
        }
        block += n
        yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns.values()], names=list(columns))


def _walk(entry: int, audit: str) -> Iterator[tuple[str, str | None]]:
    """(letter, role) of each edit: the role that a turn gets, None where it keeps its own or goes."""
    at = entry
    for letter in audit:
        if letter in "IR":
            at = _NEXT[at]
            yield letter, _SPELLED[at]
        else:
            yield letter, None


#: By kind, entry and exit: the audit, and the roles of the turns inserted and of the turn itself.
_EDITS = {(kind, i, j): (audit, [r for x, r in _walk(i, audit) if x == "I"], [(x, r) for x, r in _walk(i, audit) if x != "I"][0]) for kind, m in enumerate(_KINDS) for (i, j), (_, audit) in m.items()}


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """least, audit, roles, texts and digest of blocks with entry, exit and tail, or of whole conversations where these are null."""
    kept = ["conv", "key", "part", "block", *_COUNTS]
    for b in batches:
        found: dict[str, list] = {k: [] for k in ("least", "audit", "roles", "texts", "digest")}
        products, ranks = _stack(b["cost"]), _stack(b["rank"])
        columns = (b[k].to_pylist() for k in ("roles", "texts", "faults", "copies", "entry", "exit", "tail"))
        blocks = []
        for at, (roles, texts, faults, copies, entry, exit_, tail) in enumerate(zip(*columns)):
            total = None
            if entry is None:
                (total, exit_, tail), entry = ending(products[at], ranks[at]), START
            blocks.append((roles, texts, faults, copies, entry, exit_, tail, total))
        flat = lambda k: np.array([x for block in blocks for x in block[k]], np.int64)  # noqa: E731, B023
        role = _class(pa.array([r for block in blocks for r in block[0]], pa.string()))
        row, kind, number = _elements(role, flat(2), flat(3))
        of = np.repeat(np.arange(len(blocks)), [len(block[0]) for block in blocks])
        tree = Tree(*_matrices(kind, number), of[row])
        ends = np.array([block[4:6] for block in blocks], np.int64).reshape(-1, 2)[tree.run]
        entries, exits = tree.states(ends[:, 0], ends[:, 1])
        edits: list[list] = [[] for _ in blocks]
        base = np.r_[0, np.cumsum([len(block[0]) for block in blocks])]
        for r, k, m, i, j in zip(row.tolist(), kind.tolist(), number.tolist(), entries.tolist(), exits.tolist()):
            edits[of[r]].append((r - base[of[r]], k, m, i, j))
        for block, own in zip(blocks, edits):
            roles, texts, *_, exit_, tail, total = block
            audit, new_roles, new_texts = [], [], []
            for r, k, m, i, j in own:
                letters, inserted, (letter, role_) = _EDITS[k, i, j]
                audit.append("D" * (m - 1) + letters)
                new_roles += inserted
                new_texts += [""] * len(inserted)
                if letter != "D":
                    new_roles.append(role_ or roles[r])
                    new_texts.append(texts[r])
            behind = [r for _, r in _walk(exit_, "I" * tail)]
            audit.append("I" * tail)
            new_roles += behind
            new_texts += [""] * tail
            found["least"].append(total)
            found["audit"].append("".join(audit))
            found["roles"].append(new_roles)
            found["texts"].append(new_texts)
            found["digest"].append(None if total is None else hashlib.sha256("\n".join(f"{r}:{t}" for r, t in zip(new_roles, new_texts)).encode()).hexdigest())
        kinds = {"least": pa.int64(), "audit": pa.string(), "roles": pa.list_(pa.string()), "texts": pa.list_(pa.string()), "digest": pa.string()}
        yield pa.RecordBatch.from_arrays([*(b[k] for k in kept), *(pa.array(found[k], kind) for k, kind in kinds.items())], names=[*kept, *kinds])


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, audit, digest) of the conversations whose repaired blocks follow each other; the lines pass by one batch at a time."""
    rows = (row for b in batches for row in zip(*(b[k].to_pylist() for k in ("key", "audit", "roles", "texts"))))
    for key, blocks in groupby(rows, key=lambda row: row[0]):
        digest, started, audit = hashlib.sha256(), False, []
        for _, letters, roles, texts in blocks:
            audit.append(letters)
            for r, t in zip(roles, texts):
                digest.update(f"{chr(10) if started else ''}{r}:{t}".encode())
                started = True
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array(["".join(audit)]), pa.array([digest.hexdigest()])], names=["key", "audit", "digest"])


def _joined(table: pa.Table) -> pa.Table:
    """One node for the nodes (at, matrix, summary) of a parent."""
    table = table.sort_by("at")
    tree = Tree(_stack(table["cost"]), _stack(table["rank"]), np.zeros(table.num_rows, np.int64))
    fields = Summary._fields
    total, *others = (Summary(*x) for x in zip(*(table[k].to_pylist() for k in fields)))
    for x in others:
        total = total.then(x)
    kinds = dict.fromkeys(fields, pa.int64()) | {"first": pa.int32(), "last": pa.int32()}
    columns = {"key": table["key"][:1], "at": table["parent"][:1], "cost": _lists(tree.cost), "rank": _lists(tree.rank)} | {k: pa.array([v], kinds[k]) for k, v in total._asdict().items()}
    return pa.table(columns)


def _parted(table: pa.Table) -> pa.Table:
    """Entry, exit and tail of the nodes of a parent, from the parent's."""
    table = table.sort_by("at")
    tree = Tree(_stack(table["cost"]), _stack(table["rank"]), np.zeros(table.num_rows, np.int64))
    entry, exit_ = tree.states(*(np.array([table[k][0].as_py()], np.int64) for k in ("entry", "exit")))
    tail = [0] * (table.num_rows - 1) + [table["tail"][0].as_py()]
    return pa.table({"key": table["key"], "parent": table["parent"], "at": table["at"], "entry": pa.array(entry, pa.int32()), "exit": pa.array(exit_, pa.int32()), "tail": pa.array(tail, pa.int32())})


def _rooted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Roots with the cost of the whole, where it ends, and what is inserted behind."""
    for b in batches:
        found = [ending(c, r) for c, r in zip(_stack(b["cost"]), _stack(b["rank"]))]
        total, state, tail = zip(*found) if found else ((), (), ())
        more = {"least": pa.array(total, pa.int64()), "entry": pa.array([START] * len(found), pa.int32()), "exit": pa.array(state, pa.int32()), "tail": pa.array(tail, pa.int32())}
        yield pa.RecordBatch.from_arrays([*b.columns, *more.values()], names=[*b.schema.names, *more])


def _across(blocks: DataFrame, n: int, fan: int) -> tuple[DataFrame, DataFrame]:
    """(key, part, block, entry, exit, tail) of the blocks, and the roots of their conversations, from blocks (key, part, block, matrix, summary)."""
    names = ["cost", "rank", *Summary._fields]
    schema = f"key string, at long, {_MATRIX}, {_SUMMARY}"
    levels = [blocks.select("key", F.col("part").cast("long").alias("parent"), F.col("block").alias("at"), *names)]
    while True:
        level = stored(levels[-1].groupBy("key", "parent").applyInArrow(_joined, schema), "matrices")
        if n <= 1:
            break
        levels.append(level.select("key", F.floor(F.col("at") / fan).alias("parent"), "at", *names))
        n = -(-n // fan)
    roots = stored(level.mapInArrow(_rooted, f"{schema}, least long, entry int, exit int, tail int"), "matrices")
    states = roots.select("key", F.col("at").alias("parent"), "entry", "exit", "tail")
    for level in reversed(levels):
        below = level.select("key", "parent", "at", "cost", "rank").join(states, ["key", "parent"])
        found = below.groupBy("key", "parent").applyInArrow(_parted, "key string, parent long, at long, entry int, exit int, tail int")
        states = found.select("key", F.col("at").alias("parent"), "entry", "exit", "tail")
    return found.select("key", F.col("parent").cast("int").alias("part"), F.col("at").alias("block"), "entry", "exit", "tail"), roots


def faults(rows: DataFrame) -> DataFrame:
    """Rows (conv, key, turn, role, text, copies), equal ones once: with fault, the first of blank, duplicate and truncated."""
    rows = rows.groupBy("conv", "key", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    rows = rows.withColumns({"blank": ~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "digest": F.sha2("text", 256), "place": F.struct(F.col("turn").isNotNull().alias("known"), "turn")})
    said = rows.filter((F.col("copies") > 0) & ~F.col("blank")).groupBy("key", "role", "digest").agg(F.min("place").alias("before"), F.count("*").alias("times"))
    rows = sized_join(rows, said.filter("times > 1").drop("times"), ["key", "role", "digest"], "left")
    whole = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    fault = F.when(F.col("blank"), BLANK).when(F.col("place") > F.col("before"), REPEAT).when(whole, OK).otherwise(SHORT)
    return rows.select("conv", "key", "turn", "role", "text", "copies", fault.cast("byte").alias("fault"))


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: Column | None = None, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """The report on every conversation, and the repaired turns.

    Report: conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 (of the lines role:text).
    Turns: conv, part, block, place (which together give their order), role, text.

    Turns are taken in their order, nulls first; those of one number by role, then text, equal rows next to each
    other. copies says how often a row counts, 0 keeps the conversation alone. Null roles and texts are one space;
    null conversations are one. A conversation without turns costs nothing, its digest is that of no text. A text
    that repeats is a duplicate wherever it stood before. An empty table gives no rows. Other columns of the table,
    of any names, are left out.

    SHA-256 runs over a conversation's text in order: one that spans blocks is streamed through one task, batch by batch.
    """
    spark = turns.sparkSession
    small_batches(spark)
    n = partitions(spark)
    blank = lambda c: F.coalesce(turns[c].cast("string"), F.lit(" "))
    key = F.coalesce(F.concat(F.lit("+"), turns[conv].cast("string")), F.lit("-"))
    rows = turns.select(turns[conv].alias("conv"), key.alias("key"), turns[turn].cast("long").alias("turn"), blank(role).alias("role"), blank(text).alias("text"), (F.lit(1) if copies is None else copies).cast("long").alias("copies"))
    kind = rows.schema["conv"].dataType.simpleString()
    ranged = faults(rows).repartitionByRange(n, "key", "turn", "role", F.left("text", F.lit(64))).sortWithinPartitions("key", "turn", "role", "text")
    head = f"conv {kind}, key string, part int, block long"
    blocks = stored(ranged.mapInArrow(_blocks, f"{head}, {_ROWS}, {_MATRIX}, {_SUMMARY}"), "blocks")
    several = blocks.groupBy("key").count().filter("count > 1").select("key", F.lit(True).alias("several"))
    blocks = sized_join(blocks, several, "key", "left")
    lone, long = blocks.filter("several IS NULL"), blocks.filter("several")

    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    counts = [gaps, *_COUNTS[1:]]
    made = f"{head}, {', '.join(f'{c} long' for c in _COUNTS)}, least long, audit string, roles array<string>, texts array<string>, digest string"
    own = ["conv", "key", "part", "block", *counts, "roles", "texts", "faults", "copies", "cost", "rank"]
    whole = lone.select(*own, *[F.lit(None).cast("int").alias(k) for k in ("entry", "exit", "tail")]).mapInArrow(_repaired, made)
    states, roots = _across(long.select("key", "part", "block", "cost", "rank", *Summary._fields), n, fan)
    parts = stored(sized_join(long.select(*own), states, ["key", "part", "block"]).mapInArrow(_repaired, made), "blocks")
    streams = parts.repartition(n, "key").sortWithinPartitions("key", "part", "block").select("key", "audit", "roles", "texts")
    streamed = streams.mapInArrow(_streamed, "key string, audit string, digest string")

    convs = long.groupBy("key").agg(F.first("conv").alias("conv"))
    far = streamed.join(roots.select("key", "least", *counts), "key").join(convs, "key")
    out = ["conv", *_COUNTS, F.col("least").alias("cost"), "audit", F.col("digest").alias("repaired_sha256")]
    report = whole.select(*out).unionByName(far.select(*out))
    lines = whole.unionByName(parts).select("conv", "part", "block", F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "line"))
    return report, lines.select("conv", "part", "block", "place", F.col("line.roles").alias("role"), F.col("line.texts").alias("text"))


def damaged(turns: DataFrame) -> tuple[DataFrame, Column]:
    """conversations with the damage of the exercise done to text and role, and how often each row stands then."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    text = F.when(hit == 1, "").when(hit == 2, F.regexp_replace(part("text"), "[.!?]", "")).otherwise(part("text"))
    out = turns.select("conv_id", "turn", F.when(hit == 4, "user").otherwise(part("role")).alias("role"), text.alias("text"), hit.alias("hit"))
    return out, F.when(out["hit"] == 0, 0).when(out["hit"] == 3, 2).otherwise(1)
