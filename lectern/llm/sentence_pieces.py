"""SentencePiece encoding by a max-plus parallel scan, and decoding.

A text is cut into the vocabulary's pieces so that the sum of their scores is greatest. A giant document is
split into chunks. Each chunk gives a transfer matrix: the best score for every number of its first
characters that a piece from the chunk before has taken (the entry state), and every number of characters
that its last piece takes of the next (the exit state). Matrices combine associatively in the (max, +)
algebra: up a tree in which each task combines FAN of them, and down again to the states at all chunk
boundaries. Then each chunk is traced back on its own.

Scores are whole numbers, so sums are exact at any length: a piece of rank r in the vocabulary file scores
-round(SCALE * ln(r + 2)). A character that is no piece becomes its UTF-8 bytes' pieces, for UNKNOWN less than
the least score. Of equal sums the one whose last piece starts first wins, then the one whose last piece but one
does, and so on, as in the public library. So beside its scores a matrix holds, for each exit state, the order
of the entry states by this rule; it combines like the scores, and a text gets the same pieces in chunks of any size.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache, reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import release, small_batches, stored

SCALE, UNKNOWN = 256, 10
#: Characters in a chunk; longer documents are split.
CHUNK = 65_536
#: Matrices that one task combines.
FAN = 64
#: Distinct segments remembered in a process, each of at most SEGMENT characters.
REMEMBER, SEGMENT = 50_000, 48
#: Letters in the tables that many segments are looked up in at once.
COMMON = 288
BLANK = "▁"
_SEGMENTS = re.compile(f"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n+")
_LOW = -(2**60)
_NONE = -(2**30)  # the same for the short sums of one segment


def score_of(rank: int) -> int:
    return -round(SCALE * math.log(rank + 2))


class _Segments(dict):
    """Pieces of each segment seen: a run of blanks and what follows up to the next blank or line end, which no piece crosses."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces

    def __missing__(self, s: str) -> tuple[int, ...]:
        found = tuple(self.pieces.traced(s, self.pieces.forward(s, 0, len(s))[1], 0, len(s)))
        if len(s) <= SEGMENT:
            self[s] = found
        return found


class Pieces:
    """The vocabulary of a model file: ordinary pieces with ranks in file order, and one piece for each byte."""

    def __init__(self, model: bytes):
        m = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.names = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        self.bytes = {int(self.names[i][1:-1], 16): i for i in range(len(self.names)) if m.is_byte(i)}
        plain = [i for i in range(len(self.names)) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))]
        self.ids = {self.names[i]: i for i in plain}
        self.scores = {self.names[i]: score_of(rank) for rank, i in enumerate(plain)}
        self.longest = max(map(len, self.ids))
        self.unknown = min(self.scores.values()) - UNKNOWN
        self.by_byte = {i: b for b, i in self.bytes.items()}
        self.seen = _Segments(self)
        self.numbers = list(range(len(self.names)))  # one object for each id, however often it is remembered
        self.id_scores = [self.scores.get(name, 0) for name in self.names]
        # what each piece stands for in a text; bytes above ASCII as surrogates, until they are put together
        self.plain = [chr(b if b < 128 else 0xDC00 + b) if (b := self.by_byte.get(i)) is not None else name.replace(BLANK, " ") for i, name in enumerate(self.names)]
        self.tree: dict = {}  # letter by letter; "" holds the score of the piece that ends there
        for name, x in self.scores.items():
            node = self.tree
            for c in name:
                node = node.setdefault(c, {})
            node[""] = x
        self._tabulate()
        if any("\n" in p or BLANK in p.strip(BLANK) or p[-1:] == BLANK and p.strip(BLANK) for p in self.ids):
            raise ValueError("pieces that cross a blank or line end are not supported")

    def _tabulate(self) -> None:
        """The tree as arrays: next node by node and letter, and each node's score.

        The COMMON letters that most pieces have get a code each, the rest have none (0).
        """
        weight = Counter(c for name in self.scores for c in name)
        self.codes = np.zeros(0x110000, np.int32)
        for i, (c, _) in enumerate(((c, n) for c, n in weight.most_common(COMMON - 1) if c in self.scores), 1):
            self.codes[ord(c)] = i
        nodes, names, scores = [self.tree], [""], [_LOW]
        many = len({name[:i] for name in self.scores for i in range(len(name) + 1)}) + 1
        step, at = np.zeros((many, COMMON), np.uint16 if many < 65536 else np.int32), 0  # node 0 is dead, node 1 the root
        while at < len(nodes):
            row = step[at + 1]
            for c, node in nodes[at].items():
                if c and (code := self.codes[ord(c)]):
                    nodes.append(node)
                    names.append(names[at] + c)
                    scores.append(node.get("", _LOW))
                    row[code] = len(nodes)
            at += 1
        self.step = step.ravel()
        self.node_ids = np.array([0, *(self.ids.get(name, 0) for name in names)], np.int32)
        self.node_scores = np.maximum(np.array([_LOW, *scores]), _NONE).astype(np.int32)

    def learn(self, parts: Iterable[str]) -> None:
        """Best paths of many segments at once: the same steps as forward(), over a matrix of letters by segments."""
        if len(self.seen) >= REMEMBER:
            self.seen.clear()
        parts = sorted((p for p in set(parts).difference(self.seen) if len(p) <= SEGMENT), key=len, reverse=True)
        codes = self.codes[np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        fit = np.minimum.reduceat(codes, np.cumsum(sizes) - sizes) > 0 if parts else np.empty(0, bool)
        codes, sizes = codes[np.repeat(fit, sizes)], sizes[fit]
        parts = [p for p, ok in zip(parts, fit) if ok]
        for at in range(0, len(parts), 2048):
            some, size = parts[at : at + 2048], sizes[at : at + 2048]
            first = int(sizes[:at].sum())
            n, width = len(some), int(size[0])
            letters = np.zeros((n, width), np.int32)
            letters[np.arange(width) < size[:, None]] = codes[first : first + int(size.sum())]
            flat = np.concatenate((letters.T.ravel(), np.zeros(n * self.longest, np.int32)))
            place, node, levels = np.flatnonzero(flat), np.ones(1, np.int64), []
            for k in range(self.longest):
                node = self.step[node.astype(np.int64) * COMMON + flat[place + k * n]]
                place, node = place[node > 0], node[node > 0]
                found, nodes = np.full((width, n), _NONE, np.int32), np.zeros((width, n), np.uint32)
                found.ravel()[place], nodes.ravel()[place] = self.node_scores[node], node
                levels.append((found, (found > _NONE).any(1), nodes))
                if not len(place):
                    break
            best, back = np.full((width + 1, n), _NONE, np.int32), np.zeros((width + 1, n), np.int8)
            best[0] = 0
            for i in range(width):
                for k, (found, some_here, _) in enumerate(levels, 1):
                    if i + k <= width and some_here[i]:
                        reached = best[i] + found[i]
                        better = reached > best[i + k]
                        np.copyto(best[i + k], reached, where=better)
                        np.copyto(back[i + k], np.int8(k), where=better)
            nodes, row, end, steps = np.stack([x for _, _, x in levels]), np.arange(n), size, []
            while len(row):  # a piece of every segment that is not yet spelled, from its end
                k = back[end, row]
                end = end - k
                steps.append((row, self.node_ids[nodes[k - 1, end, row]]))
                row, end = row[end > 0], end[end > 0]
            row = np.concatenate([r for r, _ in reversed(steps)])
            ids = np.concatenate([x for _, x in reversed(steps)])[np.argsort(row, kind="stable")].tolist()
            ids = tuple(map(self.numbers.__getitem__, ids))
            upto = np.cumsum(np.bincount(row, minlength=n)).tolist()
            self.seen.update(zip(some, map(ids.__getitem__, map(slice, [0, *upto[:-1]], upto))))

    def encode_all(self, texts: list[str]) -> pa.Array:
        """Pieces of each of some marked texts of one chunk."""
        parts = [_SEGMENTS.findall(s) for s in texts]
        self.learn(chain.from_iterable(parts))
        ids, ends = array("i"), [0]
        for some in parts:
            ids.extend(chain.from_iterable(map(self.seen.__getitem__, some)))
            ends.append(len(ids))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(ids, np.int32)))

    def forward(self, s: str, start: int, stop: int) -> tuple[list[int], list[int]]:
        """Best score of each position of s from `start`, and where its last piece starts; pieces start before `stop`."""
        n = len(s)
        best, back = [_LOW] * (n + 1), [-1] * (n + 1)
        best[start] = 0
        for i in range(start, stop):
            if (b := best[i]) == _LOW:
                continue
            node, j, single = self.tree, i, False
            while j < n and (node := node.get(s[j])) is not None:
                j += 1
                if (x := node.get("")) is not None:
                    single |= j == i + 1
                    if b + x > best[j]:
                        best[j], back[j] = b + x, i
            if not single and b + self.unknown > best[i + 1]:
                best[i + 1], back[i + 1] = b + self.unknown, i
        return best, back

    def spelled(self, s: str, i: int, j: int) -> list[int]:
        found = self.ids.get(s[i:j])
        return [found] if found is not None else [self.bytes[b] for b in s[i:j].encode()]

    def traced(self, s: str, back: list[int], start: int, stop: int) -> list[int]:
        out: list[list[int]] = []
        while stop > start:
            out.append(self.spelled(s, back[stop], stop))
            stop = back[stop]
        return [x for ids in reversed(out) for x in ids]

    def encode(self, s: str) -> list[int]:
        """Pieces of a marked text of one chunk."""
        return list(chain.from_iterable(map(self.seen.__getitem__, _SEGMENTS.findall(s))))

    def score(self, s: str) -> int:
        """Sum of the scores of encode(s): an unknown letter's pieces count once."""
        ids = self.encode(s)
        unknown = sum(1 for i in ids if (b := self.by_byte.get(i)) is not None and b & 0xC0 != 0x80)
        return sum(self.id_scores[i] for i in ids) + unknown * self.unknown

    def cuts(self, s: str, size: int) -> tuple[int, int] | None:
        """The first and last place of a chunk of `size` characters that no piece crosses and that no entry state passes."""
        first = next((m.start() for m in re.compile(f"(?<=[^{BLANK}]){BLANK}").finditer(s, self.longest) if m.start() <= size), None)
        if first is None:
            return None
        last = size
        while last > first and not (s[last - 1 : last] != BLANK and s[last : last + 1] == BLANK):
            last = s.rfind(BLANK, 0, last)
        return first, last

    def transfer(self, s: str, size: int) -> np.ndarray:
        """Transfer matrix of the first `size` characters of s: scores, and beside them the ranks of entry states by exit state.

        What comes after these characters belongs to the next chunk.
        """
        n = self.longest
        table = np.full((n, n), _LOW, np.int64)
        cuts = self.cuts(s, size)
        if cuts is None:
            backs = []
            for e in range(min(n, size + 1)):
                best, back = self.forward(s, e, size)
                row = best[size : size + n]
                table[e, : len(row)] = row
                backs.append(back)
            ranks = [_ranked(backs, [e for e in range(len(backs)) if table[e, x] > _LOW], size + x, n) for x in range(n)]
            return np.hstack((table, np.array(ranks, np.int64).T))
        first, last = cuts
        heads = [self.forward(s[:first], e, first) for e in range(n)]
        head = np.array([best[first] for best, _ in heads])
        tail = self.forward(s[last:], 0, size - last)[0][size - last : size - last + n]
        middle = self.score(s[first:last])
        table[:, : len(tail)] = np.maximum(head[:, None] + np.array(tail)[None, :] + middle, _LOW)
        ranks = np.array(_ranked([back for _, back in heads], [e for e in range(n) if head[e] > _LOW], first, n))
        return np.hstack((table, np.where(table > _LOW, ranks[:, None], n)))

    def between(self, s: str, size: int, entry: int, exit: int) -> list[int]:
        """Pieces of a chunk between two states."""
        cuts = self.cuts(s, size)
        if cuts is None:
            return self.traced(s, self.forward(s, entry, size)[1], entry, size + exit)
        first, last = cuts
        head = self.traced(s[:first], self.forward(s[:first], entry, first)[1], entry, first)
        tail = self.traced(s[last:], self.forward(s[last:], 0, size - last)[1], 0, size - last + exit)
        return head + self.encode(s[first:last]) + tail

    def decode(self, ids: list[int]) -> str:
        text = "".join(map(self.plain.__getitem__, ids))
        if not text.isascii():
            text = text.encode("utf-8", "surrogateescape").decode("utf-8", "replace")
        return text[1:]


@cache
def pieces_of(model: bytes) -> Pieces:
    """One vocabulary, with the segments it remembers, for all tasks of a process."""
    return Pieces(model)


def _ranked(backs: list[list[int]], entries: list[int], at: int, n: int) -> list[int]:
    """Ranks of the entry states whose best paths reach `at`, n for all others.

    Paths are walked back side by side; where they part the lesser start ranks first, and one that has come to its
    entry state before all, as its last piece starts in the chunk before.
    """
    ranks, order, groups = [n] * n, 0, [(at, entries)]
    while groups:
        place, some = groups.pop()
        while len(some) > 1 and place not in some and len({backs[e][place] for e in some}) == 1:
            place = backs[some[0]][place]
        if len(some) == 1:
            ranks[some[0]] = order
            order += 1
            continue
        rest = [e for e in some if e != place]
        if len(rest) < len(some):
            ranks[place] = order
            order += 1
        starts = sorted({backs[e][place] for e in rest}, reverse=True)
        groups += [(start, [e for e in rest if backs[e][place] == start]) for start in starts]
    return ranks


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(max, +) product of two transfer matrices, with the ranks of its entry states."""
    n = len(a)
    sums = a[:, :n, None] + b[None, :, :n]  # entry, between, exit
    best = np.maximum(sums.max(1), _LOW)
    between = np.where(sums == sums.max(1, keepdims=True), b[None, :, n:], n + 1).argmin(1)
    reached = best > _LOW
    late = np.take_along_axis(b[:, n:], between, 0)
    early = np.take_along_axis(a[:, n:], between, 1)
    order = np.where(reached, late * (n + 1) + early, (n + 1) ** 2).argsort(0, kind="stable").argsort(0)
    return np.hstack((best, np.where(reached, order, n)))


def boundary_states(matrices: list[np.ndarray], entry: int = 0, exit: int = 0) -> list[int]:
    """States before the first chunk, between chunks and after the last, on the best path from entry to exit."""
    n = len(matrices[0])
    scores = [np.where(np.arange(n) == entry, 0, _LOW)]
    for m in matrices[:-1]:
        scores.append(np.maximum((scores[-1][:, None] + m[:, :n]).max(0), _LOW))
    states = [exit]
    for before, m in zip(reversed(scores), reversed(matrices)):
        sums = before + m[:, states[-1]]
        states.append(int(np.where(sums == sums.max(), m[:, n + states[-1]], n + 1).argmin()))
    return states[::-1]


def _matrix(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, np.int64).reshape(n, 2 * n)


def _boundaries(matrices: DataFrame, n: int, most: int, fan: int) -> DataFrame:
    """(rid, at, entry, exit) for the chunks at 0, 1, ... up to `most` of each rid, from (rid, at, m)."""

    def combine(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        m = reduce(joined, (_matrix(x, n) for x in table["m"].to_pylist()))
        return pa.table({"rid": table["rid"][:1], "at": pa.array([table["at"][0].as_py() // fan], pa.int32()), "m": pa.array([m.tobytes()], pa.binary())})

    def between(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        states = boundary_states([_matrix(x, n) for x in table["m"].to_pylist()], table["entry"][0].as_py(), table["exit"][0].as_py())
        return pa.table({"rid": table["rid"], "at": table["at"], "entry": pa.array(states[:-1], pa.int32()), "exit": pa.array(states[1:], pa.int32())})

    levels = [matrices]
    while most >= fan:
        grouped = levels[-1].withColumn("parent", F.floor(F.col("at") / fan)).groupBy("rid", "parent")
        levels.append(stored(grouped.applyInArrow(combine, "rid long, at int, m binary"), "matrices"))
        most //= fan
    states = None
    for level in reversed(levels):
        below = level.withColumn("parent", F.floor(F.col("at") / fan).cast("int"))
        if states is None:
            below = below.withColumns({"entry": F.lit(0), "exit": F.lit(0)})
        else:
            below = below.join(states.withColumnRenamed("at", "parent"), ["rid", "parent"])
        states = below.groupBy("rid", "parent").applyInArrow(between, "rid long, at int, entry int, exit int")
    return states


def _marked(text):
    """As the public library: each blank becomes a mark, with one more before the text."""
    return F.when(text == "", "").otherwise(F.concat(F.lit(BLANK), F.replace(text, F.lit(" "), F.lit(BLANK))))


def encode(docs: DataFrame, model_path: str, text_col: str = "text", keep: list[str] | None = None, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """Every row of docs as struct `row` (of the columns in keep, or all), with ids array<int> and n_chunks.

    Null and empty texts have no ids. Texts may be of any length. The model file is read by the driver and
    broadcast. An empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with open(model_path, "rb") as file:
        shared = spark.sparkContext.broadcast(file.read())
    keep = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("row"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    look = pieces_of(shared.value).longest

    @F.arrow_udf("array<int>")
    def whole(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = pieces_of(shared.value)
        for batch in texts:
            yield pieces.encode_all(batch.to_pylist())
        release()

    short = rows.filter(F.length("text") <= chunk).select("row", whole(_marked(F.col("text"))).alias("ids"), F.lit(1).alias("n_chunks"))

    if chunk < look:
        raise ValueError(f"chunks must hold the longest piece, {look} characters")
    giants = stored(rows.filter(F.length("text") > chunk).withColumns({"rid": F.monotonically_increasing_id(), "last": F.floor(F.length("text") / chunk).cast("int")}), "giants")
    most = giants.agg(F.max("last")).first()[0]
    if most is None:
        return short
    starts = F.sequence(F.lit(0), F.col("last"))  # the text and its first mark
    part = lambda i: F.struct(i.alias("at"), F.substring(_marked(F.col("text")), i * chunk + 1, F.lit(chunk + look)).alias("s"))
    chunks = giants.select("rid", F.explode(F.transform(starts, part)).alias("c")).select("rid", "c.at", "c.s")

    def transfers(batches):
        pieces = pieces_of(shared.value)
        for b in batches:
            pieces.learn(p for s in b["s"].to_pylist() for p in _SEGMENTS.findall(s))
            found = [pieces.transfer(s, min(len(s), chunk)).tobytes() for s in b["s"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["rid"], b["at"], pa.array(found, pa.binary())], names=["rid", "at", "m"])
        release()

    def traced(batches):
        pieces = pieces_of(shared.value)
        for b in batches:
            pieces.learn(p for s in b["s"].to_pylist() for p in _SEGMENTS.findall(s))
            found = [pieces.between(s, min(len(s), chunk), e, x) for s, e, x in zip(*(b[k].to_pylist() for k in ("s", "entry", "exit")))]
            yield pa.RecordBatch.from_arrays([b["rid"], b["at"], pa.array(found, pa.list_(pa.int32()))], names=["rid", "at", "ids"])
        release()

    matrices = stored(chunks.mapInArrow(transfers, "rid long, at int, m binary"), "matrices")
    states = _boundaries(matrices, look, most, fan)
    parts = chunks.join(states, ["rid", "at"]).mapInArrow(traced, "rid long, at int, ids array<int>")
    long = parts.groupBy("rid").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("at", "ids"))), lambda x: x["ids"])).alias("ids"), F.count("*").cast("int").alias("n_chunks"))
    return short.unionByName(giants.select("rid", "row").join(long, "rid").drop("rid"))


def decode(ids: str, spark, model_path: str):
    """Column of the texts of a column of ids."""
    with open(model_path, "rb") as file:
        shared = spark.sparkContext.broadcast(file.read())

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = pieces_of(shared.value)
        for batch in batches:
            ends, values = batch.offsets.to_numpy(), batch.values.to_numpy()
            yield pa.array([pieces.decode(values[a:b].tolist()) if ok else None for a, b, ok in zip(ends[:-1], ends[1:], batch.is_valid().to_pylist())], pa.string())

    return text(ids)
