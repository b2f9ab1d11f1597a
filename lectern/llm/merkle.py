"""Merkle manifest of a dataset: a tree of fan-out FAN over each source, one more over the sources' roots.

Leaves are range-sorted by source and id with splitters that follow from the table alone, so every evaluation of
the sorted RDD deals the same rows to the same partitions. The rows of a source in each partition are counted; the
counts of the partitions before give each leaf its position, and positions fix every node's coordinate (level,
index). A partition builds all aligned subtrees that lie wholly in it. Nodes whose parent doesn't (a few a level at
either end of a partition) are shuffled by the coordinate of their ancestor STEP levels up, at most 3^STEP
children to a group, and finished there, STEP levels a round. Proofs go the way back: a leaf's siblings inside its
partition's subtree, then those of the boundary node above it.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

from pyspark import RDD
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.common import id_key, partitions, sized_join

FAN = 3
STEP = 8
#: About so many keys are looked at to find where ranges end, or so many a range if that is more.
SPLIT_KEYS, SPLIT_KEYS_EACH = 20_000, 20

_STEP_TYPE = T.StructType([T.StructField("before", T.ArrayType(T.StringType())), T.StructField("after", T.ArrayType(T.StringType()))])
PROOF = T.ArrayType(_STEP_TYPE)

Steps = list[tuple[list[str], list[str]]]


def encoded(*fields: Column) -> Column:
    """The fields, each `-` if null, else its length in UTF-8 bytes, a colon, and its value."""
    text = lambda f: F.coalesce(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")), F.lit("-"))
    return F.concat(*[text(f) for f in fields])


def leaf(*fields: Column) -> Column:
    return F.sha2(encoded(*fields), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda node, s: F.sha2(F.concat(F.array_join(s["before"], ""), node, F.array_join(s["after"], "")), 256))


def siblings(proof: Column) -> Column:
    """All digests of a proof in one string, from the leaf up, left to right."""
    return F.array_join(F.flatten(F.transform(proof, lambda s: F.concat(s["before"], s["after"]))), "")


def _hash(digests: Iterable[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def subtrees(digests: list[str], first: int, n: int) -> list[tuple[int, int, list[str]]]:
    """Levels (nodes in the whole tree, first index, digests) of all subtrees that lie wholly in positions first, first + 1, ..."""
    levels = [(n, first, digests)]
    while n > 1:
        end = first + len(digests)
        above = -(-first // FAN)
        stop = -(-n // FAN) if end == n else end // FAN
        if stop <= above:
            break
        digests = [_hash(digests[k * FAN - first : (k + 1) * FAN - first]) for k in range(above, stop)]
        first, n = above, -(-n // FAN)
        levels.append((n, first, digests))
    return levels


def paths(levels: list[tuple[int, int, list[str]]]) -> list[tuple[Steps, int, int]]:
    """For each position: its steps up to the highest node that its partition has, and that node's level and index."""
    n, first, digests = levels[-1]
    found = [([], len(levels) - 1, first + i) for i in range(len(digests))]
    for level in range(len(levels) - 2, -1, -1):
        above, above_first = found, levels[level + 1][1]
        n, first, digests = levels[level]
        found = []
        for i in range(len(digests)):
            parent = (first + i) // FAN - above_first
            if 0 <= parent < len(above):
                steps, at, index = above[parent]
                a = (parent + above_first) * FAN - first
                found.append(([(digests[a:i], digests[i + 1 : a + FAN]), *steps], at, index))
            else:
                found.append(([], level, first + i))
    return found


def ragged(levels: list[tuple[int, int, list[str]]]) -> Iterator[tuple[int, int, str]]:
    """(level, index, digest) of the nodes that have no parent among the levels."""
    for level, (_, first, digests) in enumerate(levels):
        above = levels[level + 1][1:] if level + 1 < len(levels) else (0, [])
        for i, digest in enumerate(digests):
            if not 0 <= (first + i) // FAN - above[0] < len(above[1]):
                yield level, first + i, digest


def finish(nodes: Iterable[tuple[int, int, str]], n: int, low: int, step: int = STEP) -> tuple[list[tuple[int, int, Steps]], tuple[int, int, str, bool]]:
    """Joins the nodes (level, index, digest) below one coordinate at level low + step, or at the root if that comes first.

    Returns each node's steps up to there, and the node reached with whether it is the root.
    """
    given = [(level, index) for level, index, _ in nodes]
    by_level: dict[int, dict[int, str]] = {}
    for level, index, digest in nodes:
        by_level.setdefault(level, {})[index] = digest
    size, level = n, 0
    sizes = {0: n}
    while size > 1:
        size, level = -(-size // FAN), level + 1
        sizes[level] = size
    top = min(low + step, level)
    for level in range(low, top):
        for k in sorted({index // FAN for index in by_level.get(level, {})}):
            family = range(k * FAN, min(k * FAN + FAN, sizes[level]))
            by_level.setdefault(level + 1, {})[k] = _hash(by_level[level][i] for i in family)
    steps: dict[tuple[int, int], Steps] = {(top, index): [] for index in by_level[top]}
    for level in range(top - 1, low - 1, -1):
        row = by_level.get(level, {})
        for index in row:
            k = index // FAN
            family = range(k * FAN, min(k * FAN + FAN, sizes[level]))
            own = ([row[i] for i in family if i < index], [row[i] for i in family if i > index])
            steps[level, index] = [own, *steps[level + 1, k]]
    ((index, digest),) = by_level[top].items()
    return [(level, i, steps[level, i]) for level, i in given], (top, index, digest, sizes[top] == 1)


def _ranged(rows: DataFrame) -> RDD:
    """RDD of (group, order, digest, tie) -> payload, range-sorted, from columns of these names."""
    spark = rows.sparkSession
    n = partitions(spark)
    key = ["group", "order", "digest", "tie"]
    step = max(rows.count() // max(SPLIT_KEYS, SPLIT_KEYS_EACH * n), 1)
    some = rows.filter(F.pmod(F.xxhash64(*key), F.lit(step)) == 0).select(*key).collect()
    some = sorted((bytes(r.group), r.order, r.digest, r.tie) for r in some)
    starts = spark.sparkContext.broadcast([some[len(some) * i // n] for i in range(1, n)] if some else [])
    pairs = rows.select(*key, "payload").rdd.map(lambda r: ((bytes(r[0]), r[1], r[2], r[3]), r[4]))
    return pairs.repartitionAndSortWithinPartitions(n, lambda k: bisect_right(starts.value, k))


def _ends(part: int, rows: Iterator) -> Iterator[tuple[int, bytes, int, bytes, int]]:
    """(partition, its first group, rows of it, its last group, rows of it)."""
    runs = [[None, 0], [None, 0]]
    for (group, *_), _ in rows:
        if runs[1][0] != group:
            runs[1] = [group, 0]
        runs[1][1] += 1
        if runs[0][0] is None or runs[0][0] == group:
            runs[0] = list(runs[1])
    if runs[0][0] is not None:
        yield part, *runs[0], *runs[1]


def offsets(ends: Iterable[tuple[int, bytes, int, bytes, int]]) -> dict[int, tuple[int, int, int]]:
    """By partition: rows of its first group in the partitions before, and in all of its first and of its last group."""
    before: dict[bytes, int] = {}
    start, found = {}, sorted(ends)
    for part, first, n_first, last, n_last in found:
        start[part] = before.get(first, 0)
        before[first] = start[part] + n_first
        if last != first:
            before[last] = n_last
    return {part: (start[part], before[first], before[last]) for part, first, _, last, _ in found}


def tree(rows: DataFrame, payload: T.DataType, step: int = STEP) -> tuple[DataFrame, DataFrame]:
    """Trees over the rows of each `group` (binary) in the order of (`order`, `digest`).

    rows: group, order (string), digest, tie (long: tells rows of equal digests apart, so that many of them are
    dealt out), payload. Returns (group, digest, payload, proof up to the group's root), and (group, root).
    """
    spark = rows.sparkSession
    sorted_rows = _ranged(rows)
    ends = sorted_rows.mapPartitionsWithIndex(_ends).collect()  # one entry a partition
    shared = spark.sparkContext.broadcast(offsets(ends))

    def built(part: int, pairs: Iterator) -> Iterator:
        """(group, n, levels, payloads) of each group's run in the partition."""
        start, n_first, n_last = shared.value.get(part, (0, 0, 0))
        runs = groupby(pairs, key=lambda pair: pair[0][0])
        at, ahead = 0, next(runs, None)
        while ahead is not None:
            group, run = ahead
            digests, payloads = [], []
            for key, value in run:
                digests.append(key[2])
                payloads.append(value)
            ahead = next(runs, None)
            n = n_first if at == 0 else n_last if ahead is None else len(digests)
            yield group, n, subtrees(digests, start if at == 0 else 0, n), payloads
            at += 1

    def boundary(part: int, pairs: Iterator) -> Iterator:
        for group, n, levels, _ in built(part, pairs):
            for level, index, digest in ragged(levels):
                yield group, n, level, index, digest

    def leaves(part: int, pairs: Iterator) -> Iterator:
        for group, _, levels, payloads in built(part, pairs):
            for digest, value, (steps, level, index) in zip(levels[0][2], payloads, paths(levels)):
                yield group, digest, value, steps, level, index

    nodes = sorted_rows.mapPartitionsWithIndex(boundary)
    largest = max([0, *(x for found in offsets(ends).values() for x in found[1:])])
    height = 0
    while FAN**height < largest:
        height += 1
    rounds = max(1, -(-height // step))
    n_parts = partitions(spark)

    def climb(low: int) -> Callable:
        def out(pair) -> Iterator:
            (group, n, _), found = pair
            steps, (level, index, digest, is_root) = finish(list(found), n, low, step)
            yield (group, n, level, index, digest), is_root, [(group, a, i, s, level, index) for a, i, s in steps]

        return out

    above: list[RDD] = []
    carried: RDD | None = None
    roots: RDD = spark.sparkContext.emptyRDD()
    for r in range(rounds):
        low = r * step
        here = nodes.filter(lambda x, low=low, last=r == rounds - 1: low <= x[2] < low + step or (last and x[2] >= low))
        here = here if carried is None else here.union(carried)
        keyed = here.map(lambda x, low=low: ((x[0], x[1], x[3] // FAN ** (low + step - x[2]) if low + step > x[2] else x[3]), x[2:]))
        done = keyed.groupByKey(n_parts).flatMap(climb(low))
        above.append(done.flatMap(lambda x: x[2]))
        carried = done.filter(lambda x: not x[1]).map(lambda x: x[0])
        roots = roots.union(done.filter(lambda x: x[1]).map(lambda x: (x[0][0], x[0][4])))
    schema = T.StructType([T.StructField("group", T.BinaryType()), T.StructField("level", T.IntegerType()), T.StructField("index", T.LongType()), T.StructField("upper", PROOF)])
    upper: RDD | None = None
    for found in reversed(above):
        if upper is None:
            upper = found.map(lambda x: ((x[0], x[1], x[2]), x[3]))
        else:  # what the round above says of the node that this round reached
            own = found.map(lambda x: ((x[0], x[4], x[5]), (x[1], x[2], x[3])))
            joined = own.leftOuterJoin(upper, n_parts).map(lambda x: ((x[0][0], x[1][0][0], x[1][0][1]), x[1][0][2] + (x[1][1] or [])))
            upper = joined.union(upper)
    tops = spark.createDataFrame(upper.map(lambda x: (bytearray(x[0][0]), x[0][1], x[0][2], x[1])).filter(lambda x: x[3]), schema, verifySchema=False)
    root_rows = spark.createDataFrame(roots.map(lambda x: (bytearray(x[0]), x[1])), "group binary, root string")
    fields = [T.StructField("group", T.BinaryType()), T.StructField("digest", T.StringType()), T.StructField("payload", payload), T.StructField("steps", PROOF), T.StructField("level", T.IntegerType()), T.StructField("index", T.LongType())]
    made = spark.createDataFrame(sorted_rows.mapPartitionsWithIndex(leaves).map(lambda x: (bytearray(x[0]), *x[1:])), T.StructType(fields), verifySchema=False)
    out = sized_join(made, tops, ["group", "level", "index"], "left")
    proof = F.concat("steps", F.coalesce("upper", F.array().cast(PROOF)))
    return out.select("group", "digest", "payload", proof.alias("proof")), root_rows


def manifest(docs: DataFrame, digest: Column, id_col: str = "doc_id", source_col: str = "source", keep: list[str] | None = None, step: int = STEP) -> DataFrame:
    """Every row of docs as struct `row` (of the columns in keep, or all), with leaf (= digest), subroot, root and proof.

    proof is an array of (before, after), the siblings to the left and right on each level, from the leaf to its
    source's root and on to the root of all; folded() makes the root of a leaf and a proof.

    Null sources are one source, the first; null ids come first in their source; rows that share an id follow
    their digests, so equal rows have the proofs of neighbouring places. A lone leaf is its source's root, a lone
    source's root is the root. An empty table gives no rows. Columns of docs may have any names.
    """
    spark: SparkSession = docs.sparkSession
    keep = docs.columns if keep is None else keep
    source = docs[source_col].cast("string")
    group = F.coalesce(F.encode(F.concat(F.lit("+"), source), "UTF-8"), F.lit("").cast("binary"))
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("payload"), group.alias("group"), id_key(docs[id_col]).alias("order"), digest.alias("digest"))
    rows = rows.withColumn("tie", F.monotonically_increasing_id())
    made, roots = tree(rows, rows.schema["payload"].dataType, step)
    second = roots.select(F.lit("").cast("binary").alias("group"), F.hex("group").alias("order"), F.col("root").alias("digest"), F.lit(0).cast("long").alias("tie"), F.col("group").alias("payload"))
    above, top = tree(second, T.BinaryType(), step)
    above = above.select(F.col("payload").alias("group"), F.col("digest").alias("subroot"), F.col("proof").alias("more"))
    root = [r.root for r in top.collect()]  # one, or none
    out = sized_join(made, above, "group")
    return out.select(F.col("payload").alias("row"), F.col("digest").alias("leaf"), "subroot", F.lit(root[0] if root else None).cast("string").alias("root"), F.concat("proof", "more").alias("proof"))
