"""Near-duplicate groups by min-max hashing of word shingles.

Under each of PERMUTATIONS permutations both the least and the greatest hash of a document's shingles are
kept: two values for one evaluation. BANDS bands of ROWS values propose pairs; at a similarity of 0.75 a
pair shares no band with probability (1 - 0.75 ** ROWS) ** BANDS, about 1e-6. Every proposed pair is
confirmed on the full shingle sets.

Documents with equal sets form a class, which is handled once. Within a band's bucket a pair is tested
only while its two classes are in different components: twice each class against the pivot it shares most
buckets with, then in rounds in which about 4, 64, 1024... classes of each bucket that is still divided act
as pivots, until each has. So a bucket of n copies costs n tests, not n * n, and no pair of a bucket that
could join two components is left out.

Before these rounds the shingles of the classes that are left are counted. One that only a single component
has links no two: a class with `own` such shingles and `shared` others has a similarity to a class of another
component of at most min(shared) / (own + own' + max(shared)). Each class also has a bitmap of its hashed
shingles: every bit that only one of two classes has stands for a shingle that they don't share. Pairs, and
classes, that fall below 0.75 by these bounds are never formed; so texts that share a long passage but differ
beside it drop out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import discard, observed, partitions, release, sized_join, small_batches, stored, tidy
from lectern.llm.components import components
from lectern.llm.shingles import WordHashes, common, mixed, shingle_set

BANDS, ROWS = 50, 5
PERMUTATIONS = BANDS * ROWS // 2
#: Members that are compared with one copy of their pivot's set.
MEMBERS = 200
#: How many times more classes of a bucket are pivots in each round.
GROWTH = 16
#: Pivots of a bucket in the first round.
FIRST = 4
#: Words of 64 bits in a class's bitmap.
BITMAP = 16
_ODD = np.random.default_rng(3).integers(0, 2**31, PERMUTATIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_NO_ID = -(2**63)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Low 16 bits of the least and the greatest value under each permutation, in turn."""
    low, high = np.full(PERMUTATIONS, 2**32 - 1, np.uint32), np.zeros(PERMUTATIONS, np.uint32)
    for at in range(0, len(shingles), 2048):
        h = (shingles[at : at + 2048] >> np.uint64(32)).astype(np.uint32)[:, None] * _ODD
        np.minimum(low, h.min(0), out=low)
        np.maximum(high, h.max(0), out=high)
    return np.stack((low, high), 1).ravel().astype(np.uint16)


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """64 * BITMAP bits, one set for each hashed shingle."""
    bits = np.zeros(64 * BITMAP, bool)
    bits[shingles % np.uint64(64 * BITMAP)] = True
    return np.packbits(bits).view(np.int64)


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key per band for each row of signatures."""
    parts = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2])
    for i in range(ROWS):
        keys = mixed(keys * np.uint64(0x100000001B3) + parts[:, :, i])
    return keys.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = WordHashes()
    for batch in batches:
        sizes, keys, signs, maps = [], [], [], []
        for text in batch["text"].to_pylist():
            s = shingle_set(text, words)
            sizes.append(len(s))
            maps.append(bitmap(s) if len(s) else None)
            keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            signs.append(signature(s).tobytes() if len(s) else None)
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["text_key"], pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(signs, pa.binary()), pa.array(maps, pa.list_(pa.int64()))], names=["doc_id", "text_key", "n_shingles", "set_key", "sign", "bits"])
    release()


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = band_keys(np.frombuffer(b"".join(batch["sign"].to_pylist()), np.uint16).reshape(batch.num_rows, -1))
        again = lambda name: pa.array(np.repeat(batch[name].to_numpy(zero_copy_only=False), BANDS))
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), again("cls"), again("n")], names=["band", "cls", "n"])
    release()


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = WordHashes()
    for batch in batches:
        found = [(c, s.tobytes()) for c, key, text in zip(*(batch[k].to_pylist() for k in ("cls", "set_key", "text"))) if xxhash.xxh3_128_digest((s := shingle_set(text, words)).tobytes()) == key]
        yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in found], pa.int64()), pa.array([s for _, s in found], pa.binary())], names=["cls", "shingles"])
    release()


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _sets(batches):
        found = [np.frombuffer(s, np.int64) for s in batch["shingles"].to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch["cls"].to_numpy(), [len(f) for f in found])), pa.array(np.concatenate(found or [np.empty(0, np.int64)]))], names=["cls", "shingle"])
    release()


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by pivot and salt, the pivot's own set (member null) first."""
    pivot, own = None, np.empty(0, np.uint64)
    for batch in batches:
        a, b = [], []
        for p, member, shingles in zip(*(batch[k].to_pylist() for k in ("pivot", "member", "shingles"))):
            s = np.frombuffer(shingles, np.uint64)
            if member is None:
                pivot, own = p, s
                continue
            assert p == pivot, "a pivot's set comes before its members"
            n = common(own, s)
            if 100 * n >= 75 * (len(own) + len(s) - n):
                a.append(p)
                b.append(member)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    release()


def _texts_of(need: DataFrame, n: int, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """cls, set_key and text for the n classes in need."""
    need = sized_join(classes.select("cls", "set_key", "id"), need, "cls", known=(n, 8 * n))
    return sized_join(docs.select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("id"), "text"), need, "id", known=(n, 40 * n)).select("cls", "set_key", "text")


def _overlaps(active: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(cls, shared, bits): how many of its shingles a class of another component has too, and its bitmap; only classes that may be linked."""
    labels, seen = observed(active.select("cls", "n", "label").distinct(), "labelled", many=F.count("*"))
    texts = _texts_of(labels.select("cls"), seen["many"], classes, docs)
    rows = texts.mapInArrow(_shingles, "cls long, shingle long").join(labels.select("cls", "label"), "cls")
    both = rows.groupBy("shingle").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("shingle")
    shared = rows.join(both, "shingle").groupBy("cls").agg(F.count("*").alias("shared"))
    found = labels.join(shared, "cls").filter("4 * shared >= 3 * n").select("cls", "shared")
    return stored(classes.select("cls", "bits").join(found, "cls"), "overlaps")


def _linked(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> tuple[DataFrame, int]:
    """Those of pairs (pivot, member) whose sets are similar enough, as stored edges (a, b), and their number."""
    n = partitions(pairs.sparkSession)
    need, seen = observed(pairs.select("pivot").union(pairs.select("member")).toDF("cls").distinct(), "need", many=F.count("*"))
    sets = stored(_texts_of(need, seen["many"], classes, docs).mapInArrow(_sets, "cls long, shingles binary"), "sets")
    parts = pairs.groupBy("pivot").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("parts"))
    members = pairs.join(parts, "pivot").select("pivot", "member", F.expr("pmod(xxhash64(member), parts)").cast("int").alias("part"))
    members = members.join(sets, F.col("member") == F.col("cls")).select("pivot", "part", "member", "shingles")
    pivots = parts.join(sets, F.col("pivot") == F.col("cls")).select("pivot", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("member"), "shingles")
    dealt = pivots.unionByName(members).repartition(n, "pivot", "part").sortWithinPartitions("pivot", "part", F.col("member").asc_nulls_first())
    edges, seen = observed(dealt.mapInArrow(_confirm, "a long, b long").distinct(), "links", many=F.count("*"))
    discard(sets)
    return edges, seen["many"]


def _relabelled(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """labels (cls, label) after the two ends of each edge, given by label, came together."""
    merged = components(edges)
    if labels is None:
        return merged.toDF("cls", "label")
    moved = labels.join(merged, labels.label == merged.node, "left").select("cls", F.coalesce(merged.label, labels.label).alias("label"))
    new = merged.join(labels.select("cls"), merged.node == labels.cls, "left_anti").toDF("cls", "label")
    return stored(moved.unionByName(new), "labels")


def _best(met: DataFrame) -> DataFrame:
    """Of the pivots that a class meets, in rows (cls, pivot, count), the one it meets most often, as pair (pivot, member)."""
    return met.groupBy("cls").agg(F.max_by("pivot", F.struct("count", "pivot")).alias("pivot")).select("pivot", F.col("cls").alias("member"))


def _merged(labels: DataFrame, pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """labels after the links among pairs, which are stored."""
    edges, many = _linked(pairs, classes, docs)
    if not many:
        return labels
    ends = _with_label(_with_label(edges, labels, "a", "la"), labels, "b", "lb").select(F.col("la").alias("a"), F.col("lb").alias("b"))
    return _relabelled(labels, ends)


def _with_label(rows: DataFrame, labels: DataFrame, name: str, label: str) -> DataFrame:
    rows = rows.join(labels.select(F.col("cls").alias(name), F.col("label").alias("_label")), name, "left")
    return rows.withColumn(label, F.coalesce("_label", name)).drop("_label")


def _alone(a: str, b: str) -> str:
    return " + ".join(f"bit_count({a}[{i}] & ~{b}[{i}])" for i in range(BITMAP))


#: At most this many shingles are in both of two classes, by their bitmaps.
_MOST = f"least(n - ({_alone('bits', 'p_bits')}), p_n - ({_alone('p_bits', 'bits')}))"


def _plausible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs that the bitmaps of their classes leave open, and that are small beside the sets."""
    one = lambda name, prefix: classes.select(F.col("cls").alias(name), F.col("n").alias(f"{prefix}n"), F.col("bits").alias(f"{prefix}bits"))
    both = pairs.join(one("member", ""), "member").join(one("pivot", "p_"), "pivot")
    return both.filter(f"7 * {_MOST} >= 3 * (n + p_n)").select("pivot", "member")


def _proposed(active: DataFrame, reach: int) -> DataFrame:
    """Pairs (pivot, member) of this round: about `reach` pivots a bucket, less those of earlier rounds, and all members they must meet.

    Of two classes the one with the lower rank is the pivot, unless it has so many shingles of its own that
    it can only be linked to one with fewer.
    """
    place = F.expr("(cast(rank as double) + 9223372036854775808D) / 18446744073709551616D") * F.col("many")
    active = active.withColumn("leads", F.expr("7 * shared >= 6 * n"))
    turn = (place < reach) & F.col("leads")
    turn = turn & (place >= reach // GROWTH) if reach > FIRST else turn
    leaders = active.filter(turn).select("band", *[F.col(c).alias(f"p_{c}") for c in ("cls", "label", "rank", "n", "shared", "bits")])
    found = active.join(leaders, "band").filter(f"(p_rank < rank or not leads) and label <> p_label and 7 * least(shared, p_shared) >= 3 * (n + p_n) and 7 * {_MOST} >= 3 * (n + p_n)")
    return found.select(F.col("p_cls").alias("pivot"), F.col("cls").alias("member")).distinct()


def _untested(pairs: DataFrame, tested: DataFrame) -> DataFrame:
    return pairs.join(tested.union(tested.select("member", "pivot")), ["pivot", "member"], "left_anti")


def _divided(members: DataFrame, labels: DataFrame) -> tuple[DataFrame, int | None]:
    """Members, with their labels, of the buckets that have classes of more than one component; the most classes that such a bucket has."""
    marked = _with_label(members, labels, "cls", "label")
    divided = marked.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("band")
    active, seen = observed(marked.join(divided, "band"), "active", most=F.max("many"))
    return active, seen["most"]


def near_dedup(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key (of the text), n_shingles, component_id and kept for every row of documents.

    component_id is the smallest id reachable over links of similarity 0.75 or more, kept whether it is the
    row's own. Null and wordless texts have no shingles and are linked with nothing. Equal texts, also such
    with a null id, share a component; null ids are never its component_id unless there is no other. Rows
    that repeat an id with other text are separate. Other columns of documents aren't read. An empty table
    gives no rows.
    """
    spark = documents.sparkSession
    small_batches(spark)
    docs = documents.select(documents[id_col].cast("long").alias("doc_id"), documents[text_col].cast("string").alias("text"))
    signed = docs.withColumn("text_key", F.xxhash64("text"))
    whole = stored(signed.mapInArrow(_sign, "doc_id long, text_key long, n_shingles long, set_key binary, sign binary, bits array<long>"), "signed")
    one = F.first(F.struct("n_shingles", "sign", "bits")).alias("c")
    classes = whole.filter("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("size"), one)
    classes = classes.select(F.monotonically_increasing_id().alias("cls"), "set_key", "first_id", F.coalesce("first_id", F.lit(_NO_ID)).alias("id"), "size", F.col("c.n_shingles").alias("n"), "c.sign", "c.bits")
    with_signs = stored(classes, "classes")
    signed = stored(whole.select("doc_id", "text_key", "n_shingles", "set_key"), "signed")
    discard(whole)
    classes = stored(with_signs.drop("sign"), "classes")

    bands = with_signs.select("cls", "n", "sign").mapInArrow(_bands, "band long, cls long, n long").withColumn("rank", F.xxhash64("cls"))
    buckets = bands.groupBy("band").agg(F.count("*").alias("many"), F.min_by("cls", "rank").alias("pivot")).filter("many > 1")
    members = stored(bands.join(buckets, "band"), "members")
    discard(with_signs)

    met = stored(members.filter("cls <> pivot").groupBy("cls", "pivot").count(), "met")
    tested = stored(_best(met), "pairs")
    labels = _relabelled(None, _linked(stored(_plausible(tested, classes), "pairs"), classes, docs)[0])
    tidy(spark)
    apart = _with_label(_with_label(met, labels, "cls", "label"), labels, "pivot", "p_label").filter("label <> p_label")
    pairs = stored(_untested(_best(apart), tested), "pairs")
    labels = _merged(labels, stored(_plausible(pairs, classes), "pairs"), classes, docs)
    tested = tested.unionByName(pairs)
    discard(met)
    tidy(spark)

    left, _ = _divided(members, labels)
    overlaps = _overlaps(left, classes, docs)
    discard(left)
    before, members = members, stored(members.join(overlaps, "cls"), "members")
    discard(before)
    tidy(spark)
    reach = FIRST
    while True:
        active, most = _divided(members, labels)
        if most is None or reach > GROWTH * most:
            break
        pairs, seen = observed(_untested(_proposed(active, reach), tested), "pairs", many=F.count("*"))
        if seen["many"]:
            labels = _merged(labels, pairs, classes, docs)
            tested = tested.unionByName(pairs)
        discard(active)
        tidy(spark)
        reach *= GROWTH

    known = _with_label(classes, labels, "cls", "label")
    least = known.groupBy("label").agg(F.min("first_id").alias("component_id"), F.sum("size").alias("rows")).filter("rows > 1")
    found = known.select("set_key", "label").join(least, "label").select("set_key", "component_id")
    out = signed.select("doc_id", "text_key", "n_shingles", "set_key").join(found, "set_key", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "text_key", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
