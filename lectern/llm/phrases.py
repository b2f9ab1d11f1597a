"""Removal of passages that repeat across documents, by automata of the repeated phrases.

A window is WIDTH consecutive words. Its anchor is the GRAM words in it whose hash is least (the first of them), so
a window that recurs has the same anchor wherever it stands; neighbouring windows share anchors, and the stretch of a
text whose windows have one anchor in common is a piece. Three passes over the texts:

1. Anchors are counted. Those met once can't belong to a recurring window.
2. Windows of the others are counted by hash: the recurring ones are the phrases.
3. Pieces go to the shard of their anchor, as the phrases do. A shard compiles its phrases, spelled as words, into an
   Aho-Corasick automaton and runs all its pieces through it; hits are the words to remove.

So all texts are streamed, each stretch past the one automaton that can hit it, and work grows with the text, not with
text times shards. Shards with many hits are split by a salt of the piece. The anchors of pass 1 reach passes 2 and 3
as a bit filter of at most 2^MAX_BITS bits; what it lets through too much is dropped by the counts. Texts that are
equal as a whole are removed as a whole, one of them stands in for all, and none is run through an automaton.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import discard, partitions, sized_join, small_batches, stored

WIDTH, GRAM = 35, 8
#: Phrases to an automaton: the children of its root are looked through one by one.
SHARD = 4000
#: Bits of the filter for each anchor, and the logarithms of its least and largest size.
BITS_EACH, MIN_BITS, MAX_BITS = 16, 16, 28
_SLICE = 15
_BLOCK = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASES = {"byte": 0x9E3779B97F4A7C15, "word": 0xD1342543DE82EF95}
_POWERS: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def _powers(kind: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """0th to n-th powers of a base and of its inverse, modulo 2^64."""
    if kind not in _POWERS or len(_POWERS[kind][0]) <= n:
        base = _BASES[kind]
        run = lambda b: np.r_[np.uint64(1), np.cumprod(np.full(2 * n, b, np.uint64), dtype=np.uint64)]
        _POWERS[kind] = run(base), run(pow(base, -1, 1 << 64))
    return _POWERS[kind]


def _mixed(x: np.ndarray) -> np.ndarray:
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _sums(kind: str, values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of values[start:end] for each of the stretches."""
    up, down = _powers(kind, len(values))
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:], dtype=np.uint64)
    return _mixed((total[end] - total[start]) * down[start])


class Words:
    """The words of an array of strings or binaries: row, start and end in the bytes, and hash of each."""

    def __init__(self, texts: pa.Array):
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
        self.data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        word, n = ~_SPACE[self.data], len(self.data)
        ahead = np.zeros(n + 1, bool)
        ahead[offsets[:-1]] = True
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1] | ahead[1:n]
        last[:-1] &= ~word[1:] | ahead[1:n]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.row = np.searchsorted(offsets, self.start, "right") - 1
        self.hash = np.zeros(len(self.start), np.uint64)
        a = 0
        while a < len(self.start):
            b = max(a + 1, int(np.searchsorted(self.end, self.start[a] + _BLOCK)))
            base = self.start[a]
            self.hash[a:b] = _sums("byte", self.data[base : self.end[b - 1]].astype(np.uint64) + np.uint64(1), self.start[a:b] - base, self.end[a:b] - base)
            a = b

    def windows(self, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First word, hash, place of the anchor and its hash, of all windows."""
        n = len(self.row)
        if n < width:
            none = np.zeros(0, np.int64)
            return none, none.astype(np.uint64), none, none.astype(np.uint64)
        at = np.flatnonzero(self.row[: n - width + 1] == self.row[width - 1 :])
        least = _sums("word", self.hash, np.arange(n - gram + 1), np.arange(gram, n + 1))
        place, done, span = np.arange(len(least)), 1, width - gram + 1
        while done < span:
            step = min(done, span - done)
            right = least[step:] < least[:-step]
            least, place = np.where(right, least[step:], least[:-step]), np.where(right, place[step:], place[:-step])
            done += step
        return at, _sums("word", self.hash, at, at + width), place[at], least[at]

    def pieces(self, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First window, last window and hash of the anchor of every piece."""
        at, _, place, anchor = self.windows(width, gram)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if len(at) else np.zeros(0, np.int64)
        last = np.r_[first[1:], len(at)][: len(first)] - 1
        return at[first], at[last], anchor[first]

    def text(self, first: int, last: int) -> bytes:
        found = self.data[self.start[first] : self.end[last]].tobytes()
        return found if len(found) < 1 << 12 else b" ".join(found.split())


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


class Filter:
    """A set of hashes as bits: whatever is in it is found, some that isn't is found too."""

    def __init__(self, hashes: DataFrame, name: str):
        spark = hashes.sparkSession
        n = max(hashes.count(), 1)
        self.log = min(max(int(n * BITS_EACH).bit_length(), MIN_BITS), MAX_BITS)
        mask = (1 << self.log) - 1

        def bits(table: pa.Table) -> pa.Table:
            at = np.unique(table[name].to_numpy() & mask & ((1 << _SLICE) - 1))
            some = np.zeros(1 << _SLICE, bool)
            some[at] = True
            return pa.table({"slice": table["slice"][:1], "bits": pa.array([np.packbits(some).tobytes()], pa.binary())})

        slices = hashes.select(name, F.shiftright(F.col(name).bitwiseAND(F.lit(mask)), _SLICE).alias("slice"))
        whole = np.zeros(1 << (self.log - 3), np.uint8)
        for r in slices.groupBy("slice").applyInArrow(bits, "slice long, bits binary").collect():  # at most 2^MAX_BITS bits in all
            whole[r.slice << (_SLICE - 3) : (r.slice + 1) << (_SLICE - 3)] = np.frombuffer(r.bits, np.uint8)
        self.shared = spark.sparkContext.broadcast(whole)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes & np.uint64((1 << self.log) - 1)).astype(np.int64)
        return (self.shared.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0


def _counted(key: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different pairs, and how often each stands there."""
    order = np.lexsort((other, key))
    key, other = key[order], other[order]
    first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (other[1:] != other[:-1])]) if len(key) else order
    return key[first], other[first], np.diff(np.r_[first, len(key)])


def _phrase_key(window: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    return window ^ _mixed(anchor)


def located(pieces: pa.Table, phrases: pa.Table, width: int, gram: int) -> pa.Table:
    """(digest, first, last + 1) of the words of each piece (digest, at, anchor, piece) that phrases (window, anchor) of its shard cover."""
    empty = pa.table({"digest": pa.array([], pa.binary()), "first": pa.array([], pa.int64()), "stop": pa.array([], pa.int64())})
    if not pieces.num_rows or not phrases.num_rows:
        return empty
    encoded = pieces["piece"].combine_chunks().dictionary_encode()  # equal pieces are run through once
    which, texts = encoded.indices.to_numpy(), encoded.dictionary
    words = Words(texts)
    anchors = np.zeros(len(texts), np.uint64)
    anchors[which] = pieces["anchor"].to_numpy().view(np.uint64)
    at, window, *_ = words.windows(width, gram)
    key = _phrase_key(window, anchors[words.row[at]])
    wanted = np.isin(key, _phrase_key(*(phrases[c].to_numpy().view(np.uint64) for c in ("window", "anchor"))))
    if not wanted.any():
        return empty
    letters = np.unique(words.hash, return_inverse=True)[1] + 1
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for w in at[wanted][np.unique(key[wanted], return_index=True)[1]].tolist():
        automaton.add_word(tuple(letters[w : w + width].tolist()), width)
    automaton.make_automaton()
    stream = np.zeros(len(letters) + len(texts), np.int64)  # 0 parts the pieces
    stream[np.arange(len(letters)) + words.row] = letters
    ends = np.array([end for end, _ in automaton.iter(tuple(stream.tolist()))], np.int64)
    starts = ends - width + 1
    begin = np.flatnonzero(np.r_[True, starts[1:] != starts[:-1] + 1])
    first, stop = starts[begin], ends[np.r_[begin[1:], len(ends)] - 1] + 1  # hits in a row are one stretch
    heads = np.searchsorted(words.row, np.arange(len(texts))) + np.arange(len(texts))
    piece = np.searchsorted(heads, first, "right") - 1
    first, stop = first - heads[piece], stop - heads[piece]
    number = np.bincount(piece, minlength=len(texts))
    skip = np.r_[0, np.cumsum(number)]
    rows = np.repeat(np.arange(len(which)), number[which])
    within = np.arange(len(rows)) - np.repeat(np.cumsum(number[which]) - number[which], number[which])
    hit = skip[which[rows]] + within
    place = pieces["at"].to_numpy()[rows]
    return pa.table({"digest": pieces["digest"].combine_chunks().take(pa.array(rows)), "first": pa.array(place + first[hit]), "stop": pa.array(place + stop[hit])})


def _digest(text: Column) -> Column:
    """The first half of the SHA-256."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def _merged(found: DataFrame) -> DataFrame:
    """Stretches of a text that overlap or touch made one; the hits of neighbouring pieces do."""
    order = Window.partitionBy("digest").orderBy("first", "stop")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = found.withColumn("apart", (before.isNull() | (F.col("first") > before)).cast("int"))
    return apart.withColumn("at", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, 0))).groupBy("digest", "at").agg(F.min("first").alias("first"), F.max("stop").alias("stop"))


def repeated_stretches(docs: DataFrame, text_col: str = "text", width: int = WIDTH, gram: int = GRAM, shard: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """(digest, stretches) of the texts that have words to remove, stretches being an array of (first, stop) in words; and the digests of texts that stand in several rows."""
    spark = docs.sparkSession
    small_batches(spark)
    n = partitions(spark)
    text = docs[text_col].cast("string")
    rows = docs.select(_digest(text).alias("digest"), text.alias("text")).filter(F.octet_length("text") >= 2 * width - 1)
    copied = stored(rows.groupBy("digest").count().filter("count > 1").select("digest"), "copied")
    one = sized_join(rows, copied, "digest", "left_semi").groupBy("digest").agg(F.any_value("text").alias("text"), F.lit(True).alias("copied"))
    texts = stored(sized_join(rows, copied, "digest", "left_anti").withColumn("copied", F.lit(False)).unionByName(one), "texts")

    def count_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, _, anchor = Words(b["text"]).pieces(width, gram)
            found, times = np.unique(anchor, return_counts=True)
            yield pa.RecordBatch.from_arrays([_long(found), pa.array(times)], names=["anchor", "n"])

    anchors = texts.select("text").mapInArrow(count_anchors, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    anchors = stored(anchors.filter("n > 1").select("anchor"), "anchors")
    recurring = Filter(anchors, "anchor")
    discard(anchors)

    def count_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, window, _, anchor = Words(b["text"]).windows(width, gram)
            some = recurring.has(anchor)
            window, anchor, times = _counted(window[some], anchor[some])
            yield pa.RecordBatch.from_arrays([_long(window), _long(anchor), pa.array(times, pa.int64())], names=["window", "anchor", "n"])

    phrases = texts.select("text").mapInArrow(count_windows, "window long, anchor long, n long").groupBy("window", "anchor").agg(F.sum("n").alias("n"))
    phrases = stored(phrases.filter("n > 1"), "phrases")
    total, hits = phrases.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    shards = max(4 * n, -(-total // shard))
    usual = max(hits // shards, shard)
    in_shard = lambda df: df.withColumn("shard", F.pmod("anchor", F.lit(shards)))
    hot = in_shard(phrases).groupBy("shard").agg(F.ceil(F.sum("n") / usual).alias("salts")).filter("salts > 1")
    hot = stored(hot, "hot")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = Words(b["text"])
            first, last, anchor = words.pieces(width, gram)
            some = recurring.has(anchor)
            first, last, anchor = first[some], last[some] + width - 1, anchor[some]
            row = words.row[first]
            at = first - np.searchsorted(words.row, row)
            found = pa.array([words.text(a, z) for a, z in zip(first.tolist(), last.tolist())], pa.binary())
            yield pa.RecordBatch.from_arrays([b["digest"].take(pa.array(row)), pa.array(at, pa.int64()), _long(anchor), found], names=["digest", "at", "anchor", "piece"])

    pieces = texts.filter("not copied").select("digest", "text").mapInArrow(cut, "digest binary, at long, anchor long, piece binary")
    salts = F.coalesce("salts", F.lit(1))
    pieces = sized_join(in_shard(pieces), hot, "shard", "left").withColumn("salt", F.pmod(F.xxhash64("digest", "at"), salts)).drop("salts")
    spread = sized_join(in_shard(phrases).drop("n"), hot, "shard", "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).drop("salts")
    both = pieces.groupBy("shard", "salt").cogroup(spread.groupBy("shard", "salt"))
    found = both.applyInArrow(lambda a, b: located(a, b, width, gram), "digest binary, first long, stop long")
    stretches = stored(_merged(found).groupBy("digest").agg(F.collect_list(F.struct("first", "stop")).alias("stretches")), "stretches")
    for done in (texts, phrases, hot):
        discard(done)
    return stretches, copied


def phrase_dedup(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, width: int = WIDTH, gram: int = GRAM, shard: int = SHARD) -> DataFrame:
    """Every row of docs as struct `row` (of the columns in keep, or all), with n_words, n_removed and the text that is left.

    A word goes if a window of `width` words over it stands anywhere else too, in the same text or another; all are
    judged by the texts as given. Words are what ASCII white space parts; those left are joined by one space. Null
    texts have no words. Rows of equal texts lose all their words, if they are enough for a window. Neither ids nor
    the order of rows matter. An empty table gives no rows. Columns of docs may have any names: they stay inside `row`.
    """
    keep = docs.columns if keep is None else keep
    stretches, copied = repeated_stretches(docs, text_col, width, gram, shard)
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("row"), text.alias("text"), _digest(text).alias("digest"))
    rows = sized_join(rows, copied.withColumn("copied", F.lit(True)), "digest", "left")
    rows = sized_join(rows, stretches, "digest", "left")

    @F.arrow_udf("n_words long, n_removed long, text string")
    def left(texts: pa.Array, copied: pa.Array, stretches: pa.Array) -> pa.Array:
        found = []
        for text, whole, some in zip(texts.to_pylist(), copied.to_pylist(), stretches.to_pylist()):
            words = text.encode().split()
            n = len(words)
            if whole and n >= width:
                words = []
            elif some:
                gone = np.zeros(n + 1, np.int64)
                np.add.at(gone, [s["first"] for s in some], 1)
                np.add.at(gone, [s["stop"] for s in some], -1)
                words = [words[i] for i in np.flatnonzero(np.cumsum(gone[:n]) == 0).tolist()]
            found.append({"n_words": n, "n_removed": n - len(words), "text": b" ".join(words).decode()})
        return pa.array(found, pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string())]))

    return rows.select("row", left("text", "copied", "stretches").alias("found")).select("row", "found.*")
