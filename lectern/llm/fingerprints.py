"""Order MinHash fingerprints of documents, sensitive to edit distance.

The k-mers of a text are numbered by occurrence. Under each of SKETCHES hash functions the PICK least k-mers
are selected and put back in text order, and the tuple is hashed. Two texts agree on a tuple when their least
k-mers are the same and stand in the same order, so likeness, the share of equal tuples, falls with moved
text as well as with changed text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import id_key, partitions, range_of, range_starts, small_batches
from lectern.llm.shingles import mixed

K, PICK, SKETCHES = 6, 2, 64
_ODD = np.random.default_rng(11).integers(0, 2**31, SKETCHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_WEIGHTS = np.random.default_rng(12).integers(0, 2**63, K, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.uint64(20)
_MASK = np.uint64(0xFFFFFF)
_BLOCK = 1 << 14


def numbered_kmers(points: np.ndarray) -> np.ndarray:
    """Hash of (k-mer, how often it has come before) at each position; a shorter text is one k-mer."""
    n, k = len(points), min(K, len(points))
    c = points.astype(np.uint64) + np.uint64(1)
    h = c[: n - k + 1] * _WEIGHTS[0]
    for i in range(1, k):
        h += c[i : n - k + 1 + i] * _WEIGHTS[i]
    h = mixed(h) >> _PLACE
    at = np.arange(len(h), dtype=np.uint64)
    if len(h) <= 1 << int(_PLACE):  # hash and place fit one number: sorting these is quickest
        s = np.sort(h << _PLACE | at)
        order, s = (s & np.uint64((1 << int(_PLACE)) - 1)).astype(np.int64), s >> _PLACE
    else:
        order = np.argsort(h, kind="stable")
        s = h[order]
    new = np.concatenate(([True], s[1:] != s[:-1]))
    starts = np.flatnonzero(new)
    before = at - np.repeat(at[starts], np.diff(np.append(starts, len(s))))
    out = np.empty_like(h)
    out[order] = mixed(s + before * np.uint64(0x9E3779B97F4A7C15))
    return out


def sketch(text: str) -> np.ndarray:
    """SKETCHES hashes of 24 bits; of an empty text none."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(points):
        return np.empty(0, np.uint32)
    h = (numbered_kmers(points) >> np.uint64(32)).astype(np.uint32)
    values = np.full((PICK, SKETCHES), np.uint32(2**32 - 1))
    places = np.full((PICK, SKETCHES), -1, np.int64)
    columns = np.arange(SKETCHES)
    for at in range(0, len(h), _BLOCK):  # the least PICK of the block join those so far
        x = _ODD[:, None] * h[None, at : at + _BLOCK]
        for _ in range(PICK):
            i = x.argmin(1)
            v = x[columns, i]
            x[columns, i] = np.uint32(2**32 - 1)
            values, places = np.vstack((values, v)), np.vstack((places, np.where(at + i < len(h), at + i, -1)))
        best = np.argsort(values, 0, kind="stable")[:PICK]
        values, places = np.take_along_axis(values, best, 0), np.take_along_axis(places, best, 0)
    places[1:][places[1:] == places[:1]] = -1  # a text of one k-mer
    order = np.argsort(places, 0, kind="stable")
    picked = np.where(np.take_along_axis(places, order, 0) >= 0, np.take_along_axis(values, order, 0), 0).astype(np.uint64)
    out = np.arange(SKETCHES, dtype=np.uint64)
    for row in picked:
        out = mixed(out * np.uint64(0x100000001B3) + row)
    return (out & _MASK).astype(np.uint32)


def spelled(found: np.ndarray) -> str:
    return found.astype(">u4").tobytes().hex() if len(found) else ""


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal tuples; 1 for two empty texts, 0 for one."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return float(np.count_nonzero(a == b) / SKETCHES)


def edited_text(text: str, following: str) -> str:
    """The text with its last half replaced by as many characters, or all, of the next document."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def edit_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, fingerprint, edited, edited_fingerprint, near_edited and near_next for every row of docs.

    The next document is that of the next greater id, for the last the first. Null ids come first; rows that
    repeat an id follow each other by text. Null texts are empty and have an empty fingerprint. A single row is
    its own next. Other columns aren't read. An empty table gives no rows.

    Ids are cut into a range for each shuffle partition; each row goes to its range, and the first id of a range also
    to the range before, so that one shuffle brings every text next to the following one.
    """
    spark = docs.sparkSession
    small_batches(spark)
    n = partitions(spark)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    key = id_key(F.col("doc_id"))
    starts = range_starts(rows.select(key.alias("key")), n)
    marks = rows.agg(F.min("doc_id").alias("low"), F.count("*").alias("rows"), F.count("doc_id").alias("ids")).first()
    start = F.col("doc_id").isNull() if marks.ids < marks.rows else F.col("doc_id") == F.lit(marks.low)  # the first row follows the last
    placed = rows.withColumn("place", range_of(spark, key, starts))
    here = F.col("place.number")
    homes = F.array_compact(F.array(F.struct(here.alias("range"), F.lit(0).alias("ahead")), F.when(F.col("place.first"), F.struct((here - 1).alias("range"), F.lit(1).alias("ahead"))), F.when(start, F.struct(F.lit(len(starts)).alias("range"), F.lit(2).alias("ahead")))))
    dealt = placed.select("doc_id", "text", F.explode(homes).alias("home")).select("doc_id", "text", "home.range", "home.ahead")
    dealt = dealt.repartitionById(n, F.col("range")).sortWithinPartitions("range", "ahead", F.col("doc_id").asc_nulls_first(), "text")
    return dealt.mapInArrow(_pairwise, "doc_id long, n_chars long, fingerprint string, edited string, edited_fingerprint string, near_edited double, near_next double")


def _pairwise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in order of range, own rows before those of the next; each is put out when the one after it is seen."""
    held, names = None, ["doc_id", "n_chars", "fingerprint", "edited", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    for batch in batches:
        out = []
        for doc_id, text, place, ahead in zip(*(batch[k].to_pylist() for k in ("doc_id", "text", "range", "ahead"))):
            if held and held[2] == place and held[4]:
                own = held[3]
                mine = sketch(text)
                edited = edited_text(held[1], text)
                changed = own if edited == held[1] else sketch(edited)
                out.append((held[0], len(held[1]), spelled(own), edited, spelled(changed), likeness(own, changed), likeness(own, mine)))
            elif held is None or held[2] != place or not ahead:
                mine = sketch(text)
            held = (doc_id, text, place, mine, not ahead)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds], names=names)
