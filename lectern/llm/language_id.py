"""Language identification by interpolated Kneser-Ney models of characters.

One model per language, all in the same sorted hash arrays: a row for each n-gram seen in any language, with
its smoothed log-probability in each. A text gets the language of the lowest cross-entropy per character.

Fitting reads a bounded sample of labelled rows: at most about FIT_DOCS pieces of FIT_CHARS characters or
less for each language, chosen by a hash of the id, and CALIBRATION_DOCS others to calibrate the rejection.
A text of more than FIT_CHARS characters is cut into several pieces.
The model's size is bounded by this sample, so it is counted on executors and built on the driver.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import release, sized_join, small_batches
from lectern.llm.shingles import mixed

ORDER = 4
FIT_DOCS, CALIBRATION_DOCS, FIT_CHARS = 600, 300, 50_000
#: A text of at least this many letters may be rejected for its cross-entropy.
REJECT_LETTERS = 40
#: Nats per character above this quantile of the calibration documents that are most like their own language. Text in
#: another language lies above it by 0.6 and more, text that mixes two learned ones by 0.3 at most.
MARGIN, QUANTILE = 0.5, 0.95
#: Deviation of one character's nats: a text of n letters may lie above the limit by SPREAD / sqrt(n), as its mean varies by that.
SPREAD = 2.0
UNKNOWN = "und"
_WEIGHTS = np.random.default_rng(9).integers(0, 2**63, ORDER, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@cache
def _folded() -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code point for each code point (blank for all but letters and marks); whether it is a letter."""
    fold, letter = np.full(0x110000, 32, np.uint32), np.zeros(0x110000, bool)
    for i in range(0x110000):
        c = chr(i)
        letter[i] = c.isalpha()
        if letter[i] or unicodedata.category(c)[0] == "M":
            fold[i] = ord(low) if len(low := c.lower()) == 1 else i
    return fold, letter


def letters(text: str | None) -> tuple[np.ndarray, int]:
    """Folded code points of the whole text with single blanks, after ORDER - 1 blanks; the number of letters."""
    fold, letter = _folded()
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    c = np.concatenate((np.full(ORDER - 1, 32, np.uint32), fold[points], np.full(1, 32, np.uint32)))
    keep = (c[1:] != 32) | (c[:-1] != 32)
    keep[: ORDER - 2] = True
    return np.concatenate((c[:1], c[1:][keep])), int(np.count_nonzero(letter[points]))


def gram_hashes(c: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k characters that end at each position from ORDER - 1 on, for k of 0 to ORDER."""
    n = len(c) - ORDER + 1
    h = np.full(n, k + 1, np.uint64)
    for j in range(k):
        h += (c[ORDER - 1 - j : ORDER - 1 - j + n].astype(np.uint64) + np.uint64(1)) * _WEIGHTS[j]
    return mixed(h)


def context_hashes(c: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k - 1 characters before each position from ORDER - 1 on."""
    return gram_hashes(np.concatenate((c[:1], c[:-1])), k - 1)


class SortedHashes:
    """Rows of values by hash: sorted keys, with an index of their leading bits."""

    def __init__(self, keys: np.ndarray, *values: np.ndarray):
        bits = max(1, int(len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.start = np.searchsorted(keys, np.arange(2**bits, dtype=np.uint64) << self.shift)
        self.longest = int(np.diff(np.append(self.start, len(keys))).max())
        self.keys = np.append(keys, np.uint64(2**64 - 1))
        self.values = values

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows, and whether the keys there are those looked for."""
        at = self.start[h >> self.shift]
        for _ in range(self.longest):
            at += self.keys[at] < h
        return at, self.keys[at] == h


class Model:
    """Log-probabilities for the languages in names, and the cross-entropy above which each is rejected."""

    def __init__(self, names: list[str], grams: dict[int, tuple[np.ndarray, ...]]):
        """grams: for each order, arrays of hash, hash of the context, hash of the suffix, language index, count."""
        self.names, many = names, len(names)
        self.limits = np.full(many, np.inf)
        if not names:
            return
        keys, seen = {}, {}
        for k in range(1, ORDER + 1):
            h, context, suffix, lang, count = grams[k]
            keys[k], first, row = np.unique(h, return_index=True, return_inverse=True)
            counts = np.zeros((len(keys[k]), many))
            np.add.at(counts, (row, lang), count)
            seen[k] = [counts, context[first], suffix[first]]
        for k in range(ORDER - 1, 0, -1):  # below the highest order: in how many different left contexts
            above, _, suffix = seen[k + 1]
            counts = np.zeros_like(seen[k][0])
            np.add.at(counts, np.searchsorted(keys[k], suffix), above > 0)
            seen[k][0] = counts
        self.uniform = -np.log(len(keys[1]) + 1.0)
        p_below, self.tables = np.full((1, many), np.exp(self.uniform)), {}
        for k in range(1, ORDER + 1):
            counts, context, suffix = seen[k]
            above = np.searchsorted(keys[k - 1], context) if k > 1 else np.zeros(len(context), int)
            lower = np.searchsorted(keys[k - 1], suffix) if k > 1 else above
            total, kinds = np.zeros((2, len(p_below), many))
            np.add.at(total, above, counts)
            np.add.at(kinds, above, counts > 0)
            once, twice = (counts == 1).sum(0), (counts == 2).sum(0)
            discount = np.where(once > 0, once / np.maximum(once + 2 * twice, 1), 0.5).clip(0.1, 0.95)
            with np.errstate(divide="ignore", invalid="ignore"):
                rest = np.where(total > 0, discount * kinds / total, 1.0)
                own = np.where(total[above] > 0, np.maximum(counts - discount, 0) / total[above], 0.0)
            p = own + rest[above] * p_below[lower]
            if k > 1:
                self.tables[k - 1].values += (np.log(rest).astype(np.float32),)
            else:
                self.rest = np.log(rest[0])
            self.tables[k] = SortedHashes(keys[k], np.log(p).astype(np.float32))
            p_below = p

    def cross_entropies(self, text: str | None) -> tuple[np.ndarray, int]:
        """Nats per character in each language; the number of letters (none: zeros)."""
        c, n_letters = letters(text)
        if not n_letters or not self.names:
            return np.zeros(len(self.names)), n_letters
        total, n = np.zeros(len(self.names)), len(c) - ORDER + 1
        left = None  # positions that no higher order has seen
        for k in range(ORDER, 0, -1):
            h, table = gram_hashes(c, k), self.tables[k]
            at, hit = table.find(h if left is None else h[left])
            total += table.values[0][at[hit]].sum(0, dtype=np.float64)
            left = np.flatnonzero(~hit) if left is None else left[~hit]
            if not len(left):
                break
            if k > 1:
                at, hit = self.tables[k - 1].find(context_hashes(c, k)[left])
                total += self.tables[k - 1].values[1][at[hit]].sum(0, dtype=np.float64)
            else:
                total += len(left) * (self.rest + self.uniform)
        return -total / n, n_letters

    def judge(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score from 0 to 1, and whether the text is rejected."""
        ce, n = self.cross_entropies(text)
        if not n or not self.names:
            return UNKNOWN, 0.0, not n
        best = int(ce.argmin())
        odds = np.exp(-(ce - ce[best]) * min(n, 50))
        return self.names[best], float(1 / odds.sum()), bool(n >= REJECT_LETTERS and ce[best] > self.limits[best] + SPREAD / np.sqrt(n))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts: dict[str, list[np.ndarray]] = {}
    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
            texts.setdefault(lang, []).append(letters(text)[0])
    for lang, parts in texts.items():
        c = np.concatenate(parts)  # each begins with blanks
        for k in range(1, ORDER + 1):
            h, first, count = np.unique(gram_hashes(c, k), return_index=True, return_counts=True)
            columns = [h, context_hashes(c, k)[first], (gram_hashes(c, k - 1))[first]]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(h)), pa.array(np.full(len(h), k, np.int32)), *(pa.array(x.view(np.int64)) for x in columns), pa.array(count.astype(np.int64))], names=["lang", "k", "h", "context", "suffix", "n"])


def _bounded(rows: DataFrame, most: int, seed: int) -> DataFrame:
    """About `most` pieces of texts of each language, by a hash of the id and the piece's number."""
    pieces = F.ceil(F.length("text") / FIT_CHARS).cast("int")
    share = rows.groupBy("lang").agg((F.lit(float(most)) / F.sum(pieces)).alias("share"))
    place = lambda i: F.pmod(F.xxhash64("id", F.lit(seed) + i), F.lit(1_000_000)) / 1e6
    chosen = F.filter(F.sequence(F.lit(0), pieces - 1), lambda i: place(i) < F.col("share"))
    return sized_join(rows, share, "lang").select("lang", F.explode(F.transform(chosen, lambda i: F.substr("text", i * FIT_CHARS + 1, F.lit(FIT_CHARS)))).alias("text"))


def fit(labelled: DataFrame) -> Model:
    """A model from (id, text, lang). Rows without id, text or language are left out.

    Every fourth id by hash serves to calibrate, the others to fit. Of the former, texts that are more like another
    language than their label don't count, unless a language has no others. Without any labelled text the model knows
    no language, calls every text `und` and rejects only those without a letter.
    """
    usable = labelled.filter("id is not null and lang is not null and length(text) > 0")
    aside = F.pmod(F.xxhash64(F.col("id"), F.lit("calibration")), F.lit(4)) == 0
    grams = _bounded(usable.filter(~aside), FIT_DOCS, 1).mapInArrow(_count, "lang string, k int, h long, context long, suffix long, n long")
    found = grams.groupBy("lang", "k", "h", "context", "suffix").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(found["lang"].unique().to_pylist())
    if not names:
        return Model([], {})
    k, lang = found["k"].to_numpy(), np.searchsorted(np.array(names, object), found["lang"].to_numpy(zero_copy_only=False))
    columns = [found[c].to_numpy().view(np.uint64) for c in ("h", "context", "suffix")]
    model = Model(names, {i: (*(c[k == i] for c in columns), lang[k == i], found["n"].to_numpy()[k == i]) for i in range(1, ORDER + 1)})
    shared = labelled.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("ce double, own boolean")
    def own_entropy(text: pa.Array, lang: pa.Array) -> pa.Array:
        m = shared.value
        found = []
        for t, name in zip(text.to_pylist(), lang.to_pylist()):
            ce, n = m.cross_entropies(t)
            i = m.names.index(name) if n >= REJECT_LETTERS and name in m.names else None
            found.append((None, None) if i is None else (float(ce[i]), bool(ce[i] <= ce.min())))
        return pa.StructArray.from_arrays([pa.array([x[0] for x in found], pa.float64()), pa.array([x[1] for x in found], pa.bool_())], names=["ce", "own"])

    high = lambda ce: F.try_element_at(F.sort_array(F.collect_list(ce)), (F.floor(QUANTILE * (F.count(ce) - 1)) + 1).cast("int"))
    tried = _bounded(usable.filter(aside), CALIBRATION_DOCS, 2).select("lang", own_entropy("text", "lang").alias("e")).select("lang", "e.*").filter("ce is not null")
    for r in tried.groupBy("lang").agg(high(F.when(F.col("own"), F.col("ce"))).alias("own"), high(F.col("ce")).alias("ce")).collect():
        model.limits[names.index(r.lang)] = (r.ce if r.own is None else r.own) + MARGIN
    return model


def language_of(df: DataFrame, text: Column, model: Model) -> Column:
    """Struct (lang, score, rejected) of a text. Null texts and those without a letter: `und`, 0, rejected."""
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang string, score double, rejected boolean")
    def judged(texts: pa.Array) -> pa.Array:
        found = [shared.value.judge(t) for t in texts.to_pylist()]
        release()
        return pa.StructArray.from_arrays([pa.array([x[i] for x in found], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))], names=["lang", "score", "rejected"])

    return judged(text.cast("string"))
