"""Documents as token, sentence and paragraph tables, and their playback schedule.

Every positional table shares one id space: token ids count words from 0 and skip paragraph marks. Sentences and
paragraphs are told from each text's own array of words: texts are dealt out by id once, and no tokens are shuffled,
sorted or held but those of one text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import PARAGRAPH, SPACES, bound, clean_word, delay_units, dwell_tenths, ends_sentence, raw_words, words

BEFORE = (Window.unboundedPreceding, -1)


def dwell_by_document(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Token count, total dwell in tenths and sentence ends of each document, without exploding it (FN-03, AGG-18).

    A blank or null text is one empty token.
    """
    w = docs.select(key, words(F.coalesce(text, F.lit(""))).alias("w"))
    total = F.aggregate("w", F.lit(0).cast("long"), lambda a, x: a + dwell_tenths(x))
    return w.select(key, F.size("w").cast("long").alias("n_tokens"), total.alias("dwell_tenths"), F.size(F.filter("w", ends_sentence)).cast("long").alias("sentence_ends"))


def running(numbers: Column) -> Column:
    """Of a list of whole numbers the sums of those before each."""

    @F.arrow_udf("array<long>")
    def sums(lists: pa.Array) -> pa.Array:
        at, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype(np.int64)
        before = np.concatenate([[0], np.cumsum(values)])
        shifted = before[at[0] : at[-1]] - np.repeat(before[at[:-1]], np.diff(at))
        return pa.ListArray.from_arrays(pa.array(at - at[0], pa.int32()), pa.array(shifted))

    return sums(numbers.cast("array<long>"))


_BLANK, _LEAD = np.zeros(256, bool), np.zeros(256, bool)
_BLANK[[ord(c) for c in SPACES if c < "\x80"]] = True
_LEAD[[c.encode()[0] for c in SPACES if c >= "\x80"]] = True
_WIDE = np.array([ord(c) for c in SPACES if c >= "\u0800"])


class _Words:
    """Where words begin in the bytes of some texts: `at` over all, `first` and one more the numbers of each text's own; marks are left out if told so."""

    def __init__(self, texts: pa.Array, marks: bool = True):
        wide = pa.types.is_large_string(texts.type)
        ends = np.frombuffer(texts.buffers()[1] or b"", np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        ends = ends if len(ends) else np.zeros(1, np.int64)
        self.data = data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        self.ends = ends = ends - ends[0]
        self.blank = blank = _BLANK[data]
        lead = np.flatnonzero(_LEAD[data])
        two = lead[data[lead] == 0xC2]
        two = two[data[two + 1] == 0xA0]
        three = lead[data[lead] >= 0xE0]
        code = (data[three].astype(int) & 15) << 12 | (data[three + 1].astype(int) & 63) << 6 | data[three + 2].astype(int) & 63
        three = three[np.isin(code, _WIDE)]
        for i in (two, two + 1, three, three + 1, three + 2):
            blank[i] = True
        edge = np.ones(len(data) + 1, bool)  # a blank or the end of a text lies before
        edge[1:] = blank
        edge[ends] = True
        at = np.flatnonzero(~blank & edge[:-1])
        if not marks:
            may = at[at + 3 <= len(data)]
            is_mark = (data[may] == 0x5B) & (data[may + 1] == 0x50) & (data[may + 2] == 0x5D) & ~edge[may + 1] & ~edge[may + 2]
            may = may[is_mark]
            over = edge[may + 3] | np.append(blank, True)[may + 3]
            at = np.setdiff1d(at, may[over], assume_unique=True)
        self.at, self.first = at, np.searchsorted(at, ends)

    def some(self, text: int, start: int, n: int) -> str:
        """n words of a text from the one of that number, joined by blanks."""
        lo, end = self.first[text] + start, self.ends[text + 1]
        found = []
        for a in self.at[lo : min(lo + n, self.first[text + 1])]:
            stop = self.blank[a:end].argmax()
            found.append(self.data[a : a + stop if stop else end].tobytes().decode())
        return " ".join(found)


def line_words(lines: Column) -> Column:
    """Of a list of trimmed lines the number of words in each (n) and in those before it (word_index)."""

    @F.arrow_udf("array<struct<n:int,word_index:bigint>>")
    def counted(lists: pa.Array) -> pa.Array:
        of = lists.offsets.to_numpy()
        first = _Words(lists.flatten()).first
        of, before = of - of[0], first[:-1]
        shifted = before - np.repeat(first[of[:-1] - of[0]], np.diff(of))
        return pa.ListArray.from_arrays(pa.array(of, pa.int32()), pa.StructArray.from_arrays([pa.array(np.diff(first), pa.int32()), pa.array(shifted, pa.int64())], names=["n", "word_index"]))

    return counted(lines)


def n_words(text: Column) -> Column:
    """size(words(text)), without cutting it."""

    @F.arrow_udf("int")
    def count(texts: pa.Array) -> pa.Array:
        return pa.array(np.diff(_Words(texts, marks=False).first), pa.int32(), mask=~texts.is_valid().to_numpy(zero_copy_only=False))

    return F.when(count(text) > 0, count(text)).otherwise(F.size(words(text)))


def some_words(text: Column, start: Column, n: int) -> Column:
    """Up to n words of a text from the one of a number, joined by blanks; null of null."""

    @F.arrow_udf("string")
    def cut(texts: pa.Array, starts: pa.Array) -> pa.Array:
        w = _Words(texts, marks=False)
        return pa.array([w.some(i, at.as_py(), n) if ok.as_py() else None for i, (at, ok) in enumerate(zip(starts, texts.is_valid()))], pa.string())

    return cut(text, start)


def _followed(w: Column) -> Column:
    """Each word, marks left out, with what follows it (word, next)."""
    return F.filter(F.transform(w, lambda x, i: F.struct(x.alias("word"), F.get(w, i + 1).alias("next"))), lambda t: t["word"] != PARAGRAPH)


def _last(t: Column) -> Column:
    return t["next"].isNull() | (t["next"] == PARAGRAPH)


def units(docs: DataFrame, unit: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, w, units): the words of each text, and its sentences or paragraphs in order with first and last token id (TXT-01, WIN-01..04).

    A blank or null text is one empty token. A literal mark in the text is taken for a paragraph break.
    """
    is_end = _last if unit == "paragraph" else lambda t: _last(t) | ends_sentence(t["word"])
    ends = lambda t: F.filter(F.transform(t, lambda x, i: F.when(is_end(x), i)), lambda i: i.isNotNull())
    spans = lambda e: F.transform(e, lambda x, k: F.struct(F.coalesce(F.get(e, k - 1) + 1, F.lit(0)).alias("start_id"), x.alias("end_id")))
    found = bound(raw_words(F.coalesce(F.col(text), F.lit(""))), lambda w: bound(_followed(w), lambda t: F.struct(F.transform(t, lambda x: x["word"]).alias("w"), bound(ends(t), spans).alias("units"))))
    return docs.select(key, text).repartition(key).select(key, found.alias("_found")).select(key, "_found.*")


def tokens(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each token with its sentence, paragraph and flags (TXT-01, WIN-01..04).

    A blank or null text is one empty token. A literal mark in the text is taken for a paragraph break.
    """
    flagged = lambda t: F.transform(t, lambda x: F.struct(x["word"].alias("word"), _last(x).alias("paragraph_end"), (_last(x) | ends_sentence(x["word"])).alias("sentence_end")))
    raw = docs.select(key, text).repartition(key).select(key, bound(bound(raw_words(F.coalesce(F.col(text), F.lit(""))), _followed), flagged).alias("t"))
    count = lambda c: running(F.transform("t", lambda x: x[c].cast("long")))
    raw = raw.withColumns({"sentence": count("sentence_end"), "paragraph": count("paragraph_end")})
    rows = raw.select(key, F.posexplode(F.arrays_zip("t", "sentence", "paragraph", F.transform("t", lambda x, i: (i == 0) | F.get("t", i - 1)["sentence_end"]).alias("sentence_start"))).alias("id", "x"))
    rows = rows.select(key, "id", "x.t.*", "x.sentence", "x.paragraph", "x.sentence_start")
    return rows.select(key, "id", "word", clean_word(F.col("word")).alias("clean"), "sentence", "paragraph", "sentence_start", "sentence_end", "paragraph_end", dwell_tenths(F.col("word")).alias("tenths"))


def unit_spans(docs: DataFrame, unit: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """First and last token id and size of each sentence or paragraph (AGG-12)."""
    rows = units(docs, unit, key, text).select(key, F.posexplode("units").alias(unit, "u"))
    n = F.col("u.end_id") - F.col("u.start_id") + 1
    return rows.select(key, F.col(unit).cast("long").alias(unit), F.col("u.start_id").cast("long").alias("start_id"), F.col("u.end_id").cast("long").alias("end_id"), n.cast("long").alias("n_tokens"))


def sentence_schedule(docs: DataFrame, wpm: int = 300, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Start and end of each sentence in milliseconds, with fractions (WIN-15, FN-04, FN-05).

    Whole units are summed and divided once, so no rounding adds up over a text.
    """
    shown = lambda w, first: F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + delay_units(x, F.lit(first), wpm))
    of = lambda u: F.slice("w", u["start_id"] + 1, F.lit(1)), lambda u: F.slice("w", u["start_id"] + 2, u["end_id"] - u["start_id"])
    timed = units(docs, "sentence", key, text).select(key, F.transform("units", lambda u: shown(of[0](u), True) + shown(of[1](u), False)).alias("length"))
    rows = timed.withColumn("before", running(F.col("length"))).select(key, F.posexplode(F.arrays_zip("before", "length")).alias("sentence", "u"))
    return rows.select(key, F.col("sentence").cast("long").alias("sentence"), (F.col("u.before") / F.lit(float(wpm))).alias("start_ms"), ((F.col("u.before") + F.col("u.length")) / F.lit(float(wpm))).alias("end_ms"))


def sentence_openings(docs: DataFrame, reach: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, id, word, near): each sentence's first word, and as (id, word) the words within `reach` of it and itself, in order (WIN-10)."""
    low = lambda at: F.greatest(at - reach, F.lit(0))
    near = lambda at: F.transform(F.slice("w", low(at) + 1, at - low(at) + 1 + reach), lambda x, i: F.struct((low(at) + i).alias("id"), x.alias("word")))
    found = F.transform("units", lambda u: F.struct(u["start_id"].alias("id"), F.get("w", u["start_id"]).alias("word"), near(u["start_id"]).alias("near")))
    return units(docs, "sentence", key, text).select(key, F.explode(found).alias("s")).select(key, "s.*")


def spans(tokens: DataFrame, unit: str, key: str = "doc_id") -> DataFrame:
    """First and last token id and size of each sentence or paragraph (AGG-12)."""
    return tokens.groupBy(key, unit).agg(F.min("id").cast("long").alias("start_id"), F.max("id").cast("long").alias("end_id"), F.count("*").alias("n_tokens"))


def schedule(tokens: DataFrame, wpm: int = 300, key: str = "doc_id") -> DataFrame:
    """Start of each token in milliseconds and how long it shows, with fractions (WIN-15, FN-04, FN-05).

    Whole units are summed and divided once, so no rounding adds up over a text.
    """
    order = Window.partitionBy(key).orderBy("id").rowsBetween(*BEFORE)
    shown = tokens.withColumn("_units", delay_units(F.col("word"), F.col("sentence_start"), wpm))
    before = F.coalesce(F.sum("_units").over(order), F.lit(0))
    return shown.withColumns({"delay_ms": F.col("_units") / F.lit(float(wpm)), "start_ms": before / F.lit(float(wpm)), "end_ms": (before + F.col("_units")) / F.lit(float(wpm))}).drop("_units")


def neighbours(tokens: DataFrame, reach: int, fade: float, floor: float, key: str = "doc_id") -> DataFrame:
    """The words within `reach` of each token, and the opacity of the outermost (WIN-10)."""
    frame = Window.partitionBy(key).orderBy("id")
    around = F.collect_list("word").over(frame.rowsBetween(-reach, reach))
    return tokens.select("*", F.array_join(around, " ").alias("around"), edge_opacity(reach, fade, floor).alias("edge_opacity"))


def edge_opacity(reach: int, fade: float, floor: float) -> Column:
    """Opacity of the outermost of the words before a row's id."""
    return opacity(F.least(F.col("id"), F.lit(reach)), fade, floor)


def books(docs: DataFrame, front: str = "", back: str = "", block: int = 1000) -> DataFrame:
    """(book_id, text): the documents of a source in a block of ids, each a numbered chapter.

    A block holds at most `block` ids, so no book grows with the table. A null text is an empty chapter.
    """
    book = F.concat(F.col("source"), F.lit("-"), F.floor(F.col("doc_id") / block).cast("string"))
    parts = docs.groupBy(book.alias("book_id")).agg(F.array_sort(F.collect_list(F.struct("doc_id", "text"))).alias("parts"))
    chapters = F.transform("parts", lambda p, i: F.concat(F.lit("CHAPTER "), (i + 1).cast("string"), F.lit("\n\n"), F.coalesce(p["text"], F.lit(""))))
    return parts.select("book_id", F.concat(F.lit(front), F.array_join(chapters, "\n\n"), F.lit(back)).alias("text"))


#: Reach, fade and least opacity of the three ways to show neighbours.
FRAMES = {"ghost": (4, 0.2, 0.04), "line": (5, 0.4, 0.0), "sentence": (9, 0.16, 0.2)}


def faded_neighbours(tokens: DataFrame, frame: str, key: str = "doc_id") -> DataFrame:
    """Each token's neighbours as (distance, word, opacity), nearest first and the earlier before the later (WIN-10)."""
    reach, fade, floor = FRAMES[frame]
    order = Window.partitionBy(key).orderBy("id")
    near = F.collect_list(F.struct("id", "word")).over(order.rowsBetween(-reach, reach))
    return tokens.withColumn("near", faded(near, fade, floor))


def opacity(distance: Column, fade: float, floor: float) -> Column:
    return F.greatest(F.lit(floor), 1 - fade * distance)


def faded(near: Column, fade: float, floor: float) -> Column:
    """Of the (id, word) near a row's id as (distance, id, word, opacity), nearest first and the earlier before the later, without its own."""
    far = lambda x: F.abs(x["id"] - F.col("id"))
    shown = lambda x: F.struct(far(x).cast("long").alias("distance"), x["id"].cast("long").alias("id"), x["word"].alias("word"), opacity(far(x), fade, floor).alias("opacity"))
    return F.array_sort(F.transform(F.filter(near, lambda x: x["id"] != F.col("id")), shown))
