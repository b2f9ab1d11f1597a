"""As-of lookups over positions, by one union and one window: probes find starts without a range join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _merged(probes: DataFrame, starts: DataFrame, keys: list[str], at: str, shift: int, start_order: int) -> DataFrame:
    """Probes (kind 0, at `at` + shift) and starts (kind start_order) in one table, each row whole in a struct."""
    p = probes.select(*keys, (F.col(at) + shift).alias("_at"), F.lit(0).alias("_kind"), F.struct(*probes.columns).alias("_probe"), F.lit(None).alias("_start"))
    s = starts.select(*keys, F.col(at).alias("_at"), F.lit(start_order).alias("_kind"), F.lit(None).alias("_probe"), F.struct(*starts.columns).alias("_start"))
    return p.unionByName(s)


def backward(probes: DataFrame, starts: DataFrame, keys: list[str], at: str, shift: int = 0, strict: bool = False) -> DataFrame:
    """Each probe's columns, and as struct `found` its last start at or before (strict: before) position at + shift (JN-05..07, JN-09)."""
    both = _merged(probes, starts, keys, at, shift, 1 if strict else -1)
    before = Window.partitionBy(*keys).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("found", F.last("_start", ignorenulls=True).over(before)).filter("_kind = 0").select("_probe.*", "found")


def _following(keys: list[str]) -> Column:
    """The nearest start behind, read from the end: a frame that only grows is gone through once."""
    order = Window.partitionBy(*keys).orderBy(F.desc("_at"), "_kind").rowsBetween(Window.unboundedPreceding, 0)
    return F.last("_start", ignorenulls=True).over(order)


def forward(probes: DataFrame, starts: DataFrame, keys: list[str], at: str, shift: int = 0) -> DataFrame:
    """Each probe's columns, and as struct `found` its first start after position at + shift (JN-08)."""
    both = _merged(probes, starts, keys, at, shift, 1)
    return both.withColumn("found", _following(keys)).filter("_kind = 0").select("_probe.*", "found")


def around(probes: DataFrame, starts: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Each probe's columns, and as structs `before` and `after` its nearest starts on either side, none at its own position (JN-10)."""
    both = _merged(probes, starts, keys, at, 0, 1)
    before = Window.partitionBy(*keys).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumns({"before": F.last("_start", ignorenulls=True).over(before), "after": _following(keys)})
    return both.filter("_kind = 0").select("_probe.*", "before", "after")


def nearest(starts: Column, at: Column) -> tuple[Column, Column]:
    """Of a list of starts the last before a position and the first behind it, null where there is none (JN-10)."""
    return F.array_max(F.filter(starts, lambda s: s < at)), F.array_min(F.filter(starts, lambda s: s > at))


def percent(done: Column, total: Column) -> Column:
    """Whole percent from 0 to 100, half up; 0 of nothing (PRJ-09)."""
    return F.when(total > 0, F.least(F.lit(100), F.floor(100.0 * done / total + 0.5))).otherwise(0).cast("int")


def chapter_progress(probes: DataFrame, spans: DataFrame, totals: DataFrame, key: str = "book_id") -> DataFrame:
    """Chapter at each probe (key, word_index) with its span and the part read; a book without chapters is one (JN-07)."""
    found = backward(probes, spans, [key], "word_index").join(totals, key)
    start = F.coalesce("found.word_index", F.lit(0))
    end = F.coalesce("found.end_index", F.col("total") - 1)
    size = end - start + 1
    inside = F.col("word_index") - start
    return found.select(key, "word_index", F.coalesce("found.title", F.lit("Whole book")).alias("title"), start.alias("start_index"), end.alias("end_index"), inside.alias("in_chapter"), percent(inside, size).alias("percent"))


def neighbour_chapters(probes: DataFrame, chapters: DataFrame, totals: DataFrame, key: str = "book_id") -> DataFrame:
    """Start of the next chapter past the next word, else the last word; and of the chapter before the last word, else 0 (JN-08, JN-09)."""
    starts = chapters.select(key, "word_index")
    after = forward(probes, starts, [key], "word_index", 1).select(key, "word_index", F.col("found.word_index").alias("next"))
    both = backward(after, starts, [key], "word_index", -1, strict=True).join(totals, key)
    return both.select(key, "word_index", F.coalesce("next", F.col("total") - 1).alias("next_start"), F.coalesce("found.word_index", F.lit(0)).alias("previous_start"))


def resume_position(explicit: Column, authored: Column, readable: Column, total: Column) -> Column:
    """Saved position above 0, else the authored start within the book, else the readable start, else 0 (PRJ-14)."""
    return F.when(explicit > 0, explicit).when(authored < total, authored).when(readable > 0, readable).otherwise(0)


def neighbour_sentences(probes: DataFrame, tokens: DataFrame, totals: DataFrame, key: str = "doc_id") -> DataFrame:
    """Start of the next sentence after each probe (key, id), else the last token; and of one before it, else 0 (JN-10)."""
    starts = tokens.filter("sentence_start").select(key, "id")
    both = around(probes, starts, [key], "id").join(totals, key)
    return both.select(key, "id", F.coalesce("after.id", F.col("total") - 1).cast("long").alias("next_start"), F.coalesce("before.id", F.lit(0)).cast("long").alias("previous_start"))


def paragraph_at(probes: DataFrame, paragraphs: DataFrame, key: str = "book_id") -> DataFrame:
    """The paragraph (key, id, paragraph) that holds or last began before each probe (key, id); 0 before all (JN-06)."""
    return backward(probes, paragraphs, [key], "id").select(key, "id", F.coalesce("found.paragraph", F.lit(0)).cast("long").alias("paragraph"))
