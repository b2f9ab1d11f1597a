"""Annotations of texts: labelled scenes, snippets from anchors, and how sources of one fact are ranked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import SPACE, number_key, title_case, trimmed
from lectern.operators.chapters import STRONG_START
from lectern.operators.story import anchor_index, spaced

# Headings that give a scene its label. Here roman numerals count in either case.
NUMBERED = rf"(?i)^(chapter|chap|book|part|letter|canto|stave|volume|section)\.?[{SPACE}]+([0-9]{{1,9}}|[ivxlcdm]+)[.):\]]*(?:[{SPACE}]+(.+))?\z"
ROMAN_LABEL = rf"(?i)^([ivxlcdm]+)\.[{SPACE}]+([A-Z].{{1,56}})\z"
BARE = r"(?i)^([ivxlcdm]+|[0-9]{1,3})\.?\z"
ALONE = r"(?i)^(prologue|epilogue|introduction|preface|foreword|afterword|conclusion)\.?\z"
SCENE_WORD = rf"(?i)^(chapter|letter|part|book|stave|canto|act|scene)(?![A-Za-z0-9_])[.:{SPACE}]*"

SHORT, STORY = (150, 420), (600, 1700)
SNIPPET_DEPTH, START_DEPTH, SHIFT = 0.8, 0.45, 20


def clean_label(text: Column) -> Column:
    """Without emphasis marks, with single blanks, in title case if it was all capitals (FN-15)."""
    plain = F.regexp_replace(F.regexp_replace(text, "[_*]", ""), rf"[{SPACE}]+", " ")
    plain = trimmed(F.regexp_replace(plain, rf"[.{SPACE}]+\z", ""))
    return F.when((plain == F.upper(plain)) & plain.rlike("[A-Z]"), title_case(plain)).otherwise(plain)


def scene_title(text: Column) -> Column:
    """A heading without its leading word and marks (FN-16)."""
    return trimmed(F.regexp_replace(F.regexp_replace(text, SCENE_WORD, ""), r"[_*\[\]]", ""))


def stands_alone(line: Column) -> Column:
    """Whether a line may be a title by itself (FLT-12)."""
    return (line != "") & (F.length(line) <= 50) & ~line.rlike(r"^[\[(]") & line.rlike("^[A-Z“\"'0-9]") & ~line.rlike(r"[,;:]\z") & (F.size(F.split(line, rf"[{SPACE}]+")) <= 9)


def labelled_scenes(lines: DataFrame, key: str = "book_id") -> DataFrame:
    """(key, start_index, label) for headings that are far enough apart (TXT-13); a bare one takes the next line (WIN-18)."""
    order = Window.partitionBy(key).orderBy("line")
    t = F.col("trimmed")
    ahead = F.first(F.when(t != "", t), ignorenulls=True).over(order.rowsBetween(1, 3))
    lines = lines.withColumn("ahead", F.coalesce(ahead, F.lit("")))
    part = lambda pattern, i: F.regexp_extract(t, pattern, i)
    named = lambda number: F.when(stands_alone(F.col("ahead")), clean_label(F.col("ahead"))).otherwise(F.concat(F.lit("Chapter "), number_key(number)))
    rest = trimmed(part(NUMBERED, 3))
    label = (
        F.when(t.rlike(NUMBERED), F.when((rest != "") & rest.rlike(STRONG_START) & (F.length(rest) <= 58), clean_label(rest)).otherwise(named(part(NUMBERED, 2))))
        .when(t.rlike(ROMAN_LABEL), clean_label(part(ROMAN_LABEL, 2)))
        .when(t.rlike(BARE), named(part(BARE, 1)))
        .when(t.rlike(ALONE), title_case(part(ALONE, 1)))
    )
    found = lines.filter((t != "") & (F.length(t) <= 70)).select(key, F.col("word_index").cast("long").alias("start_index"), label.alias("label")).filter("label is not null")
    listed = found.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("start_index", "label"))).alias("all"))
    kept = listed.withColumn("kept", spaced(F.transform("all", lambda s: s["start_index"]))).select(key, "kept", F.explode("all").alias("s"))
    return kept.filter(F.array_contains("kept", F.col("s.start_index"))).select(key, "s.*")


def resolved_scenes(docs: DataFrame, anchors: DataFrame, key: str = "book_id", words: str = "w") -> DataFrame:
    """Anchors (key, ordinal, anchor, label) with token id, and flags for missing and out of order ones (TXT-12, WIN-14).

    One out of order is kept and becomes what the next is held against.
    """
    found = anchors.join(docs.select(key, words), key).withColumn("start_index", anchor_index(F.col(words), F.col("anchor"))).drop(words)
    before = F.last("start_index", ignorenulls=True).over(Window.partitionBy(key).orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1))
    return found.withColumns({"out_of_order": F.coalesce(F.col("start_index") <= before, F.lit(False)), "missing": F.col("start_index").isNull()})


def word_count(text: Column) -> Column:
    return F.size(F.split(trimmed(text), rf"[{SPACE}]+"))


def with_snippet(rows: DataFrame, w: Column, anchor: Column, end_anchor: Column, words: Column, bounds: tuple[int, int]) -> DataFrame:
    """rows with `start` and `words` of a passage between two anchors, or nulls (TXT-16, FLT-15).

    The first anchor has 4 words or more and is in the first 80 %; the length is told by the end anchor, else by
    `words`; one outside the bounds is rejected rather than guessed. Anchors are looked for a column at a time, so
    that none is looked for twice.
    """
    own = rows.columns
    rows = rows.withColumns({"_w": w, "_a": anchor, "_e": end_anchor, "_said": words})
    rows = rows.withColumn("_start", F.when(word_count(F.col("_a")) >= 4, anchor_index(F.col("_w"), F.col("_a"))))
    rows = rows.withColumn("_start", F.when(F.col("_start") <= F.size("_w") * SNIPPET_DEPTH, F.col("_start")))
    rest = F.slice("_w", F.col("_start") + 2, F.greatest(F.size("_w") - F.col("_start") - 1, F.lit(0)))
    rows = rows.withColumn("_after", F.when(F.col("_start").isNotNull() & (word_count(F.col("_e")) >= 4), anchor_index(rest, F.col("_e"))))
    rows = rows.withColumn("_size", F.coalesce(F.col("_after") + 1 + word_count(F.col("_e")), F.when(F.col("_said") > 0, F.col("_said"))))
    good = F.col("_start").isNotNull() & F.col("_size").between(*bounds)
    return rows.select(*own, F.when(good, F.col("_start")).alias("start"), F.when(good, F.least("_size", F.size("_w") - F.col("_start"))).alias("words"))


def clamped_snippet(w: Column, anchor: Column, words: Column) -> Column:
    """The older form: 300 to 800 words, 550 if not said (TXT-17)."""
    start = anchor_index(w, anchor)
    size = F.greatest(F.lit(300), F.least(F.lit(800), F.coalesce(words, F.lit(550))))
    return F.when(start.isNotNull(), F.struct(start.alias("start"), F.least(size, F.size(w) - start).alias("words")))


def accepted_start(w: Column, anchor: Column) -> Column:
    """Token id of a verified start: 4 words or more, in the first 45 % (FLT-16)."""
    start = anchor_index(w, anchor)
    return F.when((word_count(anchor) >= 4) & (start <= F.size(w) * START_DEPTH), start)


def moved_materially(old: Column, new: Column) -> Column:
    return F.abs(new - old) > SHIFT


def by_precedence(key: str, *sources: tuple[str, DataFrame]) -> DataFrame:
    """Each key's value from the first source that has it, and which that was (JN-16). Sources: (name, rows of key and value)."""
    every = None
    for i, (name, rows) in enumerate(sources):
        ranked = rows.filter(F.col("value").isNotNull()).select(key, "value", F.lit(i).alias("rank"), F.lit(name).alias("source"))
        every = ranked if every is None else every.unionByName(ranked)
    return every.groupBy(key).agg(F.min_by(F.struct("value", "source"), "rank").alias("r")).select(key, "r.*")


def replace_groups(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rebuilt groups in place of those with their key, and new ones (JN-17, JN-18)."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def in_order(ids: Column, rows: DataFrame, lists: DataFrame, key: str = "id") -> DataFrame:
    """Rows of hand-picked ids in the order of the list; unknown ids drop out (JN-11)."""
    return lists.select(F.posexplode(ids).alias("place", key)).join(rows, key)


def passage(w: Column, start: Column, n: Column) -> Column:
    """Words from start on (JN-19)."""
    return F.array_join(F.slice(w, start + 1, n), " ")


def outcome_counts(rows: DataFrame, outcome: str = "outcome") -> DataFrame:
    """Rows seen, by what became of them (AGG-06, AGG-10)."""
    return rows.groupBy(outcome).agg(F.count("*").alias("n"))


def first_of(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each key (AGG-13, SET-06)."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(order)).alias("r")).select(*keys, "r.*")


def flags(base: DataFrame, key: str, **stores: DataFrame) -> DataFrame:
    """base with one list of the stores that hold each key (JN-14)."""
    out = base
    for name, store in stores.items():
        out = out.join(store.select(key).distinct().withColumn(f"_{name}", F.lit(name)), key, "left")
    return out.withColumn("flags", F.array_compact(F.array(*[f"_{n}" for n in stores]))).drop(*[f"_{n}" for n in stores])
