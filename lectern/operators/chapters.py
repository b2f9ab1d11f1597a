"""Chapter headings, back matter and readable bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import SPACE, heading_title, number_key, title_case, trimmed, unix_lines, words
from lectern.operators.structure import line_words

# Heading forms, and words that open front and back matter.
KEYWORD = rf"(?i)^(chapter|chap|book|part|letter|canto|stave|volume|section)\.?[{SPACE}]+(?:no\.?[{SPACE}]*)?([0-9]{{1,3}}|[ivxlcdm]+)[.):\]]*(?:[{SPACE}]+(.+))?\z"
STANDALONE = rf"(?i)^(prologue|epilogue|introduction|preface|foreword|afterword|conclusion)\.?(?:[{SPACE}]+(.+))?\z"
ROMAN_TITLE = rf"^([IVXLCDM]+)\.[{SPACE}]+([A-Z][^a-z]*[A-Za-z].*)\z"
BARE_ROMAN = r"^([IVXLCDM]+)\.?\z"
BARE_NUMBER = r"^([0-9]{1,3})\.?\z"
STRONG_START = "^[A-Z0-9\"'(\\[“‘]"
BACK_MATTER = r"(?i)^(index|glossary|bibliography|colophon|advertisements?|ads|further reading|list of (illustrations|figures|tables)|transcriber'?s note)(?![A-Za-z0-9_])"
SKIP_FRONT = r"(?i)^(table of contents|contents|list of (illustrations|figures|tables)|illustrations|figures|title page|copyright|publisher'?s note)(?![A-Za-z0-9_])"
SKIP_BACK = r"(?i)^(index|glossary|advertisements?|ads|colophon|bibliography|further reading|appendix)(?![A-Za-z0-9_])"

DIALECTS = ("keyword", "roman-title", "bare-roman", "bare-numeric")
LEAST_CHAPTERS = 3
BACK_FROM, BACK_CHARS = 0.55, 40


def lines(books: DataFrame, key: str = "book_id", text: str = "text") -> DataFrame:
    """Each line with its number, trimmed text, number of tokens (n) and the id of its first token (WIN-05). A null text is one empty line."""
    cut = books.select(key, text).repartition(key).select(key, F.transform(F.split(unix_lines(F.coalesce(text, F.lit(""))), "\n"), trimmed).alias("trimmed"))
    counted = cut.withColumn("c", line_words(F.col("trimmed")))
    return counted.select(key, F.posexplode(F.arrays_zip("trimmed", "c")).alias("line", "l")).select(key, "line", "l.trimmed", "l.c.n", "l.c.word_index")


def plausible_title(rest: Column) -> Column:
    return (rest == "") | ((F.length(trimmed(rest)) <= 60) & trimmed(rest).rlike(STRONG_START))


def headings(lines: DataFrame) -> DataFrame:
    """Lines that look like a heading, with dialect, title, key and kind (TXT-04, TXT-05)."""
    t = F.col("trimmed")
    part = lambda pattern, i: F.regexp_extract(t, pattern, i)
    joined = lambda name, rest: F.when(heading_title(rest) == "", name).otherwise(F.concat(name, F.lit(" — "), title_case(heading_title(rest))))
    numbered = t.rlike(KEYWORD) & plausible_title(part(KEYWORD, 3))
    alone = t.rlike(STANDALONE) & plausible_title(part(STANDALONE, 2))
    kind = F.lower(part(KEYWORD, 1))
    form = lambda dialect, title, key, kind: F.struct(F.lit(dialect).alias("dialect"), title.alias("title"), key.alias("key"), kind.alias("kind"))
    chapter = F.lit("chapter")
    found = (
        F.when(numbered, form("keyword", joined(F.concat(title_case(kind), F.lit(" "), F.upper(part(KEYWORD, 2))), part(KEYWORD, 3)), F.concat(kind, F.lit(":"), number_key(part(KEYWORD, 2))), kind))
        .when(alone, form("keyword", joined(title_case(part(STANDALONE, 1)), part(STANDALONE, 2)), F.lower(part(STANDALONE, 1)), F.lower(part(STANDALONE, 1))))
        .when(t.rlike(ROMAN_TITLE), form("roman-title", F.concat(part(ROMAN_TITLE, 1), F.lit(". "), title_case(part(ROMAN_TITLE, 2))), number_key(part(ROMAN_TITLE, 1)), chapter))
        .when(t.rlike(BARE_ROMAN), form("bare-roman", F.concat(F.lit("Chapter "), part(BARE_ROMAN, 1)), number_key(part(BARE_ROMAN, 1)), chapter))
        .when(t.rlike(BARE_NUMBER), form("bare-numeric", F.concat(F.lit("Chapter "), part(BARE_NUMBER, 1)), number_key(part(BARE_NUMBER, 1)), chapter))
    )
    return lines.filter("trimmed <> ''").withColumn("found", found).filter("found is not null").select("*", "found.*").drop("found")


def winning(found: DataFrame, key: str = "book_id") -> DataFrame:
    """Headings of the first dialect with LEAST_CHAPTERS different keys, with that number (n_chapters); all that it has."""
    rank = F.array_position(F.array(*map(F.lit, DIALECTS)), F.col("dialect"))
    kinds = F.size(F.collect_set("key").over(Window.partitionBy(key, "dialect")))
    ranked = found.withColumns({"rank": rank, "n_chapters": kinds}).filter(F.col("n_chapters") >= LEAST_CHAPTERS)
    return ranked.withColumn("best", F.min("rank").over(Window.partitionBy(key))).filter("rank = best").drop("best", "rank")


def chapters(found: DataFrame, key: str = "book_id") -> DataFrame:
    """Chapters of each book that has any: of each key the last heading, in order (TXT-03)."""
    last = F.max_by(F.struct("title", "word_index", "line"), "line")
    kept = winning(found, key).groupBy(key, "dialect", "key").agg(last.alias("c")).select(key, "dialect", "c.*")
    confidence = F.when(F.col("dialect").isin("keyword", "roman-title"), "high").otherwise("medium")
    return kept.select(key, (F.row_number().over(Window.partitionBy(key).orderBy("word_index", "line")) - 1).alias("chapter"), "title", "word_index", "line", "dialect", confidence.alias("confidence"))


def back_matter(lines: DataFrame, totals: DataFrame, key: str = "book_id") -> DataFrame:
    """(key, back_start): first token of the first short back matter line in the last part of a book (TXT-06)."""
    short = lines.filter((F.length("trimmed") <= BACK_CHARS) & F.col("trimmed").rlike(BACK_MATTER))
    late = short.join(totals, key).filter(F.col("word_index") >= F.col("total") * BACK_FROM)
    return late.groupBy(key).agg(F.min_by("word_index", "line").alias("back_start"))


def readable_bounds(chapters: DataFrame, totals: DataFrame, back: DataFrame, key: str = "book_id") -> DataFrame:
    """First and last token to read of every book in totals (key, total) (TXT-07)."""
    plain = F.regexp_replace(F.lower(trimmed(F.col("title"))), rf"[.:;\-{SPACE}]+\z", "")
    flagged = chapters.withColumns({"front": plain.rlike(SKIP_FRONT), "rear": plain.rlike(SKIP_BACK)})
    one = flagged.groupBy(key).agg(
        F.first("confidence").alias("confidence"),
        F.count("*").alias("n"),
        F.min(F.when(~F.col("front"), F.struct("chapter", "word_index"))).alias("first_read"),
        F.max(F.when(~F.col("rear"), F.col("chapter"))).alias("last_read"),
        F.min(F.struct("chapter", "front")).alias("opening"),
        F.max(F.struct("chapter", "rear")).alias("closing"),
        F.map_from_entries(F.collect_list(F.struct("chapter", "word_index"))).alias("starts"),
    )
    all_ = totals.join(one, key, "left").join(back, key, "left")
    end = F.greatest(F.col("total") - 1, F.lit(0))
    known = F.col("confidence").isNotNull() & (F.col("n") >= LEAST_CHAPTERS) & (F.col("total") > 0)
    high = F.col("confidence") == "high"
    moved = known & F.col("first_read").isNotNull() & (high | F.col("opening.front"))
    start = F.when(moved, F.col("first_read.word_index")).otherwise(0)
    following = F.try_element_at("starts", (F.col("last_read") + 1).cast("int"))
    cut = known & F.col("last_read").isNotNull() & following.isNotNull() & (high | F.col("closing.rear"))
    stop = F.when(cut, F.greatest(start, following - 1)).otherwise(end)
    stop = F.when(known & (F.col("back_start") > start), F.greatest(start, F.least(stop, F.col("back_start") - 1))).otherwise(stop)
    return all_.select(key, F.col("total").cast("long").alias("total"), F.coalesce("confidence", F.lit("none")).alias("confidence"), F.least(start, end).cast("long").alias("readable_start"), F.least(stop, end).cast("long").alias("readable_end"))


def totals(books: DataFrame, key: str = "book_id", text: str = "text") -> DataFrame:
    return books.select(key, F.size(words(F.col(text))).alias("total"))


def totals_of(lines: DataFrame, key: str = "book_id") -> DataFrame:
    """(key, total) told from the lines, which a plan that has them already needn't scan again for."""
    return lines.groupBy(key).agg(F.sum("n").cast("int").alias("total"))


def chapter_spans(chapters: DataFrame, totals: DataFrame, key: str = "book_id") -> DataFrame:
    """Chapters with their last token (WIN-06), after a Frontmatter row where the first starts late."""
    order = Window.partitionBy(key).orderBy("word_index", "chapter")
    front = chapters.filter("chapter = 0 and word_index > 0").withColumns({"chapter": F.lit(-1), "title": F.lit("Frontmatter"), "word_index": F.lit(0).cast("long")})
    every = chapters.unionByName(front).join(totals, key)
    return every.withColumn("end_index", F.coalesce(F.lead("word_index").over(order) - 1, F.col("total") - 1))
