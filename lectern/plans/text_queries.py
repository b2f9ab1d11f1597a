"""Queries over the structure of texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import text as fn
from lectern.operators import chapters as ch
from lectern.operators import structure as st
from lectern.plans import sql
from lectern.plans.common import table

FRONT = "CONTENTS\n\nCHAPTER 1\nCHAPTER 2\nCHAPTER 3\n\n"
BACK = "\n\nINDEX\n\nalpha, 1\nomega, 2"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def rich_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Books with a page of contents before and an index behind their chapters."""
    return st.books(documents(spark, sf_dir), FRONT, BACK)


def token_dwell_by_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.dwell_by_document(documents(spark, sf_dir))


def focal_split_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct word, how often it occurs, and its focal letter in two modes."""
    words = documents(spark, sf_dir).select(F.explode(fn.words(F.col("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    third, big = fn.split_word(F.col("word")), fn.focal_index(F.col("word"), "centerBig")
    return words.select("word", "n", fn.clean_word(F.col("word")).alias("clean"), fn.focal_index(F.col("word")).alias("focal_index"), big.alias("focal_index_big"), third["before"].alias("before"), third["focal"].alias("focal"), third["after"].alias("after"))


def sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.unit_spans(documents(spark, sf_dir), "sentence")


def paragraph_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.unit_spans(st.books(documents(spark, sf_dir)), "paragraph", "book_id")


def playback_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When each sentence starts and ends at 300 words a minute."""
    shown = st.sentence_schedule(documents(spark, sf_dir))
    return shown.select("doc_id", "sentence", *[F.col(c).cast("long").alias(c) for c in ("start_ms", "end_ms")])


def playback_schedule_350(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same at 350 words a minute, where times have fractions."""
    shown = st.sentence_schedule(documents(spark, sf_dir), 350)
    return shown.select("doc_id", "sentence", *[F.round(c, 6).alias(c) for c in ("start_ms", "end_ms")])


def neighbour_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four words on each side of every sentence's first word."""
    near = st.sentence_openings(documents(spark, sf_dir), 4)
    around = F.array_join(F.transform("near", lambda x: x["word"]), " ")
    return near.select("doc_id", F.col("id").cast("long").alias("id"), "word", around.alias("around"), F.round(st.edge_opacity(4, 0.2, 0.04), 6).alias("edge_opacity"))


def chapter_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ch.chapters(ch.headings(ch.lines(rich_books(spark, sf_dir))))
    return found.select("book_id", F.col("chapter").cast("long").alias("chapter"), "title", F.col("word_index").cast("long").alias("word_index"), F.col("line").cast("long").alias("line"), "dialect", "confidence")


def readable_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bounds_of(rich_books(spark, sf_dir))


def bounds_of(books: DataFrame) -> DataFrame:
    """Chapters, back matter and totals from one pass over the lines."""
    lines = ch.lines(books)
    totals = ch.totals_of(lines)
    return ch.readable_bounds(ch.chapters(ch.headings(lines)), totals, ch.back_matter(lines, totals))


#: Books whose parts are no numbered chapters alone: a title page, contents, a foreword that is read, and behind them an epilogue that is read and an index that isn't.
WHALE = "THE GREAT WHALE\n\nA Novel\n\nCopyright 1899 by Some Publisher.\n\nCONTENTS\n\nChapter 1\n\nChapter 2\n\nFOREWORD\n\n" + " ".join(["These words are read."] * 9) + "\n\n"
WRECK = "\n\nEPILOGUE\n\n" + " ".join(["One survived to tell."] * 9) + "\n\nINDEX\n\nAhab, 12, 45. Whale, passim."


def authored_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readable bounds of books that open with a foreword and close with an epilogue and an index (TXT-06, TXT-07)."""
    return bounds_of(st.books(documents(spark, sf_dir), WHALE, WRECK))


_LINES = f"""
line_r AS (SELECT book_id, unnest(range(0, len(l))) AS line, unnest(l) AS raw FROM (SELECT book_id, string_split({sql.UNIX("text")}, chr(10)) AS l FROM book)),
line_n AS (SELECT book_id, line, {sql.TRIM("raw")} AS t, CASE WHEN {sql.TRIM("raw")} = '' THEN 0 ELSE len(string_split_regex({sql.TRIM("raw")}, '[{fn.SPACE}]+')) END AS n FROM line_r),
line AS (SELECT book_id, line, t, CAST(coalesce(sum(n) OVER (PARTITION BY book_id ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS word_index FROM line_n)"""
# the derived books have arabic chapter lines only; other dialects are tested against a model in tests/
_KEYWORD = "(?i)^(chapter|chap|book|part|letter|canto|stave|volume|section)\\.?\\s+(?:no\\.?\\s*)?([0-9]{1,3}|[ivxlcdm]+)[.):\\]]*(?:\\s+(.+))?$"
_BACK = "(?i)^(index|glossary|bibliography|colophon|advertisements?|ads|further reading|list of (illustrations|figures|tables)|transcriber''s note)\\b"
_CHAPTERS = f"""{_LINES},
head_m AS (SELECT *, regexp_extract(t, '{_KEYWORD}', 1) AS kind, regexp_extract(t, '{_KEYWORD}', 2) AS num, {sql.TRIM(f"regexp_extract(t, '{_KEYWORD}', 3)")} AS rest FROM line WHERE regexp_matches(t, '{_KEYWORD}')),
head AS (
    SELECT book_id, line, word_index, lower(kind) || ':' || {sql.number_key("num")} AS key, lower(kind) AS kind,
        {sql.title_case("kind")} || ' ' || upper(num) || CASE WHEN rest = '' THEN '' ELSE ' — ' || {sql.title_case("regexp_replace(rest, '[.\\]\\s]+$', '')")} END AS title
    FROM head_m WHERE rest = '' OR (length(rest) <= 60 AND regexp_matches(rest, '^[A-Z0-9"''(\\[“‘]'))
),
chap AS (
    SELECT book_id, row_number() OVER (PARTITION BY book_id ORDER BY word_index, line) - 1 AS chapter, title, word_index, line, 'keyword' AS dialect, 'high' AS confidence
    FROM (SELECT *, row_number() OVER (PARTITION BY book_id, key ORDER BY line DESC) AS r, count(*) OVER (PARTITION BY book_id) AS many FROM head) WHERE r = 1
    AND book_id IN (SELECT book_id FROM head GROUP BY book_id HAVING count(DISTINCT key) >= 3)
)"""
_TOTALS = f"total AS (SELECT book_id, len(list_filter({sql.WORDS('text')}, lambda x: x <> '[P]')) AS total FROM book)"

QUERIES = {f.__name__: f for f in (token_dwell_by_doc, focal_split_words, sentence_spans, paragraph_spans, playback_schedule, playback_schedule_350, neighbour_words, chapter_detect, readable_bounds, authored_bounds)}

ORACLE_SQL = {
    "token_dwell_by_doc": f"""
WITH {sql.tokens("documents")}
SELECT doc_id, count(*) AS n_tokens, CAST(sum({sql.TENTHS}) AS BIGINT) AS dwell_tenths, count(*) FILTER (right(word, 1) IN ('.', '!', '?')) AS sentence_ends
FROM tok GROUP BY doc_id""",
    "focal_split_words": f"""
WITH {sql.tokens("documents")}, w AS (
    SELECT word, count(*) AS n, length(word) AS len FROM tok GROUP BY word
), f AS (SELECT *, CAST(CASE WHEN len <= 1 THEN 0 WHEN len <= 5 THEN 1 WHEN len <= 9 THEN 2 WHEN len <= 13 THEN 3 ELSE (len * 3) // 10 END AS INT) AS at3 FROM w)
SELECT word, n, translate(word, '.,!?;:', '') AS clean, at3 AS focal_index, CAST(CASE WHEN len >= 11 THEN len // 2 ELSE at3 END AS INT) AS focal_index_big,
    substr(word, 1, at3) AS before, substr(word, at3 + 1, 1) AS focal, substr(word, at3 + 2) AS after
FROM f""",
    "sentence_spans": f"WITH {sql.tokens('documents')} SELECT doc_id, sentence, min(id) AS start_id, max(id) AS end_id, count(*) AS n_tokens FROM tok GROUP BY doc_id, sentence",
    "paragraph_spans": f"WITH {sql.books()}, {sql.tokens('book', 'book_id')} SELECT book_id, paragraph, min(id) AS start_id, max(id) AS end_id, count(*) AS n_tokens FROM tok GROUP BY book_id, paragraph",
    "playback_schedule": f"""
WITH {sql.tokens("documents")}, d AS (
    SELECT *, CASE WHEN sentence_start THEN ({sql.TENTHS}) * 36 + 500 ELSE ({sql.TENTHS}) * 20 END AS delay FROM tok
), s AS (SELECT *, sum(delay) OVER (PARTITION BY doc_id ORDER BY id) AS until FROM d)
SELECT doc_id, sentence, CAST(min(until - delay) AS BIGINT) AS start_ms, CAST(max(until) AS BIGINT) AS end_ms FROM s GROUP BY doc_id, sentence""",
    "playback_schedule_350": f"""
WITH {sql.tokens("documents")}, d AS (
    SELECT *, CASE WHEN sentence_start THEN ({sql.TENTHS}) * 10800 + 175000 ELSE ({sql.TENTHS}) * 6000 END AS delay FROM tok
), s AS (SELECT *, sum(delay) OVER (PARTITION BY doc_id ORDER BY id) AS until FROM d)
SELECT doc_id, sentence, round(CAST(min(until - delay) AS DOUBLE) / 350.0::DOUBLE, 6) AS start_ms, round(CAST(max(until) AS DOUBLE) / 350.0::DOUBLE, 6) AS end_ms FROM s GROUP BY doc_id, sentence""",
    "neighbour_words": f"""
WITH {sql.tokens("documents")}, n AS (
    SELECT doc_id, id, word, sentence_start, list(word) OVER (PARTITION BY doc_id ORDER BY id ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING) AS l FROM tok
)
SELECT doc_id, id, word, array_to_string(l, ' ') AS around, round(greatest(0.04::DOUBLE, 1 - 0.2::DOUBLE * least(id, 4)), 6) AS edge_opacity FROM n WHERE sentence_start""",
    "chapter_detect": f"WITH {sql.books(FRONT, BACK)}, {_CHAPTERS} SELECT book_id, chapter, title, word_index, line, dialect, confidence FROM chap",
    "authored_bounds": f"""
WITH {sql.books(WHALE, WRECK)}, {_LINES}, {_TOTALS}, k AS (
    SELECT book_id, line, word_index, CASE WHEN regexp_matches(t, '^(FOREWORD|EPILOGUE)$') THEN lower(t) ELSE lower(regexp_extract(t, '(?i)^chapter ([0-9]+)$', 1)) END AS key FROM line WHERE regexp_matches(t, '^(FOREWORD|EPILOGUE|(?i:chapter) [0-9]+)$')
), c AS (SELECT book_id, key, max(line) AS line, arg_max(word_index, line) AS word_index FROM k GROUP BY book_id, key
), o AS (SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY word_index) - 1 AS chapter FROM c
), b AS (SELECT book_id, count(*) AS n, min(word_index) AS first_read FROM o GROUP BY book_id
), back AS (SELECT l.book_id, min(word_index) AS back_start FROM line l JOIN total t ON l.book_id = t.book_id WHERE l.t = 'INDEX' AND word_index >= total * 0.55 GROUP BY l.book_id)
SELECT t.book_id, total, CASE WHEN n >= 3 THEN 'high' ELSE 'none' END AS confidence, CASE WHEN n >= 3 THEN first_read ELSE 0 END AS readable_start,
    CASE WHEN n >= 3 AND back_start > first_read THEN back_start - 1 ELSE total - 1 END AS readable_end
FROM total t LEFT JOIN b ON t.book_id = b.book_id LEFT JOIN back k ON t.book_id = k.book_id""",
    "readable_bounds": f"""
WITH {sql.books(FRONT, BACK)}, {_CHAPTERS}, {_TOTALS}, back AS (
    SELECT l.book_id, min(word_index) AS back_start FROM line l JOIN total t ON l.book_id = t.book_id
    WHERE length(t) <= 40 AND regexp_matches(t, '{_BACK}') AND word_index >= total * 0.55 GROUP BY l.book_id
), c AS (SELECT book_id, count(*) AS n, min(word_index) AS first_read FROM chap GROUP BY book_id)
SELECT t.book_id, total, CASE WHEN n IS NULL THEN 'none' ELSE 'high' END AS confidence, CASE WHEN n >= 3 THEN least(first_read, total - 1) ELSE 0 END AS readable_start,
    CASE WHEN n >= 3 AND back_start > first_read THEN greatest(first_read, least(total - 1, back_start - 1)) ELSE greatest(total - 1, 0) END AS readable_end
FROM total t LEFT JOIN c ON t.book_id = c.book_id LEFT JOIN back b ON t.book_id = b.book_id""",
}
