"""Queries over positions, gates, scenes and anchors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import text as fn
from lectern.operators import chapters as ch
from lectern.operators import gates, positions, story
from lectern.operators import structure as st
from lectern.plans import sql
from lectern.plans.common import table
from lectern.plans.text_queries import _CHAPTERS, _LINES, _TOTALS, BACK, FRONT, documents, rich_books
from lectern.sources import readers

NOTICE = "Produced by nobody\n\n*** START OF THE PROJECT GUTENBERG EBOOK ***\n\nTranscribed by hand\n or \n"
FOOTER = "\nthe project gutenberg mark\n*** END OF THE PROJECT GUTENBERG EBOOK ***\nafter all"


def _probes(totals: DataFrame) -> DataFrame:
    """Ten positions in each book."""
    return totals.select("book_id", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("k"), "total").select("book_id", F.floor(F.col("k") * F.col("total") / 10).alias("word_index"))


def chapter_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    books = rich_books(spark, sf_dir)
    totals = ch.totals(books)
    spans = ch.chapter_spans(ch.chapters(ch.headings(ch.lines(books))), totals)
    found = positions.chapter_progress(_probes(totals), spans.select("book_id", "word_index", "end_index", "title"), totals)
    return found.select("book_id", "title", "percent", *[F.col(c).cast("long").alias(c) for c in ("word_index", "start_index", "end_index", "in_chapter")])


def next_prev_chapter(spark: SparkSession, sf_dir: str) -> DataFrame:
    books = rich_books(spark, sf_dir)
    totals = ch.totals(books)
    found = positions.neighbour_chapters(_probes(totals), ch.chapters(ch.headings(ch.lines(books))), totals)
    return found.select("book_id", *[F.col(c).cast("long").alias(c) for c in ("word_index", "next_start", "previous_start")])


def scene_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user's turn that every turn belongs to."""
    turns = table(spark, sf_dir, "conversations")
    starts = turns.filter("role = 'user'").select("conv_id", "turn", F.left("text", F.lit(20)).alias("label"))
    found = positions.backward(turns.select("conv_id", "turn"), starts, ["conv_id"], "turn")
    return found.select("conv_id", "turn", F.col("found.turn").alias("scene_turn"), F.col("found.label").alias("label"))


def content_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", gates.content_reason(gates.densities(F.col("text"))).alias("reason"))


def reject_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.histogram(content_gate(spark, sf_dir))


def metadata_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as catalog entries: media, language, copyright and file are told by the key."""
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    title = F.when(k % 17 == 0, F.concat(F.lit("An Index of "), "p_name")).when(k % 19 == 0, F.concat(F.lit("A Dictionary of "), "p_name")).otherwise(F.col("p_name"))
    topics = F.array(F.col("p_type"), F.when(k % 23 == 0, "Preferences and tastes").otherwise("Fiction"))
    reason = gates.metadata_reason(F.when(k % 11 == 0, "Sound").otherwise("Text"), F.array(F.when(k % 7 == 0, "fr").otherwise("en")), F.when(k % 13 == 0, F.lit(None)).when(k % 5 == 0, True).otherwise(False), F.when(k % 29 != 0, F.lit("u")), topics, title)
    return p.select("p_partkey", reason.alias("reason"))


def html_sniff_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first tier with a text for each page id: the page itself unless it is HTML, then the document (SRC-13, FLT-06)."""
    pages, docs = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), "html"), documents(spark, sf_dir).select(F.col("doc_id").alias("id"), "text")
    found = readers.first_tier("id", pages.withColumnRenamed("html", "text"), docs)
    ids = pages.select("id").union(docs.select("id")).distinct().join(pages.select("id", fn.is_html(F.col("html")).alias("h")), "id", "left")
    name = F.when(F.col("tier") == 0, "page").when(F.col("tier") == 1, "document")
    return ids.join(found, "id", "left").select("id", name.alias("tier"), F.coalesce("h", F.lit(False)).alias("page_is_html"), F.length("text").cast("long").alias("n_chars"))


def strip_boilerplate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a library's marks around them, of several times and kinds, and what is left of them (TXT-08)."""
    k, text = F.col("doc_id") % 7, F.col("text")
    around = lambda before, after, inner=text: F.concat(F.lit(before), inner, F.lit(after))
    framed = F.when(k == 1, around("The Project Gutenberg Etext\n\n*END*THE SMALL PRINT! FOR PUBLIC DOMAIN ETEXTS*Ver.04.29.93*END*\n\n", "\n\nEnd of the Project Gutenberg Etext of it\nmore of that"))
    framed = framed.when(k == 2, around("*** START OF THIS PROJECT GUTENBERG EBOOK X ***\n\nProduced by A. B. and\nhttps://www.example.org/ebooks\n  or \n\nProofread by others\n\n", "\n"))
    framed = framed.when(k == 3, around("Said before *** START OF THE PROJECT GUTENBERG EBOOK X ***\r\n", "\r\n*** END OF THE PROJECT GUTENBERG EBOOK X ***\r\nand after", F.replace("text", F.lit("\n"), F.lit("\r\n"))))
    framed = framed.when(k == 4, around("", "\nA line of Project Gutenberg itself\nlast words"))
    framed = framed.when(k == 5, around("", "\n  End of this Project Gutenberg book\nlicense\n*** END OF THIS PROJECT GUTENBERG EBOOK ***\nrest"))
    framed = framed.when(k == 6, around("\n \nTranscriber's note\n\n(http://www.example.org)\n\n", "")).otherwise(around(NOTICE, FOOTER))
    return documents(spark, sf_dir).select("doc_id", F.sha2(gates.strip_boilerplate(framed), 256).alias("text_sha256"))


def scene_min_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scene headings of each book that are far enough from the last one kept."""
    kept = story.scene_headings(ch.lines(rich_books(spark, sf_dir)))
    return kept.select("book_id", F.explode("starts").alias("word_index"))


def scene_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return story.scenes(docs, ch.lines(docs, "doc_id"), "doc_id")


def book_scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenes of books with chapters: their headings, a sample of many, or equal parts."""
    books = rich_books(spark, sf_dir)
    return story.scenes(books, ch.lines(books))


def _romans(upto: int) -> list[str]:
    """Roman numerals from 1 on, by the rule of greatest parts."""
    parts = list(zip((100, 90, 50, 40, 10, 9, 5, 4, 1), ("C", "XC", "L", "XL", "X", "IX", "V", "IV", "I")))
    out = []
    for n in range(1, upto + 1):
        text = ""
        for value, mark in parts:
            text, n = text + mark * (n // value), n % value
        out.append(text)
    return out


ROMANS = _romans(99)


def roman_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chapters of books whose headings are roman numerals, with a title in even blocks of ids and bare in odd ones."""
    block = F.floor(F.col("doc_id") / 100)
    docs = documents(spark, sf_dir).select(F.concat(F.lit("r"), block.cast("string")).alias("book_id"), (block % 2 == 0).alias("titled"), (F.col("doc_id") % 100).cast("int").alias("k"), "source", "text")
    number = F.element_at(F.array(*map(F.lit, ROMANS)), F.col("k") % 99 + 1)
    head = F.concat(number, F.when(F.col("titled"), F.concat(F.lit(".  OF "), F.upper("source"), F.lit(" AND MORE. "))).otherwise(F.lit(".")))
    parts = docs.groupBy("book_id").agg(F.array_sort(F.collect_list(F.struct("k", F.concat(head, F.lit("\n\n"), "text").alias("t")))).alias("parts"))
    books = parts.select("book_id", F.array_join(F.transform("parts", lambda x: x["t"]), "\n\n").alias("text"))
    return ch.chapters(ch.headings(ch.lines(books))).select("book_id", F.col("chapter").cast("long").alias("chapter"), "title", F.col("word_index").cast("long").alias("word_index"), "dialect", "confidence")


def numbered_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chapters of books whose headings are bare numbers, with or without a point (TXT-05); one in ten is repeated further on, where the last counts (AGG-14)."""
    k = F.col("doc_id") % 100
    number = F.concat((k - F.when(k % 10 == 9, 5).otherwise(0) + 1).cast("string"), F.when(k % 2 == 0, ".").otherwise(""))
    docs = documents(spark, sf_dir).select(F.concat(F.lit("n"), F.floor(F.col("doc_id") / 100).cast("string")).alias("book_id"), "doc_id", F.concat(number, F.lit("\n\n"), "text").alias("t"))
    parts = docs.groupBy("book_id").agg(F.array_sort(F.collect_list(F.struct("doc_id", "t"))).alias("parts"))
    books = parts.select("book_id", F.array_join(F.transform("parts", lambda x: x["t"]), "\n\n").alias("text"))
    return ch.chapters(ch.headings(ch.lines(books))).select("book_id", F.col("chapter").cast("long").alias("chapter"), "title", F.col("word_index").cast("long").alias("word_index"), "dialect", "confidence")


def story_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    books = rich_books(spark, sf_dir)
    return story.story_starts(books, ch.headings(ch.lines(books)))


#: Front matter that a story starts behind: a foreword of more words than a page of contents has between its lines, and a prologue.
FOREWORD = "FOREWORD.\n\n" + " ".join(["These words come before."] * 40) + "\n\nPREFACE\n\n" + " ".join(["So do these."] * 50) + "\n\nPrologue\n\n" + " ".join(["Here it begins."] * 60) + "\n\n"


def story_start_front(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts of books that open with a foreword and a preface, which a start passes over (FLT-14)."""
    books = st.books(documents(spark, sf_dir), FOREWORD, BACK)
    return story.story_starts(books, ch.headings(ch.lines(books)))


def prose_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first paragraph of each book that reads like prose, null if none does."""
    books = st.books(documents(spark, sf_dir))
    return books.select("book_id", story.prose_start(F.col("text")).cast("long").alias("start"))


def anchor_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the first eight words of each benchmark item stand in a document."""
    anchors = table(spark, sf_dir, "benchmark").select("item_id", F.array_join(F.slice(F.split("text", r"\s+"), 1, 8), " ").alias("anchor"))
    return story.resolved_anchors(documents(spark, sf_dir), anchors)


def kwic_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return story.keyword_context(documents(spark, sf_dir)).withColumn("after_gap", F.coalesce("after_gap", F.lit(False)))


QUERIES = {f.__name__: f for f in (chapter_progress, next_prev_chapter, scene_asof, content_gate, reject_histogram, metadata_gate, html_sniff_tier, strip_boilerplate, scene_min_gap, scene_segments, book_scenes, roman_chapters, numbered_chapters, story_start, story_start_front, prose_starts, anchor_resolve, kwic_lines)}

_PROBES = "probe AS (SELECT book_id, total, unnest(range(0, 10)) * total // 10 AS word_index FROM total)"
_REASON = """
dens AS (SELECT doc_id, length(text) AS n, len(regexp_extract_all(text, '[.!?]')) * 1000.0::DOUBLE / length(text) AS terminal, len(regexp_extract_all(text, '[,;:]')) * 1000.0::DOUBLE / length(text) AS clause,
    len(regexp_extract_all(text, '[0-9]'))::DOUBLE / length(regexp_replace(text, '\\s', '', 'g')) AS digits FROM documents),
gate AS (SELECT doc_id, CASE WHEN n < 2000 THEN 'too short (' || CAST(n AS VARCHAR) || ' chars)' WHEN terminal < 1.2 AND clause < 8 THEN 'not prose (few marks)'
    WHEN digits > 0.15 THEN 'data-heavy (' || CAST(CAST(floor(digits * 100 + 0.5) AS BIGINT) AS VARCHAR) || '% digits)' END AS reason FROM dens)"""
_TOPICS = " ".join(f"WHEN contains(lower(p_type || ' | ' || CASE WHEN p_partkey % 23 = 0 THEN 'Preferences and tastes' ELSE 'Fiction' END), '{t}') THEN 'reference material ({t})'" for t in gates.TOPICS)
_FRONT = "(?i)^(contents|table of contents|title page|copyright|dedication|list of|illustrations?|preface|foreword|introduction|editor''?s note|translator''?s|publisher''?s note|frontispiece)\\b"
_WORDS = "|".join(k.replace("-", "\\-") for k in sorted(story.KEYWORDS))

ORACLE_SQL = {
    "chapter_progress": f"""
WITH {sql.books(FRONT, BACK)}, {_CHAPTERS}, {_TOTALS}, {_PROBES}, every AS (
    SELECT book_id, chapter, title, word_index FROM chap UNION ALL SELECT book_id, -1, 'Frontmatter', 0 FROM chap WHERE chapter = 0 AND word_index > 0
), span AS (SELECT e.book_id, title, word_index, coalesce(lead(word_index) OVER (PARTITION BY e.book_id ORDER BY word_index, chapter) - 1, total - 1) AS end_index FROM every e JOIN total t ON e.book_id = t.book_id)
SELECT p.book_id, p.word_index, s.title, s.word_index AS start_index, s.end_index, p.word_index - s.word_index AS in_chapter,
    CAST(least(100, floor(100.0::DOUBLE * (p.word_index - s.word_index) / (s.end_index - s.word_index + 1) + 0.5)) AS INT) AS percent
FROM probe p JOIN span s ON p.book_id = s.book_id AND p.word_index BETWEEN s.word_index AND s.end_index""",
    "next_prev_chapter": f"""
WITH {sql.books(FRONT, BACK)}, {_CHAPTERS}, {_TOTALS}, {_PROBES}
SELECT book_id, word_index, coalesce((SELECT min(c.word_index) FROM chap c WHERE c.book_id = p.book_id AND c.word_index > p.word_index + 1), total - 1) AS next_start,
    coalesce((SELECT max(c.word_index) FROM chap c WHERE c.book_id = p.book_id AND c.word_index < p.word_index - 1), 0) AS previous_start
FROM probe p""",
    "scene_asof": """
SELECT c.conv_id, c.turn, s.turn AS scene_turn, s.label FROM conversations c
ASOF LEFT JOIN (SELECT conv_id, turn, substr(text, 1, 20) AS label FROM conversations WHERE role = 'user') s ON c.conv_id = s.conv_id AND c.turn >= s.turn""",
    "content_gate": f"WITH {_REASON} SELECT doc_id, reason FROM gate",
    "reject_histogram": f"""
WITH {_REASON}, h AS (SELECT regexp_replace(reason, ' \\(.*\\)$', '') AS reason, count(*) AS n FROM gate WHERE reason IS NOT NULL GROUP BY 1)
SELECT reason, n, CAST(floor(1000.0::DOUBLE * n / sum(n) OVER () + 0.5) AS BIGINT) AS per_mille FROM h""",
    "metadata_gate": f"""
SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN 'not text (Sound)' WHEN p_partkey % 7 = 0 THEN 'not English' WHEN p_partkey % 13 = 0 THEN 'copyright unknown' WHEN p_partkey % 5 = 0 THEN 'still copyrighted'
    WHEN p_partkey % 29 = 0 THEN 'no plain-text file' {_TOPICS} WHEN p_partkey % 17 = 0 THEN 'reference title (index of)' END AS reason FROM part""",
    "html_sniff_tier": """
SELECT coalesce(page_id, doc_id) AS id, CASE WHEN NOT h AND html <> '' THEN 'page' WHEN text <> '' THEN 'document' END AS tier, coalesce(h, false) AS page_is_html, CASE WHEN NOT h AND html <> '' THEN length(html) WHEN text <> '' THEN length(text) END AS n_chars
FROM (SELECT *, regexp_matches(html, '(?i)^\\s*<(!doctype|html)') AS h FROM pages) p FULL JOIN documents d ON page_id = doc_id""",
    "strip_boilerplate": f"""
WITH d AS (SELECT doc_id, CASE doc_id % 7 WHEN 4 THEN text || chr(10) || 'last words' WHEN 5 THEN text || chr(10) || '  End of this Project Gutenberg book' || chr(10) || 'license' ELSE text END AS text FROM documents
), l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: NOT contains(lower(x), 'project gutenberg')) AS lines FROM d
), m AS (SELECT doc_id, array_to_string(lines, chr(10)) AS text FROM l)
SELECT doc_id, sha256({sql.TRIM('text')}) AS text_sha256 FROM m""",
    "scene_min_gap": f"""
WITH RECURSIVE {sql.books(FRONT, BACK)}, {_LINES}, h AS (
    SELECT book_id, word_index, row_number() OVER (PARTITION BY book_id ORDER BY word_index) AS r FROM line WHERE t <> '' AND length(t) <= 64 AND regexp_matches(t, '(?i)^(chapter|letter|part|book|stave|canto|act|scene|prologue|epilogue)\\b')
), k AS (
    SELECT book_id, r, word_index, word_index AS last, true AS kept FROM h WHERE r = 1
    UNION ALL SELECT h.book_id, h.r, h.word_index, CASE WHEN h.word_index - k.last >= 120 THEN h.word_index ELSE k.last END, h.word_index - k.last >= 120 FROM k JOIN h ON h.book_id = k.book_id AND h.r = k.r + 1
)
SELECT book_id, word_index FROM k WHERE kept""",
    "scene_segments": f"""
WITH t AS (SELECT doc_id, CAST(len(list_filter({sql.WORDS("text")}, lambda x: x <> '[P]')) AS BIGINT) AS total FROM documents
), n AS (SELECT *, least(14, greatest(2, CAST(floor(total / 4000.0 + 0.5) AS BIGINT))) AS n FROM t
), s AS (SELECT doc_id, total, unnest(list_distinct(list_transform(range(0, n), lambda i: i * total // n))) AS start_index FROM n
), r AS (SELECT doc_id, total, row_number() OVER (PARTITION BY doc_id ORDER BY start_index) - 1 AS scene, start_index, coalesce(lead(start_index) OVER (PARTITION BY doc_id ORDER BY start_index), total) AS end_index FROM s)
SELECT doc_id, scene, start_index, end_index, least(end_index - start_index, 900) AS passage_words FROM r""",
    "book_scenes": f"""
WITH RECURSIVE {sql.books(FRONT, BACK)}, {_LINES}, {_TOTALS}, h AS (
    SELECT book_id, word_index, row_number() OVER (PARTITION BY book_id ORDER BY word_index) AS r FROM line WHERE t <> '' AND length(t) <= 64 AND regexp_matches(t, '(?i)^(chapter|letter|part|book|stave|canto|act|scene|prologue|epilogue)\\b')
), k AS (
    SELECT book_id, r, word_index, word_index AS last, true AS kept FROM h WHERE r = 1
    UNION ALL SELECT h.book_id, h.r, h.word_index, CASE WHEN h.word_index - k.last >= 120 THEN h.word_index ELSE k.last END, h.word_index - k.last >= 120 FROM k JOIN h ON h.book_id = k.book_id AND h.r = k.r + 1
), n AS (
    SELECT t.book_id, CAST(total AS BIGINT) AS total, coalesce(list(k.word_index ORDER BY k.r) FILTER (kept), []) AS starts FROM total t LEFT JOIN k ON t.book_id = k.book_id GROUP BY t.book_id, total
), m AS (
    SELECT book_id, total, CASE WHEN len(starts) BETWEEN 2 AND 18 THEN starts WHEN len(starts) > 18 THEN list_transform(range(0, 14), lambda i: starts[i * len(starts) // 14 + 1])
        ELSE list_transform(range(0, least(14, greatest(2, CAST(floor(total / 4000.0 + 0.5) AS BIGINT)))), lambda i: i * total // least(14, greatest(2, CAST(floor(total / 4000.0 + 0.5) AS BIGINT)))) END AS found FROM n
), u AS (SELECT book_id, total, unnest(list_distinct(found)) AS start_index FROM m
), r AS (SELECT book_id, total, row_number() OVER o - 1 AS scene, start_index, coalesce(lead(start_index) OVER o, total) AS end_index FROM u WINDOW o AS (PARTITION BY book_id ORDER BY start_index))
SELECT book_id, scene, start_index, end_index, least(end_index - start_index, 900) AS passage_words FROM r""",
    "roman_chapters": f"""
WITH part_n AS (
    SELECT 'r' || CAST(doc_id // 100 AS VARCHAR) AS book_id, doc_id, [{", ".join(f"'{x}'" for x in ROMANS)}][CAST(doc_id % 100 % 99 + 1 AS INT)]
        || CASE WHEN doc_id // 100 % 2 = 0 THEN '.  OF ' || upper(source) || ' AND MORE. ' ELSE '.' END || chr(10) || chr(10) || text AS t FROM documents
), book AS (SELECT book_id, string_agg(t, chr(10) || chr(10) ORDER BY doc_id) AS text FROM part_n GROUP BY book_id), {_LINES}, m AS (
    SELECT *, regexp_extract(t, '^([IVXLCDM]+)\\.\\s+([A-Z][^a-z]*[A-Za-z].*)$', 1) AS roman, regexp_extract(t, '^([IVXLCDM]+)\\.\\s+([A-Z][^a-z]*[A-Za-z].*)$', 2) AS rest, regexp_extract(t, '^([IVXLCDM]+)\\.?$', 1) AS bare FROM line
), head AS (
    SELECT book_id, line, word_index, {sql.number_key("CASE WHEN roman <> '' THEN roman ELSE bare END")} AS key, CASE WHEN roman <> '' THEN 'roman-title' ELSE 'bare-roman' END AS dialect,
        CASE WHEN roman <> '' THEN roman || '. ' || {sql.title_case("rest")} ELSE 'Chapter ' || bare END AS title FROM m WHERE roman <> '' OR bare <> ''
), w AS (SELECT book_id, max(dialect) AS dialect FROM (SELECT book_id, dialect FROM head GROUP BY 1, 2 HAVING count(DISTINCT key) >= 3) GROUP BY 1
), c AS (SELECT h.*, row_number() OVER (PARTITION BY h.book_id, key ORDER BY line DESC) AS r FROM head h JOIN w ON h.book_id = w.book_id AND h.dialect = w.dialect)
SELECT book_id, row_number() OVER (PARTITION BY book_id ORDER BY word_index, line) - 1 AS chapter, title, word_index, dialect, CASE WHEN dialect = 'roman-title' THEN 'high' ELSE 'medium' END AS confidence FROM c WHERE r = 1""",
    "numbered_chapters": f"""
WITH part_n AS (
    SELECT 'n' || CAST(doc_id // 100 AS VARCHAR) AS book_id, doc_id, CAST(doc_id % 100 - CASE WHEN doc_id % 10 = 9 THEN 5 ELSE 0 END + 1 AS VARCHAR) || CASE WHEN doc_id % 2 = 0 THEN '.' ELSE '' END || chr(10) || chr(10) || text AS t FROM documents
), book AS (SELECT book_id, string_agg(t, chr(10) || chr(10) ORDER BY doc_id) AS text FROM part_n GROUP BY book_id), {_LINES}, head AS (
    SELECT book_id, line, word_index, CAST(regexp_extract(t, '^([0-9]{{1,3}})\\.?$', 1) AS INT) AS key FROM line WHERE regexp_matches(t, '^[0-9]{{1,3}}\\.?$')
), c AS (SELECT *, row_number() OVER (PARTITION BY book_id, key ORDER BY line DESC) AS r FROM head)
SELECT book_id, row_number() OVER (PARTITION BY book_id ORDER BY word_index, line) - 1 AS chapter, 'Chapter ' || key AS title, word_index, 'bare-numeric' AS dialect, 'medium' AS confidence FROM c WHERE r = 1""",
    # books begin with a page of contents, so all have the three headings that spare the look for prose
    "story_start": f"""
WITH {sql.books(FRONT, BACK)}, {_CHAPTERS}, {_TOTALS}, {sql.tokens("book", "book_id")}, h AS (
    SELECT h.*, total, row_number() OVER o - 1 AS i, coalesce(lead(word_index) OVER o, total) - word_index AS gap, row_number() OVER (PARTITION BY h.book_id, key ORDER BY word_index, line) > 1 AS again,
        kind IN ('preface', 'foreword', 'introduction', 'afterword', 'conclusion') OR regexp_matches(title, '{_FRONT}') AS front
    FROM head h JOIN total t ON h.book_id = t.book_id WINDOW o AS (PARTITION BY h.book_id ORDER BY word_index, line)
), per AS (
    SELECT book_id, count(*) AS n, max(gap) FILTER (i = 0) AS gap0, max(gap) FILTER (i = 1) AS gap1, min(i) FILTER (again AND gap >= 120) AS body, min(i) FILTER (again) AS again_at, count(DISTINCT key) AS n_headings FROM h GROUP BY 1
), c AS (
    SELECT book_id, n_headings, n >= 3 AND gap0 < 120 AND gap1 < 120 AND body IS NULL AS toc, CASE WHEN n >= 3 AND gap0 < 120 AND gap1 < 120 THEN coalesce(body, again_at, 0) ELSE 0 END AS begin FROM per WHERE n_headings >= 3
), f AS (SELECT c.book_id, coalesce(min(i) FILTER (i >= begin AND NOT front), min(begin)) AS i FROM c JOIN h ON c.book_id = h.book_id GROUP BY 1
), s AS (
    SELECT h.book_id, word_index AS start, total, title AS heading, n_headings, CASE WHEN word_index > total * 0.4 OR toc OR gap < 120 THEN 'low' ELSE 'high' END AS confidence,
        'chapters:keyword' || CASE WHEN toc THEN ':toc-only' WHEN word_index > total * 0.4 THEN ':deep' ELSE '' END AS method
    FROM f JOIN h ON f.book_id = h.book_id AND f.i = h.i JOIN c ON c.book_id = h.book_id
)
SELECT s.book_id, start, confidence, method, heading, n_headings, total, string_agg(word, ' ' ORDER BY id) AS preview
FROM s JOIN tok ON s.book_id = tok.book_id AND id BETWEEN start AND start + 13 GROUP BY ALL""",
    "story_start_front": f"""
WITH {sql.books(FOREWORD, BACK)}, {_CHAPTERS}, {_TOTALS}, {sql.tokens("book", "book_id")}, every_head AS (
    SELECT book_id, line, word_index, key, kind, title FROM head
    UNION ALL SELECT book_id, line, word_index, lower(w), lower(w), upper(w[1]) || lower(w[2:]) FROM (SELECT *, regexp_extract(t, '(?i)^(prologue|epilogue|introduction|preface|foreword|afterword|conclusion)\\.?$', 1) AS w FROM line) WHERE w <> ''
), h AS (
    SELECT h.*, total, row_number() OVER o - 1 AS i, coalesce(lead(word_index) OVER o, total) - word_index AS gap, row_number() OVER (PARTITION BY h.book_id, key ORDER BY word_index, line) > 1 AS again,
        kind IN ('preface', 'foreword', 'introduction', 'afterword', 'conclusion') OR regexp_matches(title, '{_FRONT}') AS front
    FROM every_head h JOIN total t ON h.book_id = t.book_id WINDOW o AS (PARTITION BY h.book_id ORDER BY word_index, line)
), per AS (
    SELECT book_id, count(*) AS n, max(gap) FILTER (i = 0) AS gap0, max(gap) FILTER (i = 1) AS gap1, min(i) FILTER (again AND gap >= 120) AS body, min(i) FILTER (again) AS again_at, count(DISTINCT key) AS n_headings FROM h GROUP BY 1
), c AS (
    SELECT book_id, n_headings, n >= 3 AND gap0 < 120 AND gap1 < 120 AND body IS NULL AS toc, CASE WHEN n >= 3 AND gap0 < 120 AND gap1 < 120 THEN coalesce(body, again_at, 0) ELSE 0 END AS begin FROM per WHERE n_headings >= 3
), f AS (SELECT c.book_id, coalesce(min(i) FILTER (i >= begin AND NOT front), min(begin)) AS i FROM c JOIN h ON c.book_id = h.book_id GROUP BY 1
), s AS (
    SELECT h.book_id, word_index AS start, total, title AS heading, n_headings, CASE WHEN word_index > total * 0.4 OR toc OR gap < 120 THEN 'low' ELSE 'high' END AS confidence,
        'chapters:keyword' || CASE WHEN toc THEN ':toc-only' WHEN word_index > total * 0.4 THEN ':deep' ELSE '' END AS method
    FROM f JOIN h ON f.book_id = h.book_id AND f.i = h.i JOIN c ON c.book_id = h.book_id
)
SELECT s.book_id, start, confidence, method, heading, n_headings, total, string_agg(word, ' ' ORDER BY id) AS preview
FROM s JOIN tok ON s.book_id = tok.book_id AND id BETWEEN start AND start + 13 GROUP BY ALL""",
    "prose_starts": f"""
WITH {sql.books()}, {sql.tokens("book", "book_id")}, p AS (
    SELECT book_id, paragraph, min(id) AS start, count(*) AS n, count(*) FILTER (regexp_matches(word, '[A-Z]') AND word = upper(word) AND length(word) > 1) AS caps,
        count(*) FILTER (regexp_matches(word, '^[a-z]')) AS low, string_agg(word, ' ' ORDER BY id) AS text FROM tok GROUP BY 1, 2
), f AS (
    SELECT book_id, min(start) AS start FROM p WHERE n >= 35 AND caps <= 0.25 * n AND low > 0.45 * n AND NOT regexp_matches(text, '(?i)\\.(jpg|jpeg|png|gif)\\b')
        AND len(regexp_extract_all(text, '[.!?]["''”’)]?(\\s|$)')) >= 2 GROUP BY 1
)
SELECT book.book_id, start FROM book LEFT JOIN f ON book.book_id = f.book_id""",
    "anchor_resolve": f"""
WITH d AS (SELECT doc_id, list_transform(list_filter({sql.WORDS("text")}, lambda x: x <> '[P]'), lambda x: regexp_replace(lower(x), '[^a-z0-9]+', '', 'g')) AS w FROM documents
), a AS (SELECT item_id, regexp_replace(lower(array_to_string(string_split_regex(text, '\\s+')[1:8], ' ')), '[^a-z0-9]+', '', 'g') AS needle FROM benchmark
), h AS (SELECT item_id, doc_id, w, instr(array_to_string(w, ''), needle) - 1 AS pos FROM d, a WHERE needle <> '' AND contains(array_to_string(w, ''), needle)
), u AS (SELECT item_id, doc_id, pos, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS p FROM h
), c AS (SELECT item_id, doc_id, pos, sum(length(p)) OVER (PARTITION BY item_id, doc_id ORDER BY i) AS until FROM u)
SELECT item_id, doc_id, count(*) FILTER (until <= pos) AS token FROM c GROUP BY item_id, doc_id""",
    "kwic_lines": f"""
WITH l AS (SELECT doc_id, unnest(range(0, len(x))) AS line, unnest(x) AS raw FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents)
), m AS (SELECT doc_id, line, raw, CAST(length(trim(raw)) > 20 AND regexp_matches(lower(raw), '{_WORDS}') AS INT) AS hit, regexp_matches(raw, '^(#+ |Title:|Source:|US[0-9]+)|Project Gutenberg') AS header FROM l
), n AS (
    SELECT *, max(hit) OVER (PARTITION BY doc_id ORDER BY line ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS near,
        coalesce(last_value(CASE WHEN header THEN trim(raw) END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line), 'Unknown Source') AS source_header FROM m
)
SELECT doc_id, line, trim(raw) AS text, hit, source_header, coalesce(line - lag(line) OVER (PARTITION BY doc_id ORDER BY line) > 1, false) AS after_gap FROM n WHERE near = 1""",
}
