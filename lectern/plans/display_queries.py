"""Queries over a library's API rows, values shown to readers, and built scenes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import display
from lectern.functions import text as fn
from lectern.operators import annotations as an
from lectern.operators import catalog as cat
from lectern.operators import positions
from lectern.plans import sql
from lectern.plans.common import table
from lectern.plans.text_queries import documents


def _api_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as a row of a library's API: field marks in titles, archives among files, lists that are missing."""
    size, url = F.col("p_size"), F.concat(F.lit("https://books.example.org/"), F.col("p_partkey").cast("string"))
    formats = F.create_map(
        F.lit("text/plain; charset=utf-8"), F.concat(url, F.when(size % 3 == 0, ".zip").otherwise(".txt")),
        F.lit("text/plain"), F.when(size % 2 == 1, F.concat(url, F.lit("-0.txt"))),
        F.lit("image/jpeg"), F.when(size % 2 == 0, F.concat(url, F.lit(".jpg"))),
    )
    author = F.struct(F.concat_ws(", ", "p_type", "p_brand").alias("name"), (size + 1800).alias("death_year"))
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.concat(F.lit(" "), "p_name", F.lit(" : $b "), "p_brand", F.lit("  "), "p_type").alias("title"),
        F.filter(F.array(author), lambda a: a["death_year"] > 1805).alias("authors"),
        F.map_filter(formats, lambda k, v: v.isNotNull()).alias("formats"),
        F.when(size > 10, F.array(F.lit("en"))).alias("languages"),
        F.split("p_name", " ").alias("subjects"),
        F.lit(None).cast("array<string>").alias("bookshelves"),
        F.lit(False).alias("copyright"),
        F.lit("Text").alias("media_type"),
        F.when(size % 5 != 0, size * 10).alias("download_count"),
    )


def api_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog rows: plain titles, authors in speaking order, the preferred file (PRJ-01, PRJ-03, PRJ-05)."""
    return cat.books_of(_api_rows(spark, sf_dir)).withColumn("download_count", F.col("download_count").cast("long"))


def lean_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What gates and shelves need, empty lists for missing ones (PRJ-02)."""
    found = cat.lean(_api_rows(spark, sf_dir))
    listed = [F.array_join(c, "|").alias(c) for c in ("languages", "subjects", "bookshelves")]
    return found.select("id", "author", F.col("author_death").cast("long").alias("author_death"), *listed, F.col("downloads").cast("long").alias("downloads"), "text_url", "has_cover")


def display_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes, motion, labels, addresses and positions of every part (FN-06, 07, 21, 25, 28, 29, 30; PRJ-06, 07, 13, 14)."""
    size, price, key = F.col("p_size"), F.col("p_retailprice"), F.col("p_partkey").cast("string")
    shown = F.concat(F.col("p_name"), F.lit(" &amp;lt; &quot;"), F.col("p_type"), F.lit("&quot; &mdash; x&nbsp;y"))
    resume = positions.resume_position(F.when(size % 4 == 0, size), F.when(size % 3 == 0, size * 30), size - 10, F.lit(500))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.round(display.font_size(price, F.when(size % 2 == 0, "compact").otherwise("full")), 6).alias("font_size"),
        F.round(display.fit_scale(size.cast("double"), price / 20), 6).alias("fit_scale"),
        F.round(display.ease_out(size / 50), 6).alias("eased"),
        F.round(display.coasted((price - 1000) / 1000, size), 6).alias("coasted"),
        display.clamped_pace(price).cast("long").alias("pace"),
        display.decoded(shown).alias("label"),
        display.short_text(F.col("p_name"), 6).alias("teaser"),
        display.cover_address(key, "https://covers.example.org").alias("cover"),
        display.proxied(F.concat(F.lit("http://www.books.example.org/"), key), "books.example.org", "/books").alias("address"),
        F.round(display.span_percent(size * 10, F.lit(100), F.when(size % 7 == 0, 100).when(size % 5 == 0, 60).otherwise(price / 4), size % 11), 6).alias("percent"),
        resume.cast("long").alias("resume"),
        display.thousands(F.col("p_partkey") * 1237).alias("thousands"),
        display.padded(F.col("p_partkey")).alias("padded"),
    )


def scene_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three anchors a document: its words 41-46, then 11-16, then words that no document has (TXT-12, WIN-14)."""
    docs = documents(spark, sf_dir).select("doc_id", fn.words(F.col("text")).alias("w"))
    part = lambda i: F.array_join(F.slice("w", i, 6), " ")
    anchors = docs.select("doc_id", F.posexplode(F.array(part(41), part(11), F.lit("zzqq never there"))).alias("ordinal", "anchor"))
    found = an.resolved_scenes(docs, anchors, "doc_id")
    return found.select("doc_id", F.col("ordinal").cast("long").alias("ordinal"), F.col("start_index").cast("long").alias("start_index"), "out_of_order", "missing")


def scene_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of those anchors are missing, out of order or in place (AGG-06, AGG-10)."""
    outcome = F.when(F.col("missing"), "missing").when(F.col("out_of_order"), "out of order").otherwise("in place")
    return an.outcome_counts(scene_build(spark, sf_dir).withColumn("outcome", outcome))


QUERIES = {f.__name__: f for f in (api_books, lean_books, display_values, scene_build, scene_outcomes)}

_URL = "'https://books.example.org/' || p_partkey"
_TEXT_URL = f"CASE WHEN p_size % 3 <> 0 THEN {_URL} || '.txt' WHEN p_size % 2 = 1 THEN {_URL} || '-0.txt' END"
_LETTERS = lambda x: f"regexp_replace(lower({x}), '[^a-z0-9]+', '', 'g')"
_SCENES = f"""
WITH d AS (SELECT doc_id, list_filter({sql.WORDS("text")}, lambda x: x <> '[P]') AS w FROM documents
), a AS (SELECT doc_id, w, list_transform(w, lambda x: {_LETTERS("x")}) AS p FROM d
), x AS (SELECT doc_id, w, array_to_string(p, '') AS letters, unnest([0, 1, 2]) AS ordinal FROM a
), y AS (SELECT doc_id, ordinal, letters, CASE ordinal WHEN 0 THEN {_LETTERS("array_to_string(w[41:46], ' ')")} WHEN 1 THEN {_LETTERS("array_to_string(w[11:16], ' ')")} ELSE 'zzqqneverthere' END AS needle FROM x
), z AS (SELECT doc_id, ordinal, CASE WHEN needle <> '' THEN instr(letters, needle) - 1 END AS pos FROM y
), u AS (SELECT doc_id, unnest(range(1, len(p) + 1)) AS i, unnest(p) AS q FROM a
), c AS (SELECT doc_id, sum(length(q)) OVER (PARTITION BY doc_id ORDER BY i) AS until FROM u
), k AS (SELECT z.doc_id, ordinal, CASE WHEN min(pos) >= 0 THEN count(*) FILTER (until <= pos) END AS start_index FROM z JOIN c ON z.doc_id = c.doc_id GROUP BY z.doc_id, ordinal
), scene AS (
    SELECT doc_id, CAST(ordinal AS BIGINT) AS ordinal, start_index, coalesce(start_index <= lag(start_index) OVER (PARTITION BY doc_id ORDER BY ordinal), false) AS out_of_order, false AS missing FROM k WHERE start_index IS NOT NULL
    UNION ALL SELECT doc_id, ordinal, NULL, false, true FROM k WHERE start_index IS NULL
)"""
ORACLE_SQL = {
    "api_books": f"""
SELECT CAST(p_partkey AS VARCHAR) AS id, p_name || ': ' || p_brand || ' ' || p_type AS title, CASE WHEN p_size > 5 THEN p_brand || ' ' || p_type ELSE 'Unknown' END AS author,
    CASE WHEN p_size % 2 = 0 THEN {_URL} || '.jpg' END AS cover_url, {_TEXT_URL} AS text_url, CASE WHEN p_size % 5 <> 0 THEN CAST(p_size AS BIGINT) * 10 END AS download_count
FROM part""",
    "lean_books": f"""
SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_size > 5 THEN p_type || ', ' || p_brand END AS author, CASE WHEN p_size > 5 THEN CAST(p_size AS BIGINT) + 1800 END AS author_death,
    CASE WHEN p_size > 10 THEN 'en' ELSE '' END AS languages, replace(p_name, ' ', '|') AS subjects, '' AS bookshelves,
    CASE WHEN p_size % 5 <> 0 THEN CAST(p_size AS BIGINT) * 10 ELSE 0 END AS downloads, {_TEXT_URL} AS text_url, p_size % 2 = 0 AS has_cover
FROM part""",
    "display_values": """
SELECT p_partkey, round(CASE WHEN p_size % 2 = 0 THEN p_retailprice * 0.8::DOUBLE ELSE p_retailprice END, 6) AS font_size,
    round(CASE WHEN p_retailprice / 20 > p_size - 14 THEN greatest(0.5::DOUBLE, (p_size - 14) / (p_retailprice / 20)) ELSE 1.0 END, 6) AS fit_scale,
    round(1 - pow(1 - p_size / 50, 3), 6) AS eased,
    round(least(greatest((p_retailprice - 1000) / 1000, -0.4::DOUBLE), 0.4::DOUBLE) * exp(-0.0035::DOUBLE * least(p_size, 64)), 6) AS coasted,
    CAST(greatest(100, least(1000, floor(p_retailprice / 50 + 0.5) * 50)) AS BIGINT) AS pace,
    p_name || ' &lt; "' || p_type || '" — x y' AS label, left(p_name, 6) AS teaser, 'https://covers.example.org/' || p_partkey || '.webp' AS cover, '/books/' || p_partkey AS address,
    round(CASE WHEN p_size % 11 > 0 THEN greatest(0.0::DOUBLE, least(100.0::DOUBLE, (p_size * 10 - 100) * 100 / greatest(1, CASE WHEN p_size % 7 = 0 THEN 100 WHEN p_size % 5 = 0 THEN 60 ELSE p_retailprice / 4 END - 100))) ELSE 0.0 END, 6) AS percent,
    CAST(CASE WHEN p_size % 4 = 0 AND p_size > 0 THEN p_size WHEN p_size % 3 = 0 AND p_size * 30 < 500 THEN p_size * 30 WHEN p_size > 10 THEN p_size - 10 ELSE 0 END AS BIGINT) AS resume,
    format('{:,}', p_partkey * 1237) AS thousands, CASE WHEN length(CAST(p_partkey AS VARCHAR)) < 6 THEN lpad(CAST(p_partkey AS VARCHAR), 6, ' ') ELSE CAST(p_partkey AS VARCHAR) END AS padded
FROM part""",
    "scene_build": _SCENES + "\nSELECT * FROM scene",
    "scene_outcomes": _SCENES + "\nSELECT CASE WHEN missing THEN 'missing' WHEN out_of_order THEN 'out of order' ELSE 'in place' END AS outcome, count(*) AS n FROM scene GROUP BY outcome",
}
