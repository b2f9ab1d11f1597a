"""Queries over the catalog, readers and ledgers, carried by the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import text as fn
from lectern.operators import catalog as cat
from lectern.operators import ledger, reading
from lectern.plans.common import table
from lectern.sources import readers


def parts_as_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as catalog entries, with their sales as downloads (JN-01: none counts 0)."""
    sold = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("id")).agg(F.count("*").alias("downloads"))
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_brand").alias("author"), F.col("p_type").alias("theme_key"), "p_size", "p_retailprice")
    return p.join(sold, "id", "left").withColumn("downloads", F.coalesce("downloads", F.lit(0)))


def catalog_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.search(parts_as_books(spark, sf_dir), " Brand#1 ").select("id", "title", "author")


def popular_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.popular(parts_as_books(spark, sf_dir)).select("rank", "id", "title", "downloads")


def _shelved(books: DataFrame) -> DataFrame:
    """Each type a theme, each size modulo 5 a shelf, cheapest books first."""
    return books.select("theme_key", F.lit(1).alias("section"), (F.col("p_size") % 5).alias("shelf_pos"), (F.col("p_retailprice") * 100).cast("long").alias("book_pos"), "id", "title", "downloads", (F.col("id") % 3 != 0).alias("verified"), (F.col("id") % 4 != 0).alias("has_cover"))


def title_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    shelves = _shelved(parts_as_books(spark, sf_dir)).withColumn("book_pos", F.col("id"))
    return cat.first_of_title(shelves).select("theme_key", "shelf_pos", "id", "title")


def hero_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    books = _shelved(parts_as_books(spark, sf_dir))
    return cat.heroes(books, books.filter("id % 10 = 0")).select("theme_key", "hero_pos", "id", "downloads")


def shelf_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every book stands on its own shelf and on the next, so shelves compete."""
    books = _shelved(parts_as_books(spark, sf_dir))
    both = books.unionByName(books.withColumn("shelf_pos", (F.col("shelf_pos") + 1) % 5))
    return cat.fill_shelves(both, cat.heroes(books, books.filter("id % 10 = 0")), 5).select("theme_key", "shelf_pos", "place", "id")


def page_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    books = _shelved(parts_as_books(spark, sf_dir))
    return cat.page_sizes(cat.heroes(books, books.filter("id % 10 = 0")), books.filter("verified"))


def in_progress_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open orders of the customers on one page (JN-02)."""
    page = table(spark, sf_dir, "customer").filter("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, sf_dir, "orders").filter("o_orderstatus = 'O'").join(page, "o_custkey", "left_semi").select("o_orderkey", "o_custkey")


def progress_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's last order as reading progress, with percent and whether it is finished (MRG-08, PRJ-09, FLT-09)."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", (F.col("o_orderkey") % 1000).alias("index"), F.lit(1000).alias("total"))
    last = reading.latest(orders, ["o_custkey"], "o_orderdate", "o_orderkey")
    return last.select("o_custkey", "o_orderkey", "o_orderdate", reading.progress_percent(F.col("index"), F.col("total")).alias("percent"), reading.finished(F.col("index"), F.col("total")).alias("finished"))


def toggle_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases as toggles of the book in the event's properties."""
    k = F.get_json_object("props", "$.k").cast("long")
    events = table(spark, sf_dir, "events").filter("event_type = 'purchase'").select("user_id", (k % 10).alias("book"), "ts")
    return reading.saved(events, ["user_id", "book"], "ts")


def play_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views as play, clicks as pause, values as positions: an invented reading."""
    e = table(spark, sf_dir, "events").filter("event_type in ('view', 'click')")
    return e.select("user_id", "ts", (F.col("event_type") == "view").alias("playing"), F.floor(F.col("value") * 10).alias("index"), F.col("event_id").alias("tie"))


def reading_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading.sessions(play_events(spark, sf_dir), ["user_id"])


def reading_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading.statistics(reading_sessions(spark, sf_dir), ["user_id"])


def progress_throttle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written at most once in six hours while playing: events are hours apart."""
    return reading.throttled(play_events(spark, sf_dir), ["user_id"], 6 * 3600 * 1000).select("user_id", "ts", "index", F.col("tie").alias("event_id"))


def _snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("n_chars") < 2000, "short").otherwise("story").alias("tier"))
    verdicts = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("keep"))
    return ledger.apply_verdicts(docs, verdicts, ["doc_id"])


def verdict_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.verdict_counts(_snippets(spark, sf_dir))


def ledger_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as the old ledger, documents' sizes as the new, merged by three rules."""
    old = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, F.col("quality").cast("long")).alias("v"))
    new = table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").alias("v"))
    rules = {"keep": ledger.keep_existing, "overwrite": ledger.overwrite, "fill": ledger.fill}
    merged = [f(old, new, ["doc_id"]).withColumn("rule", F.lit(k)) for k, f in rules.items()]
    return merged[0].unionByName(merged[1]).unionByName(merged[2]).select("rule", "doc_id", "v")


def batch_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    done = table(spark, sf_dir, "labels").select("doc_id")
    return ledger.queue(docs, done, ["doc_id"], [F.desc("n_chars"), F.col("doc_id")], 400, 40).select("doc_id", "n_chars", F.col("place").cast("long").alias("place"), F.col("batch").cast("long").alias("batch"))


def cover_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    seed = fn.rolling_hash(F.concat("p_name", "p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", seed.alias("seed"), (seed % 3).alias("variant"), (seed % 4).alias("tint"))


def author_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' names as "Segment, Name" and in other shapes."""
    k = F.col("c_custkey")
    name = F.when(k % 5 == 0, F.concat("c_mktsegment", F.lit(", "), "c_name")).when(k % 5 == 1, F.concat("c_name", F.lit(","))).when(k % 5 == 2, F.concat_ws(",", "c_name", "c_mktsegment", "c_name")).when(k % 5 == 3, F.lit(None)).otherwise(F.col("c_name"))
    return table(spark, sf_dir, "customer").select("c_custkey", fn.display_author(name).alias("author"))


def read_time_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.octet_length("text")
    n = cat.words_from_bytes(size * 40)
    return table(spark, sf_dir, "documents").select("doc_id", readers.readable(size.cast("long")).alias("readable"), n.alias("words"), fn.read_time_label(n, F.lit(300)).alias("label"), fn.duration_label(n / 300.0).alias("duration"))


def replacement_editions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth part lost its text: under shortened, longer, short, null and bare titles the best of the others is looked for (JN-12, FN-18, FN-19)."""
    books, k = parts_as_books(spark, sf_dir).withColumn("kind", F.substring_index("title", " ", 1)), F.col("id")
    lost = F.when(k % 80 == 0, F.col("title")).when(k % 80 == 10, F.concat(F.upper("title"), F.lit(" !"))).when(k % 80 == 20, F.col("kind")).when(k % 80 == 30, F.concat("title", F.lit("  of the Centre")))
    lost = lost.when(k % 80 == 40, "?!").when(k % 80 == 50, F.left("title", F.lit(2))).when(k % 80 == 60, F.lit(None)).otherwise(F.concat(F.lit("The "), "title"))
    by = F.when(k % 3 == 0, "Unknown").when(k % 3 == 1, F.concat("theme_key", F.lit(", "), "author")).otherwise("")
    dead = books.filter(k % 10 == 0).select("id", lost.alias("title"), by.alias("author"))
    title = F.when(k % 13 == 0, "***").when(k % 13 == 1, F.col("kind")).when(k % 13 == 2, F.concat("title", F.lit(" of the Center"))).otherwise(F.concat_ws(": ", "title", "theme_key"))
    other = books.filter(k % 10 != 0).select("id", title.alias("title"), F.concat_ws(" ", "theme_key", "author").alias("author"), F.when(k % 4 != 0, F.col("downloads")).alias("downloads"), (F.col("p_size") > 10).alias("readable"))
    return cat.replacements(dead, other)


QUERIES = {
    f.__name__: f
    for f in (catalog_search, popular_topk, title_dedupe, hero_topk, shelf_fill, page_sizes, in_progress_semi, progress_upsert, toggle_saved, reading_sessions, reading_stats, progress_throttle, verdict_apply, ledger_merge, batch_queue, cover_seed, author_format, read_time_label, replacement_editions)
}

_BOOK = "book AS (SELECT p_partkey AS id, p_name AS title, p_brand AS author, p_type AS theme_key, p_size, p_retailprice, (SELECT count(*) FROM lineitem WHERE l_partkey = p_partkey) AS downloads FROM part)"
_EDITION = lambda x: f"coalesce(regexp_replace(regexp_replace(replace(lower(trim({x})), 'centre', 'center'), '[^a-z0-9 ]', '', 'g'), ' +', ' ', 'g'), '')"
_SHELF = f"{_BOOK}, shelf AS (SELECT theme_key, p_size % 5 AS shelf_pos, CAST(trunc(p_retailprice * 100) AS BIGINT) AS book_pos, id, title, downloads, id % 3 <> 0 AS verified, id % 4 <> 0 AS has_cover FROM book)"
_HERO = f"{_SHELF}, hero AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY theme_key ORDER BY downloads DESC, id) AS hero_pos FROM shelf WHERE has_cover AND verified AND id % 10 <> 0) WHERE hero_pos <= 14)"
_FILL = ", ".join(
    f"""pick{i} AS (SELECT theme_key, {i} AS shelf_pos, place, id FROM (
    SELECT theme_key, id, row_number() OVER (PARTITION BY theme_key ORDER BY book_pos, id) AS place FROM (SELECT DISTINCT theme_key, id, book_pos FROM shelf WHERE verified AND (shelf_pos = {i} OR (shelf_pos + 1) % 5 = {i})) s
    WHERE NOT EXISTS (SELECT 1 FROM hero h WHERE h.theme_key = s.theme_key AND h.id = s.id) {"".join(f"AND NOT EXISTS (SELECT 1 FROM pick{j} h WHERE h.theme_key = s.theme_key AND h.id = s.id) " for j in range(i))}) WHERE place <= 20)"""
    for i in range(5)
)
_PLAY = "play AS (SELECT user_id, ts, event_type = 'view' AS playing, CAST(floor(value * 10) AS BIGINT) AS idx, event_id FROM events WHERE event_type IN ('view', 'click'))"
_SESSIONS = f"""{_PLAY}, turn AS (SELECT * FROM (SELECT *, coalesce(lag(playing) OVER (PARTITION BY user_id ORDER BY ts, event_id), false) AS was FROM play) WHERE playing <> was
), pair AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS end_ts, lead(idx) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS end_index FROM turn
), sess AS (SELECT user_id, ts AS start_ts, end_ts, greatest(end_index - idx, 0) AS words, (epoch_us(end_ts) - epoch_us(ts)) // 1000 AS ms FROM pair WHERE playing AND end_ts IS NOT NULL
), session AS (SELECT * FROM sess WHERE words > 0 AND ms > 0)"""

ORACLE_SQL = {
    "catalog_search": f"WITH {_BOOK} SELECT id, title, author FROM book WHERE contains(lower(title), 'brand#1') OR contains(lower(author), 'brand#1')",
    "popular_topk": f"WITH {_BOOK} SELECT CAST(row_number() OVER (ORDER BY downloads DESC, id) AS INT) AS rank, id, title, downloads FROM book ORDER BY downloads DESC, id LIMIT 100",
    "title_dedupe": f"WITH {_SHELF} SELECT theme_key, shelf_pos, id, title FROM (SELECT *, row_number() OVER (PARTITION BY theme_key, lower(title) ORDER BY shelf_pos, id) AS r FROM shelf) WHERE r = 1",
    "hero_topk": f"WITH {_HERO} SELECT theme_key, CAST(hero_pos AS INT) AS hero_pos, id, downloads FROM hero",
    "shelf_fill": f"WITH {_HERO}, {_FILL} " + " UNION ALL ".join(f"SELECT theme_key, CAST(shelf_pos AS INT) AS shelf_pos, CAST(place AS INT) AS place, id FROM pick{i}" for i in range(5)),
    "page_sizes": f"WITH {_HERO} SELECT theme_key, count(*) AS n_books, count(*) < 100 AS too_few FROM (SELECT theme_key FROM hero UNION ALL SELECT theme_key FROM shelf WHERE verified) GROUP BY theme_key",
    "in_progress_semi": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'O' AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')",
    "progress_upsert": """
SELECT o_custkey, o_orderkey, o_orderdate, CAST(least(100, floor((o_orderkey % 1000) / 10.0 + 0.5)) AS INT) AS percent, o_orderkey % 1000 >= 990 AS finished
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1""",
    "toggle_saved": """
SELECT user_id, CAST(props->>'$.k' AS BIGINT) % 10 AS book, count(*) AS toggles, max(ts) AS saved_at FROM events WHERE event_type = 'purchase' GROUP BY 1, 2 HAVING count(*) % 2 = 1""",
    "reading_sessions": f"WITH {_SESSIONS} SELECT * FROM session",
    "reading_stats": f"""
WITH {_SESSIONS}, t AS (SELECT user_id, CAST(sum(words) AS BIGINT) AS words, CAST(sum(ms) AS BIGINT) AS ms FROM session GROUP BY user_id
), p AS (SELECT *, CAST(floor(words * 60000.0::DOUBLE / ms + 0.5) AS BIGINT) AS wpm FROM t)
SELECT user_id, words, ms, wpm, CAST(floor(ms / 60000.0::DOUBLE + 0.5) AS BIGINT) AS minutes, words // 250 AS pages,
    CASE WHEN wpm > 250 THEN CAST(floor(words / 250.0::DOUBLE - words * 1.0::DOUBLE / wpm + 0.5) AS BIGINT) ELSE 0 END AS minutes_saved,
    CAST(floor(wpm * 100.0::DOUBLE / greatest(wpm, 250) + 0.5) AS BIGINT) AS your_bar, CAST(floor(25000.0::DOUBLE / greatest(wpm, 250) + 0.5) AS BIGINT) AS average_bar,
    CASE WHEN wpm / 250.0::DOUBLE > 1.03 THEN 'faster' WHEN wpm / 250.0::DOUBLE < 0.97 THEN 'slower' ELSE 'even' END AS pace
FROM p""",
    "progress_throttle": f"""
WITH RECURSIVE {_PLAY}, o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM play
), k AS (
    SELECT user_id, r, ts, idx, event_id, idx <> -1 AS write, CASE WHEN idx <> -1 THEN ts END AS last_ts, CASE WHEN idx <> -1 THEN idx ELSE -1 END AS last_idx FROM o WHERE r = 1
    UNION ALL
    SELECT user_id, r, ts, idx, event_id, w, CASE WHEN w THEN ts ELSE last_ts END, CASE WHEN w THEN idx ELSE last_idx END FROM (
        SELECT o.*, k.last_ts, k.last_idx, o.idx <> k.last_idx AND (NOT o.playing OR k.last_ts IS NULL OR o.ts - k.last_ts >= INTERVAL 6 HOURS) AS w FROM k JOIN o ON o.user_id = k.user_id AND o.r = k.r + 1)
)
SELECT user_id, ts, idx AS index, event_id FROM k WHERE write""",
    "verdict_apply": """
WITH j AS (SELECT CASE WHEN n_chars < 2000 THEN 'short' ELSE 'story' END AS tier, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT tier, count(*) AS had, count(*) FILTER (quality = 1) AS kept, count(*) FILTER (quality <> 1) AS killed, count(*) FILTER (quality IS NULL) AS unjudged,
    CAST(floor(100.0::DOUBLE * (count(*) - count(*) FILTER (quality = 1)) / count(*) + 0.5) AS INT) AS kill_rate FROM j GROUP BY tier""",
    "ledger_merge": """
WITH o AS (SELECT doc_id, CASE WHEN quality = 1 THEN CAST(quality AS BIGINT) END AS v FROM labels), n AS (SELECT doc_id, n_chars AS v FROM documents),
b AS (SELECT coalesce(o.doc_id, n.doc_id) AS doc_id, o.v AS ov, n.v AS nv, o.doc_id IS NOT NULL AS old, n.doc_id IS NOT NULL AS new FROM o FULL JOIN n ON o.doc_id = n.doc_id)
SELECT 'keep' AS rule, doc_id, CASE WHEN old THEN ov ELSE nv END AS v FROM b UNION ALL SELECT 'overwrite', doc_id, CASE WHEN new THEN nv ELSE ov END FROM b UNION ALL SELECT 'fill', doc_id, coalesce(ov, nv) FROM b""",
    "batch_queue": """
SELECT doc_id, n_chars, place, place // 40 AS batch FROM (SELECT doc_id, n_chars, row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1 AS place FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) WHERE place < 400""",
    "replacement_editions": f"""
WITH {_BOOK}, b AS (SELECT *, string_split(title, ' ')[1] AS kind FROM book
), dead AS (
    SELECT id AS dead_id, CASE id % 80 WHEN 0 THEN title WHEN 10 THEN upper(title) || ' !' WHEN 20 THEN kind WHEN 30 THEN title || '  of the Centre' WHEN 40 THEN '?!' WHEN 50 THEN left(title, 2) WHEN 60 THEN NULL ELSE 'The ' || title END AS title,
        CASE id % 3 WHEN 0 THEN 'Unknown' WHEN 1 THEN theme_key || ', ' || author ELSE '' END AS author FROM b WHERE id % 10 = 0
), other AS (
    SELECT id, CASE id % 13 WHEN 0 THEN '***' WHEN 1 THEN kind WHEN 2 THEN title || ' of the Center' ELSE title || ': ' || theme_key END AS title, lower(theme_key || ' ' || author) AS author, CASE WHEN id % 4 <> 0 THEN downloads ELSE 0 END AS downloads
    FROM b WHERE id % 10 <> 0 AND p_size > 10
), d AS (SELECT dead_id, {_EDITION("title")} AS want, coalesce(lower(list_filter(string_split_regex(author, '[ ,]'), lambda p: p <> '')[-1]), '') AS named FROM dead
), o AS (SELECT id, {_EDITION("title")} AS have, author, downloads FROM other)
SELECT dead_id, id, downloads FROM d, o WHERE (contains(have, want) OR contains(want, have)) AND (named IN ('', 'unknown') OR contains(author, named))
QUALIFY row_number() OVER (PARTITION BY dead_id ORDER BY downloads DESC, id) = 1""",
    "cover_seed": """
WITH s AS (SELECT p_partkey, list_reduce(list_transform(string_split(p_name || p_brand, ''), lambda c: CAST(ascii(c) AS BIGINT)), lambda h, c: (h * 31 + c) % 4294967296) AS seed FROM part)
SELECT p_partkey, seed, seed % 3 AS variant, seed % 4 AS tint FROM s""",
    "author_format": """
SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN c_name || ' ' || c_mktsegment WHEN 1 THEN c_name || ',' WHEN 2 THEN c_name || ',' || c_mktsegment || ',' || c_name WHEN 3 THEN 'Unknown' ELSE c_name END AS author FROM customer""",
    "read_time_label": """
WITH w AS (SELECT doc_id, strlen(text) > 8000 AS readable, CAST(floor(strlen(text) * 40 / 6.1::DOUBLE + 0.5) AS BIGINT) AS words FROM documents
), m AS (SELECT *, CAST(floor(words / 300.0::DOUBLE + 0.5) AS BIGINT) AS m FROM w)
SELECT doc_id, readable, words, CASE WHEN words = 0 THEN NULL WHEN m < 1 THEN '< 1 min' WHEN m < 60 THEN m || ' min' WHEN m % 60 >= 5 THEN (m // 60) || ' hr ' || (m % 60) || ' min' ELSE (m // 60) || ' hr' END AS label,
    CASE WHEN words / 300.0 < 1 THEN '< 1m' WHEN m < 60 THEN m || 'm' WHEN m % 60 > 0 THEN (m // 60) || 'h ' || (m % 60) || 'm' ELSE (m // 60) || 'h' END AS duration FROM m""",
}
