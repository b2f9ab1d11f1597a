"""Catalog queries: search, popularity, themed shelves and editions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import display_author, display_title, rounded, title_key

MIME = ("text/plain; charset=utf-8", "text/plain; charset=us-ascii", "text/plain")
PAGE_LEAST, HERO_SIZE, SHELF_SIZE = 100, 14, 20
#: Letters in the runs by which titles are looked up.
RUN = 4


def text_url(formats: Column) -> Column:
    """The first preferred plain-text file that isn't an archive, else the first by type name (PRJ-05).

    Maps have no order of their own here, so names decide among the others.
    """
    plain = lambda url: F.when(~url.endswith(".zip") & (url != ""), url)
    other = F.filter(F.array_sort(F.map_entries(formats)), lambda e: e["key"].startswith("text/plain") & ~e["value"].endswith(".zip"))
    return F.coalesce(*[plain(F.try_element_at(formats, F.lit(m))) for m in MIME], F.try_element_at(other, F.lit(1))["value"])


def books_of(raw: DataFrame) -> DataFrame:
    """Catalog rows of a library's API (PRJ-01)."""
    author = F.try_element_at("authors", F.lit(1))["name"]
    return raw.select(F.col("id").cast("string").alias("id"), display_title(F.col("title")).alias("title"), display_author(author).alias("author"), F.try_element_at("formats", F.lit("image/jpeg")).alias("cover_url"), text_url(F.col("formats")).alias("text_url"), "download_count")


def lean(raw: DataFrame) -> DataFrame:
    """Only what gates and shelves need, with empty lists for missing ones (PRJ-02)."""
    listed = lambda c: F.coalesce(c, F.array().cast("array<string>")).alias(c)
    author = F.try_element_at("authors", F.lit(1))
    return raw.select(F.col("id").cast("string").alias("id"), "title", author["name"].alias("author"), author["death_year"].alias("author_death"), *map(listed, ("languages", "subjects", "bookshelves")), "copyright", "media_type", F.coalesce("download_count", F.lit(0)).alias("downloads"), text_url(F.col("formats")).alias("text_url"), F.try_element_at("formats", F.lit("image/jpeg")).isNotNull().alias("has_cover"))


def search(catalog: DataFrame, needle: str) -> DataFrame:
    """Rows with the needle in title or author, in any case; a blank needle finds nothing (FLT-01)."""
    wanted = needle.strip().lower()
    if not wanted:
        return catalog.limit(0)
    return catalog.filter(F.lower("title").contains(wanted) | F.lower("author").contains(wanted))


def search_with_fallback(local: DataFrame, remote: DataFrame, needle: str) -> DataFrame:
    """The remote catalog answers only if the local one has nothing (FLT-02)."""
    found = search(local, needle)
    none = found.limit(1).agg((F.count("*") == 0).alias("none"))  # one row
    return found.unionByName(search(remote, needle).crossJoin(F.broadcast(none)).filter("none").drop("none"))


def popular(catalog: DataFrame, n: int = 100, key: str = "id") -> DataFrame:
    """The n most downloaded, none counting 0, with their rank (SRT-01): the limit comes before the rank."""
    top = catalog.withColumn("downloads", F.coalesce("downloads", F.lit(0))).orderBy(F.desc("downloads"), key).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("downloads"), key)))


def first_of_title(shelves: DataFrame, theme: str = "theme_key") -> DataFrame:
    """Each title once a theme: the hero's before the shelves', then by place (AGG-15)."""
    order = Window.partitionBy(theme, title_key(F.col("title"))).orderBy("section", "shelf_pos", "book_pos")
    return shelves.withColumn("_first", F.row_number().over(order)).filter("_first = 1").drop("_first")


def heroes(candidates: DataFrame, front: DataFrame, n: int = HERO_SIZE, theme: str = "theme_key", key: str = "id") -> DataFrame:
    """The n most downloaded verified books of each theme that have a cover and aren't in the front catalog (SRT-09, JN-04)."""
    open_ = candidates.filter("has_cover and verified").join(front.select(key).distinct(), key, "left_anti")
    order = Window.partitionBy(theme).orderBy(F.desc("downloads"), key)
    return open_.withColumn("hero_pos", F.row_number().over(order)).filter(F.col("hero_pos") <= n)


def fill_shelves(candidates: DataFrame, used: DataFrame, n_shelves: int, n: int = SHELF_SIZE, theme: str = "theme_key", key: str = "id") -> DataFrame:
    """(theme, shelf_pos, place, key): the shelves of every theme in turn, each with its first n verified books that no earlier shelf took (SRT-10).

    A book that a full shelf passed over stays open to later ones. Earlier shelves take at most n * n_shelves books, so
    among the first n * n_shelves of a shelf's own are all that it can take: those, found by partial ranks before the
    shuffle, meet in one array a theme, which is gone through once with the ids taken so far in hand.
    """
    open_ = candidates.filter(F.col("verified") & F.col("shelf_pos").between(0, n_shelves - 1)).join(used.select(theme, key).distinct(), [theme, key], "left_anti")
    once = open_.groupBy(theme, "shelf_pos", key).agg(F.min("book_pos").alias("book_pos"))
    rank = F.row_number().over(Window.partitionBy(theme, "shelf_pos").orderBy("book_pos", key))
    first = once.withColumn("rank", rank).filter(F.col("rank") <= n * n_shelves)
    entry = F.struct("shelf_pos", "book_pos", F.col(key).alias("id"))
    rows = first.groupBy(theme).agg(F.array_sort(F.collect_list(entry)).alias("rows"))
    id_type = candidates.schema[key].dataType.simpleString()
    none = F.struct(F.lit(-1).alias("shelf"), F.lit(0).alias("place"), F.array().cast(f"array<struct<shelf_pos:int,place:int,id:{id_type}>>").alias("picked"))

    def step(acc: Column, x: Column) -> Column:
        before = F.when(acc["shelf"] == x["shelf_pos"], acc["place"]).otherwise(0)
        takes = (before < n) & ~F.exists(acc["picked"], lambda p: p["id"] == x["id"])
        taken = F.array(F.struct(x["shelf_pos"].cast("int").alias("shelf_pos"), (before + 1).alias("place"), x["id"].alias("id")))
        return F.struct(x["shelf_pos"].cast("int").alias("shelf"), (before + takes.cast("int")).alias("place"), F.when(takes, F.concat(acc["picked"], taken)).otherwise(acc["picked"]).alias("picked"))

    picked = F.aggregate("rows", none, step)["picked"]
    return rows.select(theme, F.explode(picked).alias("p")).select(theme, "p.shelf_pos", "p.place", F.col("p.id").alias(key))


def page_sizes(hero: DataFrame, shelves: DataFrame, theme: str = "theme_key") -> DataFrame:
    """Books on each page and whether it has too few (AGG-16)."""
    both = hero.select(theme).unionByName(shelves.select(theme)).groupBy(theme).agg(F.count("*").alias("n_books"))
    return both.withColumn("too_few", F.col("n_books") < PAGE_LEAST)


def short_reads(catalog: DataFrame, wpm: int = 300, minutes: int = 45) -> DataFrame:
    """Books that are read in 45 minutes, shortest first (FLT-08)."""
    return catalog.filter((F.col("words") > 0) & (F.col("words") / max(1, wpm) <= minutes)).orderBy("words", "id")


def words_from_bytes(n_bytes: Column) -> Column:
    return rounded(n_bytes / 6.1)


def edition_key(title: Column) -> Column:
    plain = F.regexp_replace(F.replace(F.lower(F.trim(title)), F.lit("centre"), F.lit("center")), "[^a-z0-9 ]", "")
    return F.regexp_replace(plain, " +", " ")


def last_name(author: Column) -> Column:
    return F.coalesce(F.lower(F.try_element_at(F.filter(F.split(F.coalesce(author, F.lit("")), "[ ,]"), lambda p: p != ""), F.lit(-1))), F.lit(""))


def contained(needles: DataFrame, texts: DataFrame, run: int = RUN) -> DataFrame:
    """(needle, text): all pairs of distinct strings of two one-column tables, `needle` and `text`, where the text contains the needle.

    Every run of `run` letters in a needle stands in each text that contains it, so a needle meets the texts through
    one of its runs alone: the one that fewest texts have. A run that no text has finds nothing. Needles shorter than
    a run are looked up whole among the texts' runs of their length. Empty needles are in every text and nulls in none;
    both give no pairs here.
    """
    cuts = lambda c, n: F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: F.substring(F.col(c), i, n))
    needles, texts = needles.filter("needle <> ''").distinct(), texts.filter("text <> ''").distinct()
    every = F.array_distinct(F.flatten(F.array(*[F.when(F.length("text") >= n, cuts("text", F.lit(n))).otherwise(F.array().cast("array<string>")) for n in range(1, run + 1)])))
    runs = texts.select("text", F.explode(every).alias("run"))
    asked = needles.select("needle", F.explode(F.array_distinct(cuts("needle", F.least(F.length("needle"), F.lit(run))))).alias("run"))
    often = runs.join(asked.select("run").distinct(), "run", "left_semi").groupBy("run").agg(F.count("*").alias("texts"))
    rare = asked.join(often, "run", "left").groupBy("needle").agg(F.min_by("run", F.struct(F.coalesce("texts", F.lit(0)), "run")).alias("run"))
    return rare.join(runs, "run").filter(F.col("text").contains(F.col("needle"))).select("needle", "text")


def replacements(dead: DataFrame, catalog: DataFrame) -> DataFrame:
    """For each dead entry the most downloaded readable edition (JN-12): titles equal or one within the other, and the author.

    The author's last name must stand in the edition's author, unless it is missing or "unknown". Titles are compared
    once each, both ways, by contained(); a title that is empty once its marks are gone stands in every other, and the
    best edition of each author is all that such a pair can give. Null titles count as empty, null downloads as 0.
    """
    d = dead.select(F.col("id").alias("dead_id"), F.coalesce(edition_key(F.col("title")), F.lit("")).alias("want"), last_name(F.col("author")).alias("by"))
    c = catalog.filter("readable").select("id", F.coalesce(edition_key(F.col("title")), F.lit("")).alias("have"), F.coalesce(F.lower("author"), F.lit("")).alias("author"), F.coalesce("downloads", F.lit(0)).alias("downloads"))
    wanted = d.select("want", F.when(F.col("by") == "unknown", "").otherwise(F.col("by")).alias("by")).distinct()
    best = lambda rows, *keys: rows.groupBy(*keys).agg(F.min(F.struct((-F.col("downloads")).alias("less"), "id")).alias("best"))
    editions = best(c, "have", "author")
    merged = lambda rows, *keys: rows.groupBy(*keys).agg(F.min("best").alias("best"))

    one, other = wanted.select(F.col("want").alias("needle")), editions.select(F.col("have").alias("text"))
    within = contained(one, other).withColumnsRenamed({"needle": "want", "text": "have"})
    around = contained(other.withColumnRenamed("text", "needle"), one.withColumnRenamed("needle", "text")).withColumnsRenamed({"needle": "have", "text": "want"})
    pairs = within.unionByName(around).distinct()
    fits = (F.col("by") == "") | F.col("author").contains(F.col("by"))
    met = wanted.filter("want <> ''").join(pairs, "want").join(editions, "have").filter(fits).select("want", "by", "best")

    # an empty title on either side: whatever edition there is, by author
    loose = merged(editions, "author").withColumn("which", F.lit("any")).unionByName(merged(editions.filter("have = ''"), "author").withColumn("which", F.lit("bare")))
    asked = wanted.select("want", "by", F.when(F.col("want") == "", "any").otherwise("bare").alias("which"))
    names = contained(asked.select(F.col("by").alias("needle")), loose.select(F.col("author").alias("text"))).withColumnsRenamed({"needle": "by", "text": "author"})
    by_name = asked.filter("by <> ''").join(names, "by").join(loose, ["author", "which"]).select("want", "by", "best")
    by_none = asked.filter("by = ''").join(merged(loose, "which"), "which").select("want", "by", "best")
    found = merged(met.unionByName(by_name).unionByName(by_none), "want", "by")
    keyed = d.withColumn("by", F.when(F.col("by") == "unknown", "").otherwise(F.col("by")))
    return keyed.join(found, ["want", "by"]).select("dead_id", F.col("best.id").alias("id"), (-F.col("best.less")).alias("downloads"))


def has_text(url: Column) -> Column:
    """Whether an entry names a file that can be read (FLT-07)."""
    return F.coalesce(F.trim(url) != "", F.lit(False))


def page_of(asked: DataFrame, pages: DataFrame, key: str = "key") -> DataFrame:
    """Each key asked for with its page, null if there is none (JN-13)."""
    return asked.join(pages, key, "left")


def pick_of_the_day(hero: DataFrame, every: DataFrame, theme: str = "theme_key", key: str = "id") -> DataFrame:
    """Each theme's first hero, else its first book (SRT-04), from (theme, place, key)."""
    first = lambda rows, name: rows.groupBy(theme).agg(F.min_by(key, F.struct("place", key)).alias(name))
    return first(every, "_any").join(first(hero, "_hero"), theme, "full_outer").select(theme, F.coalesce("_hero", "_any").alias(key))


def chips(books: DataFrame, in_progress: DataFrame, wpm: int = 300, theme: str = "theme_key", key: str = "id") -> DataFrame:
    """Filters to show on each page (FLT-18): short reads if it has 3 or more, continue if it has a book in progress."""
    short = (F.col("words") > 0) & (F.col("words") / max(1, wpm) <= 45)
    known = books.join(in_progress.select(key).distinct().withColumn("_now", F.lit(True)), key, "left")
    return known.groupBy(theme).agg((F.count_if(short) >= 3).alias("short_reads"), (F.count_if("_now") >= 1).alias("continue"))


def lanes(books: DataFrame, n: int, order: list[Column], lane: str) -> DataFrame:
    """The first n rows of each lane with their place (SRT-05)."""
    return books.withColumn("place", F.row_number().over(Window.partitionBy(lane).orderBy(*order))).filter(F.col("place") <= n)


def most_common(words: DataFrame, n: int, word: str = "word") -> DataFrame:
    """The n words of most rows, from an array column of distinct words (AGG-05, SRT-06)."""
    return words.select(F.explode(word).alias("word")).groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(n)
