"""Readers: catalogs, themed pages, keyed maps, text folders, journals, paged services and tiers."""

from __future__ import annotations

import json
import operator
import time
import urllib.error
import urllib.request
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, SimpleDataSourceStreamReader

from lectern.functions.text import is_html

BOOK = "id string, title string, author string, coverUrl string, textUrl string, downloadCount bigint, words bigint"
PAGE = f"key string, title string, hero array<struct<{BOOK.replace(' ', ':').replace(',:', ',')}>>, shelves array<struct<title:string,books:array<struct<{BOOK.replace(' ', ':').replace(',:', ',')}>>>>"
RAW_BOOK = "id bigint, title string, authors array<struct<name:string,birth_year:int,death_year:int>>, formats map<string,string>, download_count bigint, languages array<string>, subjects array<string>, bookshelves array<string>, copyright boolean, media_type string"
SCENES = "map<string,array<struct<startIndex:int,label:string,recap:string>>>"


def json_table(spark: SparkSession, path: str, schema: str = BOOK, lines: bool = False) -> DataFrame:
    """A file that holds one array of rows, or a row a line (SRC-01); the schema is given, never inferred."""
    return spark.read.schema(schema).option("multiLine", not lines).json(path)


def themed_pages(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Pages flattened to one row for each book and place (SRC-02); section 0 is the hero."""
    pages = json_table(spark, path, PAGE, lines)
    hero = pages.select("key", F.lit(0).alias("section"), F.lit(0).alias("shelf_pos"), F.lit(None).cast("string").alias("shelf"), F.posexplode("hero").alias("book_pos", "b"))
    shelves = pages.select("key", F.posexplode("shelves").alias("shelf_pos", "s")).select("key", F.lit(1).alias("section"), "shelf_pos", F.col("s.title").alias("shelf"), F.posexplode("s.books").alias("book_pos", "b"))
    return hero.unionByName(shelves).select(F.col("key").alias("theme_key"), "section", "shelf_pos", "shelf", "book_pos", "b.*")


def keyed_map(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A file that holds one object, as (id, value) rows (SRC-03)."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", kind)).alias("id", "value"))


def scenes(spark: SparkSession, path: str) -> DataFrame:
    rows = keyed_map(spark, path, SCENES).select(F.col("id").alias("book_id"), F.explode("value").alias("s"))
    return rows.select("book_id", F.col("s.startIndex").alias("start_index"), F.col("s.label").alias("label"), F.col("s.recap").alias("recap"))


def text_folder(spark: SparkSession, path: str, only: list[str] | None = None) -> DataFrame:
    """Whole files as (book_id, text), the id being the file's stem (SRC-04); only prunes files by id (SRC-18).

    Of what text_by_id wrote the ids are its folders, and the line end that it puts behind each text is taken off.
    """
    files = spark.read.option("recursiveFileLookup", True).text(path if only is None else [f"{path}/{i}.txt" for i in only], wholetext=True)
    folder = F.url_decode(F.regexp_extract("_metadata.file_path", "/book_id=([^/]*)/[^/]*$", 1))
    stem = F.regexp_replace("_metadata.file_name", r"\.[^.]*$", "")
    text = F.when(folder == "", F.col("value")).otherwise(F.regexp_replace("value", r"\n\z", ""))
    return files.select(F.when(folder == "", stem).otherwise(folder).alias("book_id"), text.alias("text"))


def markdown_folder(spark: SparkSession, path: str) -> DataFrame:
    """Notes as (name, title, text), the title being the first heading (SRC-14)."""
    rows = text_folder(spark, path)
    title = F.regexp_extract("text", r"(?m)^# +(.+)$", 1)
    return rows.select(F.col("book_id").alias("name"), F.when(title == "", F.col("book_id")).otherwise(F.trim(title)).alias("title"), "text")


def ordered_report(spark: SparkSession, path: str) -> DataFrame:
    """(part, at, line) of a report that writers.ordered_report wrote: the files that its manifest names, in their order."""
    manifest = json.loads(spark.read.text(f"{path}/manifest.json", wholetext=True).first().value)
    names = [p["file"].rpartition("/")[2] for p in manifest["parts"]]
    if not names:
        return spark.createDataFrame([], "part int, at int, line string")
    files = spark.read.text([f"{path}/{p['file']}" for p in manifest["parts"]], wholetext=True)
    number = F.substring_index(F.substring_index("_metadata.file_name", "-", 2), "-", -1).cast("int")
    lines = F.split(F.regexp_replace("value", r"\n\z", ""), "\n")
    return files.select(number.alias("part"), F.posexplode(lines).alias("at", "line"))


def journal(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a journal as (value) VARIANT; blank, cut-off and other lines that aren't JSON are skipped (SRC-10)."""
    lines = spark.read.text(path)
    return lines.select(F.try_parse_json("value").alias("value")).filter("value is not null")


def first_tier(key: str, *tiers: DataFrame, text: str = "text") -> DataFrame:
    """Each key's text from the first tier that has one: blank texts and HTML answers don't count (SRC-13, SRC-12)."""
    every = None
    for i, t in enumerate(tiers):
        ranked = t.select(key, F.col(text).alias("text"), F.lit(i).alias("tier")).filter((F.col("text") != "") & ~is_html(F.col("text")))
        every = ranked if every is None else every.unionByName(ranked)
    return every.groupBy(key).agg(F.min_by(F.struct("tier", "text"), "tier").alias("r")).select(key, "r.*")


def readable(n_bytes: Column) -> Column:
    """Whether a file of this size holds a text (SRC-09)."""
    return n_bytes > 8000


def _get(url: str, tries: int, pause: float, timeout: float) -> bytes | None:
    """The answer, or null for "not found"; other failures are tried again after longer and longer pauses (SRC-08, FN-27)."""
    for i in range(1, tries + 1):
        try:
            with urllib.request.urlopen(url, timeout=timeout) as answer:
                return answer.read()
        except urllib.error.HTTPError as e:
            if e.code == 404:
                return None
            if i == tries:
                raise
        except urllib.error.URLError as e:
            if isinstance(e.reason, FileNotFoundError):
                return None
            if i == tries:
                raise
        time.sleep(pause * i)
    return None


class PagedCatalog(DataSource):
    """format("paged_catalog"): the `results` of a service that pages by number or by a `next` address (SRC-05, SRC-06).

    Options: url (with {page}), pages (how many to ask for at most), tries, pause, timeout; cursor=true follows `next`
    from page 1 instead, which only one task can do. Pages by number are dealt to at most TASKS tasks; a missing page is empty.
    With ids_url (with {ids}) a filter on ids asks for these alone, IDS_EACH at once.

    With push=true filters on page and id (equal, in, less, greater) are taken into account before anything is fetched
    (SRC-18); spark.sql.python.filterPushdown.enabled must be true then. As a stream it reads `every` pages a batch; its offset is the page
    to go on with, so a stopped run goes on there (SNK-03). A missing or empty page ends it.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_catalog"

    def schema(self) -> str:
        return "page int, id string, book string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return (_PushedReader if self.options.get("push") == "true" else _PagedReader)(self.options)

    def simpleStreamReader(self, schema: T.StructType) -> SimpleDataSourceStreamReader:
        return _PageStream(self.options)


#: Ids that a service is asked for at once.
IDS_EACH = 32
#: Tasks that pages by number are dealt to at most.
TASKS = 200
_COMPARE = {EqualTo: operator.eq, LessThan: operator.lt, LessThanOrEqual: operator.le, GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge, In: lambda x, some: x in some}


class _Pages:
    def __init__(self, options: dict):
        self.url, self.pages, self.cursor = options["url"], int(options.get("pages", 1)), options.get("cursor", "false") == "true"
        self.ids_url, self.every = options.get("ids_url"), int(options.get("every", 50))
        self.how = int(options.get("tries", 3)), float(options.get("pause", 0.7)), float(options.get("timeout", 30))

    def answer(self, url: str) -> tuple[list[tuple[str, str]], str | None]:
        """(id, book) of an address, and the address that follows."""
        found = json.loads(_get(url, *self.how) or b"{}")
        return [(str(b.get("id")), json.dumps(b, ensure_ascii=False)) for b in found.get("results") or []], found.get("next")


class _PagedReader(_Pages, DataSourceReader):
    def __init__(self, options: dict):
        super().__init__(options)
        self.wanted: list[tuple] = []  # (how, value) that a page must meet
        self.ids: set[str] | None = None

    def _fits(self, page: int) -> bool:
        return all(how(page, value) for how, value in self.wanted)

    def partitions(self) -> list[InputPartition]:
        if self.ids is not None:  # books that are asked for by id come on page 0
            some = sorted(self.ids) if self._fits(0) else []
            return [InputPartition(some[i : i + IDS_EACH]) for i in range(0, len(some), IDS_EACH)]
        if self.cursor:
            return [InputPartition(None)]
        asked = [p for p in range(1, self.pages + 1) if self._fits(p)]
        each = max(1, -(-len(asked) // TASKS))
        return [InputPartition(tuple(asked[i : i + each])) for i in range(0, len(asked), each)]

    def read(self, partition: InputPartition | None) -> Iterator[tuple]:
        if partition is None:  # nothing is left to ask for
            return
        if isinstance(partition.value, list):
            for id_, book in self.answer(self.ids_url.format(ids=",".join(partition.value)))[0]:
                if id_ in self.ids:
                    yield 0, id_, book
            return
        if partition.value is not None:
            for page in partition.value:
                yield from ((page, *b) for b in self.answer(self.url.format(page=page))[0])
            return
        page, url = 1, self.url.format(page=1)
        last = max((p for p in range(1, self.pages + 1) if self._fits(p)), default=0)
        while url and page <= last:
            books, url = self.answer(url)
            if self._fits(page):
                yield from ((page, *b) for b in books)
            page += 1


class _PushedReader(_PagedReader):
    """Only for sessions that push filters: others refuse a reader that could take them."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            how = _COMPARE.get(type(f))
            if how and f.attribute == ("page",):
                self.wanted.append((how, f.value))
            elif self.ids_url and isinstance(f, (EqualTo, In)) and f.attribute == ("id",):
                some = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.ids = some if self.ids is None else self.ids & some
            else:
                yield f


class _PageStream(_Pages, SimpleDataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"page": 1, "url": self.url.format(page=1)}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, at = [], dict(start)
        for _ in range(self.every):
            if at["url"] is None or at["page"] > self.pages:
                break
            books, follows = self.answer(at["url"])
            if not books:
                break
            rows += [(at["page"], *b) for b in books]
            page = at["page"] + 1
            at = {"page": page, "url": follows if self.cursor else self.url.format(page=page)}
        return iter(rows), at

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        at = dict(start)
        while at["page"] < end["page"]:
            books, follows = self.answer(at["url"])
            yield from ((at["page"], *b) for b in books)
            at = {"page": at["page"] + 1, "url": follows if self.cursor else self.url.format(page=at["page"] + 1)}


def paged_catalog(spark: SparkSession, url: str, pages: int, cursor: bool = False, **options: str) -> DataFrame:
    """Raw catalog rows of a paged service; filters on page and id are pushed into it where the session allows that (SRC-18)."""
    spark.dataSource.register(PagedCatalog)
    push = spark.conf.get("spark.sql.python.filterPushdown.enabled")
    rows = spark.read.format("paged_catalog").options(url=url, pages=pages, cursor=str(cursor).lower(), push=push, **options).load()
    # a table remembers the filters last pushed into it, so every query has one to push
    return rows.filter("page >= 0").select("page", F.from_json("book", RAW_BOOK).alias("b"), F.col("id").alias("key")).select("page", "key", "b.*")


def pages_a_step(pages: int, least: int = 50, most: int = 2000, steps: int = 20) -> int:
    """For `every`: a share of the pages, so that a stream has no more than about so many steps; at most what the driver, through which a step's rows go, can well hold."""
    return min(max(least, -(-pages // steps)), most)


def paged_stream(spark: SparkSession, url: str, pages: int, cursor: bool = False, **options: str) -> DataFrame:
    """The same service as a stream of (page, id, book as JSON), that a checkpoint lets go on where it stopped."""
    spark.dataSource.register(PagedCatalog)
    return spark.readStream.format("paged_catalog").options(url=url, pages=pages, cursor=str(cursor).lower(), **options).load()


def run_ids(curated: DataFrame, themed: DataFrame, ids: list[str] | None = None, theme: str | None = None, curated_only: bool = False, limit: int | None = None, done: DataFrame | None = None, force: bool = False) -> DataFrame:
    """(id, place): which books a run is about, in its order (SRC-18), for fetched() or looked_up() to ask for.

    ids names them; else the curated ones unless a theme is asked for, and then those on the pages, of that theme or
    all, unless curated_only. Each id counts once, where it comes first; limit keeps the first of them. Ids in done
    are left out, after the limit, unless force. curated holds (id, place), themed what themed_pages gives.
    """
    if ids:
        spark = curated.sparkSession
        first: dict[str, int] = {}
        for i, id_ in enumerate(ids):
            first.setdefault(id_.strip(), i)
        places = spark.createDataFrame([(i, p) for i, p in first.items() if i], "id string, place long").withColumn("part", F.lit(0))
        rows = places.select("id", F.struct("part", F.lit("").alias("theme"), F.lit(0).alias("section"), F.lit(0).alias("shelf"), F.col("place").alias("at")).alias("place"))
    else:
        own = curated.select("id", F.struct(F.lit(0).alias("part"), F.lit("").alias("theme"), F.lit(0).alias("section"), F.lit(0).alias("shelf"), F.col("place").cast("long").alias("at")).alias("place"))
        shelved = themed.select("id", F.struct(F.lit(1).alias("part"), F.col("theme_key").alias("theme"), F.col("section").alias("section"), F.col("shelf_pos").alias("shelf"), F.col("book_pos").cast("long").alias("at")).alias("place"))
        if theme is not None:
            own, shelved = own.limit(0), shelved.filter(F.col("place.theme") == theme)
        rows = own if curated_only else own.unionByName(shelved)
    first_of = rows.filter("id <> ''").groupBy("id").agg(F.min("place").alias("place"))
    if limit is not None:
        first_of = first_of.orderBy("place").limit(limit)
    if done is not None and not force:
        first_of = first_of.join(done.select("id"), "id", "left_anti")
    return first_of


def fetched(ids: DataFrame, urls: list[str], tries: int = 3, pause: float = 2.0, timeout: float = 60) -> DataFrame:
    """(id, text, error) for each id: the first of the addresses (with {id}) that answers (SRC-08)."""

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, errors = [], []
            for i in batch["id"].to_pylist():
                found, error = None, "not found"
                for url in urls:
                    try:
                        found = _get(url.format(id=i), tries, pause, timeout)
                    except OSError as e:
                        error = str(e)
                    if found is not None:
                        break
                texts.append(None if found is None else found.decode("utf-8", "replace"))
                errors.append(error if found is None else None)
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(texts, pa.string()), pa.array(errors, pa.string())], names=["id", "text", "error"])

    n = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes, but each asks for a text: not to be put together
    return ids.select(F.col("id").cast("string").alias("id")).repartition(n, "id").mapInArrow(get, "id string, text string, error string")


STATE = "version int, state string"
READER_STATE = (
    "stats struct<wordsRead:bigint,msRead:bigint>, wpm int, visMode string, fitMode string, progress struct<bookId:string,currentIndex:bigint,totalTokens:bigint,lastReadAt:bigint>, "
    "progressById map<string,struct<bookId:string,currentIndex:bigint,totalTokens:bigint,lastReadAt:bigint>>, savedById map<string,bigint>"
)


def reader_states(spark: SparkSession, path: str) -> DataFrame:
    """Saved client states, one JSON object (state, version) a line, as what ledger.migrate takes (SRC-16).

    A line that isn't JSON is skipped; a missing version is 0; saved books are kept by id with their time.
    """
    lines = journal(spark, path).select(F.to_json("value").alias("text"))
    rows = lines.select(F.coalesce(F.get_json_object("text", "$.version").cast("int"), F.lit(0)).alias("version"), F.from_json(F.get_json_object("text", "$.state"), READER_STATE).alias("s"))
    slot = lambda p: F.when(p.isNotNull(), F.struct(p["bookId"].alias("book_id"), p["currentIndex"].alias("current_index"), p["totalTokens"].alias("total_tokens"), p["lastReadAt"].alias("last_read_at")))
    return rows.select(
        "version", F.col("s.stats.wordsRead").alias("words_read"), F.col("s.stats.msRead").alias("ms_read"), "s.wpm", F.col("s.visMode").alias("vis_mode"), F.col("s.fitMode").alias("fit_mode"),
        slot(F.col("s.progress")).alias("progress"), F.transform_values("s.progressById", lambda _, p: slot(p)).alias("progress_by_id"), F.col("s.savedById").alias("saved_by_id"),
    )


def looked_up(ids: DataFrame, url: str, size: int = 32, tries: int = 3, pause: float = 0.7, timeout: float = 30) -> DataFrame:
    """(id, book) of the `results` of a service that is asked for up to `size` ids at once (SRC-07); url has {ids}.

    Ids that it doesn't know give no row. A partition's ids are asked for in its own order.
    """

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[str] = []

        def answered(some: list[str]) -> pa.RecordBatch:
            found = json.loads(_get(url.format(ids=",".join(some)), tries, pause, timeout) or b"{}").get("results") or []
            return pa.RecordBatch.from_arrays([pa.array([str(b["id"]) for b in found], pa.string()), pa.array([json.dumps(b, ensure_ascii=False) for b in found], pa.string())], names=["id", "book"])

        for batch in batches:
            waiting += batch["id"].to_pylist()
            while len(waiting) >= size:
                yield answered(waiting[:size])
                waiting = waiting[size:]
        if waiting:
            yield answered(waiting)

    return ids.select(F.col("id").cast("string").alias("id")).filter("id is not null").mapInArrow(get, "id string, book string")
