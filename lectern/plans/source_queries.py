"""Queries over nested journals, streams, and tables that writers wrote and readers read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import text as fn
from lectern.operators import annotations as an
from lectern.operators import ledger, nested, story
from lectern.plans import catalog_queries, sql, story_queries
from lectern.plans.catalog_queries import parts_as_books, play_events
from lectern.plans.common import table
from lectern.plans.text_queries import documents
from lectern.sources import readers, writers
from lectern.sources.shared import scratch
from lectern.streaming.reading import progress_stream, rocksdb, session_stream


def journal_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line, value): a line of JSON for each conversation and event, books at several depths, in objects, arrays and strings."""
    book = F.struct("turn", ((F.col("conv_id") * 7 + F.col("turn")) % 60).alias("id"), "role")
    held = F.array_sort(F.collect_list(book))
    convs = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.to_json(F.transform(held, lambda b: F.struct(b["id"].alias("id"), b["role"].alias("role")))).alias("b"))
    quoted = lambda *parts: F.concat(F.lit('"'), F.replace(F.concat(*parts), F.lit('"'), F.lit('\\"')), F.lit('"'))
    own = F.concat(F.lit('{"books": '), "b", F.lit("}"))
    shapes = [
        F.concat(F.lit('{"a": '), own, F.lit("}")), F.concat(F.lit('{"a": [{"x": '), own, F.lit("}, 1]}")), F.concat(F.lit('{"s": '), quoted(own), F.lit("}")),
        F.concat(F.lit('{"s": [{"t": '), quoted(F.lit('{"q": '), own, F.lit("}")), F.lit("}]}")), F.lit('{"s": "cut {\\"books\\": [1", "n": null'),
    ]
    line = shapes[4]
    for i in range(4):
        line = F.when(F.col("conv_id") % 5 == i, shapes[i]).otherwise(line)
    told = convs.select(F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("line"), line.alias("text"))
    event = quoted(F.lit('{"books": [{"id": '), (F.col("event_id") % 500 + 100).cast("string"), F.lit(', "props": '), "props", F.lit("}]}"))
    logged = table(spark, sf_dir, "events").select(F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("line"), F.concat(F.lit('{"run": {"out": '), event, F.lit(', "ok": true}}')).alias("text"))
    return told.unionByName(logged).select("line", F.try_parse_json("text").alias("value"))


def nested_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first book of each id in those lines, walking into strings or taking their own arrays (SRC-11, AGG-13)."""
    lines, out = journal_lines(spark, sf_dir), None
    for mode in ("walk", "take"):
        found = nested.harvested(nested.nested_items(lines, "books", take_strings=mode == "take"), ["line"])
        said = F.coalesce(F.get_json_object("item", "$.role"), F.get_json_object("item", "$.props.k")).alias("said")
        rows = found.select(F.lit(mode).alias("mode"), "id", "line", said)
        out = rows if out is None else out.unionByName(rows)
    return out


def _streamed(spark: SparkSession, sf_dir: str, make) -> DataFrame:
    """What a stream over the play events has written after they came in three parts, the stream stopped and started again between."""
    events, folder = play_events(spark, sf_dir), scratch(spark, "stream")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    cuts = [] if first is None else [first + (last - first) * i / 3 for i in (1, 2)]
    part = sum((F.col("ts") > F.lit(c)).cast("int") for c in cuts) if cuts else F.lit(0)
    parts = events.withColumn("part", part)
    closing = events.limit(1).select(F.lit(-1).cast("long").alias("user_id"), (F.lit(last).cast("timestamp") + F.expr("interval 40 days")).cast(events.schema["ts"].dataType).alias("ts"), F.lit(False).alias("playing"), F.lit(0).cast("long").alias("index"), F.lit(0).cast("long").alias("tie"))
    for i in range(3):
        some = parts.filter(F.col("part") == i).drop("part")
        (some.unionByName(closing) if i == 2 else some).write.mode("append").parquet(f"{folder}/in")  # a far event lets the watermark pass all others
        with rocksdb(spark):
            stream = spark.readStream.schema(events.schema).parquet(f"{folder}/in")
            make(stream).writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/at").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out").filter("user_id <> -1")


def streamed_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions from a stream that was stopped twice (STR-01): the rows of the batch."""
    kind = play_events(spark, sf_dir).schema["ts"].dataType
    return _streamed(spark, sf_dir, session_stream).withColumns({c: F.col(c).cast(kind) for c in ("start_ts", "end_ts")})


def streamed_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Throttled progress from a stream that was stopped twice (STR-02): the rows of the batch."""
    kind = play_events(spark, sf_dir).schema["ts"].dataType
    found = _streamed(spark, sf_dir, lambda s: progress_stream(s, 6 * 3600 * 1000))
    return found.select("user_id", F.col("ts").cast(kind).alias("ts"), "index", F.col("tie").alias("event_id"))


def resumed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document, written in batches of 250: stopped after two steps, then gone on with (SNK-03, SNK-05).

    A step commits whole batches, one of a small table and a share of a large one's, so that the steps, each with its log, don't grow with the table.
    """
    folder = scratch(spark, "resumed")
    rows = documents(spark, sf_dir).select("doc_id", "text", F.floor(F.col("doc_id") / 250).alias("batch"))
    writers.batch_files(rows, f"{folder}/in")
    stream = spark.readStream.schema("doc_id long, text string, batch long").option("maxFilesPerTrigger", writers.files_a_step(spark, f"{folder}/in")).json(f"{folder}/in")
    counted = stream.select("doc_id", "batch", F.size(fn.words(F.col("text"))).cast("long").alias("n_words"))
    writers.resumable(counted, f"{folder}/out", f"{folder}/at", batches=2)
    query = writers.resumable(counted, f"{folder}/out", f"{folder}/at")
    query.processAllAvailable()
    query.stop()
    return spark.read.parquet(f"{folder}/out").groupBy("doc_id", "batch", "n_words").agg(F.count("*").alias("times"))


def catalog_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog written whole, twice, and read again (SNK-01, SRC-01)."""
    books = parts_as_books(spark, sf_dir).select(F.col("id").cast("string").alias("id"), "title", "author", F.concat(F.lit("u/"), F.col("id").cast("string")).alias("textUrl"), F.when(F.col("downloads") > 25, F.col("downloads")).alias("downloadCount"))
    path = scratch(spark, "catalog")
    for rows in (books.limit(3), books):
        writers.replace_json(rows, path)
    found = readers.json_table(spark, path, lines=True)
    return found.select("id", "title", "author", F.col("coverUrl").alias("cover_url"), F.col("textUrl").alias("text_url"), F.col("downloadCount").alias("download_count"))


def themed_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page for each type of part, its shelves by size modulo 4, written and read flat again (SRC-02, SET-02)."""
    books = parts_as_books(spark, sf_dir).withColumn("shelf", F.col("p_size") % 4)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("id", "title"))), lambda b: F.struct(b["id"].cast("string").alias("id"), b["title"].alias("title")))
    shelves = books.groupBy("theme_key", "shelf").agg(listed.alias("books"))
    page = F.array_sort(F.collect_list(F.struct("shelf", "books")))
    named = F.transform(page, lambda s: F.struct(F.concat(F.lit("size "), s["shelf"].cast("string")).alias("title"), s["books"].alias("books")))
    pages = shelves.groupBy("theme_key").agg(named.alias("shelves")).select(F.col("theme_key").alias("key"), F.upper("theme_key").alias("title"), F.get("shelves", F.lit(0))["books"].alias("hero"), F.slice("shelves", 2, 9).alias("shelves"))
    path = scratch(spark, "pages")
    writers.replace_json(pages, path)
    found = readers.themed_pages(spark, path, lines=True)
    return found.select("theme_key", F.col("section").cast("long").alias("section"), F.col("shelf_pos").cast("long").alias("shelf_pos"), "shelf", F.col("book_pos").cast("long").alias("book_pos"), "id", "title")


def scene_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation's turns as scenes in a keyed map, an object a file (SRC-03)."""
    turns = table(spark, sf_dir, "conversations")
    scene = F.struct((F.col("turn") * 100).alias("startIndex"), F.col("role").alias("label"), F.left("text", F.lit(20)).alias("recap"))
    maps = turns.groupBy((F.col("conv_id") % 20).alias("block"), "conv_id").agg(F.array_sort(F.collect_list(scene)).alias("s"))
    maps = maps.groupBy("block").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.col("conv_id").cast("string"), "s")))).alias("text"))
    path = scratch(spark, "scenes")
    writers.text_by_id(maps.withColumnRenamed("block", "book_id"), path)
    return readers.scenes(spark, f"{path}/*").select("book_id", F.col("start_index").cast("long").alias("start_index"), "label", "recap")


def _told(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as texts: turns between blank lines under a heading, every third without one."""
    turns = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda t: t["text"]), "\n\n")
    told = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(turns.alias("t"))
    head = F.when(F.col("conv_id") % 3 != 0, F.concat(F.lit("# Talk "), F.col("conv_id").cast("string"), F.lit(" \n"))).otherwise("")
    return told.select(F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("book_id"), F.concat(head, "t").alias("text"))


def text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for each conversation, read whole again (SNK-02, SRC-04, SRC-14)."""
    path = scratch(spark, "texts")
    writers.text_by_id(_told(spark, sf_dir), path)
    return readers.markdown_folder(spark, path).select("name", "title", F.sha2("text", 256).alias("text_sha256"))


def journal_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as journal lines, some blank, some cut off, some no JSON (SRC-10)."""
    e, line = table(spark, sf_dir, "events"), F.to_json(F.struct("event_id", "event_type", "value"))
    n = F.col("event_id")
    text = F.when(n % 7 == 0, F.left(line, F.lit(12))).when(n % 11 == 0, F.lit(" ")).when(n % 13 == 0, F.lit("done, all well")).otherwise(line)
    path = scratch(spark, "journal")
    e.select(text.alias("value")).write.text(path)
    found = readers.journal(spark, path)
    return found.select(F.variant_get("value", "$.event_id", "long").alias("event_id"), F.variant_get("value", "$.event_type", "string").alias("event_type"))


def state_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' saved states of all versions, written as JSON lines, read and brought to the fifth (SRC-16, MIG-01)."""
    k, v = F.col("c_custkey"), F.col("c_custkey") % 6
    slot = F.struct(F.concat(F.lit("b"), (k % 50).cast("string")).alias("bookId"), (k % 100).alias("currentIndex"), F.lit(1000).alias("totalTokens"), (k * 1000).alias("lastReadAt"))
    state = F.struct(
        F.when(k % 4 != 0, F.struct((k * 3).alias("wordsRead"), (k * 7).alias("msRead"))).alias("stats"), F.when(k % 5 != 0, k % 900 + 100).alias("wpm"), F.when(k % 7 != 0, "page").alias("visMode"),
        F.when(k % 3 == 0, "classic").when(k % 3 == 1, "shrink").alias("fitMode"), F.when((v < 2) & (k % 9 != 0), slot).alias("progress"), F.when(v >= 2, F.create_map(slot["bookId"], slot)).alias("progressById"), F.when(k % 8 == 0, F.create_map(F.lit("b1"), k)).alias("savedById"),
    )
    lines = table(spark, sf_dir, "customer").select(F.when(k % 17 == 0, "cut {").otherwise(F.to_json(F.struct(F.when(v > 0, v).alias("version"), state.alias("state")))).alias("value"))
    path = scratch(spark, "states")
    lines.write.text(path)
    found = ledger.migrate(readers.reader_states(spark, path))
    first = F.try_element_at(F.map_values("progress_by_id"), F.lit(1))
    return found.select("words_read", "ms_read", F.col("wpm").cast("long").alias("wpm"), "vis_mode", "fit_mode", F.col("version").cast("long").alias("version"), first["book_id"].alias("book_id"), first["current_index"].alias("current_index"), F.try_element_at("saved_by_id", F.lit("b1")).alias("saved_at"))


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents through the content gate: the admitted and the rejects with reasons, in two tables (SNK-04)."""
    docs = story_queries.content_gate(spark, sf_dir).select("doc_id", "reason")
    path = scratch(spark, "gate")
    writers.with_dead_letters(docs, f"{path}/good", f"{path}/dead")
    good, dead = (spark.read.parquet(f"{path}/{x}") for x in ("good", "dead"))
    return good.select("doc_id", F.lit("good").alias("where"), F.lit(None).cast("string").alias("reason")).unionByName(dead.select("doc_id", F.lit("dead").alias("where"), "reason"))


def key_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes put under ids, labels over them twice, null among the keys (SNK-08)."""
    path = scratch(spark, "kv")
    key = F.when(F.col("doc_id") > 0, F.col("doc_id")).alias("id")
    writers.upsert(documents(spark, sf_dir).select(key, F.col("n_chars").alias("v")), path, ["id"])
    for _ in range(2):
        writers.upsert(table(spark, sf_dir, "labels").select(key, F.col("quality").cast("long").alias("v")), path, ["id"])
    return spark.read.parquet(path)


def context_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyword report's lines, written as Markdown and read again, with how often each stands there (SNK-11)."""
    path = scratch(spark, "context")
    writers.context_report(story.keyword_context(documents(spark, sf_dir)), path)
    return spark.read.text(path).groupBy(F.col("value").alias("line")).agg(F.count("*").alias("times"))


def progress_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a checklist, done if labelled good (SNK-06, AGG-17): the report's lines in order."""
    path = scratch(spark, "board")
    done = documents(spark, sf_dir).join(table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id", F.lit(True).alias("ok")), "doc_id", "left")
    writers.board(done.select(F.lpad(F.col("doc_id").cast("string"), 9, "0").alias("title"), F.coalesce("ok", F.lit(False)).alias("done")), path)
    return _numbered(spark, path)


def _numbered(spark: SparkSession, path: str) -> DataFrame:
    """(at, line) of an ordered report, counted through its files."""
    lines = readers.ordered_report(spark, path)
    sizes = {r.part: r.n for r in lines.groupBy("part").agg(F.count("*").alias("n")).collect()}  # one a file
    before = F.create_map(*[F.lit(x) for p in sizes for x in (p, sum(n for q, n in sizes.items() if q < p))]) if sizes else F.create_map()
    return lines.select((before[F.col("part")] + F.col("at")).cast("long").alias("at"), "line")


def start_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prose starts of documents as a versioned bundle (SNK-07): the report's lines in order."""
    path = scratch(spark, "bundle")
    docs = documents(spark, sf_dir).select(F.lpad(F.col("doc_id").cast("string"), 9, "0").alias("book_id"), F.col("n_chars").cast("int").alias("start"))
    writers.bundle_files(docs.filter("start > 500"), docs.filter("start < 600").select("book_id"), path)
    return _numbered(spark, path)


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve words of each document from its twentieth on, and the first document of each source (JN-19, AGG-13, SET-06)."""
    w = documents(spark, sf_dir).select("doc_id", "source", an.passage(fn.words(F.col("text")), F.lit(19), F.lit(12)).alias("passage"))
    first = an.first_of(w.select("source", "doc_id", "passage"), ["source"], "doc_id").select(F.col("doc_id").alias("first_id"), "source")
    return w.join(first, "source").select("doc_id", "passage", "first_id")


def id_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of verdicts, scene titles and versions brought to form (FN-16, FN-22, FN-24)."""
    k, p = F.col("p_partkey"), table(spark, sf_dir, "part")
    tail = F.when(k % 5 == 0, "-short").when(k % 5 == 1, "_STORY ").when(k % 5 == 2, ":Short").when(k % 5 == 3, "story").otherwise("-tale")
    version = F.concat_ws(".", (k % 9).cast("string"), F.floor(k / 9 % 10).cast("string"), F.floor(k / 90 % 10).cast("string"))
    return p.select("p_partkey", ledger.verdict_id(F.concat(F.lit(" "), k.cast("string"), tail)).alias("verdict_id"), an.scene_title(F.concat(F.lit("SCENE II. _"), "p_name", F.lit("_ [end]"))).alias("scene"), writers.next_version(version).alias("version"))


def paged_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a service's pages of 100, in files: read by number, by `next`, and as a stream that goes on after a stop (SRC-05, SRC-06).

    Every page is there for each of the three ways, but the numbers stop at a missing page, which is empty.
    """
    path = scratch(spark, "service")
    address = spark._jvm.org.apache.hadoop.fs.Path(path).toUri().getPath()
    p = table(spark, sf_dir, "part")
    book = F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.create_map(F.lit("text/plain"), F.col("p_brand")).alias("formats"))
    page = (F.floor(F.col("p_partkey") / 100) + 1).alias("page")
    last = p.agg(F.max(F.floor(F.col("p_partkey") / 100) + 1)).first()[0] or 0
    follows = F.when(F.col("page") < last, F.concat(F.lit(f"file://{address}/p"), (F.col("page") + 1).cast("string"), F.lit(".json")))
    pages = p.groupBy(page).agg(F.collect_list(book).alias("results")).select(F.concat(F.lit("p"), F.col("page").cast("string"), F.lit(".json")).alias("name"), F.to_json(F.struct("results", follows.alias("next"))).alias("text"))
    url = f"{writers.named_files(pages, path)}/p{{page}}.json"
    numbered, chained = (readers.paged_catalog(spark, url, last + 2, cursor=c, pause="0").select(F.lit(w).alias("way"), "page", "id", "title") for w, c in (("number", False), ("next", True)))
    stream = readers.paged_stream(spark, url, last + 2, pause="0", every=str(readers.pages_a_step(last, least=7)))
    for _ in range(2):  # the second run finds the page where the first one stopped, and nothing more
        query = writers.resumable(stream, f"{path}-out", f"{path}-at")
        query.processAllAvailable()
        query.stop()
    streamed = spark.read.parquet(f"{path}-out").select(F.lit("stream").alias("way"), "page", F.col("id").cast("long").alias("id"), F.get_json_object("book", "$.title").alias("title"))
    return numbered.unionByName(chained).unionByName(streamed).withColumn("page", F.col("page").cast("long"))


def selected_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run's books by its flags, each fetched from the first place that has it, mirror before origin (SRC-08, SRC-18, JN-04).

    Curated are documents of source src1, themes the others' sources; the run is about one theme and all curated in turn.
    """
    docs, path = documents(spark, sf_dir), scratch(spark, "mirror")
    told = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda t: t["text"]), "\n").alias("text"))
    places = []
    for tier, keep in (("mirror", F.col("conv_id") % 3 != 0), ("origin", F.col("conv_id") % 5 != 0)):
        files = told.filter(keep).select(F.concat(F.col("conv_id").cast("string"), F.lit(".txt")).alias("name"), F.concat(F.lit(tier), F.lit(" "), "text").alias("text"))
        places.append(writers.named_files(files, f"{path}-{tier}") + "/{id}.txt")
    curated = docs.filter("source = 'src1'").select(F.col("doc_id").cast("string").alias("id"), F.col("doc_id").alias("place"))
    themed = docs.filter("source <> 'src1'").select(F.col("source").alias("theme_key"), F.lit(0).alias("section"), F.lit(0).alias("shelf_pos"), F.col("doc_id").alias("book_pos"), F.col("doc_id").cast("string").alias("id"))
    done = docs.filter("doc_id % 4 = 0").select(F.col("doc_id").cast("string").alias("id"))
    out = None
    for run, flags in (("theme", {"theme": "src3"}), ("curated", {"curated_only": True, "limit": 40}), ("forced", {"curated_only": True, "limit": 40, "force": True})):
        ids = readers.run_ids(curated, themed, done=done, **flags)
        got = readers.fetched(ids.select("id"), places, tries=1, pause=0)
        rows = got.select(F.lit(run).alias("run"), "id", F.sha2("text", 256).alias("text_sha256"), "error")
        out = rows if out is None else out.unionByName(rows)
    return out


def looked_up_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts asked for by id, one at a time as a service of files allows (SRC-07)."""
    path, n = scratch(spark, "lookup"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    p = table(spark, sf_dir, "part").filter("p_partkey % 20 < 2")
    book = F.to_json(F.struct(F.array(F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"))).alias("results")))
    place = writers.named_files(p.filter("p_partkey % 20 = 0").select(F.concat(F.col("p_partkey").cast("string"), F.lit(".json")).alias("name"), book.alias("text")), path)
    found = readers.looked_up(p.select(F.col("p_partkey").alias("id")).repartition(n, "id"), f"{place}/{{ids}}.json", size=1, tries=1, pause=0)
    return found.select("id", F.get_json_object("book", "$.title").alias("title"))


QUERIES = {
    f.__name__: f
    for f in (nested_payloads, streamed_sessions, streamed_writes, resumed_batches, catalog_file, themed_file, scene_map, text_files, journal_file, state_file, dead_letters, key_values, context_lines, progress_board, start_bundle, passages, id_forms, paged_service, selected_texts, looked_up_books)
}

ORACLE_SQL = {
    "nested_payloads": r"""
WITH RECURSIVE b AS (SELECT conv_id, to_json(list({'id': (conv_id * 7 + turn) % 60, 'role': role} ORDER BY turn)) AS b FROM conversations GROUP BY conv_id
), l AS (
    SELECT 'c' || conv_id AS line, CASE conv_id % 5 WHEN 0 THEN '{"a": {"books": ' || b || '}}' WHEN 1 THEN '{"a": [{"x": {"books": ' || b || '}}, 1]}' WHEN 2 THEN '{"s": ' || to_json('{"books": ' || b || '}') || '}'
        WHEN 3 THEN '{"s": [{"t": ' || to_json('{"q": {"books": ' || b || '}}') || '}]}' ELSE '{' END AS v FROM b
    UNION ALL SELECT 'e' || event_id, '{"run": {"out": ' || to_json('{"books": [{"id": ' || (event_id % 500 + 100) || ', "props": ' || props || '}]}') || ', "ok": true}}' FROM events
), w AS (
    SELECT line, 0 AS level, 0 AS parsed, CAST(v AS JSON) AS node FROM l WHERE json_valid(v)
    UNION ALL
    SELECT line, level + 1, CASE WHEN json_type(node) = 'VARCHAR' AND parsed = 0 THEN 1 WHEN parsed > 0 THEN 2 ELSE 0 END, unnest(
        CASE WHEN json_type(node) = 'OBJECT' AND json_type(node->'$.books') = 'ARRAY' THEN CAST([] AS JSON[]) WHEN json_type(node) = 'OBJECT' THEN json_extract(node, '$.*') WHEN json_type(node) = 'ARRAY' THEN json_extract(node, '$[*]')
            WHEN json_type(node) = 'VARCHAR' AND contains(node->>'$', '"books"') AND json_valid(node->>'$') THEN [CAST(node->>'$' AS JSON)] ELSE CAST([] AS JSON[]) END)
    FROM w WHERE level < 8
), own AS (SELECT line, parsed, json_extract(node, '$.books[*]') AS items FROM w WHERE json_type(node) = 'OBJECT' AND json_type(node->'$.books') = 'ARRAY'
), own_i AS (SELECT line, parsed, unnest(range(1, len(items) + 1)) AS i, unnest(items) AS item FROM own
), every AS (SELECT 'walk' AS mode, * FROM own_i UNION ALL SELECT 'take', * FROM own_i WHERE parsed < 2
), known AS (SELECT mode, item->>'$.id' AS id, line, i, coalesce(item->>'$.role', item->>'$.props.k') AS said FROM every)
SELECT mode, id, line, said FROM known WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY mode, id ORDER BY line, i) = 1
""",
    "streamed_sessions": catalog_queries.ORACLE_SQL["reading_sessions"],
    "streamed_writes": catalog_queries.ORACLE_SQL["progress_throttle"],
    "resumed_batches": f"SELECT doc_id, doc_id // 250 AS batch, CAST(len(list_filter({sql.WORDS('text')}, lambda x: x <> '[P]')) AS BIGINT) AS n_words, CAST(1 AS BIGINT) AS times FROM documents",
    "catalog_file": """
SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS title, p_brand AS author, CAST(NULL AS VARCHAR) AS cover_url, 'u/' || p_partkey AS text_url, CASE WHEN n > 25 THEN n END AS download_count
FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey) ON l_partkey = p_partkey""",
    "themed_file": """
WITH b AS (SELECT p_type AS theme_key, p_size % 4 AS size, CAST(p_partkey AS VARCHAR) AS id, p_name AS title, row_number() OVER (PARTITION BY p_type, p_size % 4 ORDER BY p_partkey) - 1 AS book_pos FROM part
), s AS (SELECT theme_key, size, row_number() OVER (PARTITION BY theme_key ORDER BY size) - 1 AS place FROM (SELECT DISTINCT theme_key, size FROM b))
SELECT theme_key, CASE WHEN place = 0 THEN 0 ELSE 1 END AS section, greatest(place - 1, 0) AS shelf_pos, CASE WHEN place > 0 THEN 'size ' || size END AS shelf, book_pos, id, title FROM b JOIN s USING (theme_key, size)""",
    "scene_map": "SELECT CAST(conv_id AS VARCHAR) AS book_id, turn * 100 AS start_index, role AS label, left(text, 20) AS recap FROM conversations",
    "text_files": """
WITH t AS (SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS t FROM conversations GROUP BY conv_id)
SELECT 'c' || conv_id AS name, CASE WHEN conv_id % 3 <> 0 THEN 'Talk ' || conv_id ELSE 'c' || conv_id END AS title, sha256(CASE WHEN conv_id % 3 <> 0 THEN '# Talk ' || conv_id || ' ' || chr(10) ELSE '' END || t) AS text_sha256 FROM t""",
    "journal_file": "SELECT event_id, event_type FROM events WHERE event_id % 7 <> 0 AND event_id % 11 <> 0 AND event_id % 13 <> 0",
    "state_file": """
WITH c AS (SELECT c_custkey AS k, c_custkey % 6 AS v FROM customer WHERE c_custkey % 17 <> 0
), s AS (
    SELECT *, CASE WHEN k % 4 <> 0 THEN k * 3 END AS words_read, CASE WHEN k % 4 <> 0 THEN k * 7 END AS ms_read, CASE WHEN k % 5 <> 0 THEN k % 900 + 100 END AS wpm, CASE WHEN k % 7 <> 0 THEN 'page' END AS vis_mode,
        CASE k % 3 WHEN 0 THEN 'classic' WHEN 1 THEN 'shrink' END AS fit_mode, v >= 2 OR k % 9 <> 0 AS has_slot, CASE WHEN k % 8 = 0 THEN k END AS saved_at FROM c)
SELECT CASE WHEN v = 0 THEN coalesce(words_read, 0) ELSE words_read END AS words_read, CASE WHEN v = 0 THEN coalesce(ms_read, 0) ELSE ms_read END AS ms_read, CASE WHEN v = 0 THEN coalesce(wpm, 300) ELSE wpm END AS wpm,
    CASE WHEN v = 0 THEN coalesce(vis_mode, 'rsvp') ELSE vis_mode END AS vis_mode, CASE WHEN v < 4 AND coalesce(fit_mode, 'classic') = 'classic' THEN 'centerAll' ELSE fit_mode END AS fit_mode, CAST(5 AS BIGINT) AS version,
    CASE WHEN has_slot THEN 'b' || (k % 50) END AS book_id, CASE WHEN has_slot THEN k % 100 END AS current_index, saved_at FROM s""",
    "dead_letters": f"WITH g AS ({story_queries.ORACLE_SQL['content_gate']}) SELECT doc_id, CASE WHEN reason IS NULL THEN 'good' ELSE 'dead' END AS where, reason FROM g",
    "key_values": """
WITH d AS (SELECT CASE WHEN doc_id > 0 THEN doc_id END AS id, n_chars AS v FROM documents), l AS (SELECT CASE WHEN doc_id > 0 THEN doc_id END AS id, CAST(quality AS BIGINT) AS v FROM labels)
SELECT id, v FROM l UNION ALL SELECT d.id, d.v FROM d WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.id IS NOT DISTINCT FROM d.id)""",
    "context_lines": f"""
WITH k AS ({story_queries.ORACLE_SQL['kwic_lines']}), o AS (SELECT *, lag(source_header) OVER (PARTITION BY doc_id ORDER BY line) AS previous FROM k
), x AS (SELECT (CASE WHEN after_gap THEN '---' || chr(10) ELSE '' END) || (CASE WHEN source_header IS DISTINCT FROM previous THEN '## ' || source_header || chr(10) ELSE '' END) || (CASE WHEN hit = 1 THEN '**' || text || '**' ELSE text END) AS v FROM o
), y AS (SELECT unnest(string_split(v, chr(10))) AS line FROM x)
SELECT line, count(*) AS times FROM y GROUP BY line""",
    "progress_board": """
WITH d AS (SELECT lpad(CAST(doc_id AS VARCHAR), 9, '0') AS title, EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND quality = 1) AS done FROM documents d
), n AS (SELECT count(*) AS n, count(*) FILTER (done) AS d, CAST(floor(100.0::DOUBLE * count(*) FILTER (done) / count(*) + 0.5) AS BIGINT) AS share FROM d)
SELECT CAST(0 AS BIGINT) AS at, '**' || d || ' / ' || n || '** ' || repeat('█', share // 5) || repeat('░', 20 - share // 5) || ' ' || share || '%' AS line FROM n
UNION ALL SELECT row_number() OVER (ORDER BY title), CASE WHEN done THEN '- [x] ' ELSE '- [ ] ' END || title FROM d""",
    "start_bundle": """
WITH b AS (SELECT lpad(CAST(doc_id AS VARCHAR), 9, '0') AS id, n_chars FROM documents)
SELECT row_number() OVER (ORDER BY id) - 1 AS at, CASE WHEN n_chars > 500 THEN '{"v":1,"id":"' || id || '","start":' || n_chars || ',"nn":false}' ELSE '{"v":1,"id":"' || id || '","nn":true}' END AS line FROM b""",
    "passages": f"""
WITH w AS (SELECT doc_id, source, list_filter({sql.WORDS('text')}, lambda x: x <> '[P]') AS w FROM documents)
SELECT doc_id, array_to_string(w[20:31], ' ') AS passage, min(doc_id) OVER (PARTITION BY source) AS first_id FROM w""",
    "id_forms": """
WITH v AS (SELECT *, p_partkey % 9 * 100 + p_partkey // 9 % 10 * 10 + p_partkey // 90 % 10 + 1 AS n FROM part)
SELECT p_partkey, p_partkey || CASE WHEN p_partkey % 5 = 4 THEN '-tale' ELSE '' END AS verdict_id, 'II. ' || p_name || ' end' AS scene, (n // 100) || '.' || (n // 10 % 10) || '.' || (n % 10) AS version FROM v""",
    "paged_service": "SELECT way, p_partkey // 100 + 1 AS page, p_partkey AS id, p_name AS title FROM part, (VALUES ('number'), ('next'), ('stream')) w(way)",
    "selected_texts": """
WITH t AS (SELECT conv_id AS id, string_agg(text, chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id
), c AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS r FROM documents WHERE source = 'src1'
), run AS (
    SELECT 'theme' AS run, doc_id FROM documents WHERE source = 'src3' AND doc_id % 4 <> 0
    UNION ALL SELECT 'curated', doc_id FROM c WHERE r <= 40 AND doc_id % 4 <> 0 UNION ALL SELECT 'forced', doc_id FROM c WHERE r <= 40
)
SELECT run, CAST(doc_id AS VARCHAR) AS id, CASE WHEN t.id % 3 <> 0 THEN sha256('mirror ' || text) WHEN t.id % 5 <> 0 THEN sha256('origin ' || text) END AS text_sha256,
    CASE WHEN coalesce(t.id % 3 = 0 AND t.id % 5 = 0, true) THEN 'not found' END AS error FROM run LEFT JOIN t ON doc_id = t.id""",
    "looked_up_books": "SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS title FROM part WHERE p_partkey % 20 = 0",
}
