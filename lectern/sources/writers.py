"""Writers: whole tables, a file for each record, dead letters, batches, boards and bundles."""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lectern.operators.ledger import without


def replace_json(df: DataFrame, path: str) -> None:
    """The whole table anew (SNK-01)."""
    df.write.mode("overwrite").json(path)


def text_by_id(df: DataFrame, path: str, key: str = "book_id", text: str = "text") -> None:
    """A folder for each id (SNK-02). For many ids a column in a table serves better: prefer parquet then."""
    df.select(F.col(key), F.col(text).alias("value")).write.mode("overwrite").partitionBy(key).text(path)


def named_files(rows: DataFrame, path: str, name: str = "name", text: str = "text") -> str:
    """A file with that name and text, as it is, for each row (SNK-02); a null text is empty. Returns the folder's address.

    Tasks write the files, each beside its place and then moved into it, so none is seen in part and a task that runs again
    changes nothing. path must be one that pyarrow's file systems know, and shared by all executors.
    """
    spark = rows.sparkSession
    Path = spark._jvm.org.apache.hadoop.fs.Path
    fs = Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(Path(path))
    place = fs.makeQualified(Path(path)).toString()

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = FileSystem.from_uri(place)
        n = 0
        for batch in batches:
            for called, value in zip(*(batch[c].to_pylist() for c in ("name", "text"))):
                beside = f"{folder}/.{called}-{uuid.uuid4().hex}"
                with files.open_output_stream(beside) as out:
                    out.write((value or "").encode())
                files.move(beside, f"{folder}/{called}")
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    named = rows.select(F.col(name).cast("string").alias("name"), F.col(text).cast("string").alias("text"))
    named.mapInArrow(put, "n long").write.format("noop").mode("overwrite").save()
    return place


def with_dead_letters(df: DataFrame, good: str, dead: str, reason: str = "reason") -> None:
    """Admitted rows and rejects with their reasons in two tables (SNK-04)."""
    df.filter(F.col(reason).isNull()).drop(reason).write.mode("overwrite").parquet(good)
    df.filter(F.col(reason).isNotNull()).write.mode("overwrite").parquet(dead)


def batch_files(df: DataFrame, path: str, batch: str = "batch") -> None:
    """One folder for each batch number (SNK-05)."""
    df.repartition(batch).write.mode("overwrite").partitionBy(batch).json(path)


def files_a_step(spark: SparkSession, path: str, steps: int = 40) -> int:
    """How many of the files that batch_files has written a stream takes at once, so that it goes through all in at most so many steps."""
    Path = spark._jvm.org.apache.hadoop.fs.Path
    files = Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(Path(path)).getFileCount()
    return max(1, -(-files // steps))


def _moved(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"{source} can't be moved to {target}")


def upsert(df: DataFrame, path: str, keys: list[str]) -> None:
    """Rows of df over those with the same keys at path (SNK-08); running it again changes nothing.

    Null is a key like any other; of rows of df that repeat a key, all are written.

    The merged table is written beside the old one, the old one moved aside, the new one into its place, and then the
    old one deleted. A job that stops between leaves one of them whole; the next upsert puts it back first.
    """
    spark = df.sparkSession
    Path = spark._jvm.org.apache.hadoop.fs.Path
    fs = Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    aside = Path(f"{path}.old")
    if fs.exists(aside):
        if fs.exists(Path(path)):
            fs.delete(aside, True)
        else:
            _moved(fs, aside, Path(path))
    if fs.exists(Path(path)):
        old = spark.read.parquet(path)
        df = df.unionByName(without(old, df, keys))
    df.write.mode("overwrite").parquet(f"{path}.new")
    if fs.exists(Path(path)):
        _moved(fs, Path(path), aside)
    _moved(fs, Path(f"{path}.new"), Path(path))
    fs.delete(aside, True)


def resumable(stream: DataFrame, path: str, checkpoint: str, batches: int | None = None) -> StreamingQuery:
    """Starts a stream into Parquet files at path, batch by batch under a commit log (SNK-03), and returns it.

    What a batch holds is the source's matter: so many files, pages or rows. A batch is written whole or not at all: a
    run that stops between loses only the batch it was at, and the next run with the same checkpoint goes on with that
    one, so every row is written once. With batches the call waits and stops after so many.
    """
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").start()
    if batches is not None:
        done = 0
        while query.isActive and done < batches:
            query.awaitTermination(0.05)
            done = sum(p.numInputRows > 0 for p in query.recentProgress)
        query.stop()
    return query


def ordered_report(lines: DataFrame, path: str, order: list[str], line: str = "line", **head: object) -> None:
    """Lines in the order of columns as text files by range, and a manifest that names them in turn (SNK-06, SNK-07).

    All tasks write. The files of a run lie in a folder of their own; manifest.json, with the head and each file's
    number of lines, is moved into place last, so whoever reads sees the report of one whole run, the old or the new.
    The files end to end are the report. Lines must hold no line ends; null lines are left out.
    """
    spark = lines.sparkSession
    folder = f"parts-{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = lines.filter(F.col(line).isNotNull()).repartitionByRange(n, *order).sortWithinPartitions(*order)
    ranged.select(F.col(line).cast("string").alias("value")).write.text(f"{path}/{folder}")
    Path = spark._jvm.org.apache.hadoop.fs.Path
    fs = Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    files = sorted(f.getPath().getName() for f in fs.listStatus(Path(f"{path}/{folder}")) if f.getPath().getName().startswith("part-"))
    counts = {r.name: r.n for r in spark.read.text(f"{path}/{folder}").groupBy(F.col("_metadata.file_name").alias("name")).agg(F.count("*").alias("n")).collect()}  # one a file
    manifest = json.dumps({"v": 1, **head, "parts": [{"file": f"{folder}/{f}", "lines": counts[f]} for f in files if f in counts]})
    out = fs.create(Path(f"{path}/{folder}.json"), True)
    out.write(bytearray(manifest.encode()))
    out.close()
    old = Path(f"{path}/manifest.json")
    if fs.exists(old):
        fs.delete(old, False)
    _moved(fs, Path(f"{path}/{folder}.json"), old)


def board(done: DataFrame, path: str, title: str = "title") -> None:
    """A checklist of (title, done) under its count, bar and percent, as an ordered report (SNK-06, AGG-17, FN-28)."""
    d, n = done.agg(F.count_if("done"), F.count("*")).first()
    share = math.floor(100 * d / n + 0.5) if n else 0
    first = f"**{d} / {n}** {'█' * (share // 5)}{'░' * (20 - share // 5)} {share}%"
    head = done.sparkSession.createDataFrame([(0, None, first)], "part int, title string, line string")
    rows = done.select(F.lit(1).alias("part"), F.col(title).alias("title"), F.concat(F.when(F.col("done"), "- [x] ").otherwise("- [ ] "), F.coalesce(F.col(title), F.lit(""))).alias("line"))
    ordered_report(head.unionByName(rows), path, ["part", "title", "line"], done=d, total=n, percent=share)


def bundle_files(starts: DataFrame, non_narrative: DataFrame, path: str) -> None:
    """The bundle's lines by book as an ordered report, immutable under its manifest (SNK-07)."""
    ordered_report(bundle_lines(starts, non_narrative), path, ["book_id"], "bundle")


def bundle(starts: DataFrame, non_narrative: DataFrame) -> DataFrame:
    """One row: a versioned JSON object of starts by id, and ids without a story (SNK-07).

    The format is one object, for the few thousand books of a collection; bundle_files serves any number.
    """
    both = starts.select("book_id", "start").withColumn("has", F.lit(True)).unionByName(non_narrative.select("book_id", F.lit(None).cast("int").alias("start"), F.lit(False).alias("has")))
    pairs = F.array_sort(F.collect_list(F.when(F.col("has"), F.struct("book_id", "start"))))
    nn = F.sort_array(F.collect_set(F.when(~F.col("has"), F.col("book_id"))))
    return both.agg(F.map_from_entries(pairs).alias("starts"), nn.alias("nn")).select(F.to_json(F.struct(F.lit(1).alias("v"), "starts", "nn")).alias("bundle"))


def bundle_lines(starts: DataFrame, non_narrative: DataFrame) -> DataFrame:
    """The bundle as a JSON line a book (book_id, bundle), written from all tasks; of a book in both tables the start counts."""
    none = non_narrative.select("book_id").distinct().join(starts.select("book_id"), "book_id", "left_anti")
    rows = starts.select("book_id", F.col("start").cast("long").alias("start")).unionByName(none.withColumn("start", F.lit(None).cast("long")))
    return rows.select("book_id", F.to_json(F.struct(F.lit(1).alias("v"), F.col("book_id").alias("id"), "start", F.col("start").isNull().alias("nn"))).alias("bundle"))


def context_report(context: DataFrame, path: str, key: str = "doc_id") -> None:
    """Keyword context as Markdown lines in order, a heading where the source changes and a rule where lines were left out (SNK-11).

    context is what story.keyword_context returns; files are written range by range of keys.
    """
    order = Window.partitionBy(key).orderBy("line")
    turn = ~F.col("source_header").eqNullSafe(F.lag("source_header").over(order))
    rule = F.when(F.coalesce("after_gap", F.lit(False)), F.lit("---\n"))
    head = F.when(turn, F.concat(F.lit("## "), F.col("source_header"), F.lit("\n")))
    mark = F.when(F.col("hit") == 1, F.concat(F.lit("**"), F.col("text"), F.lit("**"))).otherwise(F.col("text"))
    lines = context.withColumn("value", F.concat(F.coalesce(rule, F.lit("")), F.coalesce(head, F.lit("")), mark))
    lines.repartitionByRange(key).sortWithinPartitions(key, "line").select("value").write.mode("overwrite").text(path)


def next_version(version: Column) -> Column:
    """Patch plus one, digits rolling over at 9 (FN-24)."""
    p = F.transform(F.split(version, r"\."), lambda x: x.cast("int"))
    n = p[0] * 100 + p[1] * 10 + p[2] + 1
    return F.concat_ws(".", F.floor(n / 100).cast("string"), (F.floor(n / 10) % 10).cast("string"), (n % 10).cast("string"))
