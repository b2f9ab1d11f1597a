"""Exact deduplication by content sort, in DataFrame operations alone.

Texts are normalised (each run of ASCII white space becomes one space) and range-partitioned by
sampled splitters of their leading characters: as many (HEADS) as it takes for few different texts of the sample to
begin alike. Within a range rows are sorted by the text itself: external sorting puts equal texts next to each other,
and each text is compared in full with its neighbour. The row with the smallest id of a run of equals stays. Equal
texts begin alike, so no run crosses the end of a range; digests are for the result and for counting the sample.

A text that fills a large part of a partition is found in a sample of SAMPLE_ROWS rows a partition (the
same that Spark takes for range splitters), and its rows are dealt out by a salt of their id and input
partition. The parts of such a text, at most about 4 a partition in all, are put together again by the
digest and the full text of one row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import discard, partitions, sized_join, stored

SAMPLE_ROWS = 100
HEADS = (32, 256, 2048, 16_384, 131_072, 1_048_576)


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Every row of docs as struct `row` (of the columns in keep, or all), with keep_id, group_size, kept and text_sha256.

    Null texts count as empty. Null ids sort last and are kept only if no row of the group has an id. Of
    rows that share text and id, one is kept. Columns of docs may have any names: they stay inside `row`.
    An empty table gives no rows.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    keep = docs.columns if keep is None else keep
    norm = normalised(docs[text_col].cast("string"))
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("row"), docs[id_col].alias("id"), norm.alias("norm"))
    rows = rows.withColumn("sha", F.sha2("norm", 256))

    total = docs.count()
    share = min(1.0, SAMPLE_ROWS * n / max(total, 1))
    begins = [F.xxhash64(F.left("norm", F.lit(h))).alias(f"h{h}") for h in HEADS]
    sample = stored(rows.sample(share, seed=4).select("sha", *begins), "sample")
    hot = [(r.sha, -(-r["count"] * 4 // SAMPLE_ROWS)) for r in sample.groupBy("sha").count().filter(F.col("count") > SAMPLE_ROWS // 2).collect()]
    texts = sample.dropDuplicates(["sha"])
    chars = next((h for h in HEADS if texts.groupBy(f"h{h}").count().filter(F.col("count") > SAMPLE_ROWS // 2).isEmpty()), HEADS[-1])
    discard(sample)
    if hot:
        salts = spark.createDataFrame(hot, "sha string, salts int")
        rows = rows.join(F.broadcast(salts), "sha", "left")  # at most two a partition
        rows = rows.withColumn("salt", F.coalesce(F.pmod(F.xxhash64("id", F.spark_partition_id()), "salts").cast("int"), F.lit(0)))

    key = ["head", "salt"] if hot else ["head"]
    rows = rows.withColumn("head", F.left("norm", F.lit(chars)))
    if text_col in keep:  # the text is shuffled once and normalised again
        ranged = rows.drop("norm").repartitionByRange(n, *key).withColumn("norm", normalised(F.col(f"row.`{text_col}`").cast("string")))
    else:
        ranged = rows.repartitionByRange(n, *key)
    order = Window.partitionBy(*key).orderBy("norm", F.col("id").asc_nulls_last())
    before = F.lag("norm").over(order)
    runs = ranged.withColumn("first", (before.isNull() | (before != F.col("norm"))).cast("int"))
    runs = runs.withColumn("run", F.sum("first").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy(*key, "run")
    group = [F.min("id").over(run).alias("keep_id"), F.count("*").over(run).alias("group_size")]
    kept = F.col("first") == 1
    if not hot:
        out = runs.select("row", "sha", "first", *group)
    else:
        part = ["sha", "salt", "run"]
        text = F.when(kept & F.col("salts").isNotNull(), F.col("norm"))
        out = stored(runs.select("row", "id", *part, "first", *group, text.alias("part_text")), "runs")
        parts = out.filter("part_text is not null").select("id", *part, "group_size", "part_text")
        least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "salt", "run"))
        whole = parts.groupBy("sha", "part_text").agg(least.alias("least"), F.sum("group_size").alias("all_n"))
        out = sized_join(out, parts.select(*part, "part_text").join(whole, ["sha", "part_text"]).drop("part_text"), part, "left")
        kept = kept & (F.col("least").isNull() | ((F.col("least.salt") == F.col("salt")) & (F.col("least.run") == F.col("run"))))
        out = out.withColumns({"keep_id": F.when(F.col("least").isNull(), F.col("keep_id")).otherwise(F.col("least.id")), "group_size": F.coalesce("all_n", "group_size")})
    return out.select("row", "keep_id", "group_size", kept.alias("kept"), F.col("sha").alias("text_sha256"))
