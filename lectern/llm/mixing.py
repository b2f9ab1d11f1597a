"""Mixing sources to target weights by a time-varying curriculum.

Every source has a weight for each time of training, from 0 to 1. The integral of a source's weights gives
its share of the tokens; a source whose target would exceed CAP times its size stops there and the rest is
shared again by weight. A source is read in a fixed random order, over and over, until its target is met:
a document's copy that begins after c of the target's t tokens gets the time at which the integrated demand
of its source reaches c / t. Copies are range-sorted by this position, which is the training order.

Whole rows are shuffled into the order of their source, and as often as they are taken into the order of training;
between, running sums of sizes alone meet them, by broadcast while these are small, else by one more shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import partitions, sized_join, stored

SHARE, CAP = 1.5, 2.0
WEIGHTS = (3.0, 1.0, 2.0)
#: Weight at the end of training less that at its start, in units of the mean weight.
SLOPES = (1.0, 0.0, -1.0)


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def with_sums_before(df: DataFrame, order: list[Column], **values: str) -> DataFrame:
    """df with a column for each of values: the sum of the named column over all rows that sort before.

    Rows are range-partitioned, sorted and written once, with _at, their place. Running sums are taken of the places and
    values alone and meet the rows by their place; only one row of sums for each partition meets in one place. Rows that
    tie in `order` must be alike.
    """
    ranged = df.repartitionByRange(partitions(df.sparkSession), *order).sortWithinPartitions(*order)
    part = stored(ranged.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "ranges")
    light = part.select("_part", "_at", *[F.col(v).alias(f"_{k}") for k, v in values.items()])
    sums = light.groupBy("_part").agg(*[F.sum(f"_{k}").alias(f"_{k}") for k in values])
    above = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    sums = sums.select("_part", *[F.coalesce(F.sum(f"_{k}").over(above), F.lit(0)).alias(f"_{k}_above") for k in values])
    within = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    light = light.select("_part", "_at", *[F.coalesce(F.sum(f"_{k}").over(within), F.lit(0)).alias(f"_{k}") for k in values])
    before = light.join(F.broadcast(sums), "_part").select("_at", *[(F.col(f"_{k}") + F.col(f"_{k}_above")).alias(k) for k in values])
    return sized_join(part.drop("_part"), before, "_at")


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, slopes: tuple[float, ...] = SLOPES, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """source, source_size, weight, slope and target from (source, source_size).

    Sources take the weights and slopes in turn, in code point order with null last.
    """
    ranked = with_sums_before(sources.withColumn("one", F.lit(1)), [F.col("source").asc_nulls_last()], rank="one")
    pick = lambda some: F.element_at(F.array(*map(F.lit, some)), (F.col("rank") % len(some) + 1).cast("int"))
    ranked = ranked.withColumns({"weight": pick(weights), "slope": pick(slopes)}).drop("one", "rank")
    filled = with_sums_before(ranked, [F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()], size_before="source_size", weight_before="weight")
    size, weight = filled.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    level = (share * size - cap * F.col("size_before")) * F.col("weight") / (weight - F.col("weight_before"))
    filled = filled.withColumn("capped", cap * F.col("source_size") <= level)
    capped, open_ = filled.agg(F.coalesce(F.sum(F.when(F.col("capped"), F.col("source_size"))), F.lit(0)), F.coalesce(F.sum(F.when(~F.col("capped"), F.col("weight"))), F.lit(0.0))).first()
    rest = F.try_divide((share * size - cap * capped) * F.col("weight"), F.lit(open_))
    target = F.when(F.col("capped"), cap * F.col("source_size")).otherwise(rest)
    return filled.select("source", "source_size", "weight", "slope", target.alias("target"))


def time_of(done: Column, slope: Column) -> Column:
    """The time by which a source has met the part `done` of its demand: inverts the integral of 1 + slope * (t - 1/2)."""
    b = 1 - slope / 2
    return F.least(F.lit(1.0), 2 * done / (b + F.sqrt(b * b + 2 * slope * done)))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: list[str] | None = None) -> DataFrame:
    """Every row of docs as struct `row` (of the columns in keep, or all), with place, size, source, source_size, target, taken, positions and words.

    taken counts the words that the mix takes, repeats included: of a source they add up to the whole part of
    its target, the last document being cut there. positions holds the time, from 0 to 1, of each copy taken, words
    how much of it is; place tells rows apart.

    The order within a source is that of the id's MD5, then id, size and the text's MD5: rows that tie in all of them
    have one text, so reruns take the same texts from any partitioning. Null texts have size 0 and are not taken; null
    sources are one source, the last; rows that repeat an id are each a document. An empty table gives no rows.
    Columns of docs may have any names: they stay inside `row`.
    """
    keep = docs.columns if keep is None else keep
    text = docs[text_col].cast("string")
    md5 = F.md5(F.coalesce(docs[id_col].cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("row"), docs[id_col].alias("id"), docs[source_col].cast("string").alias("source"), words_in(text).alias("size"), md5.alias("md5"), F.md5(text.cast("binary")).alias("text_md5"))
    order = [F.col("source").asc_nulls_last(), F.col("md5"), F.col("id").asc_nulls_last(), F.col("size"), F.col("text_md5")]
    placed = with_sums_before(rows, order, before="size").withColumnRenamed("_at", "place")
    sizes = placed.groupBy("source").agg(F.sum("size").alias("source_size"), F.min("before").alias("start"))
    name = lambda: F.concat(F.when(F.col("source").isNull(), "-").otherwise("+"), F.coalesce("source", F.lit(""))).alias("name")
    sizes = stored(sizes, "sizes")
    goals = targets(sizes.select("source", "source_size")).select(name(), "source_size", "slope", "target")
    goals = stored(goals.join(sizes.select(name(), "start"), "name"), "goals")
    found = sized_join(placed.withColumn("name", name()), goals, "name")
    first = F.col("before") - F.col("start")
    whole = F.floor("target")
    copies = [first + k * F.col("source_size") for k in range(int(CAP))]
    takes = [F.least(F.greatest(whole - c, F.lit(0)), F.col("size")) for c in copies]
    times = [F.when(t > 0, time_of(c / F.col("target"), F.col("slope"))) for c, t in zip(copies, takes)]
    words = F.array(*[F.when(t > 0, t) for t in takes])
    return found.select("row", "place", "size", "source", "source_size", "target", sum(takes[1:], takes[0]).alias("taken"), F.array_compact(F.array(*times)).alias("positions"), F.array_compact(words).alias("words"))


def copies_in_order(mixed: DataFrame, keep: list[str]) -> DataFrame:
    """The copies that a mix takes, range-sorted by position: the columns in keep, position and words. Copies of one position follow their source and place."""
    spark = mixed.sparkSession
    order = ["position", "source", "place"]
    columns = list(dict.fromkeys([*keep, "source", "place"]))
    copies = mixed.select(*columns, F.explode(F.arrays_zip("positions", "words")).alias("copy")).select(*columns, F.col("copy.positions").alias("position"), F.col("copy.words").alias("words"))
    return copies.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).select(*keep, "position", "words")


def in_training_order(mixed: DataFrame) -> DataFrame:
    """The rows that a mix takes, once for each copy, range-sorted by position."""
    return copies_in_order(mixed, ["row"]).select("row.*")
