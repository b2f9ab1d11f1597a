"""Ledgers: keyed tables that are merged under a rule for conflicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def without(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys aren't among those of known; a null equals a null."""
    there = known.select(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)])
    same = [F.col(k).eqNullSafe(F.col(f"_{i}")) for i, k in enumerate(keys)]
    return rows.join(there, same, "left_anti")


def keep_existing(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Old rows, and new ones with other keys (MRG-01); null is a key like any other. Rows that repeat a key within one side all stay."""
    return old.unionByName(without(new, old, keys))


def overwrite(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows, and old ones with other keys (MRG-02)."""
    return keep_existing(new, old, keys)


def fill(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """All keys; of each value the old one, or the new if that is null (MRG-03)."""
    values = [c for c in old.columns if c not in keys]
    both = old.alias("o").join(new.alias("n"), keys, "full_outer")
    return both.select(*keys, *[F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}")).alias(c) for c in values])


def done_ids(*ledgers: DataFrame) -> DataFrame:
    """Every id seen, also of rejected rows (MRG-04, SET-01, SET-03)."""
    out = ledgers[0]
    for more in ledgers[1:]:
        out = out.unionByName(more)
    return out.distinct()


def start_with_fallback(anchor: Column, detected: Column) -> Column:
    return F.coalesce(anchor, detected, F.lit(0))


def verdict_id(raw: Column) -> Column:
    return F.regexp_replace(F.trim(raw.cast("string")), r"(?i)[-_:]?(short|story)\z", "")


def apply_verdicts(items: DataFrame, verdicts: DataFrame, keys: list[str]) -> DataFrame:
    """Items with their outcome: only a verdict to keep keeps one (JN-15, MRG-06)."""
    outcome = F.when(F.col("keep"), "kept").when(F.col("keep").isNotNull(), "killed").otherwise("unjudged")
    return items.join(verdicts, keys, "left").withColumn("outcome", outcome)


def verdict_counts(judged: DataFrame, tier: str = "tier") -> DataFrame:
    """Outcomes of each tier and the whole percent that was not kept (AGG-09)."""
    of = lambda x: F.count_if(F.col("outcome") == x).alias(x)
    counts = judged.groupBy(tier).agg(F.count("*").alias("had"), of("kept"), of("killed"), of("unjudged"))
    return counts.withColumn("kill_rate", F.floor(100.0 * (F.col("had") - F.col("kept")) / F.col("had") + 0.5).cast("int"))


def queue(items: DataFrame, done: DataFrame, keys: list[str], order: list[Column], n: int, batch: int) -> DataFrame:
    """The first n items that aren't done, in batches (SRT-07, SNK-05): only the n rows are numbered in one place."""
    first = items.join(done, keys, "left_anti").orderBy(*order).limit(n)
    place = F.row_number().over(Window.orderBy(*order)) - 1
    return first.withColumn("place", place).withColumn("batch", F.floor(F.col("place") / batch))


def migrate(states: DataFrame) -> DataFrame:
    """Saved states of any version brought to the fifth (MIG-01), one rule for each step."""
    v = F.col("version")
    steps = {
        "words_read": F.when(v == 0, F.coalesce("words_read", F.lit(0))).otherwise(F.col("words_read")),
        "ms_read": F.when(v == 0, F.coalesce("ms_read", F.lit(0))).otherwise(F.col("ms_read")),
        "wpm": F.when(v == 0, F.coalesce("wpm", F.lit(300))).otherwise(F.col("wpm")),
        "vis_mode": F.when(v == 0, F.coalesce("vis_mode", F.lit("rsvp"))).otherwise(F.col("vis_mode")),
        "progress_by_id": F.when(v >= 2, F.col("progress_by_id")).when(F.col("progress.book_id") != "", F.create_map("progress.book_id", "progress")).otherwise(F.create_map().cast(states.schema["progress_by_id"].dataType)),
        "fit_mode": F.when((v < 4) & (F.col("fit_mode").isNull() | (F.col("fit_mode") == "classic")), "centerAll").otherwise(F.col("fit_mode")),
        "saved_by_id": F.when(v < 5, F.coalesce("saved_by_id", F.create_map().cast(states.schema["saved_by_id"].dataType))).otherwise(F.col("saved_by_id")),
    }
    return states.withColumns(steps).drop("progress").withColumn("version", F.lit(5))


def backfill(items: DataFrame, done: DataFrame, meta: DataFrame, keys: list[str]) -> DataFrame:
    """Items that are done but have no entry in meta (JN-03)."""
    return items.join(done, keys, "left_semi").join(meta, keys, "left_anti")


def routed_by_asset(rows: DataFrame, existing: DataFrame, assets: DataFrame, keys: list[str]) -> DataFrame:
    """Where each new row goes (MRG-07): nowhere if its key is there already, to the bundle if its file is, else to the deep store."""
    flag = lambda df, name: df.select(*keys).distinct().withColumn(name, F.lit(True))
    known = rows.join(flag(existing, "_there"), keys, "left").join(flag(assets, "_file"), keys, "left")
    return known.withColumn("route", F.when(F.col("_there"), "skipped").when(F.col("_file"), "bundled").otherwise("deep")).drop("_there", "_file")


def unexpired(entries: DataFrame, store: str, at: str, tie: str, now: Column, most: int, days: int) -> DataFrame:
    """Of each store's entries the `most` latest that are at most `days` old (STR-09)."""
    fresh = entries.filter(F.col(at) >= now - F.make_dt_interval(F.lit(days)))
    order = Window.partitionBy(store).orderBy(F.desc(at), F.desc(tie))
    return fresh.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= most).drop("_r")


def chunk_label(place: Column, size: int = 100) -> Column:
    """The chunk of a place counted from 1, as "from-to" (WIN-21)."""
    first = F.floor((place - 1) / size) * size + 1
    return F.concat_ws("-", first.cast("string"), (first + size - 1).cast("string"))
