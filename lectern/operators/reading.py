"""Readers' progress, saved books, sessions and statistics, from events."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import rounded
from lectern.operators.positions import percent

SAVE_MS, BASELINE_WPM, PAGE_WORDS = 2000, 250, 250


def latest(progress: DataFrame, keys: list[str], at: str, tie: str) -> DataFrame:
    """The last row of each key (MRG-08): one grouped maximum, no window."""
    rest = [c for c in progress.columns if c not in keys]
    return progress.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(at, tie)).alias("r")).select(*keys, "r.*")


def finished(index: Column, total: Column) -> Column:
    return F.coalesce((total > 0) & (index / total >= 0.99), F.lit(False))


def progress_percent(index: Column, total: Column) -> Column:
    return percent(index, total)


def saved(events: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Keys that are saved after an odd number of toggles, and when last (MRG-09)."""
    return events.groupBy(*keys).agg(F.count("*").alias("toggles"), F.max(at).alias("saved_at")).filter("toggles % 2 = 1")


def sessions(events: DataFrame, keys: list[str]) -> DataFrame:
    """Play-to-pause spans that took time and words, from (keys, ts, playing, index, tie) (STR-01).

    An event that repeats the state changes nothing.
    """
    order = Window.partitionBy(*keys).orderBy("ts", "tie")
    turns = events.withColumn("was", F.coalesce(F.lag("playing").over(order), F.lit(False))).filter("playing <> was")
    spans = turns.withColumns({"end_ts": F.lead("ts").over(order), "end_index": F.lead("index").over(order)}).filter("playing and end_ts is not null")
    ms = F.timestamp_diff("MILLISECOND", F.col("ts"), F.col("end_ts"))
    spans = spans.select(*keys, F.col("ts").alias("start_ts"), "end_ts", F.greatest(F.col("end_index") - F.col("index"), F.lit(0)).alias("words"), ms.alias("ms"))
    return spans.filter("words > 0 and ms > 0")


def statistics(sessions: DataFrame, keys: list[str]) -> DataFrame:
    """Totals and pace against an average reader (AGG-01..03)."""
    t = sessions.groupBy(*keys).agg(F.sum(F.greatest("words", F.lit(0))).alias("words"), F.sum(F.greatest("ms", F.lit(0))).alias("ms"))
    pace = F.when(F.col("ms") > 0, rounded(F.col("words") * 60000.0 / F.col("ms")))
    t = t.withColumn("wpm", pace)
    most = F.greatest(F.coalesce("wpm", F.lit(0)), F.lit(BASELINE_WPM))
    ratio = F.col("wpm") / BASELINE_WPM
    return t.select(
        *keys, "words", "ms", "wpm",
        rounded(F.col("ms") / 60000.0).alias("minutes"),
        F.floor(F.col("words") / PAGE_WORDS).cast("long").alias("pages"),
        F.when(F.col("wpm") > BASELINE_WPM, rounded(F.col("words") * 1.0 / BASELINE_WPM - F.col("words") * 1.0 / F.col("wpm"))).otherwise(0).cast("long").alias("minutes_saved"),
        F.coalesce(rounded(F.col("wpm") * 100.0 / most), F.lit(0)).cast("long").alias("your_bar"),
        rounded(BASELINE_WPM * 100.0 / most).alias("average_bar"),
        F.when(ratio > 1.03, "faster").when(ratio < 0.97, "slower").otherwise("even").alias("pace"),
    )


def throttled(events: DataFrame, keys: list[str], save_ms: int = SAVE_MS) -> DataFrame:
    """The events at which progress is written (STR-02), from (keys, ts, playing, index, tie): one fold in order.

    An event writes if its index isn't the one last written and reading is paused or save_ms have passed since
    the last write. Whether it does depends on all before, so each key's events pass by in time order; the fold
    holds one event and rows stream through, whatever a key has.
    """
    names = [*keys, "ts", "playing", "index", "tie"]
    kinds = events.select(*names).schema

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, at, last = None, None, None
        for batch in batches:
            keep = []
            stamps = batch["ts"].cast(pa.int64()).to_pylist()
            for key, ts, playing, index in zip(zip(*(batch[k].to_pylist() for k in keys)), stamps, batch["playing"].to_pylist(), batch["index"].to_pylist()):
                if key != own:
                    own, at, last = key, None, -1
                write = index != last and (not playing or at is None or ts - at >= 1000 * save_ms)
                if write:
                    at, last = ts, index
                keep.append(write)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return events.select(*names).repartition(*keys).sortWithinPartitions(*keys, "ts", "tie").mapInArrow(fold, kinds)


def newest_first(rows: DataFrame, keys: list[str], at: str, tie: str) -> DataFrame:
    """rows with their place in each key's list, latest first; the first is its hero (SRT-02, SRT-03)."""
    order = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(at), F.desc(tie))
    return rows.withColumn("place", F.row_number().over(order)).withColumn("hero", F.col("place") == 1)


def library_counts(progress: DataFrame, saved_: DataFrame, keys: list[str]) -> DataFrame:
    """Books finished, being read and saved by each reader (AGG-04), from (keys, index, total) and (keys, ...)."""
    done = finished(F.col("index"), F.col("total"))
    read = progress.groupBy(*keys).agg(F.count_if(done).alias("finished"), F.count_if(~done).alias("reading_now"))
    both = read.join(saved_.groupBy(*keys).agg(F.count("*").alias("saved")), keys, "full_outer")
    return both.select(*keys, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("finished", "reading_now", "saved")])


def playback_states(events: DataFrame, keys: list[str], total: Column) -> DataFrame:
    """State after each of (keys, ts, tie, event, index) (STR-04, STR-06): playing, index, and whether the word's clock restarts.

    A hidden window pauses; a seek keeps playing, at an index within the text; a reset stops at 0. Other events move nothing.
    """
    order = Window.partitionBy(*keys).orderBy("ts", "tie").rowsBetween(Window.unboundedPreceding, 0)
    e = F.col("event")
    turn = F.when(e == "play", True).when(e.isin("pause", "hidden", "reset"), False)
    index = F.when(e == "reset", 0).when(e == "seek", F.greatest(F.lit(0), F.least("index", total - 1))).otherwise(F.col("index"))
    return events.withColumns({"playing": F.coalesce(F.last(turn, ignorenulls=True).over(order), F.lit(False)), "index": index.cast("long"), "restarts": e.isin("seek", "reset")})


def flushed(events: DataFrame, writes: DataFrame, keys: list[str]) -> DataFrame:
    """The last event of each key whose index isn't the one last written (STR-03): what is still to write on leaving."""
    rest = [c for c in events.columns if c not in keys]
    last = events.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("ts", "tie")).alias("e"))
    wrote = writes.groupBy(*keys).agg(F.max_by("index", F.struct("ts", "tie")).alias("written"))
    return last.join(wrote, keys, "left").filter(~F.col("e.index").eqNullSafe(F.col("written"))).select(*keys, "e.*")
