"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast if it is counted to have no more rows and bytes than these; beyond them joins shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 24 << 20
#: Documents per Arrow batch: a batch of the longest documents still fits a Python worker.
ARROW_ROWS = 200
#: About so many distinct keys a range are looked at to find where ranges end.
SAMPLE_KEYS = 100


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where none is configured (local tests)."""
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        place = f"file://{tempfile.gettempdir()}/lectern-shared"
    return place.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/lectern/{tag}-{uuid.uuid4().hex}"


#: Of each clearing() that is open, the paths written since.
_OPEN: list[list[str]] = []


@contextmanager
def clearing(spark: SparkSession) -> Iterator[None]:
    """Deletes on leaving what stored() has written inside and discard() hasn't deleted: for work whose result is written by then."""
    _OPEN.append([])
    try:
        yield
    finally:
        for path in _OPEN.pop():
            _delete(spark, path)


def _delete(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, tag: str) -> DataFrame:
    """df written to the shared folder and read again: cuts lineage and survives lost executors."""
    path = new_path(df.sparkSession, tag)
    for some in _OPEN[-1:]:
        some.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def observed(df: DataFrame, tag: str, **values: Column) -> tuple[DataFrame, dict]:
    """df as stored() gives it, and aggregates of its rows that were taken while they were written: no job of their own."""
    seen = Observation()
    df = stored(df.observe(seen, *[value.alias(name) for name, value in values.items()]), tag)
    return df, seen.get


def discard(df: DataFrame) -> None:
    """Deletes what stored() wrote, once nothing reads it any more."""
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        _delete(df.sparkSession, name)


def tidy(spark: SparkSession) -> None:
    """Has the driver collect its garbage: only then Spark drops the broadcasts and shuffle files of steps that are done, which fill heap and disks meanwhile."""
    spark._jvm.System.gc()


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of few rows, for texts of any length."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def release() -> None:
    """Gives memory that a task no longer uses back to the system: Python workers outlive tasks, and each would keep the most it ever needed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
    if trim is not None:
        trim(0)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes."""
    size = F.lit(8 * len(df.columns))
    for name, kind in df.dtypes:
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(name), F.lit(0))
        elif kind.startswith("array"):
            size = size + 16 * F.coalesce(F.size(name), F.lit(0))
        elif kind.startswith(("map", "struct")):
            size = size + F.coalesce(F.octet_length(F.to_json(name)), F.lit(0))
    return size


def sized_join(df: DataFrame, small: DataFrame, on: str | list[str], how: str = "inner", known: tuple[int, int] | None = None) -> DataFrame:
    """Join with a side that is broadcast only if it is counted to be small; else both sides are shuffled. known: its rows and bytes, if they needn't be counted."""
    n, size = known or small.limit(BROADCAST_ROWS + 1).agg(F.count("*"), F.coalesce(F.sum(_bytes(small)), F.lit(0))).first()
    if n <= BROADCAST_ROWS and size <= BROADCAST_BYTES:
        small = F.broadcast(small)
    return df.join(small, on, how)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_key(id_: Column) -> Column:
    """A string that sorts as the long does, null first."""
    return F.coalesce(F.lpad((id_.cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")).cast("string"), 20, "0"), F.lit(""))


def range_starts(keys: DataFrame, n: int) -> np.ndarray:
    """First keys of the second to at most n-th range of (key) strings, about equally many distinct keys a range.

    They are quantiles of the keys whose hash is divisible by a number that follows from their count: they depend
    on the keys and n alone, not on partitions or attempts, and about SAMPLE_KEYS * n keys reach the driver.
    """
    total = keys.count()
    step = max(total // (SAMPLE_KEYS * n), 1)
    some = sorted(r.key.encode() for r in keys.filter(F.pmod(F.xxhash64("key"), F.lit(step)) == 0).distinct().collect())
    return np.array(sorted({some[len(some) * i // n] for i in range(1, n)} - {some[0]}) if some else [], dtype=bytes)


def range_of(spark: SparkSession, key: Column, starts: np.ndarray) -> Column:
    """Struct (number, first): in which range a key lies, and whether it is the one that the range starts with."""
    shared = spark.sparkContext.broadcast(starts)

    @F.arrow_udf("number int, first boolean")
    def place(keys: pa.Array) -> pa.Array:
        found = np.array([k.encode() for k in keys.to_pylist()] or [b""], dtype=bytes)[: len(keys)]
        at = np.searchsorted(shared.value, found, "right") if len(shared.value) else np.zeros(len(found), np.int64)
        first = shared.value[at - 1] == found if len(shared.value) else np.zeros(len(found), bool)
        return pa.StructArray.from_arrays([pa.array(at.astype(np.int32)), pa.array((at > 0) & first)], names=["number", "first"])

    return place(key)
