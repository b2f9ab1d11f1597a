from datetime import timedelta
import random

from lectern.streaming.reading import progress_stream, rocksdb, session_stream
from tests.test_catalog_and_reading import EVENT, T0, events, model


def run(spark, tmp_path, make, name):
    """What a stream has written after one more run from its checkpoint."""
    stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    with rocksdb(spark):
        query = make(stream).writeStream.format("parquet").option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"at-{name}")).trigger(availableNow=True).start()
        query.awaitTermination()
    return spark.read.parquet(str(tmp_path / name)).collect()


def shown(name, rows):
    return sorted((r.user_id, r.words, r.ms) if name == "sessions" else (r.user_id, r.ts, r["index"]) for r in rows)


def test_streams_go_on_after_a_stop_and_sort_late_events(spark, tmp_path):
    rows = events(400)
    want = dict(zip(("sessions", "writes"), model(rows)))
    end = [(-1, max(r[1] for r in rows) + timedelta(days=1), False, 0, 10**9)]  # moves the watermark past all others
    rng = random.Random(7)
    mixed = [x for i in range(0, 400, 40) for x in rng.sample(rows[i : i + 40], 40)]
    for name, make in (("sessions", session_stream), ("writes", progress_stream)):
        late = f"{int((max(r[1] for r in rows) - T0).total_seconds()) + 1} seconds"
        got = []
        for n in range(4):
            part = mixed[n * 100 : n * 100 + 100] + (end if n == 3 else [])
            spark.createDataFrame(part[:50], EVENT).coalesce(1).write.mode("append").parquet(str(tmp_path / name / "in"))
            spark.createDataFrame(part[50:], EVENT).coalesce(1).write.mode("append").parquet(str(tmp_path / name / "in"))
            got = run(spark, tmp_path / name, lambda s, make=make, late=late: make(s, late=late), "out")
        end[0] = (-1, end[0][1] + timedelta(days=30), *end[0][2:])
        spark.createDataFrame(end, EVENT).coalesce(1).write.mode("append").parquet(str(tmp_path / name / "in"))
        got = [r for r in run(spark, tmp_path / name, lambda s, make=make, late=late: make(s, late=late), "out") if r.user_id != -1]
        assert shown(name, got) == want[name]


def test_events_in_order_are_handed_on_as_the_watermark_passes(spark, tmp_path):
    rows = events(200, seed=3)
    want = model(rows)[0]
    for n in range(2):
        spark.createDataFrame(rows[n * 100 : n * 100 + 100], EVENT).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        run(spark, tmp_path, lambda s: session_stream(s, "40 seconds"), "out")
    end = [(-1, max(r[1] for r in rows) + timedelta(days=1), False, 0, 10**9)]
    spark.createDataFrame(end, EVENT).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    assert shown("sessions", run(spark, tmp_path, lambda s: session_stream(s, "40 seconds"), "out")) == want


def test_the_session_keeps_its_own_state_store(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    with rocksdb(spark):
        assert "RocksDB" in spark.conf.get(key)
    assert spark.conf.get(key, None) == before
