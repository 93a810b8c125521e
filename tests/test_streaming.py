import datetime as dt

from pyspark.sql import functions as F

from quillspark.sources.tables import SCHEMAS
from quillspark.streaming.incremental import append_once, drain, first_seen, windowed_tally

T0 = dt.datetime(2024, 1, 1)


def log(spark, rows):
    return spark.createDataFrame([(m, c, T0 + dt.timedelta(hours=h), 0.1, "x") for m, c, h in rows], SCHEMAS["memory_recall_log"])


def test_windows_and_once_only_sink(spark, tmp_path):
    source = f"file://{tmp_path}/log"
    log(spark, [(1, True, 0), (1, False, 1), (2, True, 7), (1, True, 8)]).write.parquet(source)
    stream = spark.readStream.schema(SCHEMAS["memory_recall_log"]).parquet(source)
    sink = f"file://{tmp_path}/seen"
    drain(stream, append_once(sink, "memory_id"), f"file://{tmp_path}/c1").awaitTermination(120)
    log(spark, [(2, True, 9), (3, True, 9)]).write.mode("append").parquet(source)
    drain(stream, append_once(sink, "memory_id"), f"file://{tmp_path}/c1").awaitTermination(120)
    assert sorted(r.memory_id for r in spark.read.parquet(sink).collect()) == [1, 2, 3]
    out = []
    drain(windowed_tally(stream, late="0 seconds"), lambda b, i: out.extend(b.collect()), f"file://{tmp_path}/c2").awaitTermination(120)
    assert {(r.memory_id, r.window_start): (r.cited_count, r.surfaced_count) for r in out}[(1, T0)] == (1, 2)
    drain(first_seen(stream, ["memory_id"], "30 days"), lambda b, i: out.append(b.count()), f"file://{tmp_path}/c3").awaitTermination(120)
    assert 3 in out


def test_batch_form(spark):
    rows = windowed_tally(log(spark, [(1, True, 0), (1, True, 5), (1, False, 6)])).orderBy("window_start").collect()
    assert [(r.cited_count, r.surfaced_count) for r in rows] == [(2, 2), (0, 1)]
    assert F is not None
