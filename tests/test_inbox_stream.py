import datetime as dt
import random

from pyspark.sql import functions as F

from quillspark.streaming.inbox import inbox_history, inbox_stream
from quillspark.streaming.incremental import drain

T0 = dt.datetime(2024, 1, 1)
SHAPE = "id long, seq long, event string, at timestamp"


def events(spark, rows):
    return spark.createDataFrame([(i, s, e, T0 + dt.timedelta(minutes=m)) for i, s, e, m in rows], SHAPE)


def seen(rows):
    return sorted((r.id, r.at, r.event, r.attempts) for r in rows)


def test_history_of_a_row(spark):
    rows = [(1, 0, "arrived", 0), (1, 1, "claimed", 1), (1, 2, "claimed", 5), (1, 3, "claimed", 11), (1, 4, "failed", 12), (1, 5, "failed", 13), (1, 6, "claimed", 14), (1, 7, "promoted", 15), (1, 8, "rejected", 16)]
    rows += [(2, 2 * k, "claimed", 20 * k) for k in range(1, 7)] + [(2, 2 * k + 1, "failed", 20 * k + 1) for k in range(1, 7)] + [(3, 0, "arrived", 0), (3, 1, "claimed", 2)]
    got = {}
    for i, at, event, n in seen(inbox_history(events(spark, rows), F.lit(T0 + dt.timedelta(hours=5))).collect()):
        got.setdefault(i, []).append((int((at - T0).total_seconds() // 60), event, n))
    assert got[1] == [(1, "claimed", 0), (5, "refused", 0), (11, "claimed", 0), (11, "released", 0), (12, "retry", 1), (13, "refused", 1), (14, "claimed", 1), (15, "promoted", 1), (16, "refused", 1)]
    assert [e for _, e, _ in got[2]].count("retry") == 4 and (101, "exhausted", 5) in got[2] and got[2][-2:] == [(120, "refused", 5), (121, "refused", 5)]
    assert got[3] == [(2, "claimed", 0), (12, "released", 0)]
    assert inbox_history(events(spark, rows).where("false"), F.lit(T0)).collect() == []


def test_the_stream_ends_as_the_table_does(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rng = random.Random(4)
    rows = [(i, s, "arrived" if s == 0 else rng.choice(["claimed", "claimed", "failed", "promoted"]), 7 * s + i % 3) for i in range(12) for s in range(9)]
    early, later = [r for r in rows if r[3] < 30], [r for r in rows if r[3] >= 30]
    end = [(99, 0, "arrived", 100_000)]
    source, out = f"file://{tmp_path}/events", []
    for part in (early, early + later, end, [(99, 1, "claimed", 100_001)]):  # what came is sent again with what follows
        events(spark, part).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SHAPE).parquet(source)
        drain(inbox_stream(stream), lambda b, _: out.extend(b.collect()), f"file://{tmp_path}/state").awaitTermination(300)
    want = inbox_history(events(spark, rows), F.lit(T0 + dt.timedelta(days=60)))
    assert seen(r for r in out if r.id != 99) == seen(want.collect())
    assert {r.event for r in out} >= {"released", "retry", "refused", "promoted"}
