"""The inbox's queue as a stream: leases with timers, attempts, and rows given up after too many.

Events of a row of the inbox, in the order of their ``seq``: ``arrived``, ``claimed`` (a
lease begins), ``failed``, ``promoted``, ``rejected``.  What happens goes out as
``id, at, event, attempts``: ``claimed``, ``released`` (a lease ran out), ``retry``,
``exhausted``, ``promoted``, ``rejected``, or ``refused`` for what came too late or while another's
lease ran.  The stream and the batch form give the same rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from quillspark.runtime import ship

STATE = "status string, attempts int, lease bigint, seq bigint"
OUTCOME = "id bigint, at timestamp, event string, attempts int"
#: What the operators read: times in milliseconds, so that no time zone comes in between.
_EVENTS = ("id", "seq", "event", "at", "ms")


def step(state: tuple, seq: int, event: str, ms: int, lease_ms: int, most: int) -> tuple[tuple, list[tuple]]:
    """The state ``(status, attempts, lease, seq)`` after an event, and what goes out as ``(ms, event, attempts)``.

    An event that was seen before (by its ``seq``) changes nothing.
    """
    status, attempts, lease, last = state
    if seq <= last:
        return state, []
    out = []
    if lease and ms >= lease:
        out.append((lease, "released", attempts))
        lease = 0
    if event == "arrived":
        pass
    elif status != "pending" or (event == "claimed" and lease) or (event != "claimed" and not lease):
        out.append((ms, "refused", attempts))
    elif event == "claimed":
        lease = ms + lease_ms
        out.append((ms, "claimed", attempts))
    elif event == "failed":
        attempts, lease = attempts + 1, 0
        status = "rejected" if attempts >= most else "pending"
        out.append((ms, "exhausted" if attempts >= most else "retry", attempts))
    else:
        status, lease = event, 0
        out.append((ms, event, attempts))
    return (status, attempts, lease, seq), out


NEW = ("pending", 0, 0, -1)


class _Inbox(StatefulProcessor):
    def __init__(self, lease_ms: int, most: int) -> None:
        self.lease_ms, self.most = lease_ms, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.row = handle.getValueState("row", STATE)

    def _get(self) -> tuple:
        return tuple(self.row.get()) if self.row.exists() else NEW

    @staticmethod
    def _out(key: tuple, out: list[tuple]) -> Iterator[Row]:
        for ms, event, attempts in out:
            yield Row(id=key[0], at=pd.Timestamp(ms, unit="ms").to_pydatetime(), event=event, attempts=attempts)

    def handleInputRows(self, key: tuple, rows: Iterable[Row], timerValues) -> Iterator[Row]:
        before = state = self._get()
        for r in sorted(rows, key=lambda r: r.seq):
            state, out = step(state, r.seq, r.event, r.ms, self.lease_ms, self.most)
            yield from self._out(key, out)
        if before[2] and before[2] != state[2]:
            self.handle.deleteTimer(before[2])
        if state[2] and before[2] != state[2]:
            self.handle.registerTimer(state[2])
        self.row.update(state)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        status, attempts, lease, seq = self._get()
        if lease and lease <= expiredTimerInfo.getExpiryTimeInMs():
            self.row.update((status, attempts, 0, seq))
            yield from self._out(key, [(lease, "released", attempts)])

    def close(self) -> None:
        pass


def inbox_stream(events: DataFrame, lease_minutes: int = 10, most: int = 5, late: str = "1 minute") -> DataFrame:
    """What happens to rows of the inbox, from a stream of ``id, seq, event, at``.

    A lease is kept by an event-time timer, which runs out as the watermark passes it;
    a repeated batch changes nothing.  The state store must be the RocksDB one.
    """
    ship(events.sparkSession)
    rows = events.withWatermark("at", late).withColumn("ms", F.unix_millis("at")).select(*_EVENTS)
    kind = T._parse_datatype_string(OUTCOME)
    return rows.groupBy("id").transformWithState(_Inbox(lease_minutes * 60_000, most), kind, "Append", "EventTime")


def inbox_history(events: DataFrame, as_of: Column, lease_minutes: int = 10, most: int = 5) -> DataFrame:
    """The same over a table of events, with leases that ran out by ``as_of``.

    A row's events, which its attempts bound, meet in one group.
    """
    ship(events.sparkSession)
    lease_ms = lease_minutes * 60_000

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        state, out = NEW, []
        for seq, event, ms in sorted(zip(pdf["seq"].tolist(), pdf["event"], pdf["ms"].tolist())):
            state, more = step(state, seq, event, ms, lease_ms, most)
            out += more
        if state[2] and state[2] <= pdf["end"].iloc[0]:
            out.append((state[2], "released", state[1]))
        return pd.DataFrame({"id": [key[0]] * len(out), "ms": [o[0] for o in out], "event": [o[1] for o in out], "attempts": [o[2] for o in out]}).astype({"id": "int64", "ms": "int64", "attempts": "int32"})

    rows = events.select("id", "seq", "event", F.unix_millis("at").alias("ms"), F.unix_millis(as_of).alias("end"))
    found = rows.groupBy("id").applyInPandas(run, "id long, ms long, event string, attempts int")
    return found.select("id", F.timestamp_millis("ms").alias("at"), "event", "attempts")
