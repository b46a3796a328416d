"""Keyed state with event-time timers (STR-36): activity spans of a key.

A span is a run of a key's rows whose event times lie less than ``idle`` apart. The state of a key
is its open spans only, in order of time in the state store: new rows are merged into them, also out
of order; when the watermark has passed a span's end by ``idle`` a timer closes it and it leaves
the state. A key without open spans keeps no state.

``append`` gives every span once, when it is closed. ``update`` gives every span that a batch opened
or changed; one that a row joined to an earlier span is given again with ``n = 0``, so the
newest row per (key, first) is the table, without those of ``n = 0``.

Rows behind the watermark, whose span may be closed already, are left out, as windowed
aggregations do. Rows without an event time are left out; a NULL key is a key.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: A key's open spans are one value: Spark hands over a list state element by element.
_OPEN = "first ARRAY<BIGINT>, last ARRAY<BIGINT>, n ARRAY<BIGINT>"
_OUT = "name STRING, first BIGINT, last BIGINT, n BIGINT"
_ROW = Row("name", "first", "last", "n")
#: Rows of a key that are merged into its spans at a time.
_ROWS = 10_000


def merge_spans(spans: list[tuple[int, int, int]], idle: int) -> list[tuple[int, int, int]]:
    """Spans (first, last, n), any two of which less than ``idle`` apart become one, in order."""
    out: list[tuple[int, int, int]] = []
    for first, last, n in sorted(spans):
        if out and first - out[-1][1] < idle:
            a, b, m = out[-1]
            out[-1] = (a, max(b, last), m + n)
        else:
            out.append((first, last, n))
    return out


class Spans(StatefulProcessor):
    """One key's open spans, in microseconds since the epoch."""

    def __init__(self, idle_us: int, mode: str):
        self.idle, self.mode = idle_us, mode

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", _OPEN)

    def _timer(self, spans) -> int | None:
        """When the span that ends first is over: in milliseconds, rounded up."""
        return -(-(min(s[1] for s in spans) + self.idle) // 1000) if spans else None

    def _held(self) -> list[tuple[int, int, int]]:
        held = self.open.get()
        return list(zip(*held)) if held else []

    def _keep(self, spans) -> None:
        if spans:
            self.open.update(tuple(map(list, zip(*spans))))
        else:
            self.open.clear()

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        before = self._held()
        spans = before
        for times in iter(lambda: [row.at for row in islice(rows, _ROWS)], []):
            spans = merge_spans(spans + [(at, at, 1) for at in times if at >= watermark], self.idle)
        if spans == before:
            return
        self._keep(spans)
        # the open spans tell which timer the key has: the one that they were kept with
        held, wanted = self._timer(before), self._timer(spans)
        if held != wanted:
            if held is not None:
                self.handle.deleteTimer(held)
            self.handle.registerTimer(wanted)
        if self.mode == "update":
            known, firsts = set(before), {s[0] for s in spans}
            gone = [(first, last, 0) for first, last, _ in before if first not in firsts]
            yield from (_ROW(key[0], *s) for s in gone + [s for s in spans if s not in known])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """Spark deletes the timer that has expired itself, afterwards."""
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        spans = self._held()
        left = [s for s in spans if s[1] + self.idle > watermark]
        self._keep(left)
        if left:
            self.handle.registerTimer(self._timer(left))
        if self.mode == "append":
            yield from (_ROW(key[0], *s) for s in spans if s[1] + self.idle <= watermark)

    def close(self) -> None:
        pass


def activity_spans(df: DataFrame, key: str, ts: str, idle: str, watermark: str, mode: str = "append") -> DataFrame:
    """``key``, ``first``, ``last``, ``n`` of the activity spans of a stream (see above). The query must
    run on the RocksDB state store (``sessions.stream_session``)."""
    if mode not in ("append", "update"):
        raise ValueError(f"spans are given in append or update mode, not {mode!r}")
    since_0 = F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {idle}"))
    idle_us = df.sparkSession.range(1).select(since_0).first()[0]
    # keys travel as text that is never NULL
    name = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))
    rows = (df.withWatermark(ts, watermark).where(F.col(ts).isNotNull())
            .select(name.alias("name"), ts, F.unix_micros(F.col(ts).cast("timestamp")).alias("at")))
    out = rows.groupBy("name").transformWithState(Spans(idle_us, mode), _OUT, mode, "eventTime")
    value = F.when(F.col("name") != "", F.substring("name", F.lit(2), F.length("name"))).cast(df.schema[key].dataType)
    return out.select(value.alias(key), *[F.timestamp_micros(c).alias(c) for c in ("first", "last")], "n")
