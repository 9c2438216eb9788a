"""Signals of a stream of interval rows, kept per host in typed state.

The state of a host is small however long it runs: one value per average, the latencies that may still become the lowest
of the window, the last goodputs, the length of the current streak.  It is dropped by an event-time timer when a host has
been silent for long.  The rows that come out are those that ``ema``, ``rtprop``, ``goodput_history`` and
``underperformance`` give for the same intervals in batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from urlsheaf.operators.signals import (
    ALPHA,
    DEFAULT_RTPROP,
    GOODPUT_HISTORY,
    RTPROP_WINDOW,
    UNDERPERFORMANCE,
    UNDERPERFORMANCE_RUNS,
)


@dataclass(frozen=True)
class Signals:
    """What is kept.  ``averages`` maps columns to the names of their averages."""

    averages: dict = field(default_factory=lambda: {"p10_raw": "p10", "p50_raw": "p50", "p95_raw": "p95"}, hash=False)
    alpha: float = ALPHA
    window_seconds: float = RTPROP_WINDOW
    history: int = GOODPUT_HISTORY
    threshold: float = UNDERPERFORMANCE
    runs: int = UNDERPERFORMANCE_RUNS
    #: A host without rows for so long begins anew.
    silence: timedelta = timedelta(days=7)

    def schema(self, rows: T.StructType) -> T.StructType:
        made = [T.StructField(name, T.DoubleType()) for name in self.averages.values()]
        made += [
            T.StructField("rtprop", T.DoubleType()),
            T.StructField("goodput_history", T.ArrayType(T.DoubleType())),
            T.StructField("streak", T.LongType()),
            T.StructField("revise_ceiling", T.BooleanType()),
        ]
        return T.StructType([*rows.fields, *made])


class _Processor(StatefulProcessor):
    def __init__(self, plan: Signals, names: list[str]) -> None:
        self.plan, self.names = plan, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.values = handle.getValueState("values", "averages array<double>, rtprop double, streak bigint")
        self.lows = handle.getListState("lows", "at double, p10 double")
        self.goodputs = handle.getListState("goodputs", "rps double")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        plan, made = self.plan, []
        held = self.values.get() if self.values.exists() else None
        averages = list(held[0]) if held else [None] * len(plan.averages)
        lowest, streak = (held[1], held[2]) if held else (None, 0)
        lows = [(r[0], r[1]) for r in self.lows.get()] if self.lows.exists() else []
        goodputs = [r[0] for r in self.goodputs.get()] if self.goodputs.exists() else []
        last = None
        for row in sorted(rows, key=lambda r: r["interval_start"]):
            at = row["interval_start"].timestamp()
            for i, name in enumerate(plan.averages):
                x = row[name]
                if x is not None:
                    averages[i] = float(x) if averages[i] is None else plan.alpha * x + (1 - plan.alpha) * averages[i]
            low = row["p10_raw"]
            if low is not None:
                # a latency that is not below a later one can't become the lowest
                while lows and lows[-1][1] >= low:
                    lows.pop()
                lows.append((at, float(low)))
                while lows[0][0] < at - plan.window_seconds:
                    lows.pop(0)
                lowest = lows[0][1]
            rate = row["goodput_rps"]
            if rate is not None:
                goodputs = [*goodputs, float(rate)][-plan.history :]
            slow = False
            if rate is not None and rate >= 1.0 and row["concurrency"] is not None:
                slow = rate < row["concurrency"] / (DEFAULT_RTPROP if lowest is None else lowest) * plan.threshold
                streak = streak + 1 if slow else 0
            revise = slow and streak % plan.runs == 0
            last = row["interval_end"]
            made.append(Row(*self.names)(*row, *averages, lowest, list(goodputs), streak, revise))
        self.values.update((averages, lowest, streak))
        self.lows.put(lows) if lows else self.lows.clear()
        self.goodputs.put([(g,) for g in goodputs]) if goodputs else self.goodputs.clear()
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if last is not None:
            self.handle.registerTimer(int((last + plan.silence).timestamp() * 1000))
        yield from made

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.values.clear()
        self.lows.clear()
        self.goodputs.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_signals(intervals: DataFrame, plan: Signals = Signals(), delay: str = "0 seconds") -> DataFrame:
    """Adds the averages, ``rtprop``, ``goodput_history``, ``streak`` and ``revise_ceiling`` to a stream of interval rows.

    Rows have ``host, interval_start, interval_end, p10_raw, goodput_rps, concurrency`` and the columns to be averaged,
    and come in the order of their intervals, as ``stream_interval_metrics`` writes them; rows of one batch are ordered
    here.  Where the host or one of the times is missing a row is dropped, as it has no place.  Intervals of more than
    ``delay`` behind the latest end are late.  Needs the RocksDB state store.
    """
    placed = intervals.dropna(subset=["host", "interval_start", "interval_end"]).withWatermark("interval_end", delay)
    schema = plan.schema(intervals.schema)
    return placed.groupBy("host").transformWithState(_Processor(plan, schema.names), schema, "Append", "EventTime")
