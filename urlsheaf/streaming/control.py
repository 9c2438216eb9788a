"""Concurrency advice on a live request log."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from urlsheaf.operators.control import ADVICE, INPUT, Host, Policy, fold

# Keyed state of this kind is only kept by this state store.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class ControlProcessor(StatefulProcessor):
    """Keeps one host's control state between micro-batches."""

    def __init__(self, policy: Policy):
        self.policy = policy

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.host = handle.getValueState("host", "dump string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state = Host.load(self.host.get()[0]) if self.host.exists() else Host.fresh(self.policy)
        # the closed intervals of one host in one micro-batch
        closed = pd.concat(list(rows)).sort_values("interval_start")
        advice = fold(state, closed, self.policy)
        self.host.update((state.dump(),))
        yield advice

    def close(self) -> None:
        pass


def stream_concurrency(snapshots: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Advice per closed interval; ``snapshots`` is a streamed snapshot."""
    return (
        snapshots.select(*INPUT)
        .groupBy("host")
        .transformWithStateInPandas(ControlProcessor(policy), ADVICE, "Append", "None")
    )
