"""Structured Streaming twins: the interaction log, running metrics, the circuit breaker, log lines."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from loomline.operators.learning import Breaker, metrics


def append_log(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """An append-only JSON log."""
    return stream.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(**(trigger or {"availableNow": True})).start()


def running_metrics(stream: DataFrame, name: str, checkpoint: str, trigger: dict | None = None):
    """Pattern metrics in a memory table, whole after each batch."""
    return metrics(stream).writeStream.format("memory").queryName(name).option("checkpointLocation", checkpoint).outputMode("complete").trigger(**(trigger or {"availableNow": True})).start()


def next_state(state: tuple, ok: bool, at: float, cfg: Breaker) -> tuple:
    """One event on (state, fails, oks, opened, opens): the row-at-a-time form of learning.breaker_step."""
    name, fails, oks, opened, opens = state
    if name == "OPEN" and at - opened >= cfg.cooldown:
        name, oks = "HALF_OPEN", 0
    if ok:
        oks += name != "OPEN"
        return ("CLOSED" if name == "HALF_OPEN" and oks >= cfg.successes else name, 0, oks, opened, opens)
    fails += 1
    if name != "OPEN" and fails >= cfg.failures:
        return ("OPEN", fails, 0, at, opens + 1)
    return (name, fails, 0, opened, opens)


def breaker_stream(stream: DataFrame, key: str = "pattern", cfg: Breaker = Breaker()) -> DataFrame:
    """(key, state, consec_failures, consec_successes, opens) after each batch of events (key, at, seq, success). Events of a batch are taken in (at, seq) order."""
    kind = stream.schema[key].dataType.simpleString()

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.get if state.exists else ("CLOSED", 0, 0, 0.0, 0)
        events = pd.concat(list(batches)).sort_values(["at", "seq"])
        for ok, at in zip(events["success"].tolist(), events["at"].tolist()):
            now = next_state(tuple(now), bool(ok), float(at), cfg)
        state.update(now)
        yield pd.DataFrame([(k[0], now[0], now[1], now[2], now[4])], columns=[key, "state", "consec_failures", "consec_successes", "opens"])

    out = f"{key} {kind}, state string, consec_failures int, consec_successes int, opens int"
    return stream.groupBy(key).applyInPandasWithState(step, out, "state string, fails int, oks int, opened double, opens int", "update", GroupStateTimeout.NoTimeout)
