"""Streams that keep state a key: a circuit breaker that time moves, sessions' memory, followed training logs, the improvement cycle.

Stateful operators emit what changed; keyed_upserts() puts that into a store, each batch once, so a query that starts
again from its checkpoint goes on where it was.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from loomline.functions.text import SPACE, WS
from loomline.operators import learning, memory
from loomline.sources.readers import LOG_FIELDS, LOG_FIRST, line_fields
from loomline.sources.store import KeyedStore
from loomline.streaming.jobs import next_state

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """State that processors keep needs this provider; a query takes the session's settings when it starts."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def keyed_upserts(stream: DataFrame, store: KeyedStore, name: str, checkpoint: str, order: str | None = None, trigger: dict | None = None):
    """A stream's changed rows, put into the store by key; of a batch's rows for one key the last by `order`. A batch that comes again changes nothing."""
    def put(batch: DataFrame, number: int) -> None:
        store.put(batch, order=order, stream=name, batch=number)

    with keyed_state(store.spark):
        return stream.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def running_metrics(stream: DataFrame, store: KeyedStore, name: str, checkpoint: str, pattern: str = "pattern", trigger: dict | None = None):
    """Each pattern's metrics, upserted when they change."""
    return keyed_upserts(learning.metrics(stream, pattern), store, name, checkpoint, trigger=trigger)


def row_of(key: str, columns: str) -> Row:
    """Makes rows of the key and these columns. Processors work on rows: a data frame a key costs more than its few rows."""
    return Row(key, *(c.split()[0] for c in columns.split(", ")))


# ---- the breaker

BREAKER = "state string, fails int, oks int, opened double, opens int"
BREAKER_ROW = "state string, consec_failures int, consec_successes int, opens int, moved_by string, moved_at double"


class BreakerTimers(StatefulProcessor):
    """The breaker of one key: events move it, and so does the end of its cool-down, without an event."""

    def __init__(self, key: str, cfg: learning.Breaker):
        self.cfg, self.row = cfg, row_of(key, BREAKER_ROW)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.now = handle, handle.getValueState("breaker", BREAKER)

    def _due(self, s: tuple) -> int | None:
        """When an open breaker's cool-down ends, in milliseconds."""
        return math.ceil((s[3] + self.cfg.cooldown) * 1000) if s[0] == "OPEN" else None

    def _row(self, key: tuple, s: tuple, by: str, at: float) -> Row:
        return self.row(key[0], s[0], s[1], s[2], s[4], by, at)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        was = self.now.get()
        was = tuple(was) if was is not None else ("CLOSED", 0, 0, 0.0, 0)
        events, s = sorted(((r["at"], r["seq"], r["success"]) for r in rows), key=lambda r: r[:2]), was
        for at, _, ok in events:
            s = next_state(s, bool(ok), float(at), self.cfg)
        self.now.update(s)
        if self._due(was) != self._due(s):
            if self._due(was) is not None:
                self.handle.deleteTimer(self._due(was))
            if self._due(s) is not None:
                self.handle.registerTimer(self._due(s))
        yield self._row(key, s, "event", float(events[-1][0]))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        s, at = tuple(self.now.get()), expiredTimerInfo.getExpiryTimeInMs()
        if self._due(s) is not None and self._due(s) <= at:
            s = ("HALF_OPEN", s[1], 0, s[3], s[4])
            self.now.update(s)
            yield self._row(key, s, "timer", at / 1000)

    def close(self) -> None:
        pass


def breaker_timers(stream: DataFrame, key: str = "pattern", delay: str = "0 seconds", cfg: learning.Breaker = learning.Breaker()) -> DataFrame:
    """(key, state, counts, moved_by, moved_at) of keys that moved, from events (key, at in seconds, seq, success). Event time is `at`; events later than `delay` are left out."""
    kind = stream.schema[key].dataType.simpleString()
    timed = stream.select(key, "at", "seq", "success", F.timestamp_millis(F.floor(F.col("at") * 1000)).alias("_time")).withWatermark("_time", delay)
    return timed.groupBy(key).transformWithState(BreakerTimers(key, cfg), f"{key} {kind}, {BREAKER_ROW}", "Update", "EventTime")


# ---- a session's memory


def tokens_of(text: str) -> int:
    """token_estimate() of one text."""
    return max(1, math.floor(sum(1 for w in re.split(WS + "+", text) if w) * 1.3)) if text else 0


def _sentences(text: str) -> list[str]:
    return re.split(r"(?<=[.!?])" + WS + "+", text)


_CLINICAL = re.compile(memory.CLINICAL.replace("(?iU)", "(?i)"))
_NUMBER, _NAME = re.compile(r"\b\d+\b"), re.compile(r"\b[A-Z][a-z]{3,}\b")


def key_sentences_of(text: str, budget: int) -> str:
    """memory.key_sentences() of one text."""
    rows = sorted((-(3 * len(_CLINICAL.findall(s)) + len(_NUMBER.findall(s)) + len(_NAME.findall(s))), i, tokens_of(s), s) for i, s in enumerate(_sentences(text.strip(SPACE))))
    used, got = 0, []
    for _, i, n, s in rows:
        if used < budget and used + n <= budget:
            used += n
            got.append((i, s))
    return " ".join(s for _, s in sorted(got))


def with_summary(l2: str, part: str, budget: int) -> str:
    """l2 with one more evicted turn's key sentences; beyond the budget its oldest sentences go."""
    if part == "":
        return l2
    combined = " ".join((l2, part)).strip(SPACE)
    if tokens_of(combined) <= budget:
        return combined
    used, kept = 0, []
    for s in reversed(_sentences(combined)):
        if used + tokens_of(s) > budget:
            break
        used += tokens_of(s)
        kept.insert(0, s)
    return " ".join(kept)


SESSION_ROW = "messages long, l1_messages long, l1_tokens long, l1 string, l2 string"


class SessionMemory(StatefulProcessor):
    """Live turns as a list, first in first out under a token budget; what goes is summed up. With `ttl_ms`, a session that stays silent that long is forgotten."""

    def __init__(self, session: str, budgets: memory.Budgets, ttl_ms: int | None):
        self.session, self.budgets, self.ttl = session, budgets, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.turns = handle.getListState("turns", "role string, text string, tokens int", self.ttl)
        self.facts = handle.getValueState("facts", "messages long, l1_tokens long, l2 string", self.ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        messages, used, l2 = self.facts.get() if self.facts.exists() else (0, 0, "")
        live = [tuple(x) for x in self.turns.get()] if self.turns.exists() else []
        new = pd.concat(list(rows)).sort_values("turn")
        for role, text in zip(new["role"].tolist(), new["text"].tolist()):
            text = text or ""
            live.append((role, text, tokens_of(text)))
            used += live[-1][2]
            while used > self.budgets.l1 and len(live) > 1:
                _, gone, n = live.pop(0)
                used -= n
                l2 = with_summary(l2, key_sentences_of(gone, max(self.budgets.l2 // 4, 50)), self.budgets.l2)
        messages += len(new)
        self.turns.put(live)
        self.facts.update((messages, used, l2))
        l1 = "\n".join(": ".join(x for x in (role and role.upper(), text) if x is not None) for role, text, _ in live)
        yield pd.DataFrame([(key[0], messages, len(live), used, l1, l2)], columns=[self.session, *(c.split()[0] for c in SESSION_ROW.split(", "))])

    def close(self) -> None:
        pass


def session_memory(stream: DataFrame, session: str = "session", order: str = "turn", text: str = "text", budgets: memory.Budgets = memory.Budgets(), ttl_ms: int | None = None) -> DataFrame:
    """(session, messages, l1_messages, l1_tokens, l1, l2) of each session that got turns (session, order, role, text). With ttl_ms the clock moves the query, so it has to run on a processingTime trigger: availableNow would never end."""
    kind = stream.schema[session].dataType.simpleString()
    rows = stream.select(session, F.col(order).alias("turn"), "role", F.col(text).alias("text"))
    return rows.groupBy(session).transformWithStateInPandas(SessionMemory(session, budgets, ttl_ms), f"{session} {kind}, {SESSION_ROW}", "Update", "ProcessingTime" if ttl_ms else "None")


# ---- a followed log

LOG_STATE = ", ".join(f"{n} {t}" for n, t in LOG_FIELDS.items())
LOG_ROW = f"seq long, idle boolean, {LOG_STATE}"


class FollowedLog(StatefulProcessor):
    """A run's fields as its log has them so far: one row a line, and an idle row after each `idle_ms` of silence. Input rows are (run, seq, said): a line's few fields as JSON, for each column of a row costs."""

    def __init__(self, run: str, idle_ms: int | None):
        self.idle, self.row = idle_ms, row_of(run, LOG_ROW)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.now, self.timer = handle.getValueState("log", f"seq long, {LOG_STATE}"), handle.getValueState("timer", "at long")

    def _wait(self, timerValues) -> None:
        if self.idle is None:
            return
        if self.timer.exists():
            self.handle.deleteTimer(self.timer.get()[0])
        at = timerValues.getCurrentProcessingTimeInMs() + self.idle
        self.handle.registerTimer(at)
        self.timer.update((at,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        was = self.now.get()
        last, *fields = was if was is not None else (-1, *(None for _ in LOG_FIELDS))
        now = dict(zip(LOG_FIELDS, fields))
        for last, said in sorted((r["seq"], r["said"]) for r in rows):
            for n, v in json.loads(said).items():
                if not (n in LOG_FIRST and now[n] is not None):
                    now[n] = float(v) if LOG_FIELDS[n] == "double" else v
            yield self.row(key[0], last, False, *now.values())
        self.now.update((last, *now.values()))
        self._wait(timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.timer.exists() or self.timer.get()[0] > expiredTimerInfo.getExpiryTimeInMs():
            return
        self.timer.clear()
        self._wait(timerValues)
        last, *fields = self.now.get()
        yield self.row(key[0], last, True, *fields)

    def close(self) -> None:
        pass


def followed_log(stream: DataFrame, run: str = "run", seq: str = "seq", line: str = "value", idle_ms: int | None = None) -> DataFrame:
    """(run, seq, idle, fields) for each line of a stream (run, seq, line), as readers.log_fields() has them in a batch. With idle_ms, silent runs give idle rows; the query then has to run on a processingTime trigger."""
    kind = stream.schema[run].dataType.simpleString()
    rows = line_fields(stream.select(run, F.col(seq).cast("long").alias("seq"), F.col(line).alias("_line")), "_line")
    rows = rows.select(run, "seq", F.to_json(F.struct(*LOG_FIELDS), {"ignoreNullFields": "true"}).alias("said"))
    return rows.groupBy(run).transformWithState(FollowedLog(run, idle_ms), f"{run} {kind}, {LOG_ROW}", "Update", "ProcessingTime" if idle_ms else "None")


# ---- the improvement cycle

TOTALS = "pattern {k}, total_uses long, success_count long, total_cost double, total_latency double, n_control long, s_control long, n_treatment long, s_treatment long"
BREAKERS = "pattern {k}, state string, fails int, oks int, opened double, opens int"
HISTORY = "id string, cycle long, rank int, source string, pattern {k}, action string, status string"


class ImprovementCycle:
    """One improvement cycle a batch of executions (event_id, pattern, success, cost_tokens, latency_ms, at, seq).

    Totals, breakers and history are stores under one folder. A batch adds to its patterns' totals, moves their breakers,
    and appends its cycle's proposals; each store takes a batch once, so one that comes again, after a failure between
    the stores too, changes nothing that was done and does what wasn't. A proposal for a pattern whose breaker is open
    when the cycle ends is blocked. A batch's events of one pattern are folded in one row.
    """

    def __init__(self, spark: SparkSession, path: str, kind: str = "long", autonomy: str = "full", protected: Sequence[str] = (), most: int = 10, canary: learning.Canary = learning.Canary(), breaker: learning.Breaker = learning.Breaker(), buckets: int = 16):
        self.autonomy, self.protected, self.most, self.canary, self.breaker = autonomy, protected, most, canary, breaker
        made = {"totals": (TOTALS, "pattern"), "breakers": (BREAKERS, "pattern"), "history": (HISTORY, "id")}
        for name, (schema, key) in made.items():
            try:
                store = KeyedStore(spark, f"{path}/{name}")
            except FileNotFoundError:
                store = KeyedStore.create(spark, f"{path}/{name}", schema.format(k=kind), key, buckets)
            setattr(self, name, store)

    def run(self, events: DataFrame, number: int, name: str = "cycle") -> None:
        """For foreachBatch."""
        arms = learning.arm_totals(events, "event_id", self.canary)
        old = self.totals.read()
        sums = [c for c in old.columns if c != "pattern"]
        added = arms.select("pattern", *(F.col(c).alias(f"_{c}") for c in sums)).join(old, "pattern", "left")
        self.totals.put(added.select("pattern", *(F.coalesce(c, F.lit(0)) + F.col(f"_{c}") for c in sums)).toDF("pattern", *sums), stream=name, batch=number)
        self.breakers.put(learning.breaker_from(events, self.breakers.read(), cfg=self.breaker), stream=name, batch=number)
        now = events.agg(F.max("at").alias("_now"))
        totals, states = self.totals.read(), self.breakers.read()
        found = learning.proposals(learning.judged(totals, "pattern"), learning.judged_arms(totals, self.canary), self.protected, self.most)
        cooled = F.col("_now") - F.col("opened") >= self.breaker.cooldown
        state = F.when((F.col("state") == "OPEN") & F.coalesce(cooled, F.lit(False)), "HALF_OPEN").otherwise(F.col("state"))
        known = found.join(states, "pattern", "left").crossJoin(F.broadcast(now))  # one row
        done = learning.apply_proposals(known, self.autonomy, F.coalesce(state, F.lit("CLOSED")))
        rows = done.withColumn("cycle", F.lit(number + 1).cast("long")).withColumn("id", F.concat_ws("/", F.lpad(F.lit(str(number + 1)), 9, "0"), F.lpad(F.col("rank").cast("string"), 6, "0")))
        self.history.put(rows, stream=name, batch=number)

    def start(self, stream: DataFrame, checkpoint: str, trigger: dict | None = None):
        return stream.writeStream.foreachBatch(self.run).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
