"""Streams with state, in any cut into batches and across restarts, against batch twins."""

import random
import time

import pytest
from pyspark.sql import functions as F

from loomline.operators import learning, memory
from loomline.sources import readers
from loomline.sources.store import KeyedStore
from loomline.streaming import stateful

EVENTS = "event_id long, pattern long, success boolean, cost_tokens double, latency_ms double, at double, seq long"


def executions(n=400, seed=2, patterns=4):
    r, rate = random.Random(seed), (0.3, 0.9, 0.6, 0.97)
    return [(i, p, r.random() < rate[p % 4], float(r.randint(1, 9)), float(r.randint(1, 9)), float(i * 7 + r.randint(0, 5)), i) for i in range(n) for p in [r.randrange(patterns)]]


def slices(spark, rows, schema, cuts, folder):
    """Appends one slice after another to a folder; yields after each."""
    for a, b in zip([0, *cuts], [*cuts, len(rows)]):
        spark.createDataFrame(rows[a:b], schema).repartition(2).write.mode("append").parquet(folder)
        yield


@pytest.mark.parametrize("cuts", [[], [100, 101, 333]])
def test_breaker_with_timers_in_any_cut(spark, tmp_path, cuts):
    """Also across restarts: each slice is a run of its own from the checkpoint."""
    rows, cfg = executions(), learning.Breaker(failures=3, successes=2, cooldown=60.0)
    folder, store = f"{tmp_path}/in", KeyedStore.create(spark, f"file://{tmp_path}/s", "pattern long, state string, consec_failures int, consec_successes int, opens int, moved_by string, moved_at double", "pattern", 2)
    for _ in slices(spark, rows, EVENTS, cuts, folder):
        stream = stateful.breaker_timers(spark.readStream.schema(EVENTS).parquet(folder), cfg=cfg)
        stateful.keyed_upserts(stream, store, "breaker", f"{tmp_path}/cp", order="moved_at").awaitTermination()
    now = int(max(r[5] for r in rows) * 1000) / 1000
    want = learning.cooled_down(learning.breaker_from(spark.createDataFrame(rows, EVENTS), None, cfg=cfg), F.lit(now), cfg).collect()
    got = {r.pattern: (r.state, r.consec_failures, r.consec_successes, r.opens) for r in store.read().collect()}
    assert got == {r.pattern: (r.state, r.fails, r.oks, r.opens) for r in want} and any(r.opens for r in want)


def test_time_alone_half_opens_a_breaker(spark, tmp_path):
    cfg, schema = learning.Breaker(failures=1, cooldown=60.0), "pattern string, at double, seq long, success boolean"
    folder, store = f"{tmp_path}/in", KeyedStore.create(spark, f"file://{tmp_path}/s", "pattern string, state string, opens int, moved_by string, moved_at double", "pattern", 2)
    seen = []
    for _ in slices(spark, [("a", 10.0, 1, False), ("b", 40.0, 2, True), ("b", 100.0, 3, True)], schema, [1, 2], folder):
        stateful.keyed_upserts(stateful.breaker_timers(spark.readStream.schema(schema).parquet(folder), cfg=cfg), store, "b", f"{tmp_path}/cp", order="moved_at").awaitTermination()
        seen.append({r.pattern: (r.state, r.moved_by, r.moved_at) for r in store.read().collect()}["a"])
    assert seen == [("OPEN", "event", 10.0), ("OPEN", "event", 10.0), ("HALF_OPEN", "timer", 70.0)]


TURNS = "session long, turn int, role string, text string"


def talk(n=6, turns=9):
    r = random.Random(4)
    words = ["the", "patient", "took", "Aspirin", "42", "days", "Before", "a", "stable", "dose", "was", "found", "Later", "guideline"]
    said = lambda: " ".join(r.choice(words) + r.choice(("", "", ".", "!", "?")) for _ in range(r.randint(0, 25)))
    return [(s, k, ("user", "assistant")[k % 2], r.choice((said(), said(), None, ""))) for k in range(turns) for s in range(n)]


@pytest.mark.parametrize("cuts", [[], [1, 10, 11, 30]])
def test_session_memory_in_any_cut(spark, tmp_path, cuts):
    rows, budgets = talk(), memory.Budgets(l1=30, l2=40)
    folder, store = f"{tmp_path}/in", KeyedStore.create(spark, f"file://{tmp_path}/s", f"session long, {stateful.SESSION_ROW}", "session", 2)
    for _ in slices(spark, rows, TURNS, cuts, folder):
        stateful.keyed_upserts(stateful.session_memory(spark.readStream.schema(TURNS).parquet(folder), budgets=budgets), store, "memory", f"{tmp_path}/cp").awaitTermination()
    df = spark.createDataFrame(rows, TURNS).withColumn("text", F.coalesce("text", F.lit("")))
    stats, l1, l2 = memory.segment_stats(df, budgets=budgets), memory.recent_text(df, budget=budgets.l1), memory.summaries(df, budgets=budgets)
    want = {r.session: (r.messages, r.l1_messages, r.l1_tokens, r.l1, r.l2 or "") for r in stats.join(l1, "session").join(l2, "session", "left").collect()}
    got = {r.session: (r.messages, r.l1_messages, r.l1_tokens, r.l1, r.l2) for r in store.read().collect()}
    assert got == want and any(x[4] for x in want.values())


def test_helpers_equal_the_columns(spark):
    r = random.Random(8)
    texts = ["", "One.", "  Two words. Three!  Four? ", "Patient 7 took Aspirin. patients x", "a.b c. Next Name. 12 dose"] + [" ".join(r.choice(("Dose", "dosage.", "Monday", "1", "x!", "y")) for _ in range(r.randint(1, 60))) for _ in range(30)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for budget in (5, 20):
        got = [x.k for x in df.select(memory.key_sentences(F.col("t"), budget).alias("k")).collect()]
        assert got == [stateful.key_sentences_of(t, budget) for t in texts]


def followed(stream, name, cp, enough):
    """The rows of a query that time keeps going, once there are enough."""
    with stateful.keyed_state(stream.sparkSession):
        q = stream.writeStream.format("memory").queryName(name).outputMode("update").option("checkpointLocation", cp).trigger(processingTime="300 milliseconds").start()
    return q, lambda: wait(stream.sparkSession, name, enough)


def wait(spark, name, enough):
    until = time.time() + 60
    while time.time() < until and not enough(spark.table(name).collect()):
        time.sleep(0.3)
    return spark.table(name).collect()


def test_forgotten_sessions(spark, tmp_path):
    folder = f"{tmp_path}/in"
    put = lambda turn: spark.createDataFrame([(1, turn, "user", "hello there")], TURNS).write.mode("append").parquet(folder)
    put(0)
    q, rows = followed(stateful.session_memory(spark.readStream.schema(TURNS).parquet(folder), ttl_ms=3000), "sessions", f"{tmp_path}/cp", lambda r: len(r) >= 1)
    try:
        assert [r.messages for r in rows()] == [1]
        time.sleep(6)
        put(1)
        assert [r.messages for r in wait(spark, "sessions", lambda r: len(r) >= 2)] == [1, 1]
    finally:
        q.stop()


LOG = [
    "Loading base model: small", "Loading weights:  40%", "Adding LoRA adapters", "trainable params: 1,200 || all params: 48,000 || trainable%: 2.50%", "Loading dataset", "Starting training: 320 examples", "--- Epoch 1/3 ---", "step 5/60 8% loss=2.5000",
    "step 10/60 16% loss=2.1000", "{'eval_loss': 2.3}", "noise", "--- Epoch 2/3 ---", "step 25/60 41% loss=1.7500", "Error in worker: lost", "Merging LoRA weights",
]


def test_followed_log_equals_batch(spark, tmp_path):
    rows = [(run, i, x) for i, x in enumerate(LOG) for run in ("a", "b") if run == "a" or i % 2]
    schema, folder, out = "run string, seq long, value string", f"{tmp_path}/in", f"{tmp_path}/out"
    for _ in slices(spark, rows, schema, [3, 4, 15], folder):
        with stateful.keyed_state(spark):
            stateful.followed_log(spark.readStream.schema(schema).parquet(folder)).writeStream.foreachBatch(lambda d, i: d.write.mode("append").parquet(out)).outputMode("update").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(out).select("run", "seq", *readers.LOG_FIELDS).collect()
    want = readers.log_fields(spark.createDataFrame(rows, schema)).select("run", "seq", *readers.LOG_FIELDS).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)
    end = {r.seq: r for r in want if r.run == "a"}[len(LOG) - 1]
    assert tuple(end)[2:] == ("saving", 2, 3, 25, 60, 41.0, 320, 40, 1200, 48000, 2.5, 2.5, 1.75, 2.3, "Error in worker: lost")


def test_silent_runs_give_idle_rows(spark, tmp_path):
    schema, folder = "run string, seq long, value string", f"{tmp_path}/in"
    spark.createDataFrame([("a", 0, "Loading dataset")], schema).write.parquet(folder)
    q, got = followed(stateful.followed_log(spark.readStream.schema(schema).parquet(folder), idle_ms=500), "idle_rows", f"{tmp_path}/cp", lambda r: sum(x.idle for x in r) >= 2)
    try:
        rows = got()
    finally:
        q.stop()
    assert sum(r.idle for r in rows) >= 2 and all(r.phase == "dataset" and r.seq == 0 for r in rows) and not rows[0].idle


def cycles(rows, cuts, breaker, canary):
    """The history by plain loops."""
    out = []
    for number, end in enumerate([*cuts, len(rows)]):
        seen = rows[:end]
        states = {}
        for e in sorted(seen, key=lambda e: (e[5], e[6])):
            states[e[1]] = __import__("loomline.streaming.jobs", fromlist=["x"]).next_state(states.get(e[1], ("CLOSED", 0, 0, 0.0, 0)), e[2], e[5], breaker)
        now = max(e[5] for e in seen)
        found = []
        for p in sorted({e[1] for e in seen}):
            mine = [e[2] for e in seen if e[1] == p]
            rate, sure = sum(mine) / len(mine), 1 / (1 + 2.718281828459045 ** (-0.15 * (len(mine) - 20)))
            action = "INVESTIGATE" if sure < 0.3 else "PROMOTE" if rate >= 0.85 and sure >= 0.6 else "KEEP" if rate >= 0.5 else "DEMOTE" if rate >= 0.2 else "REMOVE"
            if action in ("PROMOTE", "DEMOTE", "REMOVE"):
                found.append((p, action))
        for rank, (p, action) in enumerate(found[:10], 1):
            s = states[p]
            open_ = s[0] == "OPEN" and now - s[3] < breaker.cooldown
            out.append((number + 1, rank, "metrics", p, action, "blocked" if open_ else "applied"))
    return out


def test_cycles_with_a_repeated_batch(spark, tmp_path):
    rows, cuts = executions(600, seed=5), [150, 400]
    breaker, canary = learning.Breaker(failures=3, successes=2, cooldown=1e9), learning.Canary(min_samples=10**9)
    cycle = stateful.ImprovementCycle(spark, f"file://{tmp_path}/c", canary=canary, breaker=breaker, buckets=2)
    folder, parts = f"{tmp_path}/in", []
    for k, _ in enumerate(slices(spark, rows, EVENTS, cuts, folder)):
        cycle.start(spark.readStream.schema(EVENTS).parquet(folder), f"{tmp_path}/cp").awaitTermination()
        a, b = [0, *cuts, len(rows)][k : k + 2]
        parts.append(spark.createDataFrame(rows[a:b], EVENTS))
        before = [sorted(map(tuple, s.read().collect()), key=str) for s in (cycle.totals, cycle.breakers, cycle.history)]
        cycle.run(parts[-1], k)  # comes again
        assert before == [sorted(map(tuple, s.read().collect()), key=str) for s in (cycle.totals, cycle.breakers, cycle.history)]
    got = sorted((r.cycle, r["rank"], r.source, r.pattern, r.action, r.status) for r in cycle.history.read().collect())
    assert got == cycles(rows, cuts, breaker, canary) and {"blocked", "applied"} <= {x[-1] for x in got}


def test_a_cycle_that_failed_half_way_is_finished(spark, tmp_path, monkeypatch):
    rows = executions(200)
    whole, torn = (stateful.ImprovementCycle(spark, f"file://{tmp_path}/{n}", buckets=2) for n in ("whole", "torn"))
    events = spark.createDataFrame(rows, EVENTS)
    whole.run(events, 0)
    with monkeypatch.context() as m:
        m.setattr(torn.breakers, "put", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            torn.run(events, 0)
    torn.run(events, 0)
    for name in ("totals", "breakers", "history"):
        assert sorted(map(tuple, getattr(whole, name).read().collect()), key=str) == sorted(map(tuple, getattr(torn, name).read().collect()), key=str)


def test_arm_totals_give_the_canaries(spark):
    events = spark.createDataFrame(executions(900), EVENTS)
    cfg = learning.Canary(fraction=0.3)
    a, b = learning.canaries(events, "event_id", cfg), learning.judged_arms(learning.arm_totals(events, "event_id", cfg), cfg)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(a.columns).collect())) and a.count()


def test_running_metrics_are_upserted(spark, tmp_path):
    rows, folder = executions(120), f"{tmp_path}/in"
    store = KeyedStore.create(spark, f"file://{tmp_path}/s", "pattern long, total_uses long, success_count long, recommend string", "pattern", 2)
    for _ in slices(spark, rows, EVENTS, [50], folder):
        stateful.running_metrics(spark.readStream.schema(EVENTS).parquet(folder), store, "metrics", f"{tmp_path}/cp").awaitTermination()
    want = learning.metrics(spark.createDataFrame(rows, EVENTS)).select("pattern", "total_uses", "success_count", "recommend")
    assert sorted(map(tuple, store.read().collect())) == sorted(map(tuple, want.collect()))
