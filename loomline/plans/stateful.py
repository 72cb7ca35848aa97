"""Registered queries of what is written, kept and followed: shuffled files, keyed stores, streams with state. queries.py imports this module last."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.functions.scratch import scratch_path
from loomline.operators import curation, learning, memory, retrieval
from loomline.plans.queries import ORACLES, S_BRK, S_CAN, S_EV, S_MET, S_QA, S_TOK, _again, executions, pairs, query
from loomline.sources import readers, shuffled, sinks
from loomline.sources.store import KeyedStore
from loomline.streaming import stateful


@query("snk3_shuffled_files", f"""with {S_QA}, o as (select *, row_number() over (order by md5('42' || chr(31) || seq), seq) as n, count(*) over () as total from qa),
  s as (select *, case when n <= total - greatest(1, floor(total * 0.15)) then 'train' else 'val' end as split from o)
  select format, split, row_number() over (partition by format, split order by n) as position, question, answer from s, (values ('alpaca'), ('sharegpt')) as f(format)""")
def _(t):
    """Training files are written in the order of their shuffle, and read back with the places of their lines."""
    p = curation.split_train_val(pairs(t).select("seq", "question", "answer"), ["seq"])
    spark, path = p.sparkSession, _again(p, "shuffled", lambda d, at: sinks.write_training(d, at, ids=["seq"], rows_per_file=500))
    lines = {f: shuffled.read_in_order(spark, f"{path}/{f}", ["split"]).withColumn("format", F.lit(f)) for f in ("alpaca", "sharegpt")}
    a = lines["alpaca"].withColumn("j", F.from_json("value", "instruction string, output string")).select("format", "split", "position", F.col("j.instruction").alias("question"), F.col("j.output").alias("answer"))
    s = lines["sharegpt"].withColumn("j", F.from_json("value", "conversations array<struct<role string, content string>>")["conversations"])
    return a.unionByName(s.select("format", "split", "position", F.col("j")[0]["content"].alias("question"), F.col("j")[1]["content"].alias("answer")))


def both_ways(store: KeyedStore) -> DataFrame:
    """What a reader gets before and after a compaction."""
    merged = store.read().withColumn("read", F.lit("merged"))
    store.compact()
    return merged.unionByName(store.read().withColumn("read", F.lit("compacted")))


@query("snk6_log_store", f"""with {S_QA}, o as (select seq, question, answer, case when len(question) < 60 then false when len(answer) > len(question) then true end as approved from qa)
  select read, seq, question, answer, approved from o, (values ('merged'), ('compacted')) as r(read)""")
def _(t):
    """A log is kept by key; two reviews write only whom they approve or reject, the later one counts."""
    log = pairs(t).select("seq", "question", "answer", F.lit(None).cast("boolean").alias("approved"))
    store = KeyedStore.create(log.sparkSession, scratch_path(log.sparkSession, "log-store"), log.schema, "seq", buckets=8)
    store.put(log)
    store.patch(log.where(F.length("answer") > F.length("question")).select("seq", F.lit(True).alias("approved")))
    store.patch(log.where(F.length("question") < 60).select("seq", F.lit(False).alias("approved")))
    return both_ways(store)


@query("snk8_library_store", """with l as (select o_custkey, max_by(o_orderkey, (o_orderdate, o_orderkey)) as o_orderkey, count(*) as n from orders group by o_custkey),
  c as (select c_custkey, c_name as name, case when c_acctbal < 0 then null else n end as n, o_orderkey as latest from customer left join l on c_custkey = o_custkey where not (c_acctbal > 5000 and o_custkey is null))
  select read, c_custkey as key, name, case when n is null then null else latest end as latest, n from c, (values ('merged'), ('compacted')) as r(read)""")
def _(t):
    """Entries come in, are set from orders, put anew, and deleted; then they are read as deltas and as a base."""
    customers, orders = t("customer"), t("orders")
    spark = customers.sparkSession
    store = KeyedStore.create(spark, scratch_path(spark, "library-store"), "key long, name string, latest long, n long", "key", buckets=8)
    key = F.col("c_custkey").cast("long").alias("key")
    store.put(customers.select(key, F.col("c_name").alias("name")))
    per = orders.groupBy(F.col("o_custkey").cast("long").alias("key")).agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).cast("long").alias("latest"), F.count("*").alias("n"))
    store.patch(per)
    store.compact()
    store.put(customers.where("c_acctbal < 0").select(key, F.col("c_name").alias("name")))  # a new entry has no orders yet
    store.delete(customers.where("c_acctbal > 5000").select(key).join(per, "key", "left_anti"))
    return both_ways(store)


@query("ret5_keyword_index", ORACLES["ret3_keyword_search"])
def _(t):
    """The keyword search from an index that is built, left, and opened again."""
    library = t("documents").select(F.col("doc_id").alias("seq"), F.col("source").alias("name"), F.col("lang").alias("title"), F.col("text").alias("body"))
    path = scratch_path(library.sparkSession, "keywords")
    retrieval.KeywordIndex.build(library, path)
    found = retrieval.KeywordIndex(library.sparkSession, path).search(t("benchmark").select("item_id", F.col("text").alias("question")), by="item_id")
    return found.select("item_id", F.col("seq").alias("doc_id"), "score", "rank")


# ---- streams with state: each slice of the table is a run of its own from the checkpoint

SLICES = 3


def in_slices(df: DataFrame, at: str, run) -> str:
    """Writes df to a folder in SLICES equal ranges of `at`, and lets run(stream of the folder, checkpoint) take each before the next one comes."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "slices")
    low, high = df.agg(F.min(at), F.max(at)).first()
    for k in range(SLICES):
        a, b = (low + (high - low) * x / SLICES for x in (k, k + 1))
        part = df.where((F.col(at) >= a) & ((F.col(at) < b) if k + 1 < SLICES else F.lit(True)))
        part.write.mode("append").parquet(path)
        run(spark.readStream.schema(df.schema).parquet(path), f"{path}-state").awaitTermination()
    return path


@query("str2_breaker_timers", f"""with recursive {S_BRK}, l as (select pattern, state, fails, oks, opened, opens from r join (select pattern as p, max(i) as n from o group by pattern) on p = pattern and n = i),
  n as (select floor(max(tm) * 1000) / 1000 as now from ev)
  select pattern, case when state = 'OPEN' and now - opened >= 100000 then 'HALF_OPEN' else state end as state, fails as consec_failures, case when state = 'OPEN' and now - opened >= 100000 then 0 else oks end as consec_successes, opens from l, n""")
def _(t):
    """Breakers on a stream whose timers end a cool-down without an event; three runs from one checkpoint."""
    e = executions(t).select("pattern", "at", "seq", "success")
    cfg, spark = learning.Breaker(failures=2, cooldown=100_000), e.sparkSession
    store = KeyedStore.create(spark, scratch_path(spark, "breakers"), f"pattern {e.schema['pattern'].dataType.simpleString()}, {stateful.BREAKER_ROW}", "pattern", 8)
    in_slices(e, "at", lambda stream, cp: stateful.keyed_upserts(stateful.breaker_timers(stream, cfg=cfg), store, "breakers", cp, order="moved_at"))
    return store.read().select("pattern", "state", "consec_failures", "consec_successes", "opens")


@query("str3_upserted_metrics", f"with {S_MET} select pattern, total_uses, success_count, round(sr, 4) as success_rate, recommend from mr")
def _(t):
    """Running metrics in update mode, upserted by key."""
    e = executions(t)
    spark = e.sparkSession
    store = KeyedStore.create(spark, scratch_path(spark, "metrics"), f"pattern {e.schema['pattern'].dataType.simpleString()}, total_uses long, success_count long, success_rate double, recommend string", "pattern", 8)
    in_slices(e, "at", lambda stream, cp: stateful.running_metrics(stream, store, "metrics", cp))
    return store.read()


@query("str7_live_sessions", f"""with k as (select conv_id, turn, role, text, {S_TOK('text')} as tokens from conversations), l as (select *, (turn = max(turn) over (partition by conv_id)
  or sum(tokens) over (partition by conv_id order by turn rows between current row and unbounded following) <= 120) as live from k)
  select conv_id, count(*) as messages, count(*) filter (live) as l1_messages, sum(tokens) filter (live)::bigint as l1_tokens, md5(string_agg(upper(role) || ': ' || text, chr(10) order by turn) filter (live)) as l1 from l group by conv_id""")
def _(t):
    """Sessions' memory on a stream, turn by turn; three runs from one checkpoint."""
    c = t("conversations").select("conv_id", "turn", "role", "text")
    spark = c.sparkSession
    store = KeyedStore.create(spark, scratch_path(spark, "sessions"), f"conv_id {c.schema['conv_id'].dataType.simpleString()}, {stateful.SESSION_ROW}", "conv_id", 8)
    in_slices(c, "turn", lambda stream, cp: stateful.keyed_upserts(stateful.session_memory(stream, "conv_id", budgets=memory.Budgets(l1=120, l2=200)), store, "sessions", cp))
    return store.read().select("conv_id", "messages", "l1_messages", "l1_tokens", F.md5("l1").alias("l1"))


def s_cycle(k: int) -> str:
    """The proposals of cycle k, from all executions up to its end."""
    edge = f"(select min(epoch(ts)::double) + (max(epoch(ts)::double) - min(epoch(ts)::double)) * {k} / {SLICES} from events)"
    own = lambda s: s.replace(S_EV, S_EV.replace("from events", f"from events where epoch(ts)::double < {edge}" if k < SLICES else "from events"))
    return f"""(with recursive {own(S_MET)}, {S_CAN.replace(S_EV + ', ', '')}, {S_BRK.replace(S_EV + ', ', '')}, b as (select pattern, state, opened from r join (select pattern as p, max(i) as n from o group by pattern) on p = pattern and n = i),
  u as (select 0 as k, 'metrics' as source, pattern, recommend as action from mr where recommend in ('PROMOTE', 'DEMOTE', 'REMOVE')
    union all select 1, 'canary', pattern, case recommendation when 'promote' then 'PROMOTE' else 'ROLLBACK' end from cr where recommendation <> 'inconclusive'),
  w as (select *, row_number() over (order by k, pattern) as rank from u)
  select {k}::bigint as cycle, rank::int as rank, source, pattern, action, case when state = 'OPEN' and (select max(tm) from ev) - opened < 100000 then 'blocked' else 'applied' end as status from w join b using (pattern) where rank <= 10)"""


@query("str5_cycles", " union all ".join(f"select * from {s_cycle(k)}" for k in range(1, SLICES + 1)))
def _(t):
    """Improvement cycles on a stream of executions: totals, canaries, breakers and history are kept; a cycle blocks what an open breaker forbids."""
    e = executions(t)
    spark = e.sparkSession
    cycle = stateful.ImprovementCycle(spark, scratch_path(spark, "cycles"), e.schema["pattern"].dataType.simpleString(), canary=learning.Canary(fraction=0.3), breaker=learning.Breaker(failures=2, cooldown=100_000), buckets=4)
    in_slices(e, "at", cycle.start)
    return cycle.history.read().select("cycle", "rank", "source", "pattern", "action", "status")


_LOG_SQL = ", ".join(f"{'first' if n in readers.LOG_FIRST else 'last'}_value({n} ignore nulls) over w as {n}" for n in ("phase", "epoch", "epochs", "step", "total_steps", "percent", "n_examples", "initial_loss", "loss", "eval_loss"))


@query("str13_log_fields", f"""with k as (select user_id as run, event_id as seq, event_id % 7 as k, (event_id % 9 + 1)::bigint as e, (event_id % 100)::bigint as p, round(value, 2) as v from events),
  x as (select run, seq, case k when 0 then 'dataset' when 1 then 'training' end as phase, case when k = 2 then e end as epoch, case when k = 2 then 9::bigint end as epochs, case when k = 3 then seq end as step, case when k = 3 then 100000000::bigint end as total_steps,
    case when k = 3 then p::double end as percent, case when k = 1 then p end as n_examples, case when k = 3 then v end as initial_loss, case when k = 3 then v end as loss, case when k = 4 then v end as eval_loss from k)
  select how, run, seq, {_LOG_SQL} from x, (values ('batch'), ('stream')) as h(how) window w as (partition by how, run order by seq rows between unbounded preceding and current row)""")
def _(t):
    """What training logs say of their runs up to each line, in a batch and on a stream."""
    e, k = t("events"), F.col("event_id") % 7
    seq, v = F.col("event_id").cast("string"), F.format_string("%.2f", F.round("value", 2))
    said = (
        F.when(k == 0, "Loading dataset").when(k == 1, F.concat(F.lit("Starting training: "), (F.col("event_id") % 100).cast("string"), F.lit(" examples"))).when(k == 2, F.concat(F.lit("--- Epoch "), (F.col("event_id") % 9 + 1).cast("string"), F.lit("/9 ---")))
        .when(k == 3, F.concat(F.lit("step "), seq, F.lit("/100000000 "), (F.col("event_id") % 100).cast("string"), F.lit("% loss="), v)).when(k == 4, F.concat(F.lit("eval_loss="), v)).otherwise("...")
    )
    lines = e.select(F.col("user_id").alias("run"), F.col("event_id").cast("long").alias("seq"), said.alias("value"))
    spark, out = lines.sparkSession, scratch_path(lines.sparkSession, "log-rows")

    def start(stream: DataFrame, cp: str):
        with stateful.keyed_state(spark):
            return stateful.followed_log(stream).writeStream.outputMode("update").foreachBatch(lambda d, i: d.write.mode("overwrite").parquet(f"{out}/{i:09d}")).option("checkpointLocation", cp).trigger(availableNow=True).start()

    in_slices(lines, "seq", start)
    streamed = spark.read.option("recursiveFileLookup", True).parquet(out)
    names = ["run", "seq", *(n for n in readers.LOG_FIELDS if f" as {n}" in _LOG_SQL)]
    return readers.log_fields(lines).select(F.lit("batch").alias("how"), *names).unionByName(streamed.select(F.lit("stream").alias("how"), *names))
