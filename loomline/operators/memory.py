"""Conversation memory: log, statistics, mining, relevance, promotion between tiers, segmented context."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.functions.scratch import written
from loomline.functions.text import n_words, sentences, strip, token_estimate, tokens
from loomline.operators.curation import has_code, has_list

RECORD = "id string, timestamp string, session_id string, question string, answer string, approved boolean, model_name string, kb_context_used boolean"

# Fixed values.
RELEVANCE_WEIGHTS = {"frequency": 0.30, "complexity": 0.25, "effectiveness": 0.25, "feedback": 0.20}
CLINICAL_WORDS = ("hypertension", "aspirin", "contraindication", "dosage", "dose", "monitoring", "diagnosis", "guideline", "adverse", "interaction", "blood pressure", "therapy", "treatment", "prescrib", "patient")
CLINICAL = rf"(?iU)\b({'|'.join(CLINICAL_WORDS)})\b"


@dataclass(frozen=True)
class Promotion:
    short_capacity: int = 500
    mid_capacity: int = 10_000
    threshold: float = 0.60
    archive: float = 0.85
    min_age: float = 3600.0


@dataclass(frozen=True)
class Budgets:
    rom: int = 5_000
    kernel: int = 2_000
    l1: int = 10_000
    l2: int = 3_000


def new_records(df: DataFrame) -> DataFrame:
    """Records for the log from question, answer, session_id, model_name, kb_context_used: stripped, with id and time, not yet approved."""
    return df.select(
        F.replace(F.expr("uuid()"), F.lit("-"), F.lit("")).alias("id"), F.concat(F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z")).alias("timestamp"), "session_id",
        strip("question").alias("question"), strip("answer").alias("answer"), F.lit(None).cast("boolean").alias("approved"), "model_name", "kb_context_used",
    )


def interactions(log: DataFrame, approved_only: bool = False, session_id: str | None = None, limit: int | None = None, seq: str = "seq") -> DataFrame:
    """Records newest first; a limit of 0 is none."""
    out = log.where(F.col("approved").eqNullSafe(True)) if approved_only else log
    out = out.where(F.col("session_id") == session_id) if session_id else out
    out = out.orderBy(F.desc(seq))
    return out.limit(limit) if limit else out


def usable(log: DataFrame) -> DataFrame:
    """Approved records with a question and an answer: what training takes from the log."""
    return log.where(F.col("approved").eqNullSafe(True) & (F.trim("question") != "") & (F.trim("answer") != ""))


def pick_list(log: DataFrame, limit: int = 100, seq: str = "seq") -> DataFrame:
    """(label): the newest records, as id | status time question's start."""
    status = F.when(F.col("approved"), "approved").when(~F.col("approved"), "rejected").otherwise("pending")
    return interactions(log, limit=limit, seq=seq).select(F.format_string("%s | %s %s %s", F.col("id"), status, F.col("timestamp"), F.substring("question", 1, 60)).alias("label"))


def by_id(log: DataFrame, record: str) -> DataFrame:
    return log.where(F.col("id") == record)


def set_approval(log: DataFrame, updates: DataFrame, seq: str = "seq") -> DataFrame:
    """log with `approved` from updates (id, approved), in the first record of each id."""
    first = F.row_number().over(Window.partitionBy("id").orderBy(seq)) == 1
    new = updates.groupBy("id").agg(F.last("approved").alias("_new"))
    out = log.withColumn("_first", first).join(new, "id", "left")
    return out.withColumn("approved", F.when(F.col("_first"), F.coalesce("_new", "approved")).otherwise(F.col("approved"))).select(*log.columns)


def status_counts(log: DataFrame) -> DataFrame:
    yes, no = (F.count_if(F.col("approved").eqNullSafe(v)) for v in (True, False))
    return log.agg(F.count("*").alias("total"), yes.alias("approved"), no.alias("rejected"), F.count_if(F.col("approved").isNull()).alias("pending"))


def question_key(c: Column | str) -> Column:
    return strip(F.regexp_replace(F.lower(c), r"(?U)[^\w\s]", ""))


def frequent_questions(log: DataFrame, min_count: int = 2, approved_only: bool = False, seq: str = "seq") -> DataFrame:
    """(question, n, answer): question groups asked often enough with their latest wording and answer; by count, then by the group seen last."""
    d = log.where(F.col("approved").eqNullSafe(True)) if approved_only else log
    latest = F.max_by(F.struct("question", "answer"), F.struct("timestamp", seq))
    out = d.groupBy(question_key("question").alias("key")).agg(F.count("*").alias("n"), latest.alias("l"), F.max(seq).alias("last_seq")).where(F.col("n") >= min_count)
    return out.select("key", "l.question", "n", "l.answer", "last_seq").orderBy(F.desc("n"), F.desc("last_seq"))


# ---- relevance


def complexity(a: Column) -> Column:
    base = F.least(F.log1p(n_words(a)) / F.log1p(F.lit(200)), F.lit(1.0))
    return F.least(base + F.when(has_code(a), 0.15).otherwise(0.0) + F.when(has_list(a), 0.10).otherwise(0.0), F.lit(1.0))


def effectiveness(approved: Column, kb: Column) -> Column:
    base = F.lit(0.3) + F.when(kb, 0.3).otherwise(0.0)
    return F.least(F.when(approved.eqNullSafe(True), base + 0.4).when(approved.eqNullSafe(False), F.greatest(F.lit(0.0), base - 0.3)).otherwise(base), F.lit(1.0))


def feedback(approved: Column) -> Column:
    return F.when(approved.eqNullSafe(True), 1.0).when(approved.eqNullSafe(False), 0.0).otherwise(0.3)


ENOUGH = 0.5  # a similarity from here on gives the full frequency score


TARGETS, POOL = 4096, 32768  # sets of a block


def best_overlap(targets: DataFrame, pool: DataFrame, earlier: bool, seq: str = "seq") -> DataFrame:
    """(seq, jaccard): each target's highest Jaccard similarity of question words with another record of the pool; from ENOUGH on, some value of at least that.

    Records with the same words are one set, of which the earliest record and the earliest of another id decide whether
    a target may meet it. Equal sets come first. The rest meet by their rarest words: sets of similarity ENOUGH share
    one of the rarest half, so that frequent words pair nothing. Only targets that find nothing so similar meet all sets
    with a word in common, block by block: no pair of them is a row. What several steps read is written once to the
    shared folder, the result too.
    """
    def sets(d: DataFrame) -> DataFrame:
        w = F.array_sort(F.array_distinct(tokens("question", "[a-z]{3,}")))
        return d.select(F.col(seq).alias("s"), F.coalesce("id", F.lit("")).alias("i"), w.alias("w")).where(F.size("w") > 0).withColumn("k", F.md5(F.array_join("w", " ")))

    records = written(sets(pool), "questions")
    a = (records if targets is pool else written(sets(targets), "questions")).withColumnsRenamed({"s": "aseq", "i": "aid", "w": "aw"})
    first = records.groupBy("k").agg(F.min(F.struct("s", "i")).alias("one"), F.first("w").alias("bw"))
    other = records.join(first.select("k", F.col("one.i").alias("oi")), "k").where("i <> oi").groupBy("k").agg(F.min(F.struct("s", "i")).alias("two"))
    b = written(first.join(other, "k", "left"), "questions")
    may = lambda x: (F.col(f"{x}.i") != F.col("aid")) & ((F.col(f"{x}.s") < F.col("aseq")) if earlier else F.lit(True))
    fits = may("one") | F.coalesce(may("two"), F.lit(False))

    equal = a.join(b, "k").where(fits).select("aseq", F.lit(1.0).alias("j"))
    left = a.join(equal.select("aseq"), "aseq", "left_anti").drop("k")
    often = written(b.select(F.explode("bw").alias("word")).groupBy("word").agg(F.count("*").alias("f")).withColumn("n", F.monotonically_increasing_id()), "words")  # a table of its own: Spark then splits a frequent word's join

    def numbered(df: DataFrame, words: str, *keys: str) -> DataFrame:
        """df's keys with the numbers of its words, the rarest first; -1 for words the pool hasn't."""
        e = df.select(*keys, F.explode(words).alias("word")).join(often, "word", "left")
        per = e.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.coalesce("f", F.lit(0)).alias("f"), F.coalesce("n", F.lit(-1)).alias("n")))).alias("o"))  # a question's words
        return per.select(*keys, F.transform("o", lambda x: x["n"]).alias(words))

    def rarest(words: str) -> Column:
        """Each of the rarest words of which sets at ENOUGH share one, with its place."""
        n = F.size(words)
        return F.posexplode(F.slice(words, 1, n - F.ceil(n * ENOUGH).cast("int") + 1)).alias(f"{words}_at", "word")

    ours, theirs = written(numbered(left, "aw", "aseq", "aid"), "sets"), written(numbered(b, "bw", "k").join(b.drop("bw"), "k"), "sets")
    shared = F.size(F.array_intersect("aw", "bw"))
    rest = F.least(F.size("aw") - F.col("aw_at"), F.size("bw") - F.col("bw_at"))  # where the word is the first that both have, no more are shared
    met = ours.select("*", rarest("aw")).join(theirs.select("*", rarest("bw")), "word").where(rest * (1 + ENOUGH) >= (F.size("aw") + F.size("bw")) * ENOUGH)
    near = met.where(fits).select("aseq", (shared / (F.size("aw") + F.size("bw") - shared)).alias("j")).where(F.col("j") >= ENOUGH)
    near = written(near.groupBy("aseq").agg(F.max("j").alias("j")), "near")
    far = _far(ours.join(near.select("aseq"), "aseq", "left_anti"), theirs, earlier, ours.count() - near.count(), theirs.count())
    return written(equal.union(near).union(far).groupBy(F.col("aseq").alias(seq)).agg(F.max("j").alias("jaccard")), "overlaps")


def _set_blocks(d: DataFrame, n: int, rows: int, prefix: str) -> DataFrame:
    """The n rows (s, i, t, w) in ranges of s, packed by `rows` at most: arrays s, i, t, and w one after another with their sizes n; names with the prefix."""
    s, i = (d.schema[c].dataType.simpleString() for c in "si")

    def pack(batches):
        import pyarrow as pa

        held = []

        def block():
            x = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held.clear()
            whole = lambda v: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v)
            w = x.column("w")
            return pa.RecordBatch.from_arrays([*(whole(x.column(c)) for c in "sit"), whole(w.value_lengths()), whole(w.flatten())], names=[f"{prefix}{c}" for c in "sitnw"])

        for batch in batches:
            while batch.num_rows:
                more = rows - sum(h.num_rows for h in held)
                held.append(batch.slice(0, more))
                batch = batch.slice(more)
                if sum(h.num_rows for h in held) == rows:
                    yield block()
        if held:
            yield block()

    dealt = d.select("s", "i", "t", "w").repartitionByRange(1 + 4 * n // (3 * rows), "s").sortWithinPartitions("s")  # a range is a block: they are drawn from a sample, so there is room
    return written(dealt.mapInArrow(pack, f"{prefix}s array<{s}>, {prefix}i array<{i}>, {prefix}t array<{s}>, {prefix}n array<int>, {prefix}w array<bigint>"), "blocks")


def _far(ours: DataFrame, theirs: DataFrame, earlier: bool, n_ours: int, n_theirs: int) -> DataFrame:
    """(aseq, j): the highest similarity of each of our sets with those of theirs that fit, by counts of shared words over the postings of a block.

    Blocks of theirs meet blocks of ours by pairs of partitions; a task holds one pair of blocks at a time, and hands out one
    row for each of our sets. Counting takes time with the pairs that share a word, which is the job itself.
    """
    held = _set_blocks(theirs.select(F.col("one.s").alias("s"), F.col("one.i").alias("i"), F.col("two.s").alias("t"), F.col("bw").alias("w")), n_theirs, POOL, "b_")
    asked = _set_blocks(ours.select(F.col("aseq").alias("s"), F.col("aid").alias("i"), F.lit(None).cast(ours.schema["aseq"].dataType).alias("t"), F.col("aw").alias("w")), n_ours, TARGETS, "a_")
    may = (F.array_min("b_s") < F.array_max("a_s")) if earlier else F.lit(True)
    pairs = held.hint("shuffle_replicate_nl").join(asked.drop("a_t"), may)

    def meet(batches):
        import pyarrow as pa

        for batch in batches:
            for n in range(batch.num_rows):
                x = {c: batch.column(c)[n].values for c in batch.schema.names}
                at, j = _most_shared(x, earlier)
                yield pa.RecordBatch.from_arrays([x["a_s"].take(pa.array(at)), pa.array(j)], names=["aseq", "j"])

    found = pairs.mapInArrow(meet, f"aseq {ours.schema['aseq'].dataType.simpleString()}, j double")
    return found.groupBy("aseq").agg(F.max("j").alias("j"))


def _most_shared(x: dict, earlier: bool):
    """Of a pair of blocks: places in ours and their highest similarity, where that is above 0."""
    import numpy as np

    array = lambda c: x[c].to_numpy(zero_copy_only=False)
    size, ours = array("b_n").astype(np.int64), array("a_n").astype(np.int64)
    known, words = np.unique(array("b_w"), return_inverse=True)
    order = np.argsort(words, kind="stable")
    posted, ends = np.repeat(np.arange(len(size)), size)[order], np.searchsorted(words[order], np.arange(len(known) + 1))
    asked = array("a_w")
    place = np.searchsorted(known, asked)
    found = np.append(known, -2)[place] == asked
    starts = np.concatenate([[0], np.cumsum(ours)])
    one, two, a_s = (array(c) for c in ("b_s", "b_t", "a_s"))
    alone = np.array(x["b_t"].is_null())
    upto = np.searchsorted(one, a_s, "left") if earlier else np.full(len(ours), len(size))  # a block is in order
    own: dict = {}
    for p, i in enumerate(x["b_i"].to_pylist()):
        own.setdefault(i, []).append(p)
    at, best = [], []
    for n, i in enumerate(x["a_i"].to_pylist()):
        m = upto[n]
        mine = place[starts[n] : starts[n + 1]][found[starts[n] : starts[n + 1]]]
        if not m or not len(mine):
            continue
        c = np.bincount(np.concatenate([posted[ends[w] : ends[w + 1]] for w in mine]), minlength=len(size))[:m]
        for p in own.get(i, ()):  # a set whose first record has this id counts by its first of another
            if p < m and (alone[p] or earlier and not two[p] < a_s[n]):
                c[p] = 0
        j = (c / (ours[n] + size[:m] - c)).max()
        if j > 0:
            at.append(n)
            best.append(j)
    return np.array(at, np.int64), np.array(best, np.float64)


def relevance(records: DataFrame, pool: DataFrame | None = None, seq: str = "seq") -> DataFrame:
    """records with the four scores and `relevance`. Without a pool each record meets the ones before it."""
    best = best_overlap(records, records if pool is None else pool, pool is None, seq)
    a = F.coalesce("answer", F.lit(""))
    detail = {
        "frequency": F.round(F.least(F.coalesce("jaccard", F.lit(0.0)) * 2, F.lit(1.0)), 4), "complexity": F.round(complexity(a), 4),
        "effectiveness": F.round(effectiveness(F.col("approved"), F.col("kb_context_used")), 4), "feedback": F.round(feedback(F.col("approved")), 4),
    }
    out = records.join(best, seq, "left").withColumns(detail).drop("jaccard")
    total = sum((F.col(k) * w for k, w in RELEVANCE_WEIGHTS.items()), F.lit(0.0))
    return out.withColumn("relevance", F.round(total, 4))


def evict(pool: DataFrame, capacity: int, by: Sequence[str], key: str = "seq") -> DataFrame:
    """pool with `evicted`: all but the `capacity` rows that come last by the columns `by`, found by a top-k."""
    kept = pool.orderBy(*(F.desc(c) for c in by)).limit(capacity).select(F.col(key).alias("_kept"))
    return pool.join(kept, F.col(key) == F.col("_kept"), "left").withColumn("evicted", F.col("_kept").isNull()).drop("_kept")


def promote(short: DataFrame, mid: DataFrame, now: Column, cfg: Promotion = Promotion(), seq: str = "seq") -> DataFrame:
    """All records with their new `tier`. Old and relevant short-term records move to mid-term and are scored anew against
    it as it was; the oldest beyond its capacity, and the very relevant, go long-term. Both inputs: scored, with ingested_at (epoch seconds)."""
    moving = (now - F.col("ingested_at") >= cfg.min_age) & (F.col("relevance") >= cfg.threshold)
    up = short.where(moving)
    scored = relevance(up.drop("frequency", "complexity", "effectiveness", "feedback", "relevance"), mid, seq)
    columns = short.columns
    both = evict(mid.select(*columns).unionByName(scored.select(*columns)), cfg.mid_capacity, ["ingested_at", seq], seq)
    tier = F.when(F.col("evicted") | (F.col("relevance") >= cfg.archive), "long_term").otherwise("mid_term")
    return short.where(~moving).withColumn("tier", F.lit("short_term")).unionByName(both.withColumn("tier", tier).drop("evicted"))


def tier_stats(records: DataFrame, cfg: Promotion = Promotion()) -> DataFrame:
    spark = records.sparkSession
    tiers = spark.createDataFrame([("short_term", cfg.short_capacity), ("mid_term", cfg.mid_capacity), ("long_term", None)], "tier string, capacity long")
    got = records.groupBy("tier").agg(F.count("*").alias("n"), F.round(F.avg("relevance"), 4).alias("avg_relevance"))
    return tiers.join(got, "tier", "left").fillna({"n": 0, "avg_relevance": 0.0})


def search_long_term(records: DataFrame, query: str, k: int = 5, seq: str = "seq") -> DataFrame:
    """The k most relevant records that hold any of the query's words, also inside words; without words, of all."""
    import re

    words = sorted(set(re.findall("[a-z]{3,}", query.lower())))
    if words:
        text = F.lower(F.concat_ws(" ", "question", "answer"))
        hit = F.lit(False)
        for w in words:
            hit = hit | text.contains(w)
        records = records.where(hit)
    return records.orderBy(F.desc("relevance"), F.asc(seq)).limit(k)


# ---- segmented context


def live_turns(turns: DataFrame, session: str = "session", order: str = "turn", text: str = "text", budget: int = 10_000) -> DataFrame:
    """turns with tokens, `in_l1` (whether it is still in the recent segment after the session's last turn) and `evicted_by`, the turn that pushed it out.

    First in first out under a budget has a closed form: a turn stays while the tokens from it on fit; the newest always stays.
    """
    d = turns.withColumn("tokens", token_estimate(text))
    upto = Window.partitionBy(session).orderBy(order)
    d = d.withColumn("_cum", F.sum("tokens").over(upto))
    d = d.withColumn("_total", F.max("_cum").over(Window.partitionBy(session))).withColumn("_last", F.max(order).over(Window.partitionBy(session)))
    return d.withColumn("in_l1", (F.col(order) == F.col("_last")) | (F.col("_total") - F.col("_cum") + F.col("tokens") <= budget)).drop("_cum", "_total", "_last")


def key_sentences(text: Column, budget: int) -> Column:
    """The sentences of highest priority that fit the budget, in their order."""
    def priority(s: Column) -> Column:
        return F.regexp_count(s, F.lit(CLINICAL)) * 3 + F.regexp_count(s, F.lit(r"(?U)\b\d+\b")) + F.regexp_count(s, F.lit(r"(?U)\b[A-Z][a-z]{3,}\b"))

    rows = F.transform(sentences(strip(text)), lambda s, i: F.struct((-priority(s)).alias("p"), i.alias("i"), token_estimate(s).alias("t"), s.alias("s")))
    start = F.struct(F.lit(0).alias("used"), F.array().cast("array<struct<i:int,s:string>>").alias("got"))

    def step(a: Column, x: Column) -> Column:
        fits = (a["used"] < budget) & (a["used"] + x["t"] <= budget)
        return F.struct(F.when(fits, a["used"] + x["t"]).otherwise(a["used"]).alias("used"), F.when(fits, F.concat(a["got"], F.array(F.struct(x["i"].alias("i"), x["s"].alias("s"))))).otherwise(a["got"]).alias("got"))

    return F.aggregate(F.array_sort(rows), start, step, lambda a: F.array_join(F.transform(F.array_sort(a["got"]), lambda x: x["s"]), " "))


def summaries(turns: DataFrame, session: str = "session", order: str = "turn", text: str = "text", budgets: Budgets = Budgets()) -> DataFrame:
    """(session, l2): key sentences of evicted turns, oldest trimmed to the budget. One fold a session over its evicted turns' summaries."""
    gone = live_turns(turns, session, order, text, budgets.l1).where("not in_l1")
    made = gone.withColumn("_s", key_sentences(F.col(text), max(budgets.l2 // 4, 50)))
    parts = made.groupBy(session).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("_s").alias("s")))), lambda x: x["s"]).alias("parts"))

    def trimmed(combined: Column) -> Column:
        start = F.struct(F.lit(0).alias("used"), F.lit(False).alias("done"), F.array().cast("array<string>").alias("kept"))

        def step(a: Column, s: Column) -> Column:
            t = token_estimate(s)
            stop = a["done"] | (a["used"] + t > budgets.l2)
            return F.struct(F.when(stop, a["used"]).otherwise(a["used"] + t).alias("used"), stop.alias("done"), F.when(stop, a["kept"]).otherwise(F.concat(F.array(s), a["kept"])).alias("kept"))

        return F.aggregate(F.reverse(sentences(combined)), start, step, lambda a: F.array_join(a["kept"], " "))

    def fold(l2: Column, s: Column) -> Column:
        combined = strip(F.concat_ws(" ", l2, s))
        return F.when(s == "", l2).when(token_estimate(combined) > budgets.l2, trimmed(combined)).otherwise(combined)

    return parts.select(session, F.aggregate("parts", F.lit(""), fold).alias("l2"))


def rom(text: Column, budget: int = 5_000) -> Column:
    from loomline.functions.text import words

    return F.when(token_estimate(text) > budget, F.array_join(F.slice(words(text), 1, int(budget / 1.3)), " ")).otherwise(text)


def kernel(pairs: Column, budget: int = 2_000) -> Column:
    """key: value lines of an array of (key, value); values that don't fit are left out where all together don't."""
    def text(p: Column) -> Column:
        return F.array_join(F.transform(p, lambda x: F.concat_ws(": ", x["key"], x["value"])), "\n")

    start = F.struct(F.lit(0).alias("used"), F.array().cast("array<struct<key:string,value:string>>").alias("kept"))

    def step(a: Column, x: Column) -> Column:
        t = token_estimate(x["value"])
        fits = a["used"] + t <= budget
        return F.struct(F.when(fits, a["used"] + t).otherwise(a["used"]).alias("used"), F.when(fits, F.concat(a["kept"], F.array(F.struct(x["key"].alias("key"), x["value"].alias("value"))))).otherwise(a["kept"]).alias("kept"))

    return F.when(token_estimate(text(pairs)) > budget, F.aggregate(pairs, start, step, lambda a: text(a["kept"]))).otherwise(text(pairs))


def rendered(rom_text: Column, kernel_text: Column, l2: Column, l1: Column) -> Column:
    parts = F.array(rom_text, F.when(kernel_text != "", F.concat(F.lit("[Session context]\n"), kernel_text)), F.when(l2 != "", F.concat(F.lit("[Summary of earlier conversation]\n"), l2)), l1)
    return F.array_join(F.filter(parts, lambda x: x.isNotNull() & (x != "")), "\n\n")


def recent_text(turns: DataFrame, session: str = "session", order: str = "turn", text: str = "text", budget: int = 10_000) -> DataFrame:
    """(session, l1): ROLE: content lines of the live turns."""
    live = live_turns(turns, session, order, text, budget).where("in_l1")
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.concat_ws(": ", F.upper("role"), F.col(text)).alias("s"))))
    return live.groupBy(session).agg(F.array_join(F.transform(rows, lambda x: x["s"]), "\n").alias("l1"))


def last_messages(turns: DataFrame, n: int = 6, session: str = "session", order: str = "turn") -> DataFrame:
    return turns.withColumn("_n", F.row_number().over(Window.partitionBy(session).orderBy(F.desc(order)))).where(F.col("_n") <= n).drop("_n")


def segment_stats(turns: DataFrame, session: str = "session", order: str = "turn", text: str = "text", budgets: Budgets = Budgets()) -> DataFrame:
    """(session, messages, l1_messages, l1_tokens, l1_share): what the live segment of each session holds, and how full it is."""
    d = live_turns(turns, session, order, text, budgets.l1)
    used = F.sum(F.when(F.col("in_l1"), F.col("tokens")).otherwise(0))
    return d.groupBy(session).agg(F.count("*").alias("messages"), F.count_if("in_l1").alias("l1_messages"), used.alias("l1_tokens"), F.round(used / budgets.l1, 4).alias("l1_share"))


def messages(turns: DataFrame, session: str = "session", order: str = "turn", text: str = "text", budget: int = 10_000) -> DataFrame:
    """(session, messages): the live turns as role and content, in order."""
    live = live_turns(turns, session, order, text, budget).where("in_l1")
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), "role", F.col(text).alias("content"))))  # a session's
    return live.groupBy(session).agg(F.transform(rows, lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))


def cleared(turns: DataFrame, sessions: DataFrame, session: str = "session") -> DataFrame:
    """turns without those of the given sessions, whose conversation starts again; fixed text and kernel aren't kept with turns and stay."""
    return turns.join(sessions.select(session).distinct(), session, "left_anti")
