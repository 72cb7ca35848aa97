"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions only.

Each source's documents are shuffled by a hash of their key and queue up to MOST_REPEATS times, the whole source once
more each time. A turn's virtual finish time is the source's running word count up to its end over the source's
target. All turns of all sources are put in order of that time and truncated at the total budget: the order and the
budget alone decide. By default a turn queues in packets of QUANTUM words, the last one taken gives what the budget has
left, and so a source's words stray from its target by a packet a source at most. With whole_documents a
turn is one packet, taken if its middle lies before its source's target and the budget has room for all of it.

Running counts are prefix sums over hash buckets of about BUCKET_ROWS rows (then over virtual-time ranges), and over
SPAN buckets at a time, so that a source with a third of all rows never meets in one task; only sums do.

Defined results: null text has size 0 and is taken 0 times; very long texts are documents like others; rows without a
key are dealt by a hash of text and source; a null source is a source of its own, ordered last;
an empty table gives no rows; repeated rows are rows of their own; columns beside key, text and source are ignored.
Targets: sources by code point weigh 1, 2, 3, repeating; a target stops at 3 times its source's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.llm.textops import cut, quoted
from loomline.sources.readers import read_table

WORD = r"[^\x20\x09-\x0D]+"
MOST_REPEATS, QUANTUM, BUCKET_ROWS, SPAN, SEED = 3, 128, 4_000, 4_096, 17
WEIGHTS = (1, 2, 3)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, most: int = MOST_REPEATS, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target) from (source, size). Sources are few; one narrow window ranks them."""
    rank = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("n") - 1, F.lit(len(weights))) + 1).cast("int")).cast("double")
    t = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("n", F.row_number().over(rank)).withColumn("w", weight)
    t = t.withColumn("most", (F.col("source_size") * most).cast("double"))
    order = Window.orderBy(F.col("most") / F.col("w"), "n")
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    level = (F.sum(F.col("source_size").cast("double")).over(everything) - before) / F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    t = t.withColumn("level", level)
    met = F.when(F.col("level") * F.col("w") <= F.col("most"), F.col("level"))
    t = t.withColumn("level", F.first(met, ignorenulls=True).over(everything))
    return t.select("source", "source_size", F.least("most", F.col("level") * F.col("w")).alias("target"))


def prefix(df: DataFrame, part: list[str], bucket: str, order: list[Column], value: str) -> DataFrame:
    """df with `before`, the sum of `value` over the rows ahead in (bucket, order) within `part`, and row_number `rn` in its bucket."""
    def same(names: list[str]) -> Column:
        on = F.lit(True)
        for k in names:
            on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
        return on

    keys, before = [*part, bucket], (Window.unboundedPreceding, -1)
    sums = df.groupBy(*keys).agg(F.sum(value).alias("_sum")).withColumn("span", F.floor(F.col(bucket) / SPAN))
    spans = sums.groupBy(*part, "span").agg(F.sum("_sum").alias("_sum"))
    far = F.coalesce(F.sum("_sum").over(Window.partitionBy(*part).orderBy("span").rowsBetween(*before)), F.lit(0))
    spans = spans.select(*(F.col(k).alias(f"_{k}") for k in (*part, "span")), far.alias("_far"))
    near = F.coalesce(F.sum("_sum").over(Window.partitionBy(*part, "span").orderBy(bucket).rowsBetween(*before)), F.lit(0))
    sums = sums.withColumn("_near", near).join(spans, same([*part, "span"])).select(*(F.col(k).alias(f"_{k}") for k in keys), (F.col("_far") + F.col("_near")).alias("_ahead"))
    inside = Window.partitionBy(*keys).orderBy(*order)
    here = F.coalesce(F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return df.join(sums, same(keys)).withColumn("before", F.col("_ahead") + here).withColumn("rn", F.row_number().over(inside)).drop("_ahead", *(f"_{k}" for k in keys))


def _numbered(df: DataFrame) -> DataFrame:
    """Rows alike in every column told apart: they share k1 and k2 and differ in n."""
    return df.withColumn("n", F.row_number().over(Window.partitionBy("k1", "k2").orderBy("k1")))


def _keys(df: DataFrame) -> list[Column]:
    return [F.xxhash64(*map(quoted, df.columns)).alias("k1"), F.xxhash64(F.lit("b"), *map(quoted, df.columns)).alias("k2")]


def mix_counts(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED, whole_documents: bool = False, rows_apart: bool = False) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, copies) of each row; copies counts whole takes. rows_apart adds `id`, the row's (k1, k2, n)."""
    name = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("null:"), F.xxhash64(F.col(text), F.col(source))))  # rows without a key are dealt by what they hold
    docs = df.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), name.alias("name"), *(_keys(df) if rows_apart else []))
    if rows_apart:
        docs = _numbered(docs).withColumn("id", F.struct("k1", "k2", "n")).drop("k1", "k2", "n")
    docs = cut(docs)
    rows = docs.count()
    buckets = max(1, rows // BUCKET_ROWS)
    docs = docs.withColumn("h", F.md5(F.concat_ws(":", F.lit(str(seed)), "name"))).drop("name")
    share = F.conv(F.substring("h", 1, 8), 16, 10).cast("double") / 2.0**32
    docs = docs.withColumn("b", F.floor(share * buckets).cast("long"))
    docs = prefix(docs, ["source"], "b", [F.col("h"), F.col("doc_id"), F.col("size"), *[F.col("id")] * rows_apart], "size").withColumnRenamed("rn", "row").withColumnRenamed("before", "at")
    targets = source_targets(docs).select(F.col("source").alias("_source"), "source_size", "target")
    docs = docs.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")

    total = cut(targets.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("budget"), F.count("*").alias("sources")))
    turns = docs.crossJoin(F.broadcast(total)).withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(MOST_REPEATS - 1))))  # one row
    turns = turns.withColumn("start", F.col("at") + F.col("turn") * F.col("source_size"))
    if whole_documents:
        part = F.when(F.col("start") + F.col("size") / 2 <= F.col("target"), F.col("size")).otherwise(0)
        turns = turns.where("turn = 0 or start < target").withColumn("packet", F.lit(0))
    else:
        # the budget is the sum of the targets: what the sources leave of theirs is less than a packet each, and a source's
        # own packets from its target to this bound would use it up before a later one
        first = F.sequence(F.lit(0), F.greatest(F.ceil(F.col("size") / QUANTUM) - 1, F.lit(0)).cast("int"))
        turns = turns.withColumn("packet", F.explode(first)).withColumn("start", F.col("start") + F.col("packet") * QUANTUM)
        part = F.least(F.col("size") - F.col("packet") * QUANTUM, F.lit(QUANTUM))
        turns = turns.where(f"turn = 0 or start < target + sources * {QUANTUM}")
    turns = turns.withColumn("part", part.cast("long")).withColumn("finish", F.coalesce((F.col("start") + F.col("part")) / F.when(F.col("target") > 0, F.col("target")), share))  # texts without words have no say in the order: they are spread over it
    turns = turns.withColumn("range", F.floor(F.col("finish") * buckets).cast("long"))
    turns = prefix(turns, [], "range", [F.col("finish"), F.col("h"), F.col("doc_id"), F.col("turn"), F.col("row"), F.col("packet")], "part")
    if whole_documents:
        taken = F.when(F.col("before") + F.col("part") <= F.col("budget"), F.col("part")).otherwise(0)
    else:
        taken = F.greatest(F.lit(0), F.least("part", F.col("budget") - F.col("before")))
    turns = turns.withColumn("taken", taken.cast("long"))
    out = turns.groupBy("source", "b", "row").agg(
        F.first("doc_id").alias("doc_id"), F.first("size").alias("size"), F.first("source_size").alias("source_size"), F.first("target").alias("target"),
        *([F.first("id").alias("id")] if rows_apart else []), F.sum("taken").alias("taken"), F.sum(F.when((F.col("taken") == F.col("size")) & (F.col("size") > 0), 1).otherwise(0)).alias("copies"),
    )
    return out.select("doc_id", "source", "size", "source_size", "target", "taken", "copies", *["id"] * rows_apart)


def mix_documents(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED) -> DataFrame:
    """The mix itself: df's rows, whole, each as often as the mix takes it (at most 3 times). Texts without words cost nothing and stay once."""
    counts = mix_counts(df, key, text, source, seed, True, True)
    times = F.when(F.col("size") > 0, F.col("copies")).otherwise(1)
    counts = counts.select("id.*", times.cast("int").alias("times")).where("times > 0")
    names = [f"c{i}" for i in range(len(df.columns))]  # columns of any name
    rows = _numbered(df.select(*_keys(df), *(F.col(quoted(c)).alias(n) for c, n in zip(df.columns, names))))
    return rows.join(counts, ["k1", "k2", "n"]).withColumn("_turn", F.explode(F.sequence(F.lit(1), F.col("times")))).select(*(F.col(n).alias(c) for c, n in zip(df.columns, names)))


def op2_mix(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, f"{sf_dir}/documents.parquet")
    return mix_counts(docs).select("doc_id", "size", "source_size", "target", "taken")


OP2_SQL = r"""
with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size from documents),
s as (select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as n from d group by source),
w as (select *, ((n - 1) % 3 + 1)::double as w, (source_size * 3)::double as most from s),
l as (select *, (sum(source_size::double) over () - coalesce(sum(most) over (order by most / w, n rows between unbounded preceding and 1 preceding), 0.0))
    / sum(w) over (order by most / w, n rows between current row and unbounded following) as level from w),
c as (select arg_min(level, (most / w, n)) as level from l where level * w <= most),
t as (select source, source_size, least(most, c.level * w) as target from l, c),
p as (select d.*, row_number() over () as id, md5('17:' || doc_id) as h, source_size, target, coalesce(sum(size) over (partition by d.source order by md5('17:' || doc_id), doc_id, size rows between unbounded preceding and 1 preceding), 0) as pos
    from d join t on d.source is not distinct from t.source),
q as (select p.*, turn, k, least(size - k * 128, 128) as part from p, range(3) r(turn), lateral (select unnest(range(greatest(1, (size + 127) // 128))) as k)),
f as (select *, (pos + turn * source_size + k * 128 + part)::double / target as finish from q where part > 0),
b as (select *, coalesce(sum(part) over (order by finish, h, doc_id, turn, k, size rows between unbounded preceding and 1 preceding), 0) as before, (select sum(source_size) from t) as budget from f),
s2 as (select id, sum(greatest(0, least(part, budget - before))) as taken from b group by id)
select doc_id, size::bigint as size, source_size, target, coalesce(taken, 0)::bigint as taken from p left join s2 using (id)
"""
