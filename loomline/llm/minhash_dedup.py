"""Near-duplicates by bottom-k sketches from one hash function.

A document's set holds its distinct 5-word shingles (lower-cased A-Z). Texts with the same words in the same order are
one class from the start. A class's sketch is the K least hashes of its set. Inverted lists of the sketches' values
generate overlaps: each class enters only the lists of its rarest values (prefix filter: two sets at the threshold
share at least ALPHA of their K values, or their whole prefix if they are small, so they meet in one of these lists);
lists with the same least member are one group. Inside a group the union sketch's estimate drops pairs that can't
reach the threshold, and exact Jaccard on the full sets verifies the rest. Groups above CHUNK members are dealt into
chunks that all hold the group's least member. Members that are still apart from it are grouped anew, with all members
of their groups, by an exact prefix filter on their full sets (the rarest quarter of a set meets any set at the
threshold), so that what only shares a header falls apart; inside these groups those apart meet all others, block by
block, by bit counts. Only a spanning forest of verified links leaves a task; components() joins them.

Sets are sets of 64-bit hashes of words' 64-bit hashes; classes are told by two such hashes, each from word hashes of its own. With K = 32 and ALPHA = 11 a pair at exactly 0.75 fails to share enough values with
probability about 3e-7, above it with less.

Defined results: null, empty and blank texts have the empty set and link with nothing; fewer than five words are one
shingle; a null doc_id links with nothing and has no component; rows that share a doc_id share a component; repeated
rows are one class; an empty table gives no rows; columns beside those named are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.components import Forest, components
from loomline.llm.textops import LOWER, U64, cut, forget, list_array, pieces, sequence_hashes, short_batches, signed, span_hashes, utf8, window_hashes, word_spans
from loomline.sources.readers import read_table

WIDTH, K, ALPHA, CHUNK, COLUMNS = 5, 32, 11, 256, 4096
NUMERATOR, DENOMINATOR = 3, 4
_WORDS, _SHINGLE, _SHORT, _WHOLE = (71, 72), 73, 74, (75, 76)  # seeds


def shingle_sets(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct shingle hashes of all texts, each text's sorted; offsets; two hashes of each whole word sequence)."""
    buf, offsets = utf8(text)
    starts, ends, per = word_spans(buf, offsets)
    low = LOWER[buf]
    words, others = (span_hashes(low, starts, ends, seed) for seed in _WORDS)
    first, n = per[:-1], np.diff(per)
    grams, short = window_hashes(words, WIDTH, _SHINGLE), sequence_hashes(words, per, _SHORT)
    sets = []
    for i, (a, k) in enumerate(zip(first.tolist(), n.tolist())):
        sets.append(np.unique(grams[a : a + k - WIDTH + 1]) if k >= WIDTH else short[i : i + 1] if k else short[:0])
    whole = [sequence_hashes(w, per, seed) for w, seed in zip((words, others), _WHOLE)]
    return np.concatenate(sets) if sets else np.zeros(0, U64), np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int64), *whole


def sketches(df: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, f1, f2, n, sketch): class hashes, set size, and the K least hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            flat, at, f1, f2 = shingle_sets(piece.column("text"))
            n = np.diff(at)
            keep = np.minimum(n, K)
            off = np.concatenate([[0], np.cumsum(keep)])
            pick = np.repeat(at[:-1] - off[:-1], keep) + np.arange(off[-1])
            yield pa.RecordBatch.from_arrays([piece.column("key"), pa.array(signed(f1)), pa.array(signed(f2)), pa.array(n), list_array(signed(flat[pick]), off, pa.int64())], ["doc_id", "f1", "f2", "n", "sketch"])

    return df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).transform(short_batches).mapInArrow(run, "doc_id long, f1 long, f2 long, n long, sketch array<long>")


def by_group(df: DataFrame, keys: list[str], fn: Callable[[pa.Table], list[tuple]], schema: str, kinds: list[pa.DataType], numbered: int = 0) -> DataFrame:
    """fn on all rows of each key, streamed from partitions that are dealt and sorted by key. numbered: the key counts from 0 below this, and each value gets a partition of its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows)) if rows else [()] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

        waiting: list[pa.Table] = []  # the parts of the last group, joined once it has ended
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            change = np.zeros(table.num_rows, bool)
            for k in keys:
                v = np.asarray(table.column(k))
                change[1:] |= v[1:] != v[:-1]
                change[0] |= bool(waiting) and waiting[-1].column(k)[-1] != table.column(k)[0]
            edges = [0, *np.flatnonzero(change).tolist(), table.num_rows]
            rows: list[tuple] = []
            for a, b in zip(edges, edges[1:]):
                if a < b and change[a] and waiting:
                    rows += fn(pa.concat_tables(waiting).combine_chunks())
                    waiting = []
                if a < b:
                    waiting.append(table.slice(a, b - a))
            if rows:
                yield out(rows)
        if waiting:
            yield out(fn(pa.concat_tables(waiting).combine_chunks()))

    names = [p.split()[0] for p in schema.split(", ")]
    dealt = df.repartitionById(numbered, F.col(keys[0])) if numbered else df.repartition(*keys)
    return dealt.sortWithinPartitions(*keys).transform(short_batches).mapInArrow(run, schema)


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    whole = column.combine_chunks()
    whole = whole.chunk(0) if isinstance(whole, pa.ChunkedArray) else whole
    flat, off = np.asarray(whole.flatten(), np.int64), np.concatenate([[0], np.cumsum(np.asarray(whole.value_lengths()))])
    return [flat[a:b] for a, b in zip(off, off[1:])]


def estimated(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the union sketch of two sketches leaves the threshold open."""
    x, y = np.sort(a.view(U64)), np.sort(b.view(U64))
    both = np.intersect1d(x, y, assume_unique=True)
    union = len(x) + len(y) - len(both)
    if len(x) < K and len(y) < K:  # whole sets
        return DENOMINATOR * len(both) >= NUMERATOR * union
    k = min(K, union)
    last = np.union1d(x, y)[k - 1]
    return np.searchsorted(both, last, "right") * K >= ALPHA * k


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Exact, on sorted distinct hashes: 100 * intersection >= 75 * union."""
    n, m = len(a), len(b)
    if DENOMINATOR * min(n, m) < NUMERATOR * max(n, m):
        return False
    x = np.concatenate([a, b])
    x.sort(kind="stable")
    both = int((x[1:] == x[:-1]).sum())
    return DENOMINATOR * both >= NUMERATOR * (n + m - both)


def linked(sets: list[np.ndarray]) -> np.ndarray:
    """Which of these sorted distinct hash sets are similar(), as a matrix. Shared values are counted as common bits of the sets' rows of an incidence matrix, COLUMNS values at a time."""
    size = np.array([len(x) for x in sets])
    owner, flat = np.repeat(np.arange(len(sets)), size), np.concatenate(sets)
    _, value, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times > 1
    column, owner = (np.cumsum(shared) - 1)[value[shared[value]]], owner[shared[value]]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    both = np.zeros((len(sets), len(sets)), np.int64)
    for at in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(column, (at, at + COLUMNS))
        seen = np.zeros((len(sets), COLUMNS), bool)
        seen[owner[a:b], column[a:b] - at] = True
        bits = np.packbits(seen, axis=1).view(U64)
        for i in range(len(sets)):
            both[i] += np.bitwise_count(bits[i] & bits).sum(1, dtype=np.int64)
    return DENOMINATOR * both >= NUMERATOR * (size[:, None] + size[None, :] - both)


def candidate_clusters(table: pa.Table) -> list[tuple]:
    """Members of a group with a possible partner, by cluster of possible links."""
    ids, sketch = np.asarray(table.column("doc_id")), _lists(table.column("sketch"))
    forest = Forest(len(ids))
    for i in range(len(ids)):
        for j in range(i + 1, len(ids)):
            if forest.root(i) != forest.root(j) and estimated(sketch[i], sketch[j]):
                forest.join(i, j)
    roots = [forest.root(i) for i in range(len(ids))]
    size = np.bincount(roots, minlength=len(ids))
    p, c = table.column("pivot")[0].as_py(), table.column("chunk")[0].as_py()
    return [(p, c, int(ids[r]), int(ids[i])) for i, r in enumerate(roots) if size[r] > 1]


def verified_links(table: pa.Table) -> list[tuple]:
    """A spanning forest of the links among a cluster's members."""
    ids, sets = np.asarray(table.column("doc_id")), _lists(table.column("shingles"))
    forest = Forest(len(ids))
    for i, j in np.argwhere(np.triu(linked(sets), 1)).tolist():
        forest.join(i, j)
    return forest.links(ids)


def cross_links(table: pa.Table) -> list[tuple]:
    """Links between a block's members that are apart from their group's least member and all its members; rows of one known component start joined."""
    ids, sets, apart, known = np.asarray(table.column("doc_id")), _lists(table.column("shingles")), np.asarray(table.column("apart")), np.asarray(table.column("component"))
    forest, first = Forest(len(ids)), {}
    for i, c in enumerate(known.tolist()):
        forest.join(i, first.setdefault(c, i))
    if apart.any():
        for i, j in np.argwhere(linked(sets) & apart[:, None]).tolist():
            forest.join(i, j)
    return [x for x in forest.links(ids) if x[0] != x[1]]


LONGS = [pa.int64(), pa.int64()]


def full_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, shingles) of the documents named in ids, from their whole texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            flat, at, _, _ = shingle_sets(piece.column("text"))
            for i in range(0, piece.num_rows, 512):
                j = min(piece.num_rows, i + 512)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id").slice(i, j - i), list_array(signed(flat[at[i] : at[j]]), at[i : j + 1] - at[i], pa.int64())], ["doc_id", "shingles"])

    # ids grow with the documents: the same join at every size
    return docs.join(ids.distinct().hint("merge"), "doc_id").select("doc_id", "text").transform(short_batches).mapInArrow(run, "doc_id long, shingles array<long>")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row."""
    docs = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    made = cut(sketches(docs, "doc_id", "text"))
    real = made.where("n > 0 and doc_id is not null")
    classes = cut(real.groupBy("f1", "f2").agg(F.min("doc_id").alias("rep")))
    reps = real.join(classes.withColumnRenamed("rep", "doc_id"), ["f1", "f2", "doc_id"]).dropDuplicates(["doc_id", "f1", "f2"]).select("doc_id", "n", "sketch")
    reps = cut(reps)

    values = reps.select("doc_id", F.explode("sketch").alias("v"))
    shared = cut(values.groupBy("v").agg(F.count("*").alias("c"), F.min("doc_id").alias("pivot")).where("c > 1"))  # a table of its own: Spark then splits a frequent value's join
    per = values.join(shared, "v").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("c", "v", "pivot"))).alias("found"))  # at most K each
    s = F.size("sketch")
    # a set of at most 24 meets only sets that are their own sketches: the exact prefix holds
    need = F.when(F.col("n") <= K * NUMERATOR // DENOMINATOR, F.ceil(s * NUMERATOR / DENOMINATOR)).otherwise(F.greatest(F.floor(s * ALPHA / K), F.lit(1)))
    room = (s - need + 1 - (s - F.size("found"))).cast("int")
    member = reps.join(per, "doc_id").where(room > 0).select("doc_id", F.explode(F.array_distinct(F.transform(F.slice("found", 1, room), lambda x: x["pivot"]))).alias("pivot"))
    member = cut(member.distinct())
    forget(shared)
    sizes = cut(member.groupBy("pivot").agg(F.count("*").alias("m"), F.min("doc_id").alias("center")).where("m > 1"))  # a table of its own: Spark then splits a large group's join
    dealt = member.join(sizes, "pivot").withColumn("chunks", F.ceil(F.col("m") / CHUNK).cast("int"))
    dealt = dealt.withColumn("chunk", F.explode(F.when(F.col("doc_id") == F.col("center"), F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(F.array(F.pmod(F.xxhash64("doc_id"), F.col("chunks")).cast("int")))))
    dealt = cut(dealt.select("pivot", "chunk", "chunks", "doc_id", "center"))

    sketched = dealt.select("pivot", "chunk", "doc_id").join(reps.select("doc_id", "sketch"), "doc_id")
    clusters = cut(by_group(sketched, ["pivot", "chunk"], candidate_clusters, "pivot long, chunk int, cluster long, doc_id long", [pa.int64(), pa.int32(), pa.int64(), pa.int64()]).distinct())
    big = dealt.where("chunks > 1")
    sets = full_sets(docs, clusters.select("doc_id").union(big.select("doc_id")))
    has_big = not big.isEmpty()
    if has_big:
        sets = cut(sets)
    forget(member, sizes)
    links = cut(by_group(clusters.join(sets, "doc_id"), ["pivot", "chunk", "cluster"], verified_links, "a long, b long", LONGS))
    joined = components(links)
    if has_big:
        across = cut(_across(big, joined, sets))
        joined = components(joined.select(F.col("id").alias("a"), F.col("component_id").alias("b")).union(across))
        forget(across, sets)
    forget(reps, dealt, clusters, links)
    out = made.join(classes, ["f1", "f2"], "left").join(joined.withColumnRenamed("id", "rep"), "rep", "left")
    component = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.coalesce("component_id", "rep")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"))


def prefix_members(values: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, pivot): for (doc_id, n, v), the least members of the lists of each set's rarest n - ceil(3n / 4) + 1 values, where others have them too. And the table of lists, to be dropped once they are read."""
    shared = cut(values.groupBy("v").agg(F.count("*").alias("c"), F.min("doc_id").alias("pivot")).where("c > 1"))
    per = values.join(shared, "v").groupBy("doc_id").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("c", "v", "pivot"))).alias("found"))  # a document's
    room = (F.floor(F.col("n") * (DENOMINATOR - NUMERATOR) / DENOMINATOR) + 1 - (F.col("n") - F.size("found"))).cast("int")
    return per.where(room > 0).select("doc_id", F.explode(F.array_distinct(F.transform(F.slice("found", 1, room), lambda x: x["pivot"]))).alias("pivot")), shared


def _across(big: DataFrame, joined: DataFrame, sets: DataFrame) -> DataFrame:
    """Links of big groups' members that are apart from their center, against all members of their groups."""
    known = big.select("pivot", "doc_id", "center").distinct()
    known = known.join(joined.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component_id", "doc_id")).drop("component_id")
    centers = joined.select(F.col("id").alias("center"), F.col("component_id").alias("main"))
    known = known.join(centers, "center", "left").withColumn("apart", F.col("component") != F.coalesce("main", "center"))
    known = cut(known.select("pivot", "doc_id", "component", "apart"))
    open_groups = cut(known.groupBy("pivot").agg(F.max("apart").alias("open")).where("open").select("pivot"))
    known = cut(known.join(open_groups, "pivot").groupBy("doc_id").agg(F.min("component").alias("component"), F.max("apart").alias("apart")))
    # exact prefix filter: of sets of n, the rarest n - ceil(3n / 4) + 1 values meet in one at least
    own = known.select("doc_id").join(sets, "doc_id")
    member, shared = prefix_members(own.select("doc_id", F.size("shingles").alias("n"), F.explode("shingles").alias("v")))
    known = cut(member.join(known, "doc_id").select("pivot", "doc_id", "component", "apart"))
    forget(shared)
    sizes = known.groupBy("pivot").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"), F.ceil(F.sum(F.col("apart").cast("int")) / CHUNK).cast("int").alias("rests"))
    known = known.join(cut(sizes.where("rests > 0")), "pivot")
    h = F.xxhash64("doc_id")
    columns = F.sequence(F.lit(0), F.col("chunks") - 1)
    ours = known.where("apart").withColumn("rest", F.pmod(h, F.col("rests")).cast("int")).withColumn("chunk", F.explode(columns))
    theirs = known.withColumn("chunk", F.pmod(h, F.col("chunks")).cast("int")).withColumn("rest", F.explode(F.sequence(F.lit(0), F.col("rests") - 1))).withColumn("apart", F.lit(False))
    names = ["pivot", "rest", "chunk", "doc_id", "component"]
    # a row that is on both sides of a block comes once
    blocks = ours.select(*names, "apart").union(theirs.select(*names, "apart")).groupBy(*names).agg(F.max("apart").alias("apart"))
    return by_group(blocks.join(sets, "doc_id"), ["pivot", "rest", "chunk"], cross_links, "a long, b long", LONGS)


def op7_minhash_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, f"{sf_dir}/documents.parquet"))


OP7_SQL = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')] else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) end as s from w),
e as (select doc_id, unnest(s) as x from s),
k as (select min(doc_id) as c, list(doc_id) as ids, s from (select doc_id, list_sort(s) as s from s where len(s) > 0) group by s),
f as (select c, len(s) as n, unnest(s) as x from k),
p as (select a.c as a, b.c as b from f a join f b on a.x = b.x and a.c <> b.c group by a.c, b.c, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))),
r(a, c) as (select c, c from k union select p.b, r.c from r join p on r.a = p.a),
m as (select a, min(c) as m from r group by a),
d as (select unnest(ids) as doc_id, c from k)
select s.doc_id, len(s.s)::bigint as n_shingles, coalesce(m.m, s.doc_id)::bigint as component_id, coalesce(m.m, s.doc_id) = s.doc_id as kept
from s left join d on d.doc_id = s.doc_id left join m on m.a = d.c
"""
