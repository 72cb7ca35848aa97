"""Embedding near-duplicates by product quantisation.

Coarse inverted lists (k-means) hold, for every vector, codes of its residual in subspaces (k-means of 256). Each
vector is a query too. It probes its own list and every list whose bisector with its own is within REACH of the
threshold's distance r: REACH 1 loses no link, but in high dimensions leaves most lists in. A link of length r between
vectors that differ in no special direction lies along the bisector's normal by r / sqrt(dimensions) on average, 0.125 r
for 64; it is lost only if both its ends are further than REACH * r from the bisector, by 3.2 deviations for 0.4 (tests
and the README give measured recall). Codes of a list are scanned by asymmetric table look-up, those within r plus the
stored vector's own quantisation error stay (so none is lost by coding), and the exact cosine in double precision
decides. A link that only one end probes counts for both.

Lists are split into blocks of at most BLOCK stored rows and QUERIES queries, by hash, so that no list, label or
group of near copies meets in one task. Equal vectors of a label are one class with a count, expanded at the end.
A block returns link counts and a spanning forest, never all pairs. Centroids are fitted on at most SAMPLE vectors
(least hashes, an equal share for each vector length); every row is indexed.

Defined results: vectors that are null, empty, zero or hold null or non-finite parts, and rows without a label,
link with nothing; vectors of different lengths never link; an empty table gives no rows; rows that repeat a vec_id
count as vectors of their own, but share their id's component; columns beside those named are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomline.llm.components import Forest, components
from loomline.llm.textops import cut, forget, short_batches

THRESHOLD, REACH, SAMPLE, LIST_ROWS, MOST_LISTS = 0.93, 0.4, 20_000, 2048, 4096
SUB, CODES, BLOCK, QUERIES, SLACK = 8, 256, 2048, 4096, 1e-6


def kmeans(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centers = x[np.sort(rng.choice(len(x), min(k, len(x)), replace=False))].copy()
    for _ in range(rounds):
        near = nearest(x, centers)
        n = np.bincount(near, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, near, x)
        centers[n > 0] = sums[n > 0] / n[n > 0, None]
    return centers


def square_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ y.T + (y * y).sum(1)[None, :], 0)


def nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.concatenate([square_distances(x[i : i + 4096], centers).argmin(1) for i in range(0, len(x), 4096)]) if len(x) else np.zeros(0, np.int64)


class Quantiser:
    """Coarse centroids, and a codebook for each subspace of the residuals."""

    def __init__(self, sample: np.ndarray, lists: int):
        dim = sample.shape[1]
        self.coarse = kmeans(sample, lists, 1)
        rest = sample - self.coarse[nearest(sample, self.coarse)]
        self.cuts = [(i, min(dim, i + SUB)) for i in range(0, dim, SUB)]
        self.books = [kmeans(rest[:, a:b], CODES, 2 + a) for a, b in self.cuts]
        self.between = np.sqrt(square_distances(self.coarse, self.coarse))

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(list, codes, distance from the decoded vector) of each unit vector."""
        at = nearest(x, self.coarse)
        rest = x - self.coarse[at]
        codes = np.stack([nearest(rest[:, a:b], book) for (a, b), book in zip(self.cuts, self.books)], 1).astype(np.uint8)
        made = np.concatenate([book[codes[:, i]] for i, book in enumerate(self.books)], 1)
        return at, codes, np.sqrt(((rest - made) ** 2).sum(1))

    def probes(self, x: np.ndarray, at: np.ndarray, radius: float) -> np.ndarray:
        """Whether each list may hold a vector within radius of x: x is at most that far beyond the bisector."""
        d = square_distances(x, self.coarse)
        own = d[np.arange(len(x)), at]
        return d - own[:, None] <= 2 * (radius + SLACK) * self.between[at] + SLACK

    def scan(self, query: np.ndarray, which: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric distances of queries (rows) to the coded rows of one list, by one table a subspace."""
        rest = query - self.coarse[which]
        out = np.zeros((len(query), len(codes)))
        for i, ((a, b), book) in enumerate(zip(self.cuts, self.books)):
            out += square_distances(rest[:, a:b], book)[:, codes[:, i]]
        return np.sqrt(out)


def units(lists: pa.Array, dim: int) -> np.ndarray:
    x = np.asarray(lists.flatten(), np.float64).reshape(-1, dim)
    top = np.abs(x).max(1, keepdims=True)
    x = x / top  # keeps squares finite
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def fit(vectors: DataFrame, sample: int = SAMPLE) -> dict[int, Quantiser]:
    """A quantiser for each vector length; lists follow the number of rows of that length. One count a length reaches the driver, and at most `sample` vectors (or one a length)."""
    sizes = vectors.groupBy("dim").agg(F.count("*").alias("rows"))
    counts = {r["dim"]: r["rows"] for r in sizes.collect()}
    share = max(1, sample // max(1, len(counts)))
    h = F.xxhash64("class", "label")
    few = vectors.join(sizes, "dim").where(F.pmod(h, F.lit(1 << 30)) < (2.0 * share + 20) / F.col("rows") * (1 << 30))  # some more than the share, so that no length is ranked whole
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("dim").orderBy(h, "class", "vector")))
    some = ranked.where(F.col("rank") <= share).select("dim", "vector").toArrow()
    dims, lists = np.asarray(some.column("dim")), some.column("vector").combine_chunks()
    out = {}
    for dim, n in counts.items():
        mine = lists.filter(pa.array(dims == dim))
        if len(mine):
            out[dim] = Quantiser(units(mine, dim), int(min(MOST_LISTS, max(1, n // LIST_ROWS))))
    return out


def link_counts(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD, reach: float = REACH) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of df."""
    sc = df.sparkSession.sparkContext
    v = F.col("vector")
    fine = F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    kind = "float" if df.schema[vector].dataType.simpleString() == "array<float>" else "double"  # as it came: a float is half as long to send
    rows = df.select(F.col(key).alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast(f"array<{kind}>").alias("vector"))
    rows = rows.withColumn("fine", F.coalesce(fine, F.lit(False))).withColumn("h1", F.xxhash64("vector")).withColumn("h2", F.xxhash64(F.lit("b"), "vector"))
    good = rows.where("fine and vec_id is not null")
    classes = cut(good.groupBy("label", "h1", "h2").agg(F.min("vec_id").alias("class"), F.count("*").alias("n")))  # a table of its own: Spark then splits a repeated vector's join
    # equal vectors share their class's least id; one row that has that id brings the vector
    reps = good.join(classes.withColumnRenamed("class", "vec_id"), ["label", "h1", "h2", "vec_id"]).groupBy("label", "h1", "h2").agg(F.min("vec_id").alias("class"), F.first("n").alias("n"), F.min("vector").alias("vector"))
    reps = cut(reps.select("label", "class", "n", "vector", F.size("vector").alias("dim")))
    model = sc.broadcast(fit(reps))  # at most MOST_LISTS centroids a length
    radius = float(np.sqrt(2 - 2 * threshold))
    probed = reach * radius

    def place(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            dims = np.asarray(batch.column("dim"))
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                q = model.value.get(dim)
                n = part.num_rows
                if q is None:
                    at, hits = np.zeros(n, np.int64), np.ones((n, 1), bool)
                    codes, error = np.zeros((n, 1), np.uint8), np.zeros(n)
                else:
                    x = units(part.column("vector"), dim)
                    at, codes, error = q.encode(x)
                    hits = q.probes(x, at, probed)
                    hits[np.arange(n), at] = True
                row, lst = np.nonzero(hits)
                row, lst, stored = np.concatenate([np.arange(n), row]), np.concatenate([at, lst]), np.arange(n + len(row)) < n
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [part.column("label").take(take), pa.array(np.full(len(row), dim), pa.int32()), pa.array(lst, pa.int32()), pa.array(at[row], pa.int32()), pa.array(stored), part.column("class").take(take), part.column("n").take(take),
                     pa.array([codes[i].tobytes() if s else None for i, s in zip(row.tolist(), stored.tolist())], pa.binary()), pa.array(error[row]), part.column("vector").take(take)],
                    ["label", "dim", "list", "home", "stored", "class", "n", "codes", "error", "vector"],
                )

    label_type = reps.schema["label"].dataType.simpleString()
    placed = cut(reps.transform(short_batches).mapInArrow(place, f"label {label_type}, dim int, list int, home int, stored boolean, class long, n long, codes binary, error double, vector array<{kind}>"))
    key_cols = ["label", "dim", "list"]
    sizes = cut(placed.groupBy(*key_cols).agg(
        F.greatest(F.ceil(F.sum(F.col("stored").cast("int")) / BLOCK), F.lit(1)).cast("int").alias("blocks"), F.greatest(F.ceil(F.sum((~F.col("stored")).cast("int")) / QUERIES), F.lit(1)).cast("int").alias("turns"),
    ).where("blocks > 0"))
    h = F.xxhash64("class")
    dealt = placed.join(sizes, key_cols)
    dealt = dealt.withColumn("block", F.explode(F.when(F.col("stored"), F.array(F.pmod(h, F.col("blocks")).cast("int"))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))))
    dealt = dealt.withColumn("turn", F.explode(F.when(~F.col("stored"), F.array(F.pmod(h, F.col("turns")).cast("int"))).otherwise(F.sequence(F.lit(0), F.col("turns") - 1))))

    def search(table: pa.Table) -> pa.Table:
        stored = np.asarray(table.column("stored"))
        ids, n, home = (np.asarray(table.column(c)) for c in ("class", "n", "home"))
        dim, lst = table.column("dim")[0].as_py(), table.column("list")[0].as_py()
        x = units(table.column("vector").combine_chunks(), dim)
        s, q = np.flatnonzero(stored), np.flatnonzero(~stored)
        found = np.zeros(len(ids), np.int64)
        forest = Forest(len(ids))
        quantiser = model.value.get(dim)
        place_of = {int(ids[i]): int(i) for i in s}
        for i in q.tolist():  # a query and its own stored row are one class
            if int(ids[i]) in place_of:
                forest.join(i, place_of[int(ids[i])])
        if len(s) and len(q):
            if quantiser is not None:
                codes = np.frombuffer(b"".join(table.column("codes").filter(pa.array(stored)).to_pylist()), np.uint8).reshape(len(s), -1)
                reach = radius + np.asarray(table.column("error"))[s] + SLACK
            for at in range(0, len(q), 256):
                some = q[at : at + 256]
                if quantiser is None:
                    a, b = (m.ravel() for m in np.meshgrid(np.arange(len(some)), np.arange(len(s)), indexing="ij"))
                else:
                    a, b = np.nonzero(quantiser.scan(x[some], lst, codes) <= reach)
                for c in range(0, len(a), 1 << 16):
                    i, j = some[a[c : c + (1 << 16)]], s[b[c : c + (1 << 16)]]
                    hit = (np.einsum("ij,ij->i", x[i], x[j]) >= threshold) & (ids[i] != ids[j])
                    i, j = i[hit], j[hit]
                    np.add.at(found, i, n[j])
                    if quantiser is not None:  # the other end counts here as well if it doesn't probe this one's list
                        for k in range(0, len(i), 2048):
                            a1, b1 = i[k : k + 2048], j[k : k + 2048]
                            apart = home[a1] != lst
                            a1, b1 = a1[apart], b1[apart]
                            alone = ~quantiser.probes(x[b1], np.full(len(b1), lst), probed)[np.arange(len(b1)), home[a1]]
                            np.add.at(found, b1[alone], n[a1[alone]])
                    for k, m in zip(i.tolist(), j.tolist()):
                        forest.join(k, m)
        links = [(a, b) for a, b in forest.links(ids) if a != b]
        with_links = np.flatnonzero(found)
        return pa.table({
            "id": pa.array([*ids[with_links].tolist(), *(a for a, _ in links)], pa.int64()),
            "other": pa.array([*[None] * len(with_links), *(b for _, b in links)], pa.int64()),
            "found": pa.array([*found[with_links].tolist(), *[0] * len(links)], pa.int64()),
        })

    hits = cut(dealt.groupBy(*key_cols, "block", "turn").applyInArrow(search, "id long, other long, found long"))
    forget(reps, placed, sizes)
    counts = cut(hits.where("other is null").groupBy(F.col("id").alias("class")).agg(F.sum("found").alias("found")))
    same_id = good.groupBy("vec_id").agg(F.min("label").alias("l0"), F.max("label").alias("l1"), F.count("*").alias("k")).where("k > 1").select("vec_id")
    member = good.join(classes, ["label", "h1", "h2"]).select("vec_id", "class", "n")
    twins = member.join(same_id, "vec_id").select(F.col("vec_id").alias("a"), F.col("class").alias("b"))
    joined = components(hits.where("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")).union(twins))
    # rows: each good row's class, its links and its component; rows that can't link stand alone
    out = rows.withColumn("good", F.col("fine") & F.col("vec_id").isNotNull())
    out = out.select("vec_id", F.when(F.col("good"), F.col("label")).alias("label"), "good", "h1", "h2").join(classes, ["label", "h1", "h2"], "left")
    out = out.join(counts, "class", "left").join(joined.withColumnRenamed("id", "class"), "class", "left")
    links = F.when(F.col("good"), F.coalesce("found", F.lit(0)) + F.col("n") - 1).otherwise(0)
    component = F.coalesce("component_id", "class", "vec_id")
    return out.select("vec_id", links.cast("long").alias("n_links"), component.cast("long").alias("component_id"), (component == F.col("vec_id")).alias("kept"))


def op9_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return link_counts(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP9_SQL = """
with recursive v as (select vec_id, label, embedding::double[] as e from embeddings
  where label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
p as (select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.93),
r(a, c) as (select vec_id, vec_id from v union select p.b, r.c from r join p on r.a = p.a),
c as (select a, min(c) as component_id from r group by a),
n as (select a, count(*) as n from p group by a)
select e.vec_id, coalesce(n.n, 0)::bigint as n_links, coalesce(c.component_id, e.vec_id)::bigint as component_id, coalesce(c.component_id, e.vec_id) = e.vec_id as kept
from embeddings e left join c on c.a = e.vec_id left join n on n.a = e.vec_id
"""
