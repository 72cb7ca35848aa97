"""Dense search by blocks against the row by row expression."""

import random

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from loomline.operators import retrieval


def plain(queries, vectors, k, min_score):
    """Every pair as a row, scored by the expression."""
    pairs = vectors.crossJoin(queries).withColumn("score", F.round(retrieval.dense_cosine(F.col("qv"), F.col("embedding")), 4)).where("score = score").where(F.col("score") >= min_score)
    best = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= k)
    return sorted(map(tuple, best.select("query_id", "vec_id", "score", "rank").collect()))


def test_blocks_equal_pairs(spark, monkeypatch):
    monkeypatch.setattr(retrieval, "VECTORS", 64)
    monkeypatch.setattr(retrieval, "QUERIES", 7)
    r = random.Random(4)
    rows = [[r.gauss(0, 1) for _ in range(8)] for _ in range(40)]
    # near copies by the hundred, of which many round to one score; scaled and opposite ones; zero
    some = [[x * r.choice((1.0, 0.5)) + r.gauss(0, 1e-4) for x in r.choice(rows)] for _ in range(500)] + [rows[3]] * 300 + [[-x for x in rows[3]]] * 20 + [[0.0] * 8]
    odd = [None, [], [1.0, None], [float("nan")] * 8, [float("inf")] * 8, [1.0, 2.0]]
    r.shuffle(some)
    vectors = spark.createDataFrame([(i, v) for i, v in enumerate(some + odd)], "vec_id long, embedding array<float>").repartition(5)
    queries = spark.createDataFrame([(f"q{i}", v) for i, v in enumerate(rows + [[0.0] * 8, [2.0, 4.0], None, []])], "query_id string, qv array<float>").repartition(3)
    good = vectors.where("embedding is not null and size(embedding) > 0 and forall(embedding, x -> x is not null and x = x and abs(x) < double('inf') and not isnan(x))")
    for k, least in ((3, 0.05), (1, 0.5), (25, -2.0)):
        got = retrieval.dense_search(queries, vectors, k=k, min_score=least)
        assert sorted(map(tuple, got.select("query_id", "vec_id", "score", "rank").collect())) == plain(queries.where("size(qv) > 0"), good, k, least)
    assert retrieval.dense_search(queries.limit(0), vectors).count() == 0 and retrieval.dense_search(queries, vectors.limit(0)).count() == 0


def test_copies_leave_a_block_k_times():
    q, v = np.eye(4)[:1], np.tile([[1.0, 1e-9, 0, 0]], (1000, 1))
    i, j, _ = retrieval._nearest(q, v, 3, 0.05)
    assert len(i) == 3 and list(j) == [0, 1, 2]
