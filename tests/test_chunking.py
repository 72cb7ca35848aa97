"""Chunk ranges from pointers against the packing rule, part by part; growth with a text's paragraphs."""

import random
import time

import pytest
from pyspark.sql import functions as F

from loomline.operators import chunking
from tests.test_core import plain_chunks


@pytest.mark.parametrize("seed", range(40))
def test_followed_pointers_equal_the_rule(seed):
    r = random.Random(seed)
    lengths = [r.randint(0 if seed % 5 == 0 else 1, r.choice((5, 30, 120))) for _ in range(r.randint(0, 60))]
    fixed = [r.random() < 0.2 for _ in lengths] if seed % 2 else None
    size, overlap, joint, alone = r.choice((10, 50, 100)), r.choice((0, 0, 5, 40, 100, 500)), r.choice((1, 2)), seed % 3 > 0
    parts = ["x" * n for n in lengths]
    at = {id(p): i for i, p in enumerate(parts)}
    out, now, used = [], [], 0
    for i, n in enumerate(lengths):
        if used + n + joint > size and now:
            out.append((now[0] + 1, now[-1] + 1))
            if overlap and (alone or len(now) > 1):
                keep = []
                for k in reversed(now):
                    if (fixed and fixed[k]) or sum(lengths[j] for j in keep) + lengths[k] > overlap:
                        break
                    keep.insert(0, k)
                now, used = [*keep, i], sum(lengths[j] for j in keep) + n + joint * len(keep)
            else:
                now, used = [i], n + joint
        else:
            now, used = [*now, i], used + n + joint
    want = [*out, (now[0] + 1, now[-1] + 1)] if now else out
    assert at is not None and chunking.followed(lengths, fixed, size, overlap, joint, alone) == want


def test_batches_of_texts(spark):
    r = random.Random(3)
    texts = [None, "", " \n\n ", "short"] + ["\n\n".join("w" * r.randint(1, 60) for _ in range(r.randint(1, 50))) for _ in range(60)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string").repartition(3)
    for size, overlap in ((80, 0), (80, 30)):
        got = {x.id: x.c for x in df.select("id", chunking.chunks("t", size, overlap).alias("c")).collect()}
        for i, t in enumerate(texts):
            want = [] if not (t or "").strip() else [t.strip()] if len(t) <= size else ["\n\n".join(c) for c in plain_chunks(t, size, overlap)]
            assert got[i] == want


def test_time_grows_with_the_paragraphs(spark):
    def took(n, overlap):
        df = spark.createDataFrame([("\n\n".join("paragraph %06d" % i + "x" * 90 for i in range(n)),)], "t string")
        made = chunking.exploded(df, chunking.chunks("t", 100, overlap)).select(F.count("*"))
        began = time.perf_counter()
        assert made.first()[0] == n
        return time.perf_counter() - began

    took(1000, 0)
    assert took(80_000, 0) < 6 and took(80_000, 200) < 8
