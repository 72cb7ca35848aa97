"""Sections of long documents against the windows over whole documents."""

import random

import pytest
from pyspark.sql import functions as F

from loomline.operators import pages

HEADS = ["DOSE TABLE", "SAFETY RULES", "FOLLOW UP"]


def made(r, doc, n, share):
    text = lambda i: (r.choice(HEADS) + "\n" if r.random() < share else "") + f"page {i} says this, and that."
    return [(doc, i, r.choice((None, "")) if r.random() < 0.05 else text(i)) for i in range(n)]


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_equal_rows(spark, partitions):
    r = random.Random(partitions)
    rows = made(r, "long", 700, 0.1) + made(r, "bare", 90, 0) + made(r, None, 60, 0.4) + [x for i in range(30) for x in made(r, f"short{i}", r.randint(1, 4), 0.5)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "doc string, page long, text string").repartition(4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = pages.long_sections(df)
        want = pages.sections(df).select(got.columns)
        assert got.dtypes == want.dtypes
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert pages.long_sections(df.limit(0)).count() == 0


def test_a_long_document_has_several_parts(spark, monkeypatch):
    kept = {}
    write = pages.written
    monkeypatch.setattr(pages, "written", lambda df, name: kept.setdefault(name, write(df, name)))
    df = spark.range(20_000).select(F.lit("one").alias("doc"), F.col("id").alias("page"), F.when(F.col("id") % 50 == 0, F.concat(F.lit("RULE "), F.chr(65 + F.col("id") / 50 % 26), F.lit("\ntext"))).otherwise("more text.").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = pages.long_sections(df).agg(F.count("*"), F.sum("pages"), F.max("pages")).first()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [x["count"] for x in kept["pages"].groupBy(F.shiftright("n", 33)).count().collect()]
    assert tuple(out) == (400, 20_000, 50) and len(sizes) >= 4 and max(sizes) < 10_000
