"""Texts and names made to break operators: hashes' patterns, marks, column names, hot keys."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loomline.llm import components, minhash_dedup, secrets, substring_index, toxicity
from loomline.llm.textops import sequence_hashes, settings, span_hashes, utf8, window_hashes, word_spans
from tests.llm import cases


def thue_morse(n, a, b):
    return [(a, b)[bin(i).count("1") % 2] for i in range(n)]


def patterned():
    """Words of 1,024 letters, and sequences of 1,024 words, that any polynomial modulo 2**64 takes for one another."""
    words = ["".join(thue_morse(1024, *ab)) for ab in ("ab", "ba")]
    rows = [" ".join([f"w{i}" for i in range(34)] + [w]) for w in words] + words + [" ".join(thue_morse(1024, *ab)) for ab in (("x", "y"), ("y", "x"))]
    return [(i, t, "en", "s", 1) for i, t in enumerate(rows)]


def test_patterns_do_not_collide(spark):
    rows = patterned()
    df = spark.createDataFrame(rows, cases.SCHEMA)
    assert sorted(map(tuple, substring_index.deduplicate(df).collect()), key=str) == cases.repeated_words(rows)
    assert {r.doc_id: tuple(r)[1:] for r in minhash_dedup.near_duplicates(df).collect()} == cases.near(rows)


def test_hashes_tell_what_differs_and_only_that():
    texts = ["", "a", "ab", "a\0", "a" * 255, "a" * 256, "a" * 257, "a" * 258, "b" + "a" * 256, "a" * 256 + "b", "a" * 10_000, "a" * 9_999 + "b", "".join(thue_morse(4096, "a", "b")), "".join(thue_morse(4096, "b", "a"))]
    buf, offsets = utf8(pa.array(texts))
    h = span_hashes(buf, offsets[:-1], offsets[1:], 7)
    assert len(set(h.tolist())) == len(texts)
    assert (span_hashes(np.concatenate([np.zeros(3, np.uint8), buf, buf]), np.append(offsets[:-1], offsets[:-1] + len(buf)) + 3, np.append(offsets[1:], offsets[1:] + len(buf)) + 3, 7) == np.append(h, h)).all()
    x = np.arange(200, dtype=np.uint64) % np.uint64(13)
    for width in (1, 2, 5, 6, 35):
        got = window_hashes(x, width, 3)
        assert len(got) == 201 - width and len(set(got.tolist())) == 13 and (got[13:] == got[:-13]).all()
    s = sequence_hashes(x, np.array([0, 13, 26, 27, 27, 200]), 5)
    assert s[0] == s[1] and len(set(s.tolist())) == 4


def test_marks_at_a_words_ends():
    def ids(text):
        return toxicity.features(pa.array([text]))[0].tolist()

    for n in (0, 1, 4, 5, 10, 3000):
        assert ids("bad" + "!" * n) == ids("*" * n + "BAD") == ids('"' * n + "bad" + ")" * n) == ids("bad")
    assert ids("!" * 50) == ids("?!") == ids("!") != ids("?") and ids("b-d.") == ids("b-d")


@pytest.mark.parametrize("stage", ["toxicity", "near_duplicates", "pii", "mixing"])
def test_stages_take_any_column_names(spark, tmp_path, stage):
    docs = spark.createDataFrame(cases.ROWS, cases.SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, 1, 0), (9, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    names = ["toxic", "grade", "p_toxic", "expected_severity", "a.b", "c d", "e`f", "c0", "id", "k1", "n", "rest", "redacted", "key"]
    fn = dict(corpus_pipeline.STAGES)[stage]
    got = fn(spark, docs.withColumns({x: F.lit(i) for i, x in enumerate(names)}), str(tmp_path))
    assert got.columns == [*docs.columns, *names]
    plain = fn(spark, docs, str(tmp_path))
    assert sorted(hashlib.md5(str(tuple(r[: len(docs.columns)])).encode()).hexdigest() for r in got.collect()) == sorted(hashlib.md5(str(tuple(r)).encode()).hexdigest() for r in plain.collect())


def joins_split(df):
    """Whether adaptive execution split a skewed join of what ran."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return "skew=true" in df._jdf.queryExecution().executedPlan().toString()


SKEW = {
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "16k", "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5", "spark__sql__adaptive__advisoryPartitionSizeInBytes": "16k",
    "spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__shuffle__partitions": "16", "spark__sql__adaptive__coalescePartitions__enabled": "false",
}


def test_joins_of_hot_keys_are_split(spark, monkeypatch):
    """The plans that meet a hot key read both sides as they were dealt, so that Spark splits them."""
    split, real = [], minhash_dedup.cut

    def cut(df):
        if df.columns == ["doc_id", "pivot"]:  # members of the inverted lists
            split.append(joins_split(df))
        return real(df)

    hot = "deadbeefdeadbeef0123"
    rows = [(i, f"{hot} and Ab{i:04d}cdEFgh{i * 7919:08d}xyZW " + " ".join(f"{i}w{j}" for j in range(20)), "en", f"s{i % 3}", 1) for i in range(6000)]
    df = spark.createDataFrame(rows, cases.SCHEMA)
    with settings(spark, **SKEW):
        scan = secrets.scan(df.repartition(8))
        assert joins_split(scan)
        monkeypatch.setattr(minhash_dedup, "cut", cut)
        common = [(i, f"one two three four five {i}w", "en", "s", 1) for i in range(6000)]
        minhash_dedup.near_duplicates(spark.createDataFrame(common, cases.SCHEMA).repartition(8)).write.format("noop").mode("overwrite").save()
    assert split == [True]


def test_star_components(spark):
    links = spark.range(1, 3000).selectExpr("0L as a", "id as b")
    assert components.components(links).where("component_id = 0").count() == 2999
