"""Files in a shuffle's order, and the keyed store."""

import json
import random

import pytest
from pyspark.sql import functions as F

from loomline.operators.curation import shuffle_key, split_train_val
from loomline.plans import prepare
from loomline.sources import shuffled, sinks
from loomline.sources.store import KeyedStore


@pytest.mark.parametrize("rows_per_file", [7, 40, 10_000])
def test_files_are_the_shuffle(spark, tmp_path, rows_per_file):
    df = spark.range(300).select("id", F.concat(F.lit("q"), F.col("id").cast("string")).alias("question"), F.lit("a\nb").alias("answer"), F.when(F.col("id") % 5 == 0, "val").otherwise("train").alias("split"))
    sinks.write_training(df.repartition(6), str(tmp_path / "t"), ids=["id"], rows_per_file=rows_per_file)
    want = {s: [r.question for r in df.where(f"split = '{s}'").orderBy(shuffle_key(42, "id"), "id").collect()] for s in ("train", "val")}
    for f, text in (("alpaca", lambda x: json.loads(x)["instruction"]), ("sharegpt", lambda x: json.loads(x)["conversations"][0]["content"])):
        got = shuffled.read_in_order(spark, str(tmp_path / "t" / f), ["split"]).collect()
        for s in want:
            mine = sorted((r.position, text(r.value)) for r in got if r["split"] == s)
            assert [p for p, _ in mine] == list(range(1, len(want[s]) + 1)) and [x for _, x in mine] == want[s]
    files = list((tmp_path / "t" / "alpaca" / "split=train").glob("*.json"))
    assert len(files) == min(-(-300 // rows_per_file), len(files)) and (len(files) > 30 if rows_per_file == 7 else True)


def test_order_survives_split_files_and_many_numbers(spark, tmp_path):
    """A file that is read in several blocks, and file numbers of more than five digits."""
    lines = [f"{i:05d}" + "x" * 200 for i in range(3000)]
    (tmp_path / "part-99999-a.json").write_text("\n".join(lines[:2500]) + "\n")
    (tmp_path / "part-100000-a.json").write_text("\n".join(lines[2500:]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        got = shuffled.read_in_order(spark, str(tmp_path)).orderBy("position").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.value for r in got] == lines and [r.position for r in got] == list(range(1, 3001))


def test_prepared_rows_are_written_in_the_order_they_were_split_by(spark, tmp_path):
    docs = spark.createDataFrame([(i, "\n\n".join(f"Topic {i} {j} is explained here in a paragraph of its own, which is long enough to count." for j in range(6)), "s") for i in range(30)], "doc_id long, text string, source string")
    made = prepare.prepare(documents=docs)
    prepare.write(made, str(tmp_path / "out"))
    pairs = made["pairs"].withColumn("k", shuffle_key(42, *prepare.PAIR_IDS[0])).orderBy("k", *prepare.PAIR_IDS[0]).collect()
    got = shuffled.read_in_order(spark, str(tmp_path / "out" / "alpaca"), ["split"]).orderBy("split", "position").collect()
    for s in ("train", "val"):
        assert [json.loads(r.value)["instruction"] for r in got if r["split"] == s] == [r.question for r in pairs if r["split"] == s]
    # the split is a cut through the same order
    assert [r["split"] for r in pairs] == sorted(r["split"] for r in pairs)


def test_null_ids_and_empty_tables(spark, tmp_path):
    df = spark.createDataFrame([(None, "a"), (1, "b"), (None, "c")], "id long, value string")
    shuffled.write_shuffled(df, ["value"], str(tmp_path / "n"), ["id", "value"])
    assert shuffled.read_in_order(spark, str(tmp_path / "n")).count() == 3
    assert len({r.position for r in shuffled.read_in_order(spark, str(tmp_path / "n")).collect()}) == 3
    shuffled.write_shuffled(df.limit(0), ["value"], str(tmp_path / "e"), ["id"])
    assert split_train_val(df.limit(0), ["id"]).count() == 0


SCHEMA = "id string, a int, b string, c struct<x:int>"


def state(store):
    return {r.id: (r.a, r.b, r.c and r.c.x) for r in store.read().collect()}


def test_store_equals_a_dictionary(spark, tmp_path):
    r = random.Random(1)
    store, want = KeyedStore.create(spark, f"file://{tmp_path}/s", SCHEMA, "id", buckets=3), {}
    for step in range(14):
        op, keys = r.choice(("put", "put", "patch", "patch", "delete")), [f"k{r.randint(0, 11)}" for _ in range(5)]
        rows = [(k, r.choice((None, step)), f"{step}", (step,)) for k in dict.fromkeys(keys)]
        if op == "put":
            store.put(spark.createDataFrame(rows, SCHEMA))
            want |= {k: (a, b, c[0]) for k, a, b, c in rows}
        elif op == "patch":
            store.patch(spark.createDataFrame([(k, a) for k, a, *_ in rows], "id string, a int"))
            want |= {k: (a, *want[k][1:]) for k, a, *_ in rows if k in want}
        else:
            store.delete(spark.createDataFrame([(k,) for k, *_ in rows], "id string"))
            want = {k: v for k, v in want.items() if k not in {x[0] for x in rows}}
        if step in (6, 11):
            assert store.compact() and not store.manifest()["deltas"]
        if step % 3 == 0 or step in (6, 11):
            assert state(store) == want == state(KeyedStore(spark, f"file://{tmp_path}/s"))
    assert state(store) == want


def test_a_batch_touches_only_its_delta(spark, tmp_path):
    store = KeyedStore.create(spark, f"file://{tmp_path}/s", "id string, a int", "id", buckets=2)
    store.put(spark.createDataFrame([("x", 1), ("y", 2)], "id string, a int"))
    store.compact()
    files = lambda: {(p, p.stat().st_mtime_ns) for p in (tmp_path / "s").rglob("*") if p.is_file()}
    before = files()
    store.patch(spark.createDataFrame([("x", 5)], "id string, a int"))
    new = {p for p, _ in files() - before}
    assert before <= files() and all("delta-" in str(p) or "manifest" in str(p) for p in new)
    assert store.read(1).collect()[0].a in (1, 2) and {r.id: r.a for r in store.read().collect()} == {"x": 5, "y": 2}
    assert {r.id: r.a for r in store.read(2).collect()} == {"x": 1, "y": 2}  # an older version
    store.compact()
    assert store.vacuum() > 0 and {r.id: r.a for r in store.read().collect()} == {"x": 5, "y": 2} and len(list((tmp_path / "s" / "manifest").glob("*.json"))) == 1


def test_rows_of_a_batch_and_repeated_batches(spark, tmp_path):
    store = KeyedStore.create(spark, f"file://{tmp_path}/s", "id long, a int", "id", buckets=2)
    rows = spark.createDataFrame([(1, 1, 3), (1, 2, 9), (1, 3, 5), (None, 4, 1), (2, 1, 1)], "id long, a int, at int")
    assert store.put(rows, order="at", stream="s", batch=0)
    assert not store.put(rows.withColumn("a", F.lit(7)), stream="s", batch=0)
    assert {r.id: r.a for r in store.read().collect()} == {1: 2, 2: 1}
    assert store.put(rows.withColumn("a", F.lit(7)), stream="s", batch=1) and store.put(rows.limit(0), stream="other", batch=0)
    assert {r.id: r.a for r in store.read().collect()} == {1: 7, 2: 7}


def test_two_writers(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/s"
    one = KeyedStore.create(spark, path, "id long, a int", "id", buckets=2)
    two = KeyedStore(spark, path)
    row = lambda i: spark.createDataFrame([(i, i)], "id long, a int")
    real, busy = KeyedStore._put_text.__func__, []

    def put_text(cls, spark_, at, text):
        if not busy:
            busy.append(1)
            two.put(row(2))  # another writer takes the number first
        return real(cls, spark_, at, text)

    monkeypatch.setattr(KeyedStore, "_put_text", classmethod(put_text))
    one.put(row(1))
    assert {r.id for r in one.read().collect()} == {1, 2} and len(one.manifest()["deltas"]) == 2
    with pytest.raises(FileExistsError):
        KeyedStore.create(spark, path, "id long", "id")
    with pytest.raises(FileNotFoundError):
        KeyedStore(spark, path + "-none")


def test_base_is_read_without_a_shuffle(spark, tmp_path):
    store = KeyedStore.create(spark, f"file://{tmp_path}/s", "id long, a long", "id", buckets=4)
    store.put(spark.range(5000).selectExpr("id", "id as a"))
    store.compact()
    store.patch(spark.range(10).selectExpr("id", "-1L as a"))
    df = store.read()
    assert df.where("a = -1").count() == 10
    plan = df._jdf.queryExecution().executedPlan().toString()
    full = plan[plan.index("SortMergeJoin") :].split("\n")
    scan = next(i for i, x in enumerate(full) if "base_" in x or "bucketed" in x.lower() and "4 out of 4" in x)
    assert not any("Exchange" in x for x in full[: scan + 1])
