"""Sinks: record builders and JSONL writers, and keyed updates of logs and libraries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomline.functions.text import col
from loomline.operators.memory import RECORD
from loomline.sources.shuffled import ROWS_PER_FILE, write_shuffled


def alpaca(question: Column | str = "question", answer: Column | str = "answer") -> list[Column]:
    return [col(question).alias("instruction"), F.lit("").alias("input"), col(answer).alias("output")]


def message(role: str, content: Column | str) -> Column:
    return F.struct(F.lit(role).alias("role"), col(content).alias("content"))


def sharegpt(question: Column | str = "question", answer: Column | str = "answer") -> Column:
    return F.array(message("user", question), message("assistant", answer)).alias("conversations")


def from_scratch(conversations: Column) -> Column:
    """Question: .. Answer: .. of a conversation that starts with a user and an assistant message, both filled; else null."""
    q, a = (F.try_element_at(conversations, F.lit(i)) for i in (1, 2))
    fits = (F.size(conversations) >= 2) & (q["role"] == "user") & (a["role"] == "assistant")
    qt, at = F.trim(F.coalesce(q["content"], F.lit(""))), F.trim(F.coalesce(a["content"], F.lit("")))
    return F.when(fits & (qt != "") & (at != ""), F.concat(F.lit("Question: "), qt, F.lit(" Answer: "), at))


def training_text(conversations: Column) -> Column:
    """Messages that have role and content, every role but user as assistant."""
    kept = F.filter(conversations, lambda m: m["role"].isNotNull() & m["content"].isNotNull())
    return F.transform(kept, lambda m: F.struct(F.when(m["role"] == "user", "user").otherwise("assistant").alias("role"), m["content"].alias("content")))


def write_jsonl(df: DataFrame, path: str, partition_by: Sequence[str] = (), order: Sequence[str] = (), one_file: bool = False) -> None:
    """JSON lines, in order inside each file; one_file is for small exports."""
    out = df.coalesce(1) if one_file else df
    out = out.sortWithinPartitions(*order) if order else out
    writer = out.drop(*(c for c in order if c not in partition_by)).write.mode("overwrite").option("ignoreNullFields", False)
    (writer.partitionBy(*partition_by) if partition_by else writer).json(path)


def write_training(qa: DataFrame, path: str, formats: Sequence[str] = ("alpaca", "sharegpt"), multiturn: DataFrame | None = None, by: Sequence[str] = ("split",),
                   ids: Sequence[str] = (), talk_ids: Sequence[str] = (), seed: int = 42, rows_per_file: int = ROWS_PER_FILE) -> None:
    """{path}/{format}/split=.. for each format, and multiturn with sharegpt. qa: question, answer, split; multiturn: conversations, split.

    ids, talk_ids: columns that tell rows apart; the files are then a seeded shuffle of the rows, the one that
    split_train_val() cuts. Without them rows lie as they come."""
    def put(df: DataFrame, made: Sequence[Column | str], at: str, own: Sequence[str]) -> None:
        if own:
            write_shuffled(df, made, at, own, seed, by, rows_per_file)
        else:
            write_jsonl(df.select(*by, *made), at, by)

    for f in formats:
        put(qa, alpaca() if f == "alpaca" else [sharegpt()], f"{path}/{f}", ids)
    if multiturn is not None and "sharegpt" in formats:
        put(multiturn, ["conversations"], f"{path}/multiturn", talk_ids)


def append_records(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("ignoreNullFields", False).json(path)


def export_approved(log: DataFrame, path: str, seq: str = "seq") -> int:
    """Approved interactions as conversations, oldest first; no file for none."""
    rows = approved_rows(log, seq)
    n = rows.count()
    if n:
        write_jsonl(rows.sort("_seq"), path, order=["_seq"])
    return n


def long_term_records(records: DataFrame) -> DataFrame:
    """Scored records in the archive's shape: id, tier, relevance, score_detail, record."""
    parts = ("frequency", "complexity", "effectiveness", "feedback")
    detail = F.create_map(*(x for p in parts for x in (F.lit(p), F.col(p))))
    fields = [c.split()[0] for c in RECORD.split(", ") if c.split()[0] in records.columns]
    return records.select("id", F.lit("long_term").alias("tier"), "relevance", detail.alias("score_detail"), F.struct(*fields).alias("record"))


def carve_validation(train: DataFrame, val: DataFrame | None, ids: Sequence[str], ratio: float = 0.15, seed: int = 42) -> DataFrame:
    """train and val as one table with `split`; without a validation set one is carved from a shuffle of train."""
    from loomline.operators.curation import split_train_val

    if val is not None:
        return train.withColumn("split", F.lit("train")).unionByName(val.withColumn("split", F.lit("val")))
    return split_train_val(train, ids, ratio, seed)


def upsert(old: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """Rows by key, the latest by order."""
    w = Window.partitionBy(key).orderBy(F.desc(order), F.desc("_new"))
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return both.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_new")


def delete(old: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return old.join(keys.select(key).distinct(), key, "left_anti")


def library_stats(index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(totals, by category) of a library index; an empty category is general."""
    kind = F.when(F.coalesce("category", F.lit("")) == "", "general").otherwise(F.col("category")).alias("category")
    return index.agg(F.count("*").alias("total_patterns"), F.coalesce(F.sum("qa_count"), F.lit(0)).alias("total_qa_pairs")), index.groupBy(kind).agg(F.count("*").alias("n"))


def snapshot(spark: SparkSession, source: str, target: str) -> None:
    """A copy of a dataset's folder, file by file, by the store that holds it; an older copy at the target gives way."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    a, b = (jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    if not a.getFileSystem(conf).exists(a):
        raise FileNotFoundError(source)
    b.getFileSystem(conf).delete(b, True)
    jvm.org.apache.hadoop.fs.FileUtil.copy(a.getFileSystem(conf), a, b.getFileSystem(conf), b, False, conf)


def restore(spark: SparkSession, saved: str, target: str) -> None:
    """The dataset's folder as it was at the snapshot."""
    snapshot(spark, saved, target)


def union_sources(**sources: DataFrame) -> DataFrame:
    """All rows with `origin`, the name they are given under; columns that a source lacks are null."""
    out = None
    for name, df in sources.items():
        rows = df.withColumn("origin", F.lit(name))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def approved_rows(log: DataFrame, seq: str = "seq") -> DataFrame:
    """What export_approved() writes, with its order."""
    return log.where(F.col("approved").eqNullSafe(True)).select(F.col(seq).alias("_seq"), sharegpt())


def concat_jsonl(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """The non-blank lines of all, as they are."""
    for r in rest:
        first = first.unionByName(r)
    return first.where(F.trim("value") != "")
