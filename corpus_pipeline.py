"""A corpus pipeline over documents: toxicity, near-duplicates, personal data, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm import minhash_dedup, mixing, packing, pii, toxicity
from loomline.llm.textops import drop_path, fresh_path, quoted, stored


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model takes for toxic go; it is fitted on the labelled rows of the documents table.

    Null and empty texts are judged by the thresholds alone, equal texts alike, rows without a doc_id like others; without labels nobody goes.
    """
    model = toxicity.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.clean_rows(docs, model)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays, the one with the least doc_id (null last), then the least hashes of all columns.

    Rows are told by numbers given to them in a written copy, so rows without a doc_id take part, and rows that share a
    doc_id stay apart unless their texts are near-duplicates. Rows without words have none, but of rows alike in every
    column one stays.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]  # columns of any name
    row = [F.monotonically_increasing_id().alias("id"), F.xxhash64(*map(quoted, docs.columns)).alias("k1"), F.xxhash64(F.lit("b"), *map(quoted, docs.columns)).alias("k2")]
    rows = stored(docs.select(*row, "doc_id", "text", *(F.col(quoted(c)).alias(n) for c, n in zip(docs.columns, names) if c != "text")), fresh_path(spark, "pipeline-rows"), compression="zstd")
    found = minhash_dedup.near_duplicates(rows, "id").withColumnRenamed("doc_id", "id")
    words = F.col("n_shingles") > 0
    group = [F.when(words, F.col("component_id")).alias("component"), F.when(~words, F.col("k1")).alias("g1"), F.when(~words, F.col("k2")).alias("g2")]
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2", "id")
    kept = rows.select("id", "k1", "k2", "doc_id").join(found, "id").groupBy(*group).agg(F.min(order).alias("least")).select("least.id")
    # ids grow with the documents: the same join at every size
    return rows.join(kept.hint("merge"), "id", "left_semi").select(*(F.col("text" if c == "text" else n).alias(c) for c, n in zip(docs.columns, names)))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to its kind; n_chars follows the text. Null texts stay null, no row goes."""
    found = pii.redact_column(docs, pii.trained())
    return found.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")).select(*map(quoted, docs.columns))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; one without words stays once. Ties go by hashes of the row; a null source is a source."""
    return mixing.mix_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences; a null or empty text is its end id alone, each repeat a document of its own."""
    return packing.pack(docs)


STAGES = [("toxicity", toxicity_stage), ("near_duplicates", dedup_stage), ("pii", pii_stage), ("mixing", mixing_stage), ("packing", packing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage but the last is written as Parquet in the shared folder and read again; a stage's table goes when the next one is written. An empty documents table gives no rows."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, f"pipeline-{name}")
        docs = stored(stage(spark, docs, sf_dir), path)
        if before:
            drop_path(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)


#: Byte-pair tokens are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None
