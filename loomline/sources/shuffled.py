"""Files in one global order: training rows lie in files as a seeded shuffle has them, and are read back with their places.

The order's key is a hash, so its values are spread evenly and a row's file follows from the key's leading digits: no
sample is taken, no range is uneven, and rows are sorted only inside their file. Reading files by number, and each from
top to bottom, gives the whole order, at any size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomline.operators.curation import shuffle_key

ROWS_PER_FILE = 100_000


def file_number(key: Column, files: int) -> Column:
    """The file of a row with this key (hexadecimal): files split the key's values into equal ranges."""
    return F.least(F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("double") / 2.0**32 * files).cast("int"), F.lit(files - 1))


def in_order(df: DataFrame, ids: Sequence[str], seed: int = 42, by: Sequence[str] = (), rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """df dealt and sorted so that its partitions, one after another, are the seeded shuffle of its rows by `ids` (for each value of `by`); ties go by ids. A null id counts as one that comes first."""
    files = max(1, -(-df.count() // rows_per_file))
    keyed = df.withColumn("_key", shuffle_key(seed, *ids))
    return keyed.repartitionById(files, file_number(F.col("_key"), files)).sortWithinPartitions(*by, "_key", *ids).drop("_key")


def write_shuffled(df: DataFrame, columns: Sequence[Column | str], path: str, ids: Sequence[str], seed: int = 42, by: Sequence[str] = (), rows_per_file: int = ROWS_PER_FILE) -> None:
    """JSON lines of `columns` under path (in folders by `by`), in the order of in_order()."""
    out = in_order(df, ids, seed, by, rows_per_file).select(*by, *columns).write.mode("overwrite").option("ignoreNullFields", False)
    (out.partitionBy(*by) if by else out).json(path)


def read_in_order(spark: SparkSession, path: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, position, value): each line of the text files under path with its place, from 1, over all files in order of their numbers. Only counts of lines a block of a file meet in one window."""
    at = ["_number", "_file", "_block"]
    # inside a partition of the scan, lines of one block are numbered as they lie
    lines = spark.read.text(path).select(*by, "value", F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("long").alias("_number"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"))
    counts = lines.groupBy(*by, *at).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*by).orderBy(*at).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(*(F.col(c).alias(f"{c}_") for c in (*by, *at)), before.alias("_before"))
    same = F.lit(True)
    for c in (*by, *at):
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_"))
    inside = F.row_number().over(Window.partitionBy(*by, *at).orderBy("_id"))
    return lines.withColumn("_in", inside).join(counts, same).select(*by, (F.col("_before") + F.col("_in")).alias("position"), "value")
