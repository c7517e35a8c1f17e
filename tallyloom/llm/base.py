"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words: space and the control characters tab to carriage return.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def crc_of_id(doc_id: Column) -> Column:
    """crc32 of the id printed as text; the documented splits take it modulo a small number."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def partitions_for(spark: SparkSession, rows: int, per_partition: int) -> int:
    """Partitions for so many rows, and at least as many as the session shuffles into."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / per_partition), 1)


def text_mark(text: Column) -> Column:
    """A 64-bit mark that, next to the id, names a row by its text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like the wanted ones that `df` does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def keep_listed(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """One row of `docs` for each of the distinct `keys` (doc_id, mark), with the columns of `docs`, whatever their names.

    Rows of one id and one text are repeats, of which one stays; only those are shuffled to be told apart.
    An empty table gives an empty result.
    """
    mark, left, right = free_names(docs, "mark", "key_id", "key_mark")
    named = docs.withColumn(mark, text_mark(F.col("text")))
    keys = keys.select(F.col("doc_id").alias(left), F.col("mark").alias(right))

    def on(other: DataFrame, how: str) -> DataFrame:
        return named.join(other, F.col("doc_id").eqNullSafe(F.col(left)) & (F.col(mark) == F.col(right)), how)

    counts = named.groupBy(F.col("doc_id").alias(left), F.col(mark).alias(right)).agg(F.count(F.lit(1)).alias("n"))
    repeats = counts.filter("n > 1").drop("n")
    if repeats.isEmpty():
        return on(keys, "left_semi").drop(mark)
    once = on(keys.exceptAll(keys.intersect(repeats)), "left_semi")
    more = on(keys.intersect(repeats), "left_semi").dropDuplicates(["doc_id", mark])
    return once.unionByName(more).drop(mark)
