"""File inventory and tables read from files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import hashing, text
from tallyloom.operators import intake, ordered
from tallyloom.settings import DEFAULTS, Settings


def relative_path(path: Column, root: str) -> Column:
    """Path below the imports folder, escapes undone."""
    tail = F.regexp_replace(path, "^" + text.quoted(_uri(root)) + "/+", "")
    return F.url_decode(F.replace(tail, F.lit("+"), F.lit("%2B")))


def _uri(root: str) -> str:
    root = root.rstrip("/")
    return root if "://" in root or root.startswith("file:") else f"file:{root}"


def inventory(raw: DataFrame, root: str, cfg: Settings = DEFAULTS) -> DataFrame:
    """(relative_path, filename, stage, sha256, size, content) of binaryFile rows, eligible files only.

    Spark's file listing already leaves out empty files and names starting with "." or "_".
    """
    rel = relative_path(F.col("path"), root)
    stage = F.lit(None).cast("string")
    for folder, name in cfg.stage_folders.items():
        if name in cfg.stages:
            stage = F.when(F.substring_index("relative_path", "/", 1) == folder, name).otherwise(stage)
    named = raw.withColumn("relative_path", rel).withColumn("filename", text.file_name(F.col("relative_path")))
    hidden = F.rlike(F.col("relative_path"), F.lit(r"/\."))
    return (
        named.withColumn("stage", stage)
        .where(F.col("stage").isNotNull() & F.contains("relative_path", F.lit("/")) & ~hidden)
        .where(intake.eligible(F.col("filename"), F.col("length")))
        .select(
            "relative_path", "filename", "stage", hashing.sha256(F.col("content")).alias("sha256"),
            F.col("length").alias("size"), "content",
        )
    )


def discover(spark: SparkSession, root: str, cfg: Settings = DEFAULTS) -> DataFrame:
    """Inventory of the imports folder, in no order. Drop `content` before any join."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return inventory(raw, root, cfg)


def discover_stream(spark: SparkSession, root: str, cfg: Settings = DEFAULTS) -> DataFrame:
    """The same inventory as a stream of arriving files."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    raw = (
        spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true").load(root)
    )
    return inventory(raw, root, cfg)


def text_content(files: DataFrame) -> DataFrame:
    """(source_file, content, valid): bytes as text; invalid bytes are replaced, and `valid` is then false."""
    raw = F.col("content").cast("string")
    return files.select(
        F.col("relative_path").alias("source_file"), F.make_valid_utf8(raw).alias("content"), F.is_valid_utf8(raw).alias("valid")
    )


def with_position(df: DataFrame) -> DataFrame:
    """`pos` in file order for a table read from one file or few."""
    return df.withColumn("pos", F.monotonically_increasing_id())


def read_dimension(spark: SparkSession, path: str, columns: dict[str, str], key: str) -> DataFrame:
    """CSV dimension: header names mapped to columns, values trimmed, empty keys out, first row per key."""
    raw = with_position(spark.read.option("header", "true").option("multiLine", "true").csv(path))
    named = raw.select("pos", *[F.trim(F.coalesce(F.col(f"`{h}`"), F.lit(""))).alias(c) for h, c in columns.items()])
    return first_rows(named, key)


def first_rows(named: DataFrame, key: str) -> DataFrame:
    return ordered.first_per_key(named.where(F.col(key) != ""), [key], [F.col("pos")])
