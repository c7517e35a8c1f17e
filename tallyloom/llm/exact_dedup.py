"""Exact dedup by deterministic block naming; DataFrame functions only.

Every normalised text is cut into blocks of a fixed length. The distinct blocks are sorted into
integer names; then adjacent pairs of names are named in turn, level by level, until every document
has one name. Two documents share level and name exactly if their normalised texts are equal.

The text is shuffled once, as distinct blocks per map task. Blocks travel under a 64-bit hash; each
hash keeps the set of texts it stands for, and if one ever stands for two texts, naming starts over
with another hash, so names are free of collisions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.durable import Scratch
from tallyloom.llm.base import SPACE, keep_listed, table, text_mark
from tallyloom.llm.registry import query

BLOCK_CHARS = 4096


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")


def block_hash(block: Column, attempt: int) -> Column:
    return F.xxhash64(block) if attempt == 0 else F.xxhash64(F.lit(attempt), block)


def _blocks(text: Column, chars: int) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % chars), F.lit(0))


def identities(docs: DataFrame, block_chars: int = BLOCK_CHARS, hashing: Callable[[Column, int], Column] = block_hash,
               scratch: Scratch | None = None) -> DataFrame:
    """One row per input row: row, doc_id, n_code, mark, text_sha256, level, name.

    Rows are equal in level and name exactly if their texts are equal without white space. A null
    text counts as empty; empty texts share level -1. `row` tells repeated rows apart.
    """
    scratch = scratch or Scratch(docs.sparkSession, "naming")
    text = docs.select("doc_id", "text")
    attempt = 0
    while True:
        blocks = text.select(F.explode(_blocks(normalised(F.col("text")), block_chars)).alias("block"))
        sets = blocks.groupBy(hashing(F.col("block"), attempt).alias("h")).agg(F.collect_set("block").alias("texts"))
        named = sets.sortWithinPartitions("h").select("h", F.monotonically_increasing_id().alias("name"),
                                                      F.size("texts").alias("texts"))
        names = scratch.write(named, "block-names")
        if names.filter("texts > 1").isEmpty():
            break
        attempt += 1
    each = text.select("doc_id", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_code"), text_mark(F.col("text")).alias("mark"),
                       normalised(F.col("text")).alias("t"))
    hashes = F.transform(_blocks(F.col("t"), block_chars), lambda b: hashing(b, attempt))
    start = scratch.write(each.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_code", "mark",
                                      F.sha2("t", 256).alias("text_sha256"), hashes.alias("hashes")), "hashes")
    cells = start.select("row", F.posexplode("hashes").alias("pos", "h")).join(names.select("h", "name"), "h")
    level, done = 0, None
    while True:
        rows = cells.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("pos", "name"))).alias("cells"))
        state = scratch.write(rows.select("row", F.col("cells.name").alias("names")), f"level-{level}")
        ended = state.filter(F.size("names") == 1).select("row", F.lit(level).alias("level"), F.col("names")[0].alias("name"))
        done = ended if done is None else done.union(ended)
        more = state.filter(F.size("names") > 1)
        if more.isEmpty():
            break
        half = F.sequence(F.lit(0), F.floor((F.size("names") - 1) / 2).cast("int"))
        pairs = more.select("row", F.posexplode(F.transform(half, lambda i: F.struct(
            F.get("names", i * 2).alias("left"), F.coalesce(F.get("names", i * 2 + 1), F.lit(-1)).alias("right")))))
        pairs = pairs.select("row", "pos", "col.left", "col.right")
        distinct = pairs.select("left", "right").distinct().sortWithinPartitions("left", "right")
        names = scratch.write(distinct.withColumn("name", F.monotonically_increasing_id()), f"pair-names-{level}")
        cells = pairs.join(names, ["left", "right"]).select("row", "pos", "name")
        level += 1
    empty = start.filter(F.size("hashes") == 0).select("row", F.lit(-1).alias("level"), F.lit(0).cast("long").alias("name"))
    found = scratch.write(done.union(empty), "identities")
    return start.drop("hashes").join(found, "row")


def dedup(docs: DataFrame, **options) -> DataFrame:
    """The documents of equal text and the one that stays: most code points, then smallest doc_id.

    Returns one row per input row: doc_id, keep_id, group_size, kept, text_sha256 (of the text without
    white space) and mark, a hash of the text as it is. Null texts count as empty. A null doc_id comes after all others. Of repeated rows
    exactly one stays. Other columns are ignored. An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    rows = scratch.write(identities(docs, scratch=scratch, **options), "named")
    order = F.struct((-F.col("n_code")).alias("n"), F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("id"), F.col("row").alias("row"))
    groups = rows.groupBy("level", "name").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("group_size"))
    groups = scratch.write(groups, "groups")  # so that the join can split the rows of a hot group
    out = rows.join(groups, ["level", "name"])
    return out.select("doc_id", F.col("best.id").alias("keep_id"), "group_size",
                      (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256", "mark")


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all their columns."""
    return keep_listed(docs, dedup(docs).filter("kept").select("doc_id", "mark"))


SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
k AS (SELECT norm, arg_min(doc_id, (-n, doc_id)) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM t JOIN k USING (norm)
"""


@query("op3_exact_dedup", SQL)
def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup(table(spark, folder, "documents")).drop("mark")
