"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints come from XXH64 of word shingles, by majority of bits. Bit i of a fingerprint gets a nonzero
vector m(i) of radius + 1 bits. Table v (one for each nonzero vector v) keeps the bits with <m(i), v> odd.
Two fingerprints that differ in at most `radius` bits collide in some table: that many vectors m(i) leave
a nonzero v that is orthogonal to all of them.

Within a bucket only the left-out bits can differ. A pair at distance 1 or 2 is found there without
pairing all members: each member stands at its own value and at its values with one left-out bit
flipped, and members that share a value are at most two bits apart. Each value links its members to
the smallest one. So links within a bucket grow with its members, not with their square.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.durable import Scratch
from tallyloom.llm.base import keep_listed, table, text_mark
from tallyloom.llm.components import components
from tallyloom.llm.registry import query

SHINGLE = 3
SEED = 42
RADIUS = 2
#: Hashes whose bits are summed at once; bounds memory for very long texts.
SLAB = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Signed 64-bit SimHash of one text; 0 for a null text or one without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line, take = b" ".join(words), min(shingle, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(words) - take + 1].tolist()
    ends = ends[take - 1:].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), SLAB):
        hashes = [xxhash.xxh64_intdigest(line[a:b], seed) for a, b in zip(starts[at:at + SLAB], ends[at:at + SLAB])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [fingerprint(x.as_py()) for x in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("mark"), pa.array(found, pa.int64())], ["doc_id", "mark", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, fp) for every row; texts are read whole. mark is a hash of the text as it is."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_mark(F.col("text")).alias("mark"), "text").mapInArrow(_fingerprints, f"doc_id {kind}, mark long, fp long")


def masks(radius: int = RADIUS) -> list[int]:
    """One mask per nonzero v: the bits that its table keeps. m(i) runs through all nonzero vectors."""
    top = 1 << (radius + 1)
    chosen = [1 + i % (top - 1) for i in range(64)]
    return [sum(1 << i for i in range(64) if bin(chosen[i] & v).count("1") % 2) for v in range(1, top)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(values: DataFrame) -> DataFrame:
    """(a, b) links among distinct fingerprints `fp`, every pair of at most two differing bits connected.

    Directly linked rows differ in 1 or 2 bits. Pairs of a common neighbour are joined through its
    smallest member, so the links are as few as the members of shared values.
    """
    tables = F.explode(F.array(*[F.struct(F.lit(v).alias("v"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for v, m in enumerate(masks())]))
    cells = values.select("fp", tables.alias("t")).select("fp", "t.v", "t.key")
    shared = cells.groupBy("v", "key").count().filter("count > 1").drop("count")
    members = cells.join(shared, ["v", "key"])
    left_out = {v: [_signed(1 << i) for i in range(64) if not m >> i & 1] for v, m in enumerate(masks())}
    flips = F.element_at(F.array(*[F.array(F.lit(0).cast("long"), *[F.lit(x).cast("long") for x in left_out[v]]) for v in sorted(left_out)]), F.col("v") + 1)
    near = members.select("fp", "v", F.explode(flips).alias("flip")).select("v", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("value"))
    stars = near.groupBy("v", "value").agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)
    return stars.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a <> b").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Fingerprint and component of every row: doc_id, mark, fp (signed long), root, component_id.

    Two documents are linked if their fingerprints differ in at most two bits; component_id is the
    smallest doc_id reachable, itself included. `root`, a fingerprint, names the component itself: ids that
    are null or stand for several texts are no name. Null and empty texts have fingerprint 0 and are linked
    like any other. Rows with a null doc_id keep their fingerprint; their component is the smallest
    id among the others there, or null. Repeated rows are returned as often as given. Other columns
    are ignored; an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.write(fingerprints(docs), "fingerprints")
    values = scratch.write(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "values")
    roots = components(links(values.select("fp")), scratch)
    held = values.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    held = scratch.write(held, "roots")
    named = held.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = scratch.write(held.join(named, "root").select("fp", "root", "component_id"), "classes")
    return rows.join(classes, "fp").select("doc_id", "mark", "fp", "root", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The row of `docs` with the smallest doc_id of each component, with all its columns.

    A component of null doc_ids keeps one of its rows too. A doc_id of two texts far apart stays twice.
    """
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("doc_id"), F.col("mark").alias("mark")))
    kept = near_duplicates(docs).groupBy("root").agg(first.alias("one"))
    return keep_listed(docs, kept.select("one.doc_id", "one.mark"))


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


@query("op9_simhash_near_dedup")
def op9_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = near_duplicates(table(spark, folder, "documents"))
    return out.select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id")
