"""Mixing sources to target weights; DataFrame functions only.

The words of each source, laid end to end, form blocks of a fixed length. Each source gets as many
words as its target asks for: whole rounds over all its blocks, then part of another round. How many
slots of each source a shard of the output holds is a multinomial draw, made so that the slots of a source
add up to its target; the shards then take the slots of a source one after another. Slot i of a source holds
block perm(i mod n) of its round i div n, where perm is a keyed permutation of the source's n block
numbers (swap-or-not rounds, so any n works and nothing is sorted). Slots and blocks are joined by block
number. Inside a shard the slots of all sources stand in one random order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.durable import Scratch
from tallyloom.llm.base import WORD, free_names, partitions_for, table, text_mark
from tallyloom.llm.registry import query

BLOCK_WORDS = 1024
WEIGHTS = (5, 2, 1)
MOST_ROUNDS = 3
SEED = 20
SWAPS = 24
#: Rows of one stretch of a source: the running totals of a stretch are taken in one task.
STRETCH_ROWS = 4000
#: Slots numbered by one task.
CHUNK = 5_000
#: Words written by one task, about.
TASK_WORDS = 1 << 22
#: Bits of a place left out to name its stretch: 64 stretches to a shard.
STRETCH_BITS = 58


def n_words(text: Column) -> Column:
    """Words of a text, counted as starts of words."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_ROUNDS) -> DataFrame:
    """(source, source_size, weight) plus target: shares by weight of all sizes, none above `most` times its size.

    Sources are ordered by code point, null last; weights repeat along that order. What lies above a
    limit is shared again by weight. The rule ends at one level t with target = min(limit, t * weight):
    ordered by limit / weight, the limits met so far and the weights left give t at each place.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights)
    x = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (place + 1).cast("int")))
    x = x.withColumn("limit", F.col("source_size") * most).withColumn("ratio", F.col("limit") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything)
    t = (total - F.coalesce(F.sum("limit").over(before), F.lit(0))) / F.sum("weight").over(after)
    x = x.withColumn("t", t).withColumn("level", F.max(F.when(F.col("t") <= F.col("ratio"), F.col("t"))).over(everything))
    target = F.when(F.col("t") <= F.col("ratio"), F.col("level") * F.col("weight")).otherwise(F.col("limit"))
    return x.select("source", "source_size", "weight", F.coalesce(target, F.lit(0)).cast("double").alias("target"))


def permuted(index: Column, n: Column, key: Column, seed: int = SEED, swaps: int = SWAPS) -> Column:
    """A keyed permutation of 0 .. n-1: in each round, index and its mirror trade places or not."""

    def swap(x: Column, r: Column) -> Column:
        turn = F.pmod(F.xxhash64(F.lit(seed), r, key), n)
        other = F.pmod(turn - x + n, n)
        coin = F.xxhash64(r, key, F.greatest(x, other), F.lit(seed)).bitwiseAND(F.lit(1))
        return F.when(coin == 1, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(swaps)), index.cast("long"), swap)


def shard_counts(plan: DataFrame, shards: int, seed: int = SEED, partitions: int = 8) -> DataFrame:
    """(source_no, shard, n, first): slots of each source that a shard takes, and the number of the first of them.

    plan: source_no, count. Each of the `count` slots of a source is one draw among equally likely shards, so its counts
    are multinomial and add up to `count`; the counts of a shard vary around the shares of the sources. Only counts are
    kept of the draws, added up before they are shuffled.
    """
    chunks = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(count - 1) div {CHUNK}")))
    x = plan.select("source_no", "count", chunks.alias("chunk")).repartition(partitions, "source_no", "chunk")
    first = F.col("chunk") * CHUNK
    x = x.select("source_no", F.explode(F.sequence(first, F.least(first + CHUNK, F.col("count")) - 1)).alias("draw"))
    drawn = x.select("source_no", F.pmod(F.xxhash64(F.lit(seed), "source_no", "draw"), F.lit(shards)).alias("shard"))
    counts = drawn.groupBy("source_no", "shard").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))


def slots(plan: DataFrame, block_words: int = BLOCK_WORDS, seed: int = SEED, shards: int = 1, partitions: int = 8) -> DataFrame:
    """One row per slot of the mix: source, source_no, slot, round, block, words (used of the block), shard, place.

    plan: source, source_no, source_size, want (words). The last slot of a source may use part of its block. A shard
    holds the slots of a source that shard_counts() gives it; `place` orders all slots of a shard.
    """
    n = F.ceil(F.col("source_size") / block_words)
    x = plan.filter("source_size > 0 AND want > 0").withColumn("n", n)
    # Words of the whole rounds, and of the part round that follows them.
    x = x.withColumn("rounds", F.expr("want div source_size"))
    # Blocks of the part round: enough that even a short last block among them leaves no gap.
    rest = F.col("want") - F.col("rounds") * F.col("source_size")
    part = F.when(rest > 0, F.least(F.col("n"), F.ceil(rest / block_words) + 1)).otherwise(0)
    x = x.withColumn("rest", rest).withColumn("count", F.col("rounds") * F.col("n") + part)
    counts = shard_counts(x, shards, seed, partitions).withColumnsRenamed({"source_no": "no", "n": "taken"})
    x = x.join(counts, F.col("source_no") == F.col("no")).drop("no")
    chunks = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(taken - 1) div {CHUNK}")))
    x = x.withColumn("chunk", chunks).repartition(partitions, "source_no", "shard", "chunk")
    begin = F.col("first") + F.col("chunk") * CHUNK
    x = x.withColumn("slot", F.explode(F.sequence(begin, F.least(begin + CHUNK, F.col("first") + F.col("taken")) - 1)))
    x = x.withColumn("round", F.expr("slot div n")).withColumn("turn", F.expr("slot % n"))
    x = x.withColumn("block", permuted(F.col("turn"), F.col("n"), F.xxhash64("source_no", "round"), seed))
    last = F.col("n") - 1
    short = F.col("source_size") - last * block_words
    size = F.when(F.col("block") == last, short).otherwise(block_words)
    # In the part round, words before this slot: full blocks, less the gap if the short block came before.
    x = x.withColumn("at_last", _turn_of_last(n, seed))
    ahead = F.col("turn") * block_words - F.when(F.col("turn") > F.col("at_last"), block_words - short).otherwise(0)
    used = F.when(F.col("round") < F.col("rounds"), size).otherwise(F.greatest(F.lit(0), F.least(size, F.col("rest") - ahead)))
    x = x.withColumn("words", used.cast("long")).filter("words > 0")
    place = F.xxhash64(F.lit("place"), F.lit(seed), "source_no", "slot")
    return x.select("source", "source_no", "slot", "round", "block", "words", "shard", place.alias("place"))


def _turn_of_last(n: Column, seed: int) -> Column:
    """The turn at which the part round reaches the last block: the swaps undone in reverse order."""
    key = F.xxhash64(F.col("source_no"), F.col("rounds"))

    def swap(x: Column, r: Column) -> Column:
        turn = F.pmod(F.xxhash64(F.lit(seed), r, key), n)
        other = F.pmod(turn - x + n, n)
        coin = F.xxhash64(r, key, F.greatest(x, other), F.lit(seed)).bitwiseAND(F.lit(1))
        return F.when(coin == 1, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(SWAPS), F.lit(1), F.lit(-1)), (n - 1).cast("long"), swap)


def layout(docs: DataFrame, rows: int, stretch: int = STRETCH_ROWS) -> DataFrame:
    """Places the rows (doc_id, source, size) of each source end to end: adds `start`, the words before.

    Rows fall into stretches by a hash of their id; inside a stretch they follow the id. Totals of
    stretches are added up over the few summary rows, so no source is ever ordered in one task.
    """
    count = max(1, rows // stretch)
    x = docs.withColumn("stretch", F.pmod(F.xxhash64("doc_id", "copy"), F.lit(count))).repartition(F.col("stretch"))
    inside = Window.partitionBy("stretch", "source").orderBy("doc_id", "copy").rowsBetween(Window.unboundedPreceding, -1)
    sums = docs.withColumn("stretch", F.pmod(F.xxhash64("doc_id", "copy"), F.lit(count))).groupBy("source", "stretch").agg(F.sum("size").alias("s"))
    before = Window.partitionBy("source").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("src"), F.col("stretch").alias("st"), F.coalesce(F.sum("s").over(before), F.lit(0)).alias("base"))
    x = x.withColumn("own", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    out = x.join(sums, F.col("source").eqNullSafe(F.col("src")) & (F.col("stretch") == F.col("st")))
    return out.withColumn("start", F.col("base") + F.col("own")).drop("src", "st", "stretch", "own", "base")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_ROUNDS, block_words: int = BLOCK_WORDS,
        seed: int = SEED, shard_words: int = 1 << 24) -> dict[str, DataFrame]:
    """The mix of a table with doc_id, text, source: tables `plan`, `slots`, `pieces` and `docs`.

    plan: one row per source (source, source_no, source_size, weight, target, want). slots: see slots().
    pieces: the words each slot takes of each document (doc_id, mark, copy, round, first, words, shard, slot, place),
    `first` counted from the document's start. docs: one row per input row with size, source_size, target, taken.
    A source's taken words are its rounded target exactly; no row is taken more than `most` times.
    Null texts have size 0. Rows without doc_id take part like others; repeated rows count each. A null
    source is a source of its own. Empty tables give empty results. Reruns give the same rows.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), text_mark(F.col("text")).alias("mark"))
    # Equal rows are told apart by their number among them, other rows of one id by text and source.
    each = scratch.write(sized.groupBy("doc_id", "source", "size", "mark").agg(F.count(F.lit(1)).alias("copies")), "sizes")
    rows = each.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copies")
    rows = rows.withColumn("copy", F.xxhash64("copy", "size", "mark", "source"))
    placed = scratch.write(layout(rows, each.count()), "layout")
    sizes = each.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    plan = targets(sizes, weights, most)
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long")
    want = F.least(F.round("target").cast("long"), F.col("source_size") * most)
    plan = scratch.write(plan.withColumn("source_no", number).withColumn("want", want), "plan")
    total = plan.agg(F.sum("want")).first()[0] or 0
    partitions = partitions_for(docs.sparkSession, total // block_words, CHUNK)
    made = scratch.write(slots(plan, block_words, seed, max(1, total // shard_words), partitions), "slots")
    numbered = placed.join(plan.select(F.col("source").alias("src"), "source_no"), F.col("source").eqNullSafe(F.col("src"))).drop("src")
    last = F.expr(f"(start + size - 1) div {block_words}")
    cells = numbered.filter("size > 0").withColumn("block", F.explode(F.sequence(F.expr(f"start div {block_words}"), last)))
    used = made.select("source_no", "block", "slot", "round", "words", "shard", "place")
    cut = cells.join(used, ["source_no", "block"])
    low = F.greatest(F.col("start"), F.col("block") * block_words)
    high = F.least(F.col("start") + F.col("size"), F.col("block") * block_words + F.col("words"))
    pieces = cut.select("doc_id", "mark", "source", "copy", "source_no", "round", "shard", "slot", "place", (low - F.col("start")).alias("first"), (high - low).alias("words")).filter("words > 0")
    taken = pieces.groupBy("doc_id", "copy", "source_no").agg(F.sum("words").alias("taken"))
    taken = taken.withColumnsRenamed({"doc_id": "d", "copy": "c", "source_no": "s"})
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("copy") == F.col("c")) & (F.col("source_no") == F.col("s"))
    shares = plan.select(F.col("source_no").alias("no"), "source_size", "target")
    out = numbered.join(taken, same, "left").join(shares, F.col("source_no") == F.col("no"))
    out = out.select("doc_id", "source", "copy", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    return {"plan": plan, "slots": made, "pieces": pieces, "docs": out}


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, with the columns of `docs`: one row for each document and round that takes words of it.

    A round that takes a document whole returns its text as it is; otherwise the words taken, in order,
    joined by one space. n_chars, if present, follows the text. Columns may have any names; an empty table gives an
    empty mix. Rows are laid out by shard and place: each stands where the first of its slots does, and a partition
    holds whole stretches of shards in order.
    """
    made = mix(docs, **options)
    pieces = made["pieces"]
    at = F.min(F.struct("shard", "place")).alias("at")
    parts = pieces.groupBy("doc_id", "mark", "source", "copy", "round").agg(F.array_sort(F.collect_list(F.struct("first", "words"))).alias("parts"), F.sum("words").alias("taken"), at)
    takes = parts.groupBy("doc_id", "mark", "source").agg(F.collect_list(F.struct("parts", "taken", "at")).alias("takes"))
    own, left, right, where, take, every = free_names(docs, "mark", "key_id", "key_mark", "key_source", "take", "takes")
    takes = takes.withColumnsRenamed({"doc_id": left, "mark": right, "source": where, "takes": every})
    keys = ["doc_id", own, "source"]
    named = docs.withColumn(own, text_mark(F.col("text")))
    counts = named.groupBy(F.col("doc_id").alias(left), F.col(own).alias(right), F.col("source").alias(where)).agg(F.count(F.lit(1)).alias("n"))
    repeats = counts.filter("n > 1").drop("n")
    same = F.col("doc_id").eqNullSafe(F.col(left)) & (F.col(own) == F.col(right)) & F.col("source").eqNullSafe(F.col(where))
    if not repeats.isEmpty():
        named = named.join(repeats, same, "left_anti").unionByName(named.join(repeats, same, "left_semi").dropDuplicates(keys))
    rows = named.join(takes, same).withColumn(take, F.explode(every))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    some = F.array_join(F.flatten(F.transform(F.col(take)["parts"], lambda p: F.slice(words, p["first"].cast("int") + 1, p["words"].cast("int")))), " ")
    out = rows.withColumn("text", F.when(F.col(take)["taken"] == n_words(F.col("text")), F.col("text")).otherwise(some))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    total = made["plan"].agg(F.sum("want")).first()[0] or 0
    place = F.col(take)["at"]["place"]
    laid = out.repartition(partitions_for(docs.sparkSession, total, TASK_WORDS), F.col(take)["at"]["shard"], F.shiftrightunsigned(place, STRETCH_BITS))
    return laid.sortWithinPartitions(F.col(take)["at"]).select(*docs.columns)


@query("op8_mix_sources")
def op8_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    out = mix(table(spark, folder, "documents"))["docs"]
    return out.select("doc_id", "size", "source_size", "target", "taken")
