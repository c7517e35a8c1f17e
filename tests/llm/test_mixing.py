import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from tallyloom.llm import mixing
from tallyloom.llm.catalog import QUERIES


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """sizes: {source: words}; excess over the limits is shared again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed.update({s: most * sizes[s] for s in over})


def test_query_meets_targets(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in docs}
    source = {r.doc_id: r.source for r in docs}
    sizes = Counter()
    for d, n in size.items():
        sizes[source[d]] += n
    want = plain_targets(sizes)
    got = {r.doc_id: r for r in QUERIES["op8_mix_sources"](spark, folder).collect()}
    again = {r.doc_id: r for r in QUERIES["op8_mix_sources"](spark, folder).collect()}
    assert got == again and got.keys() == size.keys()
    taken = Counter()
    for d, r in got.items():
        assert (r.size, r.source_size) == (size[d], sizes[source[d]])
        assert r.target == pytest.approx(want[source[d]])
        assert 0 <= r.taken <= 3 * r.size
        taken[source[d]] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.5


def spark_hash(*values):
    """Spark's xxhash64: ("i", 32-bit), ("l", 64-bit) or text, each seeded by the hash before it; nulls are passed over."""
    h = 42
    for v in values:
        if v is not None:
            data = v.encode() if isinstance(v, str) else v[1].to_bytes(4 if v[0] == "i" else 8, "little", signed=True)
            h = xxhash.xxh64_intdigest(data, h & (1 << 64) - 1)
            h -= (h >> 63) << 64
    return h


def plain_taken(rows, block_words):
    """Words taken of each row (doc_id, text, source), by walking over every word of every slot."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    sizes = Counter()
    for (_, _, s), n in zip(rows, size):
        sizes[s] += n
    targets = plain_targets(sizes)
    count = max(1, len(rows) // mixing.STRETCH_ROWS)
    taken = Counter()
    for no, source in enumerate(sorted(sizes, key=lambda s: (s is None, (s or "").encode())), 1):
        placed = []
        for i, ((d, t, s), n) in enumerate(zip(rows, size)):
            if s == source:
                copy = spark_hash(("l", 1), ("l", n), ("l", spark_hash(t or "")), s)
                placed.append((spark_hash(("l", d), ("l", copy)) % count, d, copy, i))
        words = [i for *_, i in sorted(placed) for _ in range(size[i])]
        blocks = [words[a:a + block_words] for a in range(0, len(words), block_words)]
        left, turn = min(round(targets[source]), 3 * sizes[source]), 0
        while left:
            lap, x, n = turn // len(blocks), turn % len(blocks), len(blocks)
            key = spark_hash(("l", no), ("l", lap))
            for r in range(1, mixing.SWAPS + 1):
                other = (spark_hash(("i", mixing.SEED), ("i", r), ("l", key)) % n - x) % n
                if spark_hash(("i", r), ("l", key), ("l", max(x, other)), ("i", mixing.SEED)) & 1:
                    x = other
            used = blocks[x][:left]
            left, turn = left - len(used), turn + 1
            taken.update(rows[i][0] for i in used)
    return taken


def test_taken_against_plain_loops(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "source")
    want = plain_taken([tuple(r) for r in docs.collect()], 64)
    got = {r.doc_id: r.taken for r in mixing.mix(docs, block_words=64)["docs"].collect()}
    assert got == {d: want.get(d, 0) for d in got}


def test_limits_are_shared_again(spark):
    sizes = {"a": 10, "b": 1000, "c": 5, "d": 400, None: 0, "e": 3000, "ä": 1}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_permutation(spark):
    for n in (1, 2, 7, 64, 1000):
        df = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3).cast("long")).alias("x"))
        out = [r.x for r in df.collect()]
        assert sorted(out) == list(range(n))


def test_pieces_and_edge_rows(spark):
    rows = [(1, "a b c " * 700, "s"), (2, None, "s"), (3, "", "t"), (4, "one", None), (4, "one", None), (5, "x y", "u"), (None, "w " * 50, "s"), (6, "v " * 3000, "t"), (7, "z " * 10, "u")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("copy", F.lit("k")).withColumn("block", F.lit(1))
    made = mixing.mix(df, block_words=16)
    docs = made["docs"].collect()
    assert len(docs) == len(rows)
    plan = {r.source: r for r in made["plan"].collect()}
    taken = Counter()
    for r in docs:
        assert r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert {s: taken[s] for s in plan} == {s: r.want for s, r in plan.items()}
    parts = made["pieces"].groupBy("doc_id", "copy").agg(F.sum("words").alias("n")).collect()
    assert sum(p.n for p in parts) == sum(taken.values())
    assert mixing.mix(df.limit(0))["docs"].count() == 0


def test_counts_by_shard_follow_the_weights(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("w " * 64).alias("text"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"))
    made = mixing.mix(df, block_words=32, shard_words=32000)
    by = {(r.shard, r.source): r["count"] for r in made["slots"].groupBy("shard", "source").count().collect()}
    shards = {k for k, _ in by}
    assert len(shards) == 8
    for k in shards:
        assert abs(by[k, "s0"] / sum(by[k, s] for s in ("s0", "s1", "s2")) - 0.625) < 0.08


def test_shards_take_what_was_drawn(spark):
    """Counts by shard are those of the draw, and each shard's slots of a source follow those of the shard before."""
    df = spark.range(900).select(F.col("id").alias("doc_id"), F.lit("w " * 64).alias("text"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"))
    made = mixing.mix(df, block_words=32, shard_words=8000)
    shards = 900 * 64 // 8000
    want, got, places = Counter(), {}, {}
    for p in made["plan"].collect():
        rest = p.want % p.source_size
        blocks = -(-p.source_size // 32)
        count = p.want // p.source_size * blocks + (min(blocks, -(-rest // 32) + 1) if rest else 0)
        for draw in range(count):
            want[p.source_no, spark_hash(("i", mixing.SEED), ("l", p.source_no), ("l", draw)) % shards] += 1
    for r in made["slots"].collect():
        got.setdefault((r.source_no, r.shard), []).append(r.slot)
        places.setdefault(r.shard, []).append((r.place, r.source_no))
    first = Counter()
    for no, k in sorted(want):
        # The last slot of a source may have no word left for it.
        assert set(range(first[no], first[no] + want[no, k])) - set(got.get((no, k), [])) <= {sum(n for (o, _), n in want.items() if o == no) - 1}
        assert set(got.get((no, k), [])) <= set(range(first[no], first[no] + want[no, k]))
        first[no] += want[no, k]
    for order in places.values():
        # One random order: the sources change from slot to slot more often than not.
        sources = [no for _, no in sorted(order)]
        assert sum(a != b for a, b in zip(sources, sources[1:])) > len(sources) / 3


def test_mix_is_laid_out_by_shard_and_place(spark):
    rows = [(i, f"d{i} " + "w " * (i % 50), f"s{i % 2}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mixed(df, block_words=8, shard_words=2000)
    places = mixing.mix(df, block_words=8, shard_words=2000)["pieces"].groupBy("doc_id", "round").agg(F.min(F.struct("shard", "place")).alias("at")).collect()
    at = {}
    for r in places:
        at.setdefault(r.doc_id, set()).add(tuple(r["at"]))
    parts = {}
    for r in out.select("doc_id", F.spark_partition_id().alias("p")).collect():
        parts.setdefault(r.p, []).append(r.doc_id)
    assert len(parts) > 1 and sum(map(len, parts.values())) == len(places)
    for ids in parts.values():
        here = (-1,)
        for d in ids:
            nxt = min((a for a in at[d] if a >= here), default=None)
            assert nxt is not None, "a row stands before one that belongs ahead of it"
            here = nxt
