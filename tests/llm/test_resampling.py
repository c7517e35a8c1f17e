import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyloom.llm import resampling

LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_features(text, longest):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWERED))
    return w, [" ".join(w[i:i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def plain(docs, target, percent=10, least=20, longest=1, buckets=10_000, seed=2024):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s = Counter(bucket(f) for _, t in docs for f in plain_features(t, longest)[1])
    t = Counter(bucket(f) for _, x in target for f in plain_features(x, longest)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    rows = []
    for doc, text in docs:
        w, features = plain_features(text, longest)
        weight = sum(gain[bucket(f)] for f in features) // len(features) if features else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append((doc, len(w), len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted([r for r in rows if r[1] >= least], key=lambda r: (-r[4], r[0] is None, r[0], r[2]))
    drawn = order[: len(order) * percent // 100]
    ranks = {}
    for i, r in enumerate(drawn):
        ranks.setdefault(r, []).append(i + 1)
    return sorted([(*r, ranks[r].pop() if ranks.get(r) else None) for r in rows], key=repr)


def ours(spark, docs, target, **options):
    d, t = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(target, "item_id long, text string")
    return sorted([tuple(r) for r in resampling.resample(d, t, **options).collect()], key=repr)


def made(rng, n):
    return " ".join(rng.choice(["tree", "Apple", "apple", "ÉTÉ", "été", "x9", "漢字", "don't", "a", "b"]) for _ in range(n))


@pytest.mark.parametrize("longest, buckets, percent", [(1, 10_000, 10), (3, 50, 40)])
def test_random_texts(spark, longest, buckets, percent):
    rng = random.Random(longest)
    docs = [(i, made(rng, rng.randint(0, 60))) for i in range(120)]
    target = [(i, made(rng, 30)) for i in range(5)]
    got = ours(spark, docs, target, longest=longest, buckets=buckets, percent=percent)
    assert got == plain(docs, target, longest=longest, buckets=buckets, percent=percent)
    assert sum(r[5] is not None for r in got) == sum(r[1] >= 20 for r in got) * percent // 100


def test_edge_rows(spark):
    long_text = "alpha beta GAMMA, " * 60000  # cut into several slabs
    docs = [(1, None), (2, ""), (3, "., !"), (4, long_text), (5, "w " * 20), (5, "w " * 20), (5, "v " * 25), (None, "u " * 30), (None, "u " * 30), (None, None), (6, "w " * 19), (7, "x" * 3_000_000)]
    target = [(1, "w v"), (2, None), (2, "w v"), (3, "")]
    assert ours(spark, docs, target, percent=100) == plain(docs, target, percent=100)
    assert ours(spark, docs, [], percent=50) == plain(docs, [], percent=50)
    assert ours(spark, [], target) == []


def test_ties_go_to_the_smaller_id(spark):
    df = spark.createDataFrame([(i, 3 if i % 2 else 9, 25, True, i * 7) for i in range(1, 41)], "doc_id long, score long, n_features long, eligible boolean, row long")
    from tallyloom.durable import Scratch

    ranks = {r.doc_id: r["rank"] for r in resampling.drawn(df, 25, Scratch(spark, "t")).collect()}
    want = {d: i + 1 for i, d in enumerate([*range(2, 41, 2), *range(1, 41, 2)][:25])}
    assert ranks == {d: want.get(d) for d in range(1, 41)}


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a " * 25, "x", 1, 2, 3)], "doc_id long, text string, score string, rank int, row int, bucket int")
    assert resampling.resample(df, df, percent=100).select("rank").first()[0] == 1


@pytest.mark.parametrize("longest", [1, 2, 4])
def test_parts_of_a_long_text_lose_no_run(longest):
    rng = random.Random(longest)
    text = made(rng, 400)
    got = Counter()
    for _, part in resampling._slabs([text, "", "one", None], 64, longest):
        got.update(part.data[s:e].decode() for s, e in zip(part.starts, part.ends))
    assert got == Counter(plain_features(text, longest)[1]) + Counter(["one"])


def test_table_tells_equal_hashes_apart():
    """All features under one hash: bytes decide, and probing goes on past the end."""
    words = [b"aa", b"ab", b"aa", b"b" * 40, b"b" * 39 + b"c", b"b" * 40, b"abc"]
    data = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - np.array([len(w) for w in words])
    table = resampling.Table(data, starts, ends, 1000, hashing=lambda d, s, e: np.full(len(s), 15, np.uint64))
    slots = table.slot.tolist()
    assert len(set(slots)) == 5 and slots[0] == slots[2] and slots[3] == slots[5]
    assert [table.bucket[s] for s in slots] == [zlib.crc32(w) % 1000 for w in words]
    assert table.count[slots[0]] == 2 and table.count.sum() == 7
