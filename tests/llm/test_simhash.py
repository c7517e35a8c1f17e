import itertools
import random

import xxhash
from pyspark.sql import Row

from tallyloom.llm import simhash
from tallyloom.llm.catalog import QUERIES
from tallyloom.llm.components import components
from tallyloom.durable import Scratch


def plain_fingerprint(text):
    words = [w for w in (text or "").encode().lower().split() if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(pairs):
    """pairs: (doc_id, fingerprint) -> {doc_id: smallest reachable id}"""
    root = {d: d for d, _ in pairs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, f), (b, g) in itertools.combinations(pairs, 2):
        if bin(f ^ g).count("1") <= 2:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {d: find(d) for d, _ in pairs}


def test_every_close_pair_shares_a_table():
    kept = simhash.masks()
    for a, b in itertools.combinations(range(64), 2):
        assert any(not (1 << a | 1 << b) & m for m in kept)


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    prints = {d: plain_fingerprint(t) for d, t in texts.items()}
    roots = plain_components(sorted(prints.items()))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op9_simhash_near_dedup"](spark, folder).collect()}
    assert got == {d: (f"{prints[d]:016x}", roots[d]) for d in texts}


def test_links_on_random_fingerprints(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(30)]
    values = set(base)
    for x in base:
        for _ in range(12):
            for _ in range(rng.randint(0, 3)):
                x ^= 1 << rng.randrange(64)
            values.add(x)
    signed = [simhash._signed(v) for v in values]
    df = spark.createDataFrame([Row(fp=v) for v in signed], "fp long")
    roots = {r.node: r.root for r in components(simhash.links(df), Scratch(spark, "t")).collect()}
    want = plain_components([(v, v & (1 << 64) - 1) for v in sorted(signed)])
    assert {v: roots.get(v, v) for v in signed} == want


def test_edge_rows(spark):
    rows = [(3, None, "x"), (1, "", "x"), (2, " \t\n", None), (5, "one", "y"), (5, "one", "y"), (6, "One", None), (None, "zwei", None), (9, "a b c d " * 30000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(3, 1), (1, 1), (2, 1), (5, 5), (5, 5), (6, 5), (None, None), (9, 9)], key=str)
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    assert simhash.fingerprint("a b c d " * 30000) == simhash._signed(plain_fingerprint("a b c d " * 30000))


def test_one_of_each_without_usable_ids(spark):
    far = ["one two three", "eins zwei drei", "un deux trois", "uno dos tres"]
    rows = [(None, far[0]), (None, far[1]), (None, far[1]), (None, far[2].upper()), (None, far[2]), (7, far[2]), (3, "red green blue"), (3, "white black brown"), (3, "white black brown"), (4, "RED green blue"), (9, far[3]), (None, far[3])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, source string")
    got = sorted((tuple(r) for r in simhash.one_of_each(df).collect()), key=str)
    want = [(None, far[0]), (None, far[1]), (7, far[2]), (3, "red green blue"), (3, "white black brown"), (9, far[3])]
    assert got == sorted([(*w, "x") for w in want], key=str)


def test_long_chain(spark):
    n = 200
    df = spark.createDataFrame([(i, i + 1) for i in range(n)], "a long, b long")
    assert {(r.node, r.root) for r in components(df, Scratch(spark, "t")).collect()} == {(i, 0) for i in range(n + 1)}
