import hashlib
import random
import re

import numpy as np
import pytest

from tallyloom.llm import substring_dedup as sd
from tallyloom.llm.catalog import QUERIES


def plain(rows, window=13):
    """[(doc_id, n_words, spans of removed words, kept text)] in input order."""
    key = lambda d: sd.LAST_ID if d is None else d
    words = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    least = {}
    for d, w in words:
        for i in range(len(w) - window + 1):
            g = tuple(w[i:i + window])
            least[g] = min(least.get(g, key(d)), key(d))
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if least[tuple(w[i:i + window])] < key(d):
                gone.update(range(i, i + window))
        spans = [(i, next(k for k in range(i, len(w) + 1) if k not in gone) - i) for i in sorted(gone) if i - 1 not in gone]
        out.append((d, len(w), spans, " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def found(df, **options):
    return [(r.doc_id, r.n_words, [tuple(s) for s in r.removed], r.kept) for r in sd.remove_repeats(df, **options).collect()]


def order(rows):
    return sorted(rows, key=str)


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = sorted((d, n, sum(s[1] for s in spans), hashlib.sha256(k.encode()).hexdigest()) for d, n, spans, k in plain(rows))
    assert sorted(tuple(r) for r in QUERIES["op2_substring_dedup"](spark, folder).collect()) == want
    assert sum(w[2] for w in want) > 0


@pytest.mark.parametrize("window,first", [(13, 4), (5, 2), (3, 4), (8, 1), (1, 4)])
def test_random_texts_in_small_blocks(spark, window, first):
    rng = random.Random(window)
    rows = [(i, " ".join(rng.choice("ab") + rng.choice(["", "é", "\n"]) for _ in range(rng.randint(0, 60)))) for i in range(-20, 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert order(found(df, window=window, first_level=first, block_bytes=200, bucket_bytes=500)) == order(plain(rows, window))


def test_edge_rows(spark):
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [(5, long), (1, None), (2, ""), (3, " \t\n "), (4, "x " + long + " y"), (4, "x " + long + " y"), (None, long), (None, long), (7, "q " * 50000), (8, "q " * 13), (9, "q " * 12),
            (10, "z" * 200000), (11, "a" * 70 + " " + "a" * 134), (12, long.replace(" ", "\x0b\r\n")), (13, long.replace(" ", " ")), (-3, "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12")]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, home int, kept string")
    assert order(found(df)) == order(plain(rows))
    assert order(found(df, block_bytes=1000, bucket_bytes=1000)) == order(plain(rows))
    assert found(df.limit(0)) == []
    assert order(found(df.filter("doc_id < 4 AND doc_id > 0"))) == [(1, 0, [], ""), (2, 0, [], ""), (3, 0, [], "")]


def test_words_and_hashes():
    text = ("long" * 40 + "  ab\tab é " + "long" * 39 + "lonG\n").encode()
    w = sd.Words(np.frombuffer(text, np.uint8), np.array([len(text)]))
    assert [text[a:a + n] for a, n in zip(w.start, w.size)] == text.split()
    assert w.hash[1] == w.hash[2] and len(set(w.hash.tolist())) == 4
    assert sd.lengths(13) == [4, 8, 13] and sd.lengths(16, 1) == [1, 2, 4, 8, 16] and sd.lengths(3) == [3]


def test_a_long_word_changes_no_other_hash():
    one, two = b"ab cd\n", b"ab " + b"z" * 200 + b" cd\n"
    a, b = (sd.Words(np.frombuffer(t, np.uint8), np.array([len(t)])).hash.tolist() for t in (one, two))
    assert a == [b[0], b[2]]
