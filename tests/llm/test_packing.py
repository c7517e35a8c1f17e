import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyloom.llm import packing
from tallyloom.llm.catalog import QUERIES


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def check(rows, pieces, plain, most_padding):
    ids = {d: np.array(plain(t), "<u4") for d, t in rows}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert by_doc.keys() == ids.keys()
    for d, own in by_doc.items():
        own.sort(key=lambda p: p.start)
        at = 0
        for p in own:
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids[d])
            assert p.ids_crc32 == zlib.crc32(ids[d][at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids[d])
    padding = 0
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        at = 0
        for p in own:
            assert p.offset == at
            at += p.length
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    assert padding <= most_padding


def test_query(spark, plain):
    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op5_packing"](spark, folder).collect()
    check(rows, found, plain, 1024)
    assert sorted(found) == sorted(QUERIES["op5_packing"](spark, folder).collect())


def test_edge_rows(spark, plain):
    words = "the of " * 9
    texts = [None, "", " ", "a  b", words, words + "\n\n" + words, " " + words, words + " ", "x" + " " * 40 + words, "it's 'll 'S " * 9, "  a  b " * 9, "a  b   c" * 9,
             "<|endoftext|> a b <|endoftext|>c d e f g h i j" * 3, "日本 語 テキ スト。 " * 20, "1 2 3 4 5 6 7 8 9 10 11 \x1c \x1c 12", "é́ " * 30, "long " * 40000, "\x85 a b c d e f g h i j", "a \x0b b c d e f g \x00 h i"]
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(i, t, "p", 5) for i, t in rows], "doc_id long, text string, pack string, length int")
    check(rows, packing.pack(df).collect(), plain, 1024)
    assert packing.pack(df.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c"), (None, None)], "doc_id long, text string")
    assert sum(p.length for p in packing.pack(twice).collect()) == 3 + 3 + 2 + 1


def test_first_fit_decreasing():
    sizes = np.random.default_rng(0).integers(1, 1025, 500).tolist()
    room, want = [], []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = next((k for k, r in enumerate(room) if r >= sizes[i]), len(room))
        if at == len(room):
            room.append(1024)
            want.append([])
        room[at] -= sizes[i]
        want[at].append(i)
    assert packing.first_fit_decreasing(sizes) == want
    assert packing.first_fit_decreasing([]) == []


def test_equal_rests_leave_one_open_sequence():
    sizes = [600] * 41
    made = packing.fill_up(packing.first_fit_decreasing(sizes), sizes)
    totals = sorted(sum(p[2] for p in b) for b in made)
    assert sum(totals) == 41 * 600 and all(t == 1024 for t in totals[1:])


def test_rows_of_one_id_spread_over_groups(spark, plain):
    """A third of the rows equal, a third of one id: groups stay bounded, and each row is packed once."""
    rows = [(1, "same text")] * 600 + [(2, f"text {i}") for i in range(600)] + [(i, f"own {i}") for i in range(3, 603)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = packing.pack(df, group_docs=100).collect()
    want, lengths = Counter(), Counter()
    for d, t in rows:
        ids = np.array(plain(t), "<u4")
        want[d, zlib.crc32(ids.tobytes())] += 1
        lengths[d] += len(ids)
    got = Counter()
    for p in found:
        got[p.doc_id] += p.length
    assert got == lengths
    assert Counter(p.doc_id for p in found if p.start == 0) == Counter(d for d, _ in rows)
    assert not Counter((p.doc_id, p.ids_crc32) for p in found if p.length == p.doc_tokens) - want
    groups = Counter(p.sequence_id >> 32 for p in found)
    assert len(groups) == 18 and max(groups.values()) < 200
    assert sorted(found) == sorted(packing.pack(df.repartition(3), group_docs=100).collect())
    copies = packing.numbered_copies(df).filter("doc_id = 1").select("copy").collect()
    assert sorted(r.copy for r in copies) == list(range(1, 601))
