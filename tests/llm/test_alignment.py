import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tallyloom.llm import alignment
from tallyloom.llm.catalog import QUERIES

ZERO = (0, 0, 0, 0, 0, 0, "")


@pytest.fixture(scope="module")
def sides():
    a = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))


def byte_of():
    """The printable stand-in of each byte in a byte-level vocabulary: printable Latin-1 stays, the rest follows from 256 on."""
    stays = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in stays]
    return {**{chr(b): b for b in stays}, **{chr(256 + i): b for i, b in enumerate(others)}}


def plain_tokens(text, sides):
    a, b = sides
    if not text:
        return [], []
    table = byte_of()
    mine = a.encode(" " + text, add_special_tokens=False)
    ours = [(i, bytes(table[c] for c in a.id_to_token(i))) for i in mine.ids]
    theirs = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        byte = re.fullmatch(r"<0x([0-9A-F]{2})>", piece)
        theirs.append((i, bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if b"".join(t for _, t in ours) != whole or b"".join(t for _, t in theirs) != whole:
        return [], []
    return ours, theirs


def spans(tokens):
    at, out = 0, []
    for i, t in tokens:
        out.append((i, at, at + len(t)))
        at += len(t)
    return out


def plain(docs, sides):
    """Rows by comparing every token of A with every token of B."""
    found = []
    for doc, text in docs:
        a, b = (spans(t) for t in plain_tokens(text, sides))
        links = [(x, y) for x, s, e in a for y, f, g in b if max(s, f) < min(e, g)]
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, start = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in side if start < e <= cut) for side in (a, b)))
            start = cut
        found.append((doc, len(a), len(b), links, groups))
    count = Counter(link for f in found for link in f[3])
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    return sorted([(d, na, nb, len(g), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links), ";".join(g)) for d, na, nb, links, g in found], key=repr)


def ours(spark, docs, **options):
    rows = alignment.align(spark.createDataFrame(docs, "doc_id long, text string"), **options).collect()
    return sorted([tuple(r) for r in rows], key=repr)


SPOKEN = ["the", "unbelievable", "Straße", "ไม่", "漢字", "don't", "x1y2", "  ", "\n", "\t", "<|endoftext|>", "</s>", "<0x41>", "🙂", "é", " ", "ﬁ", "…", "aaaa", "1234567"]


@pytest.mark.parametrize("chars", [40, 1 << 20])
def test_random_texts(spark, sides, chars):
    rng = random.Random(chars)
    docs = [(i, rng.choice(["", " "]).join(rng.choice(SPOKEN) for _ in range(rng.randint(0, 14)))) for i in range(60)]
    assert ours(spark, docs, block_chars=chars) == plain(docs, sides)


def test_edge_rows(spark, sides):
    docs = [(1, None), (2, ""), (3, " "), (4, "a ▁ b"), (5, "same"), (5, "same"), (5, "not the same"), (None, "same"), (None, None), (6, "<s> </s> <unk>"), (7, "\x00\x01"), (8, "ab c\n" * 40)]
    got = ours(spark, docs)
    assert got == plain(docs, sides)
    assert (1, *ZERO) in got and (2, *ZERO) in got and (4, *ZERO) in got
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_long_text(spark, sides):
    line = "Ein sehr langer Text, der sich wiederholt. "
    got = ours(spark, [(1, line * 20000)])[0]
    a, b = plain_tokens(line * 200, sides)
    assert got[1] > 99 * len(a) and got[2] > 99 * len(b) and got[3] <= min(got[1], got[2])


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "some text", 7, "c", 5)], "doc_id long, text string, block int, code string, groups int")
    assert alignment.align(df).first()["n_links"] >= 2


def test_jump_on_long_chains():
    """Two sides that never end together but at the last byte: one chain over all tokens."""
    n = 5000
    a = np.arange(2, 2 * n + 1, 2)
    b = np.append(np.arange(1, 2 * n, 2), 2 * n)
    label = alignment.jump(alignment.successors(a, b))
    assert set(label.tolist()) == {len(a) + len(b) - 1}


def test_query_against_brute_force(spark, sides):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text[:1500]) for r in spark.read.parquet(f"{folder}/documents.parquet").limit(25).collect()]
    want = plain(docs, sides)
    assert ours(spark, docs) == want
    rows = {r.doc_id: r for r in QUERIES["op12_token_alignment"](spark, folder).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert set(rows) == set(texts)
    for doc in list(texts)[:40]:
        a, b = (spans(t) for t in plain_tokens(texts[doc], sides))
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, start = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in side if start < e <= cut) for side in (a, b)))
            start = cut
        r = rows[doc]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links) == (len(a), len(b), len(groups), len({e for _, _, e in a} | {e for _, _, e in b}))
        assert r.groups_sha256 == (hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "")
