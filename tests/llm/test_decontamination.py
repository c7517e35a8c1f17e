import random
import re

import pytest

from tallyloom.llm import decontamination

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWERED = str.maketrans(UPPER, LOWER)


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWERED))


def plain(docs, items, window=10):
    """(doc_id, n_words, n_hit, item ids) for every row, by comparing all runs."""
    runs = {}
    for item, text in items:
        w = plain_words(text)
        for s in range(len(w) - min(window, len(w)) + 1 if w else 0):
            runs.setdefault(tuple(w[s:s + window]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, ids = plain_words(text), set(), set()
        for n in {len(r) for r in runs}:
            for s in range(len(w) - n + 1):
                found = runs.get(tuple(w[s:s + n]))
                if found:
                    hit.update(range(s, s + n))
                    ids.update(str(i) for i in found if i is not None)
        out.append((doc, len(w), len(hit), sorted(ids)))
    return sorted(out, key=repr)


def ours(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    rows = decontamination.decontaminate(d, i, **options).docs.collect()
    return sorted([(r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in rows], key=repr)


@pytest.mark.parametrize("seed, stretch", [(1, 4096), (2, 7), (3, 1)])
def test_random_texts(spark, seed, stretch):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "b", "çé", "7", "tree"]  # few words: many ties and repeats

    def text(n):
        return rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary) for _ in range(n))

    items = [(i, text(rng.choice([1, 3, 8, 10, 11, 25]) if i % 4 else 14)) for i in range(12)]
    docs = [(i, text(rng.randint(0, 60))) for i in range(40)]
    for i in range(0, 40, 3):  # passages cut out of items
        source = plain_words(rng.choice(items)[1])
        docs.append((100 + i, text(9) + " " + " ".join(source[rng.randint(0, 4):]) + " " + text(rng.randint(0, 20))))
    assert ours(spark, docs, items, stretch=stretch) == plain(docs, items)


def test_edge_rows(spark):
    passage = "One two three four five six seven eight nine ten eleven"
    words = passage.split()
    items = [(1, passage), (1, passage), (2, None), (3, ""), (4, " ,. "), (10, "zero " + passage), (None, passage), (5, "ÉCLAIR")]
    docs = [
        (1, passage.upper()), (2, None), (3, ""), (4, "?! "), (5, passage), (5, passage), (5, "other text"), (None, passage), (None, None),
        (6, " ".join(words[:9])), (7, " ".join(words[1:])), (8, "x " * 30000 + passage + " y" * 30000), (9, "éclair"), (10, "an ÉCLAIR"), (11, "one-two;three.four_five six/seven\teight\nnine ten"),
    ]
    got = ours(spark, docs, items)
    assert got == plain(docs, items)
    assert (6, 9, 0, []) in got and (8, 60011, 11, ["1", "10"]) in got and (10, 2, 1, ["5"]) in got and got.count((5, 11, 11, ["1", "10"])) == 2
    assert all(r[2:] == (0, []) for r in ours(spark, docs, [])) and ours(spark, [], items) == []


def test_no_short_window_is_joined_to_a_hot_passage(spark):
    """A passage in a third of documents and items gives one row per occurrence, not one per item."""
    passage = " ".join(f"w{i}" for i in range(12))
    items = [(i, f"item{i} {passage}") for i in range(60)]
    docs = [(i, f"doc{i} {passage}" if i % 3 == 0 else f"clean document number {i}") for i in range(90)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    found = decontamination.decontaminate(d, spark.createDataFrame(items, "item_id long, text string"))
    assert found.windows.count() == 30 * 3
    assert {(r.n_hit, len(r.item_ids)) for r in found.docs.collect()} == {(12, 60), (0, 0)}


def test_clashing_columns(spark):
    rows = [(1, "a b c d e f g h i j", "m", 1, 2, 3, 4, "t")]
    names = "doc_id long, text string, mark string, at int, words int, places int, n_words int, right_id string"
    items = [(7, "b c d e f g h i j a b c d e f g h i j k", "x", 0)]
    found = decontamination.decontaminate(spark.createDataFrame(rows, names), spark.createDataFrame(items, "item_id long, text string, run string, h int"))
    assert [(r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in found.docs.collect()] == [(1, 10, 10, ["7"])]


def test_windows_are_the_real_places(spark):
    text = "start " + " ".join(f"w{i}" for i in range(11))
    found = decontamination.decontaminate(spark.createDataFrame([(4, text)], "doc_id long, text string"), spark.createDataFrame([(1, text[6:])], "item_id long, text string"))
    assert sorted((r["first"], r["words"]) for r in found.windows.collect()) == [(1, 10), (2, 10)]
    assert [r["items"] for r in found.classes.collect()] == [["1"]]
