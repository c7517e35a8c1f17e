import re
import zlib

import numpy as np

from tallyloom.llm import toxicity as tx
from tallyloom.llm.catalog import QUERIES


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_query_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").count()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op10_toxicity"](spark, folder).collect()}
    assert len(got) == docs
    assert all(r.held_out == held(d) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for d, r in got.items())
    out = [d for d in labels if held(d) and d in got]
    toxic = [d for d in out if labels[d] == 1]
    clean = [d for d in out if labels[d] == 0]
    assert np.mean([got[d].predicted for d in toxic]) > 0.9
    assert np.mean([got[d].predicted for d in clean]) < 0.01


def test_folding():
    assert tx.fold("1D10T") == tx.fold("idiot") == tx.fold("іԁіоt") == tx.fold("ｉｄｉｏｔ") == tx.fold("id​iot")
    assert tx.fold("$tupid, l0$er!").split() == tx.fold("stupid loser").split()
    assert tx.fold("moron$$$").split() == tx.fold("moron").split()
    assert tx.fold("é").strip().encode("latin-1").decode() == "é"


def test_marks_of_any_script_are_spaces():
    for mark in "“”‘’«»‹›–—…¡¿·•、。「」،؟।\u00a0\u3000\u2028☠🤬":
        assert tx.folded_words(f"an{mark}idiot{mark}") == ["an", "idiot"], mark
    assert tx.folded_words("☠\ufe0fidiot id\u2060iot \ufeffidiot") == ["idiot"] * 3
    for word in ("cafe\u0301", "हिन्दी", "voilà", "\u0448\u0445\u0448"):  # marks on letters, bytes 85 and A0 within letters
        assert len(tx.folded_words(f"({word})")) == 1, word
    lexicon = tx.Lexicon({"idiot": 1.0, "ass ": 2.0, " ".join(tx.folded_words("混蛋")) + " ": 4.0}, ("smart ass",))
    assert [lexicon.measure(t)[0] for t in ("“Idiot”", "you—idiot", "¡idiot!", "assume", "an ass", "smart ass", "ass ass", "他是混蛋吗", "混的")] == [1, 1, 1, 0, 2, 0, 4, 4, 0]


def test_learns_short_words_marked_words_and_runs(spark):
    fill = "red green blue white black brown pink grey".split()
    han = "天地人山水火木金土日"
    toxic = ["{0} “moron” {1}", "{0}—moron {1}", "the {0} ass {1}", "{2}{3}混蛋{3}{2}"]
    clean = ["the {0} weather is {1}", "they assume {0} or {1}", "{2}{3}{2}{2}{3}", "so {1} passes {0}"]
    rows = [(i, (toxic if i % 3 == 0 else clean)[i // 3 % 4].format(fill[i % 7], fill[i % 8], han[i % 10], han[i // 10 % 10])) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(900)], "doc_id long, toxic int")
    got = tx.rate(docs, labels).collect()
    assert [r.doc_id for r in got if r.predicted != (r.doc_id % 3 == 0)] == []


def test_learns_exceptions_from_clean_contexts(spark):
    fill = "red green blue white black brown pink grey".split()
    toxic = ["you {0} trash and {1}", "{0} trash {1}", "such trash {1} {0}"]
    clean = ["the {0} weather is {1}", "they say {0} or {1}", "the trash “collector” is {0} {1}", "so {0} it is", "why {1} at all"]
    rows = [(i, (toxic[i // 2 % 3] if i % 2 == 0 else clean[i // 2 % 5]).format(fill[i % 7], fill[i % 8])) for i in range(1200)]
    rows = [(i, t) for i, t in rows if "collector" not in t or i < 300]  # rare enough for "trash" to be an entry
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i, _ in rows], "doc_id long, toxic int")
    lexicon = tx.learn(docs, labels, exceptions=())
    assert any("trash".startswith(t) for t in lexicon.weights)
    phrase = " ".join(tx.folded_words("trash collector"))
    assert phrase in lexicon.learned and not any("such" in p or "you" in p for p in lexicon.learned)
    assert lexicon.measure("Trash, collector")[0] == 0 < lexicon.measure("trash blue")[0]
    assert lexicon.score("the trash collector is red") < 0.5 < lexicon.score("you red trash and blue")


def test_phrases_around_hits_against_plain_splitting():
    lexicon = tx.Lexicon({"iose": 1.0, "ass ": 2.0, " ".join(tx.folded_words("混蛋")) + " ": 4.0}, ("smart ass",))
    around = lambda text: {p for p in lexicon.around(tx.folded_words(text))}
    fold = lambda text: " ".join(tx.folded_words(text))
    assert around("a loser goes") == {fold("a loser"), fold("loser goes")}
    assert around("a loser losers goes") == {fold("a loser"), fold("losers goes")}
    assert around("smart ass goes") == around("") == around("assume") == set()
    assert around("ass") == set() and around("x ass") == {fold("x ass")}
    assert around("他混蛋吗") == {fold("他混蛋"), fold("混蛋吗")}


def test_measure_against_plain_matching():
    lexicon = tx.Lexicon({t: w for t, w in zip(["iose", "stupid", "trash", "mor"], [1.0, 2.0, 4.0, 8.0])}, ("trash can", "stupid question"))
    rng = np.random.default_rng(4)
    words = ["loser", "Stupid", "trash", "can", "question", "moron", "more", "x", "TRASH,", "st", "7rash  can"]
    for _ in range(200):
        text = " ".join(rng.choice(words, rng.integers(0, 15)))
        folded = " " + " ".join(tx.fold(text).split()) + " "
        for phrase in (" trash can ", " stupid question "):
            while phrase in folded:  # shared spaces: neighbours may both match
                at = folded.index(phrase)
                folded = folded[:at] + " " + "_" * (len(phrase) - 2) + folded[at + len(phrase) - 1:]
        want = sum(w * len(re.findall(f" {t}", folded)) for t, w in lexicon.weights.items())
        assert lexicon.measure(text)[0] == want, text
    assert lexicon.measure(None) == lexicon.measure("") == (0.0, 0)


def test_labels_of_held_out_rows_do_not_matter(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.toxic) for r in spark.read.parquet(f"{folder}/labels.parquet").collect()]
    lies = [(d, 1 - t if held(d) and t is not None else t) for d, t in rows]
    a, b = (sorted(tx.rate(docs, spark.createDataFrame(x, "doc_id long, toxic int")).collect()) for x in (rows, lies))
    assert a == b


def test_edge_rows(spark):
    fill = "red green blue white black brown pink grey".split()
    bad, good = "you {0} moron and {1} loser", "the {0} weather is {1} today"
    rows = [(i, (bad if i % 3 == 0 else good).format(fill[i % 7], fill[i % 8]), "x") for i in range(300)]
    rows += [(1000, None, "x"), (1001, "", "x"), (1002, "moron " * 100000, "x"), (1003, "fine " * 100000, "x"), (None, "moron", "x"), (1, rows[1][1], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0), "p") for i in range(300)] + [(1000, None, "p"), (None, 1, "p"), (7, 5, "p"), (1, 0, "p")], "doc_id long, toxic int, text string")
    got = tx.rate(docs, labels).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[1000].score == by[1001].score < 0.5 and by[1002].predicted == 1 and by[1003].predicted == 0
    assert all(by[i].predicted == (i % 3 == 0) for i in range(300))
    assert tx.rate(docs.limit(0), labels).count() == 0
    assert {r.predicted for r in tx.rate(docs, labels.limit(0)).collect()} == {0}


def test_sample_takes_one_text_of_an_id(spark):
    docs = spark.createDataFrame([(1, f"repeated {i}") for i in range(500)] + [(i, f"text {i}") for i in range(2, 40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i == 1)) for i in range(1, 40)], "doc_id long, toxic int")
    found = tx.sample(docs, labels, {0: 8, 1: 4}).collect()
    assert [r.text for r in found if r.toxic == 1] == ["repeated 0"]
    assert 0 < sum(r.toxic == 0 for r in found) <= 8
