import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import language_id as lid
from tallyloom.llm.catalog import QUERIES


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_query_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op4_language_id"](spark, folder).collect()}
    assert got.keys() == docs.keys()
    assert all(r.held_out == held(d) and 0 <= r.score <= 1 for d, r in got.items())
    out = [d for d in docs if held(d) and docs[d].text]
    right = sum(got[d].lang_pred == docs[d].lang for d in out) / len(out)
    assert right > 0.97
    # Calibrated: what the scores say is what comes true.
    assert abs(np.mean([got[d].score for d in out]) - right) < 0.05


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    rows = [(r.doc_id, r.text, r.lang) for r in docs]
    lies = [(d, t, "xx" if held(d) else g) for d, t, g in rows]
    a, b = (sorted(lid.identify(spark.createDataFrame(x, "doc_id long, text string, lang string")).collect()) for x in (rows, lies))
    assert a == b and "xx" not in {r.lang_pred for r in a}


def test_document_frequencies_and_scores(spark):
    texts = ["Ab ab", "zß", "", None, "ab c"]
    df = lid.document_frequencies(spark.createDataFrame([(t,) for t in texts], "text string"))
    want = Counter(f for t in texts if t is not None for f in set(lid.grams(t).tolist()))
    assert df[-1] == 4 and {i: int(n) for i, n in enumerate(df[:-1]) if n} == want
    rng = np.random.default_rng(1)
    model = lid.Model(["a", "b"], rng.normal(size=(lid.FEATURES, 2)).astype(np.float32), np.array([0.1, 0.2]), 1.0)
    text = "Größe und mehr " * 5000
    found = lid.grams(text)
    assert len(found) == sum(len(text.lower()) - k + 1 for k in lid.ORDERS)
    assert model.scores(text) == pytest.approx(model.weights[found].astype(float).mean(axis=0) * lid.SCALE + model.bias, rel=1e-4)


def test_slices_lose_no_ngram(monkeypatch):
    text = "abcdefghij" * 7 + "xyz"
    whole = sorted(lid.grams(text).tolist())
    for slab in (5, 7, 73):
        monkeypatch.setattr(lid, "SLAB", slab)
        assert sorted(lid.grams(text).tolist()) == whole


def test_edge_rows(spark):
    rows = [(1, "the and of", "en", "x"), (2, "der und die", "de", "x"), (3, None, "en", "x"), (4, "", None, "x"), (5, "12 ++", "de", "x"), (6, "the " * 100000, None, "x"), (7, "the and", "en", "x"), (7, "the and", "en", "x"), (None, "der", "de", "x"), (9, "é", None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = lid.identify(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all((by[d].lang_pred, by[d].score) == ("und", 0.0) for d in (3, 4, 5))
    assert all(by[d].lang_pred in ("en", "de") for d in (1, 2, 6, 7, None, 9))
    assert lid.identify(df.limit(0)).count() == 0
    assert {r.lang_pred for r in lid.identify(df.selectExpr("doc_id", "text", "cast(null as string) lang")).collect()} == {"und"}


def test_least_score_follows_chance(spark, monkeypatch):
    none = np.zeros((0, 0), np.float32), np.zeros(0), 1.0
    assert [lid.least_score(lid.Model(["x"] * n, *none)) for n in (1, 2, 4, 100)] == [1.0, 0.6, 0.3, 0.012]
    assert lid.least_score(lid.Model(["x"] * 4, *none, tested=False)) == 0.0
    texts = {"en": "the weather of this house and that garden", "de": "das wetter dieses hauses und jener garten"}
    rows = [(i, texts["en" if i % 2 else "de"], "en" if i % 2 else "de") for i in range(200)]
    df = spark.createDataFrame([*rows, (500, "\u4f60\u597d", None), (501, "12 34", None), (502, None, None)], "doc_id long, text string, lang string")
    alone = df.filter("lang = 'en' OR lang IS NULL")
    assert sorted(r.doc_id for r in lid.in_a_language(alone).collect()) == [*range(1, 200, 2), 500]
    assert lid.fit([("en", texts["en"]), ("de", texts["de"])] * 20, np.ones(lid.FEATURES + 1)).tested
    unlabelled = lid.in_a_language(df.withColumn("lang", F.lit(None).cast("string")))
    assert sorted(r.doc_id for r in unlabelled.collect()) == [*range(200), 500] and unlabelled.columns == df.columns
    unsure = lid.Model(["de", "en"], np.zeros((lid.FEATURES, 2), np.float32), np.array([0.2, 0.0]), 1.0)  # 0.55 against 0.45
    monkeypatch.setattr(lid, "train", lambda docs: unsure)
    assert lid.in_a_language(df).count() == 0


def test_sample_takes_one_text_of_an_id(spark):
    rows = [(1, f"repeated {i}", "en") for i in range(500)] + [(i, f"text {i}", "de") for i in range(2, 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = lid.sample(df, 10)
    assert [t for lang, t in found if lang == "en"] == ["repeated 0"]
    assert 0 < sum(lang == "de" for lang, _ in found) <= 10 and found == lid.sample(df, 10)
