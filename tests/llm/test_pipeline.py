import re
from collections import Counter, defaultdict

import corpus_pipeline
import public_tokenizers
import pytest
from test_exact_dedup import plain as plain_dedup
from test_mixing import plain_targets
from test_simhash import plain_components, plain_fingerprint
from tokenizers import Tokenizer

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("pipeline")
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    out.append(docs)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(f"{root}/{i}")
        docs = spark.read.parquet(f"{root}/{i}")
        out.append(docs)
    return [df.collect() for df in out]


def ids(rows):
    return sorted(r.doc_id for r in rows)


def test_language_keeps_clean_documents(steps):
    assert ids(steps[1]) == ids([r for r in steps[0] if r.text and re.search(r"[^\W\d_]", r.text)])


def test_exact_copies_go(steps):
    keep = {k for _, k, _, _ in plain_dedup([(r.doc_id, r.text) for r in steps[1]])[0]}
    assert ids(steps[2]) == sorted(keep)


def test_near_copies_go(steps):
    roots = plain_components(sorted((r.doc_id, plain_fingerprint(r.text)) for r in steps[2]))
    assert ids(steps[3]) == sorted(set(roots.values()))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def test_mix(steps):
    before = {r.doc_id: r for r in steps[3]}
    sizes, taken, copies = Counter(), Counter(), defaultdict(int)
    for r in steps[3]:
        sizes[r.source] += len(words(r.text))
    for r in steps[4]:
        old = before[r.doc_id]
        assert (r.lang, r.source, r.n_chars) == (old.lang, old.source, len(r.text))
        assert r.text == old.text or not Counter(words(r.text)) - Counter(words(old.text))
        taken[r.source] += len(words(r.text))
        copies[r.doc_id] += 1
    assert max(copies.values()) <= 3
    for s, want in plain_targets(sizes).items():
        assert abs(taken[s] - want) <= 0.5


def test_pack(steps):
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    total = sum(len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in steps[4])
    assert sum(r.length for r in steps[5]) == total
    single = Counter(r.doc_id for r in steps[4])
    rows = [(r.doc_id, r.text) for r in steps[4] if single[r.doc_id] == 1]
    pieces = [p for p in steps[5] if single[p.doc_id] == 1]
    by = defaultdict(int)
    for p in pieces:
        by[p.doc_id] += p.length
    assert all(by[d] == len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, t in rows)
    lengths = defaultdict(int)
    for p in steps[5]:
        lengths[p.sequence_id] += p.length
    assert max(lengths.values()) <= 1024 and sum(1024 - n for n in lengths.values()) < 1024


def test_run_and_edge_rows(spark, tmp_path):
    columns = "doc_id long, text string, lang string, source string, n_chars long, score string, lang_pred string, fp long, name string, copy int, block string"
    clash = ("s", "l", 1, "n", 2, "b")
    rows = [(1, None, "en", "a", 0), (2, "", "en", None, 0), (3, "the and of " * 20, "en", None, 9), (3, "the and of " * 20, "en", None, 9), (4, "der und die " * 30, "de", "a", None), (None, "le la les " * 30, "fr", "b", 1), (5, "el la los " * 30000, None, "b", 1), (6, "12 34", "en", "a", 5)]
    docs = spark.createDataFrame([(*r, *clash) for r in rows], columns)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for given in (docs, docs.limit(0)):
            out = stage(spark, given, str(tmp_path))
            assert out.schema.simpleString() == docs.schema.simpleString(), name
            assert all(tuple(r)[5:] == clash for r in out.collect())
    kept = corpus_pipeline.STAGES[0][1](spark, docs, "").collect()
    assert sorted(str(r.doc_id) for r in kept) == ["3", "3", "4", "5", "None"]
    assert len(corpus_pipeline.STAGES[1][1](spark, docs, "").collect()) == 6
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_near_copies_keep_distinct_texts_without_usable_ids(spark, tmp_path):
    texts = ["the and of " * 20, "der und die " * 30, "le la les " * 30, "el la los " * 30]
    rows = [(None, t, "en", "a", len(t)) for t in texts] + [(5, t.upper() + "x y z", "en", "a", 1) for t in ("red green blue", "white black brown")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    for _, stage in corpus_pipeline.STAGES[1:3]:
        docs = stage(spark, docs, str(tmp_path))
        assert sorted(map(str, docs.collect())) == sorted(map(str, spark.createDataFrame(rows, docs.schema).collect()))


def test_stages_keep_columns_of_any_name(spark, tmp_path):
    """Names that the stages use, or used, for columns of their own."""
    names = ["__id", "__key", "__mark", "__source", "__take", "mark", "key_id", "KEY_MARK", "key_source", "take", "takes", "n"]
    columns = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names)
    texts = ["the and of " * 20, "the and of " * 20, "der und die " * 30, "the  and of " * 20]
    rows = [(i, t, "en", "ab"[i % 2], len(t), *names) for i, t in enumerate(texts)] + [(0, texts[0], "en", "a", 220, *names)]
    docs = spark.createDataFrame(rows, columns)
    for (name, stage), kept in zip(corpus_pipeline.STAGES[1:4], (2, 2, None)):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        got = out.collect()
        assert got and all(tuple(r)[5:] == tuple(names) for r in got), name
        assert kept is None or len(got) == kept, name
        assert stage(spark, docs.limit(0), str(tmp_path)).collect() == [], name
