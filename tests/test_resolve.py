"""Supplier resolution: an acceptance set, and the whole chain against a plain loop."""

import random

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.scorers import ratio, token_set_ratio
from tallyloom.operators import resolve
from tallyloom.settings import PROCESSOR_WORDS, Settings

SUPPLIERS = [
    (0, "Loom Fabrics", "Cloth", 10), (1, "Mill", "Cloth", 4), (2, "T-Porter", "Phone", 9), (3, "Riverbank", "Food", 2),
    (4, "Riverbank.com", "Food", 30), (5, "North Star Air", "Travel", 5), (6, "Cord & Co", "Cloth", 1), (7, "Mills Paper", "Office", 3),
]
ALIASES = [(0, "LOOMFAB NYC", "Loom Fabrics")]


def book(spark):
    return resolve.Book(
        spark.createDataFrame(SUPPLIERS, "pos long, supplier string, default_category string, count long"),
        spark.createDataFrame(ALIASES, "pos long, alias string, supplier string"),
    )


def names_frame(spark, names):
    rows = [(i, n, "ctx", f"f{i}") for i, n in enumerate(names)]
    return spark.createDataFrame(rows, "seq long, name string, context string, source_file string")


def test_descriptors(spark):
    want = {
        "SQ *LOOM FABRICS NY": "Loom Fabrics", "loomfab nyc": "Loom Fabrics", "TPORTER*AUTO PAY": "T-Porter", "MILL 221": "Mill",
        "GOOD MILL CAFE": None, "NORTH STAR AIR 00123 TX": "North Star Air", "Loom Fabrics Inc.": "Loom Fabrics",
        "RIVERBANK COM 3-12": "Riverbank.com", "Zzyzx": None, "": None,
    }
    got = resolve.resolve(names_frame(spark, list(want)), book(spark)).matches.orderBy("seq").collect()
    assert {r.name: r.canonical for r in got} == want


def test_first_use_is_fuzzy_later_use_is_alias(spark):
    out = resolve.resolve(names_frame(spark, ["SQ *Loom Fabrics NY", "sq loom fabrics ny"]), book(spark))
    assert [(r.method) for r in out.matches.orderBy("seq").collect()] == ["fuzzy", "alias"]
    assert [tuple(r) for r in out.learned.collect()] == [(0, "SQ *Loom Fabrics NY", "Loom Fabrics")]


def plain_resolve(norm, dim, aliases):
    """One name after another, the long way."""
    for alias_norm, canonical in aliases:
        if norm == alias_norm:
            return canonical, 100.0, "alias"
    for pos, canon, n, count, name in dim:
        if norm == canon:
            return name, 100.0, "exact"
    words = norm.split()
    lead = list(words)
    while len(lead) > 1 and lead[0] in PROCESSOR_WORDS:
        lead.pop(0)
    best = sorted(dim, key=lambda d: (-token_set_ratio(norm, d[1]), d[0]))[:10]
    found = []
    for pos, canon, _, count, name in best:
        cw = canon.split()
        strict = len(cw) == 1 and len(words) > 1 and lead[:1] != cw
        found.append([name, ratio(norm, canon) if strict else token_set_ratio(norm, canon)])
    squeezed = {}
    for _, canon, _, _, name in dim:
        squeezed.setdefault(canon.replace(" ", ""), name)
    for alias_norm, canonical in aliases:
        squeezed.setdefault(alias_norm.replace(" ", ""), canonical)
    if len(lead[0]) >= 5 and lead[0] in squeezed:
        found = [f for f in found if f[0] != squeezed[lead[0]]] + [[squeezed[lead[0]], 96.0]]
    inside = None
    for _, canon, _, _, name in dim:
        cw = canon.split()
        if len(canon) < 4 or (len(cw) == 1 and lead[:1] != cw):
            continue
        if any(words[i : i + len(cw)] == cw for i in range(len(words))) and (inside is None or len(canon) > len(inside[1])):
            inside = (name, canon)
    if inside:
        hit = [f for f in found if f[0] == inside[0]]
        if hit:
            hit[0][1] = max(hit[0][1], 95.0)
        else:
            found.append([inside[0], 95.0])
    info = {name: (count, len(canon)) for _, canon, _, count, name in dim}
    found.sort(key=lambda f: (-f[1], -info[f[0]][0], -info[f[0]][1]))
    return found[0][0], found[0][1], "fuzzy" if found[0][1] >= 92 else "new"


def test_chain_equals_plain_loop_over_slices(spark):
    rnd = random.Random(11)
    words = ["loom", "mill", "north", "star", "air", "cord", "paper", "river", "bank", "sq", "the", "visa"]
    suppliers = sorted({" ".join(rnd.sample(words[:9], rnd.randrange(1, 4))) for _ in range(40)})
    rows = [(i, s, "c", rnd.randrange(5)) for i, s in enumerate(suppliers)]
    names = sorted({" ".join(rnd.choice(words) + rnd.choice(["", "", "s"]) for _ in range(rnd.randrange(1, 5))) for _ in range(120)})
    names += ["riverbank auto pay", "northstar 12"]
    b = resolve.Book(
        spark.createDataFrame(rows, "pos long, supplier string, default_category string, count long"),
        spark.createDataFrame(ALIASES, "pos long, alias string, supplier string"),
    )
    frame = names_frame(spark, names)
    out = resolve.resolve(frame, b, Settings(dimension_slice_rows=15)).by_name.collect()
    got = {r.norm: (r.canonical, round(r.score, 6), r.method) for r in out}
    dim = [(r.pos, r.norm, None, r["count"], r.supplier) for r in resolve.supplier_index(b.suppliers).orderBy("pos").collect()]
    for norm, (canonical, score, method) in got.items():
        want = plain_resolve(norm, dim, [("loomfab nyc", "Loom Fabrics")])
        want = (None if want[2] == "new" else want[0], round(want[1], 6), want[2])
        assert (canonical, score, method) == want, norm


def test_duplicates_equal_all_pairs(spark):
    out = resolve.suggest_duplicates(book(spark).suppliers, cfg=Settings(dimension_slice_rows=3))
    got = {(r.supplier_a, r.supplier_b): (round(r.score, 4), r.suggested_canonical) for r in out.collect()}
    assert got[("Riverbank", "Riverbank.com")] == (100.0, "Riverbank.com")
    assert ("Loom Fabrics", "Mill") not in got


def test_decisions_fill_the_grey_zone(spark):
    b, frame = book(spark), names_frame(spark, ["Norh Sta Ai", "Norh Sta Ai"])
    assert {r.method for r in resolve.resolve(frame, b).matches.collect()} == {"new"}
    decided = spark.createDataFrame([("norh sta ai", "North Star Air")], "norm string, choice string")
    out = resolve.resolve(frame, b, decisions=decided)
    assert [r.method for r in out.matches.orderBy("seq").collect()] == ["model", "alias"]


def test_a_very_long_name_keeps_its_candidates(spark):
    from tallyloom.operators import probe

    long = "a" * 40_000
    dim = spark.createDataFrame([(0, long + " b"), (1, "c d"), (2, "e")], "pos long, norm string")
    got = probe.top_candidates(spark.createDataFrame([(long + " c",)], "norm string"), dim, 2, 2).orderBy("place").collect()
    assert [r.pos for r in got] == [0, 1] and got[0].token_set > 99


def random_names(rnd, n):
    words = ["loom", "looms", "mill", "mills", "north", "northern", "star", "air", "cord", "paper", "riverbank", "ab", "a", "x1"]
    out = set()
    while len(out) < n:
        w = [rnd.choice(words) for _ in range(rnd.randrange(1, 5))]
        if rnd.random() < 0.5:
            i = rnd.randrange(len(w))
            at = rnd.randrange(len(w[i]) + 1)
            w[i] = w[i][:at] + rnd.choice(["", "e", "zz"]) + w[i][at + rnd.randrange(2):]
        out.add(" ".join(x for x in w if x) or "a")
    return sorted(out)


@pytest.mark.parametrize("least", [80.0, 85.0, 95.0])
def test_similar_names_equal_all_pairs(spark, least):
    from tallyloom.operators import probe

    names = random_names(random.Random(int(least)), 160)
    dim = spark.createDataFrame([(i, n) for i, n in enumerate([*names, ""])], "pos long, norm string")
    want = {}
    for i, a in enumerate(names):
        for j in range(i + 1, len(names)):
            x, y = a.split(), names[j].split()
            n = min(len(x), len(y))
            lead, score = x[:n] == y[:n], token_set_ratio(a, names[j])
            if score >= least or (lead and min(len(a), len(names[j])) >= 4):
                want[i, j] = (score, lead)
    got = {(r.pos_a, r.pos_b): (r.token_set, r.leads) for r in probe.similar_pairs(dim, least).collect()}
    assert got == want and len(want) > 20


def test_a_hot_letter_pair_is_split(spark, monkeypatch):
    from tallyloom.operators import probe

    names = random_names(random.Random(3), 80)
    dim = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "pos long, norm string")
    want = {tuple(r) for r in probe.similar_pairs(dim, 85.0).collect()}
    monkeypatch.setattr(probe, "PAIR_ROWS", 5)
    assert {tuple(r) for r in probe.similar_pairs(dim, 85.0).collect()} == want


def test_few_of_all_pairs_are_scored(spark):
    """Distinct names: the pairs that reach the scorer are a small share of all pairs."""
    from tallyloom.durable import Scratch
    from tallyloom.operators import probe

    rnd = random.Random(9)
    names = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) + " " + "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(600)]
    dim = spark.createDataFrame(list(enumerate(names)), "pos long, norm string")
    met = probe.similar_candidates(dim, 85.0, Scratch(spark, "t")).count()
    assert met < 600 * 599 / 2 / 10
    assert probe.similar_pairs(dim, 85.0).count() == 0


def test_ten_best_equal_plain_scores(spark):
    from tallyloom.operators import probe

    rnd = random.Random(4)
    dim = random_names(rnd, 150) + ["", "q" * 70 + " loom", "loom " + "w" * 300]
    names = random_names(rnd, 60) + ["loom " + "q" * 66, "ö漢 loom", "w" * 299]
    held = probe._Slice(list(range(len(dim))), dim)
    for name in names:
        want = sorted((-token_set_ratio(name, d), i) for i, d in enumerate(dim))[:10]
        assert held.best(name, 10) == [(i, -s) for s, i in want], name


def test_whole_candidates_are_the_ten_best_at_100(spark, monkeypatch):
    from tallyloom.operators import probe

    monkeypatch.setattr(probe, "PAIR_ROWS", 5)  # hot words are split
    rnd = random.Random(6)
    dim, names = random_names(rnd, 200) + ["", "mill mill"], random_names(rnd, 80) + ["", "unknown word", "star star mill"]
    frame = spark.createDataFrame([(n,) for n in sorted(set(names))], "norm string")
    found = probe.whole_candidates(frame, spark.createDataFrame(list(enumerate(dim)), "pos long, norm string"), 10).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.norm, r.place)):
        got.setdefault(r.norm, []).append((r.pos, r.token_set, r.plain))
    want = {}
    for name in names:
        whole = [i for i, d in enumerate(dim) if token_set_ratio(name, d) == 100.0][:10]
        if whole:
            want[name] = [(i, 100.0, ratio(name, dim[i]) if len(dim[i].split()) == 1 else None) for i in whole]
    assert got == want and max(map(len, want.values())) == 10


def test_names_that_hold_a_supplier_do_not_meet_the_whole_dimension(spark, monkeypatch):
    from tallyloom.operators import probe

    met, plain = [], probe.top_candidates

    def watched(names, *rest):
        met.extend(r.norm for r in names.collect())
        return plain(names, *rest)

    monkeypatch.setattr(probe, "top_candidates", watched)
    out = resolve.resolve(names_frame(spark, ["SQ *LOOM FABRICS NY", "Lom Fabrics", "GOOD MILL CAFE"]), book(spark))
    assert [r.canonical for r in out.matches.orderBy("seq").collect()] == ["Loom Fabrics", "Loom Fabrics", None]
    assert sorted(met) == ["good mill cafe", "lom fabrics"]
