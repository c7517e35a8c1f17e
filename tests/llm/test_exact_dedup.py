import hashlib
import re

from pyspark.sql import functions as F

from tallyloom.llm import exact_dedup


def plain(rows):
    groups = {}
    for place, (d, t) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), d is None, d or 0, place, d))
    out = []
    for norm, members in groups.items():
        best = min(members)
        for m in members:
            out.append((m[4], best[4], len(members), hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str), len(groups)


ROWS = [(1, "a b c"), (2, "abc"), (3, "a\x0bbc  "), (4, None), (5, ""), (6, " \n"), (7, "xyz" * 50000), (8, "xyz" * 50000 + "!"),
        (9, "x yz" * 50000), (10, "ä ö"), (11, "äö"), (12, "ab"), (13, "ab\u00a0"), (13, "ab\u00a0"), (None, "abc"), (14, "q" * 5), (15, "q" * 6),
        (16, "q" * 7), (17, "r" * 8), (18, "r" * 8 + " "), (19, "qqqqqr"), (20, "rqqqqq")]


def check(spark, **options):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("name", F.lit("x")).withColumn("h", F.lit(1)).withColumn("row", F.lit(2))
    got = exact_dedup.dedup(df, **options).collect()
    want, groups = plain(ROWS)
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == want
    assert sum(r.kept for r in got) == groups


def test_edge_rows(spark):
    check(spark)


def test_small_blocks_name_over_many_levels(spark):
    check(spark, block_chars=3)


def test_colliding_hashes_change_the_hash(spark):
    seen = []

    def weak(block, attempt):
        seen.append(attempt)
        return F.pmod(F.xxhash64(block), F.lit(3)) if attempt < 2 else F.xxhash64(block)

    check(spark, hashing=weak)
    assert max(seen) == 2


def test_empty_table(spark):
    assert exact_dedup.dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
