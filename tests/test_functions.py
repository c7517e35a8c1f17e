"""Scalar functions on small cases, and scorers against plain dynamic programming."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import dates, hashing, money, scorers, text


def column(spark, values, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.select("i", build(F.col("v")).alias("o")).orderBy("i").select("o").collect()]


def test_normalise(spark):
    given = ["C&C Button Inc", "T-Mobile", "The Company", "Inc", "the", "Ärzte GmbH & Co.", None, "  "]
    want = ["c c button", "t mobile", "the", "inc", "the", "ärzte gmbh", "", ""]
    # "The Company" loses its company form first; a lone "the" stays.
    assert column(spark, given, text.normalise_name) == want


def test_processor_words_never_empty_a_name(spark):
    assert column(spark, ["sq fern hill", "pos debit visa", "paypal", "fern sq"], text.strip_processor) == [
        "fern hill", "visa", "paypal", "fern sq",
    ]


def test_canonical_path(spark):
    given = ["e/a__deadbeef.pdf", "e/a__DEADBEEF.pdf", "e/a__deadbee.pdf", "x__deadbeef/a.pdf", "e/a__deadbeef", "a.__deadbeef"]
    want = ["e/a.pdf", "e/a__DEADBEEF.pdf", "e/a__deadbee.pdf", "x__deadbeef/a.pdf", "e/a", "a.__deadbeef"]
    assert column(spark, given, text.canonical_path) == want


def test_filename_hint(spark):
    given = ["2026-09-01 - Loom (a) receipt (2 b) Receipt.pdf", "2026-09-01 receipts (x.pdf", "202609011 Loom.pdf", "2026-09-01 - Loom.pdf", "20260901_Loom Works (1).jpg", "2026-13-45 Loom receipt.pdf", "IMG_1.jpg", "2026-09-01.pdf"]
    d = dt.date(2026, 9, 1)
    got = [tuple(r) for r in column(spark, given, text.filename_hint)]
    assert got == [(d, "Loom"), (d, "receipts (x"), (None, None), (d, "Loom"), (d, "Loom Works"), (None, "Loom"), (None, None), (d, None)]


def test_strip_phrases(spark):
    got = column(spark, ["Loom Works - Ann Lee", "Ann Lee", "Annlee Loom", "a_-Ann  Lee", "Ann Lee - ann lee_x"], lambda c: text.strip_phrases(c, ["Ann Lee"]))
    assert got == ["Loom Works", None, "Annlee Loom", "a_-Ann Lee", "ann lee_x"]


def test_payment_method(spark):
    known = ["Visa", "Cash", "Store card"]
    got = column(spark, ["VISA **1", "paid cash", "store CARD 9", "Barter ", "", "my bank"], lambda c: text.payment_method(c, known, [("my bank", "Visa")]))
    assert got == ["Visa", "Cash", "Store card", "Barter", "", "Visa"]


@pytest.mark.parametrize(
    "cell, want",
    [
        ("$1,234.56", ("1234.56", None, False)), ("(12.34)", ("12.34", None, True)), ("-$5", ("5.00", None, True)),
        ("12.34 CR", ("12.34", "credit", False)), ("dr 3", ("3.00", "debit", False)), ("12.34CR", None), ("$(5.00)", None),
        ("", None), ("n/a", None), ("2.675", ("2.68", None, False)), ("2.665", ("2.66", None, False)),
    ],
)
def test_parse_amount(spark, cell, want):
    got = column(spark, [cell], money.parse_amount)[0]
    assert (None if got is None else (str(got[0]), got[1], got[2])) == want


def test_parse_date(spark):
    given = ["09-Mar-24", "9 Mar 24", "Mar 9, 24", "2024-03-09", "3/9/2024", "13/5/2024", "3/9/24", "Mar 9, 2024", "9 March 2024", "20240309", "3/9", "Mar 9", "2024-02-30", "x", "2024-03-09T10:00:00"]
    d = dt.date(2024, 3, 9)
    want = [d, d, d, d, d, dt.date(2024, 5, 13), d, d, d, d, dt.date(2020, 3, 9), dt.date(2020, 3, 9), None, None, d]
    assert column(spark, given, lambda c: dates.parse_date(c, F.lit(2020))) == want


def test_statement_period(spark):
    given = ["Statement Period: 01/02/2024 - 02/01/2024\nx", "From January 2, 2024 through February 1, 2024.", "none"]
    got = column(spark, given, dates.statement_period)
    span = (dt.date(2024, 1, 2), dt.date(2024, 2, 1))
    assert [None if g is None else tuple(g) for g in got] == [span, span, None]


def test_block_hash(spark):
    import hashlib

    data = b"abcdefghij"
    digests = b"".join(hashlib.sha256(data[i : i + 4]).digest() for i in range(0, 10, 4))
    df = spark.createDataFrame([(bytearray(data),), (bytearray(b""),)], "b binary")
    got = [r[0] for r in df.select(hashing.block_hash(F.col("b"), 4)).collect()]
    assert got == [hashlib.sha256(digests).hexdigest(), hashlib.sha256(b"").hexdigest()]


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for ch in a:
        new = [0]
        for j, other in enumerate(b, start=1):
            new.append(row[j - 1] + 1 if ch == other else max(row[j], new[j - 1]))
        row = new
    return row[-1]


def test_scorers_against_plain_tables():
    rnd = random.Random(7)
    for _ in range(1500):
        a, b = ("".join(rnd.choice("abc d") for _ in range(rnd.randrange(12))) for _ in range(2))
        assert scorers.lcs_length(a, b) == slow_lcs(a, b)
        if a and b:
            windows = []
            for x, y in ((a, b), (b, a)):
                if len(x) <= len(y):
                    windows += [200 * slow_lcs(x, w) / (len(x) + len(w)) for i in range(-len(x) + 1, len(y)) if (w := y[max(0, i) : i + len(x)])]
            assert scorers.partial_ratio(a, b) == pytest.approx(max(windows))


def test_token_set_shortcuts():
    assert scorers.token_set_ratio("delta", "delta air lines") == 100.0
    assert scorers.token_set_ratio("", "x") == 0.0
    assert scorers.token_set_ratio("air delta", "delta air") == 100.0
    assert scorers.token_set_ratio("ab", "ac") == pytest.approx(50.0)
