"""Statement readers on re-created files."""

import datetime as dt

from tallyloom.sources import statements as source

CARD = (
    "Transaction Date,Posted Date,Card No.,Description,Category,Debit,Credit\r\n"
    "2024-03-01,2024-03-02,11,LOOM WORKS,Goods,12.50,\r\n"
    "2024-03-05,2024-03-06,11,\"MILL, NORTH\",Goods,\"1,200.00\",\r\n"
    "2024-03-04,2024-03-04,11,PAYMENT THANKS,Pay,,50.00\r\n"
    "2024-03-07,2024-03-08,11,NOTHING,Goods,,\r\n"
    "2024-03-07,2024-03-08,11,BROKEN,Goods,abc,5.00\r\n"
)
SIGNED = "﻿My bank\nAccount 1\nDate,Description,Amount\n3/1/2024,Reed shop,-5.00\n3/2/2024,CARD PAYMENT,-9.00\nTotal,,14.00\n"
SPANNING = 'Date,Details,Withdrawals,Deposits,Balance\n2024-01-02,"two\nlines",7.00,,10.00\n2024-01-03,back,,3.00,13.00\n'
OTHER = "Item,Quantity,Price\nA,1,2\n"
PAGE = """<html><body><p>Statement Period: 12/20/2023 - 01/19/2024</p>
<table><tr><td>Date</td><td>Points</td></tr></table>
<table><thead><tr><th>Date</th><th>Description</th><th>Amount</th></tr></thead><tbody>
<tr><td>12/21</td><td>Loom <b>Works</b></td><td>$4.00</td></tr><tr><td>12/30</td><td>Refund</td><td>-$1.00</td></tr>
<tr><td>Total</td><td>all</td><td>$3.00</td></tr></tbody></table></body></html>"""


def parse(spark, **files):
    rows = [(name.replace("__", "."), body) for name, body in files.items()]
    txns, status = source.parse_statements(spark.createDataFrame(rows, "source_file string, content string"))
    got = [
        (r.source_file, r.date.isoformat(), r.description, str(r.amount), r.direction, r.ref)
        for r in txns.orderBy("source_file", "row_no").collect()
    ]
    return txns, got, {r.source_file: (r.reader, r.flagged) for r in status.collect()}


def test_formats(spark):
    txns, got, status = parse(spark, card__csv=CARD, signed__csv=SIGNED, span__csv=SPANNING, other__csv=OTHER, page__html=PAGE)
    assert got == [
        ("card.csv", "2024-03-01", "LOOM WORKS", "12.50", "debit", "card.csv#1"),
        ("card.csv", "2024-03-05", "MILL, NORTH", "1200.00", "debit", "card.csv#2"),
        ("card.csv", "2024-03-04", "PAYMENT THANKS", "50.00", "credit", "card.csv#3"),
        ("page.html", "2023-12-21", "Loom Works", "4.00", "debit", "page.html#1"),
        ("page.html", "2023-12-30", "Refund", "1.00", "credit", "page.html#2"),
        ("signed.csv", "2024-03-01", "Reed shop", "5.00", "debit", "signed.csv#1"),
        ("signed.csv", "2024-03-02", "CARD PAYMENT", "9.00", "credit", "signed.csv#2"),
        ("span.csv", "2024-01-02", "two\nlines", "7.00", "debit", "span.csv#1"),
        ("span.csv", "2024-01-03", "back", "3.00", "credit", "span.csv#2"),
    ]
    assert status["other.csv"] == (None, True) and status["card.csv"] == ("csv", False) and status["page.html"] == ("html", False)
    spans = {r.source_file: (r.statement_start, r.statement_end) for r in txns.collect()}
    assert spans["card.csv"] == (dt.date(2024, 3, 1), dt.date(2024, 3, 5))
    assert spans["page.html"] == (dt.date(2023, 12, 20), dt.date(2024, 1, 19))


def test_lines_of_a_file_on_disk(spark, tmp_path):
    (tmp_path / "a.csv").write_text(SIGNED)
    rows = source.parse_csv_lines(source.read_lines(spark, str(tmp_path))).orderBy("row_no").collect()
    assert [r.description for r in rows] == ["Reed shop", "CARD PAYMENT"]


def test_replies(spark):
    reply = '```json\n{"statement_start": "2024-01-01", "statement_end": null, "transactions": [{"date": "2024-01-03", "description": "A", "amount": 5.5, "direction": "debit", "balance": null, "ref": null}, {"date": "?", "description": "B", "amount": 1, "direction": "debit"}, {"date": "2024-01-04", "description": "C", "amount": "7", "direction": "credit", "ref": "Z9"}]}\n```'
    rows = source.parse_responses(spark.createDataFrame([("s.pdf", reply)], "source_file string, response string")).orderBy("row_no")
    assert [(r.description, str(r.amount), r.ref) for r in rows.collect()] == [("A", "5.50", "s.pdf#1"), ("C", "7.00", "Z9")]


def test_long_preamble_and_late_header(spark):
    body = "".join(f"note {i}\n" for i in range(22)) + "Date,Description,Amount\n2024-03-01,Reed shop,5.00\n"
    _, got, status = parse(spark, late__csv=body)
    assert got == [("late.csv", "2024-03-01", "Reed shop", "5.00", "debit", "late.csv#1")] and status["late.csv"] == ("csv", False)


def test_semicolons_with_quoted_breaks_and_commas(spark):
    body = "x, y, z, and more, of this, in a preamble\nDate;Details;Withdrawals;Deposits\n2024-01-02;\"two, three,\nfour, five\";7.00;\n2024-01-03;back, home;;3.00\n"
    _, got, _ = parse(spark, semi__csv=body)
    assert [(d, a) for _, _, d, a, _, _ in got] == [("two, three,\nfour, five", "7.00"), ("back, home", "3.00")]


def test_quoted_cells(spark):
    lines = ['a,"b, ""c""",d', '"x",,"y,z"', "plain,cells,", '"",e']
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = [r[0] for r in df.select(source._split_cells(df.line, ",")).collect()]
    assert got == [["a", 'b, "c"', "d"], ["x", "", "y,z"], ["plain", "cells", ""], ["", "e"]]


def test_bad_bytes_and_failing_files_stay_alone(spark, monkeypatch):
    from tallyloom.sources import files as file_source

    rows = [("bank/good.csv", CARD.encode()), ("bank/bad.csv", CARD.encode() + b"2024-03-09,,,\xff\xfe,,1.00,\n"), ("bank/page.html", PAGE.encode().replace(b"Loom", b"L\xffom"))]
    raw = spark.createDataFrame([(n, bytearray(b)) for n, b in rows], "relative_path string, content binary")
    txns, status = source.parse_statements(file_source.text_content(raw))
    flags = {r.source_file: (r.reader, r.flagged) for r in status.collect()}
    assert flags == {"bank/good.csv": ("csv", False), "bank/bad.csv": (None, True), "bank/page.html": ("html", False)}
    assert "L�om Works" in [r.description for r in txns.collect()]
    import csv

    huge = 'Date,Details,Withdrawals\n2024-01-02,"two\n' + "y" * (csv.field_size_limit() + 10) + '",7.00\n'
    df = spark.createDataFrame([("huge.csv", huge), ("card.csv", CARD)], "source_file string, content string")
    txns, status = source.parse_statements(df)
    by = {r.source_file: r for r in status.collect()}
    assert by["huge.csv"].error and not by["huge.csv"].flagged and by["card.csv"].error is None
    assert {r.source_file for r in txns.collect()} == {"card.csv"}


def test_replies_with_braces_in_prose(spark):
    from tallyloom.operators import expenses

    replies = ['Here {see below}: {"total": 5, "notes": ["a {b}"]} and {more}', "no object {at all}", "", '{"total": "7"}', None, '{"a": {"total": 1}}']
    df = spark.createDataFrame(list(enumerate(replies)), "source_file string, response string")
    got = {r.source_file: (r.total, r.error) for r in expenses.read_replies(df).collect()}
    assert [None if got[str(i)][0] is None else int(got[str(i)][0]) for i in range(6)] == [5, None, None, 7, None, None]
    assert [got[str(i)][1] is not None for i in range(6)] == [False, True, True, False, True, False]


def test_whole_files_come_in_small_batches(spark):
    """A reader's Python task holds a few megabytes of files at a time, however many its split has."""
    from pyspark.sql import functions as F

    from tallyloom.operators import statements as st
    from tallyloom.settings import DEFAULTS
    from tallyloom.sources import statements as source

    def weigh(batches):
        for pdf in batches:
            yield pdf.assign(layout="csv", row_no=pdf["content"].str.len().sum(), cells=[["x"]] * len(pdf), year_hint=2024).drop(columns="content")

    files = spark.range(0, 200, 1, 1).select(F.col("id").cast("string").alias("source_file"), F.repeat(F.lit("x"), 100_000).alias("content"))
    reader = source.Reader("big", (".big",), lambda f: f.mapInPandas(weigh, source.ROWS), lambda rows: rows, lambda rows, _: st.with_header(rows))
    _, rows, _ = source._parse_with(reader, files, DEFAULTS)
    assert rows.count() == 200
    assert rows.agg(F.max("row_no")).first()[0] <= 2 * source.BATCH_BYTES


def test_plain_table_tags_are_read_as_the_parser_does(monkeypatch):
    import random
    import re

    rnd = random.Random(5)
    pieces = ["<table>", "</table>", "<tr>", "</tr>", "<td>", "</td>", "<th>", "</th>", "<thead>", "</thead>", "<tbody>", "<TD>", "<td class=a>", "</td >",
              "<script>", "</script>", "<style>", "</style>", "<td/>", "<tr", "<", "a &amp; b", "x", " ", "\n", "<b>y</b>", "<!-- <td> -->", "</tr"]
    pages = ["<table><tr>" + "".join(rnd.choice(pieces) for _ in range(rnd.randrange(5, 60))) for _ in range(400)]
    got = [source._page_rows(p) for p in pages]
    never = re.compile("(?!)")
    monkeypatch.setattr(source, "_PLAIN_START", never)
    monkeypatch.setattr(source, "_PLAIN_END", never)
    assert got == [source._page_rows(p) for p in pages] and sum(map(len, got)) > 200


def test_a_page_is_read_once(spark):
    """Neither the header of a table nor the period of a page needs the page a second time."""
    from pyspark.sql import functions as F

    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(body):
        read.add(1)
        return body

    files = spark.createDataFrame([(f"p{i}.html", PAGE) for i in range(4)], "source_file string, content string")
    txns = source.parse_html(files.withColumn("content", counted.asNondeterministic()("content"))).collect()
    assert len(txns) == 8 and read.value == 4
    assert {(r.statement_start, r.statement_end) for r in txns} == {(dt.date(2023, 12, 20), dt.date(2024, 1, 19))}
