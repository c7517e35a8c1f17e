"""Readers for bank statements: CSV lines, HTML tables, structured responses, and their dispatch.

A reader takes files(source_file, content) or lines and returns table rows
(source_file, layout, row_no, cells, year_hint). `READERS` is the place to add another format.
"""

from __future__ import annotations

import csv
import io
import re
from collections import Counter
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.durable import Scratch
from tallyloom.functions import dates, money, text
from tallyloom.functions.bind import let
from tallyloom.operators import statements as st
from tallyloom.settings import DEFAULTS, Settings

DELIMITERS = {"comma": ",", "semicolon": ";", "tab": "\t"}
BATCH_BYTES = 4 << 20
ROWS = "source_file string, layout string, row_no bigint, cells array<string>, year_hint int"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, row_no, line) of text files. Large files are split; row_no keeps file order:
    start of the split, then place inside it."""
    raw = spark.read.option("recursiveFileLookup", "true").text(path).select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("id"),
        F.col("value").alias("line"),
    )
    # ids grow inside a split; the first id of the split makes them relative.
    firsts = raw.groupBy("source_file", "start").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("source_file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    skips = firsts.select("source_file", "start", "first_id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    return raw.join(skips, ["source_file", "start"]).select(
        "source_file", (F.col("id") - F.col("first_id") + F.col("skip")).alias("row_no"), "line"
    )


def lines_of(files: DataFrame) -> DataFrame:
    """(source_file, row_no, line) of files(source_file, content) with text content."""
    return files.select("source_file", F.posexplode(F.split("content", r"\r?\n")).alias("row_no", "line")).withColumn(
        "row_no", F.col("row_no").cast("bigint")
    )


def _split_cells(line, mark: str):
    """Cells of one line: split at marks outside quotes, outer quotes removed, "" read as one quote.

    A line without a quote is split plainly. Else cells are read one by one from the left, so the work
    follows the length of the line.
    """
    q = text.quoted(mark) if mark != "\t" else r"\t"
    plain = F.split(line, q, -1)
    # Each cell is read with the mark before it; the mark put in front makes the first one like the rest.
    read = F.regexp_extract_all(F.concat(F.lit(mark), line), F.lit(rf'{q}((?:[^"{mark}]++|"[^"]*+"|"[^"]*+$)*+)'), F.lit(1))
    return F.when(~F.contains(line, F.lit('"')), plain).otherwise(_unquoted(read))


def _unquoted(cells):
    return F.transform(
        cells,
        lambda c: F.when(
            F.rlike(c, F.lit(r'^".*"$')),
            F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"')),
        ).otherwise(c),
    )


def file_marks(lines: DataFrame) -> DataFrame:
    """(source_file, mark): the delimiter of each file that has a header line.

    The first line that any of comma, semicolon and tab cuts into a header decides, by the mark that
    cuts it into the most cells. Only lines that hold the words of a header are cut.
    """
    hopeful = lines.where(st.may_be_header(F.col("line")))
    cuts = [F.struct(F.lit(i).alias("at"), F.lit(m).alias("mark"), _split_cells(F.col("line"), m).alias("cells")) for i, m in enumerate(DELIMITERS.values())]
    tries = hopeful.select("source_file", "row_no", F.explode(F.array(*cuts)).alias("cut")).where(st.is_header(F.col("cut.cells")))
    best = F.struct("row_no", -F.size("cut.cells"), F.col("cut.at").alias("at"))
    return tries.groupBy("source_file").agg(F.min_by("cut.mark", best).alias("mark"))


def _clean(lines: DataFrame) -> DataFrame:
    return lines.withColumn("line", F.regexp_replace("line", "^\ufeff|\r$", ""))


def csv_rows(lines: DataFrame, default_year: int | None = None) -> DataFrame:
    """Table rows of CSV lines, split at the file's delimiter; a byte order mark is dropped."""
    clean = _clean(lines)
    cells = F.when(F.col("mark") == ",", _split_cells(F.col("line"), ","))
    for mark in (";", "\t"):
        cells = cells.when(F.col("mark") == mark, _split_cells(F.col("line"), mark))
    return (
        clean.where(F.trim("line") != "")
        .join(file_marks(clean), "source_file")
        .select(
            "source_file",
            F.lit("csv").alias("layout"),
            "row_no",
            cells.alias("cells"),
            F.lit(default_year).cast("int").alias("year_hint"),
        )
    )


def _whole_csv(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for name, content, mark in zip(pdf["source_file"], pdf["content"], pdf["mark"]):
            try:
                rows = list(csv.reader(io.StringIO(content.lstrip("﻿"), newline=""), delimiter=mark))
            except csv.Error as e:  # one bad file is told, the others go on
                yield pd.DataFrame({"source_file": name, "layout": "error", "row_no": -1, "cells": [[str(e)]], "year_hint": pd.Series([None], dtype="Int32")})
                continue
            yield pd.DataFrame(
                {
                    "source_file": name,
                    "layout": "csv",
                    "row_no": range(len(rows)),
                    "cells": rows,
                    "year_hint": pd.Series([None] * len(rows), dtype="Int32"),
                }
            )


def csv_file_rows(files: DataFrame, default_year: int | None = None) -> DataFrame:
    """Table rows of CSV files. Files with a quoted line break go through a full CSV reader, one
    file at a time; all others are read line by line in the JVM."""
    # A line with an odd number of quotes opens or closes a cell that spans lines.
    broken = F.exists(F.split("content", "\n"), lambda line: F.length(F.regexp_replace(line, '[^"]', "")) % 2 == 1)
    marked = files.select("source_file", "content").withColumn("broken", broken)
    plain = csv_rows(lines_of(marked.where("not broken")), default_year)
    spanning = marked.where("broken").drop("broken")
    quoted = spanning.join(file_marks(_clean(lines_of(spanning))), "source_file")
    whole = quoted.mapInPandas(_whole_csv, ROWS).withColumn("year_hint", F.lit(default_year).cast("int"))
    return plain.unionByName(whole)


#: Most tags of a table carry nothing but their name.
_PLAIN_START = re.compile("<(table|thead|tbody|tfoot|tr|td|th)>")
_PLAIN_END = re.compile("</(table|thead|tbody|tfoot|tr|td|th)>")


class _Tables(HTMLParser):
    """Rows of the tables of one page: (table, row, all cells are <th>, inside <thead>, cells).

    Tags of a table without attributes are told by one pattern; all others take the parser's own way.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[list] = []
        self.open: list[dict] = []
        self.tables = 0
        self.skip = 0

    def updatepos(self, i, j):
        return j  # nobody asks for line numbers

    def parse_starttag(self, i):
        plain = _PLAIN_START.match(self.rawdata, i) if self.cdata_elem is None else None
        if plain is None:
            return super().parse_starttag(i)
        self.lasttag = plain[1]
        self.handle_starttag(plain[1], [])
        return plain.end()

    def parse_endtag(self, i):
        plain = _PLAIN_END.match(self.rawdata, i) if self.cdata_elem is None else None
        if plain is None:
            return super().parse_endtag(i)
        self.handle_endtag(plain[1])
        return plain.end()

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.skip += 1
        elif tag == "table":
            self.open.append({"no": self.tables, "row": None, "cell": None, "head": False})
            self.tables += 1
        elif self.open:
            top = self.open[-1]
            if tag == "thead":
                top["head"] = True
            elif tag in ("tbody", "tfoot"):
                self._end_row(top)
                top["head"] = False
            elif tag == "tr":
                self._end_row(top)
                top["row"] = [top["no"], len(self.rows), True, top["head"], []]
                self.rows.append(top["row"])
            elif tag in ("td", "th"):
                self._end_cell(top)
                if top["row"] is not None:
                    top["cell"] = []
                    top["row"][2] = top["row"][2] and tag == "th"

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.skip = max(0, self.skip - 1)
        elif self.open:
            top = self.open[-1]
            if tag in ("td", "th"):
                self._end_cell(top)
            elif tag == "tr":
                self._end_row(top)
            elif tag == "thead":
                self._end_row(top)
                top["head"] = False
            elif tag == "table":
                self._end_row(top)
                self.open.pop()

    def handle_data(self, data):
        if self.skip:
            return
        piece = data.strip()
        if piece:
            for table in self.open:
                if table["cell"] is not None:
                    table["cell"].append(piece)

    def _end_cell(self, table):
        if table["cell"] is not None:
            table["row"][4].append(" ".join(table["cell"]))
            table["cell"] = None

    def _end_row(self, table):
        self._end_cell(table)
        table["row"] = None


CELLS = (
    "source_file string, table_no int, row_no bigint, all_th boolean, in_head boolean, cells array<string>, "
    "td_rows int, period struct<start: date, end: date>"
)
_CELL_TYPES = [pa.string(), pa.int32(), pa.int64(), pa.bool_(), pa.bool_(), pa.list_(pa.string()), pa.int32()]
_CELL_NAMES = ["source_file", "table_no", "row_no", "all_th", "in_head", "cells", "td_rows", "period"]


def _page_rows(content: str | None) -> list[list]:
    """Table rows of a page; the header row of each table carries the number of its rows that are not all <th>."""
    page = _Tables()
    try:
        page.feed(content or "")
        page.close()
        for table in page.open:
            page._end_row(table)
    except Exception as e:  # one bad file is told, the others go on
        return [[-1, -1, False, False, [f"{type(e).__name__}: {e}"], None]]
    found = [r for r in page.rows if r[4]]
    # Header of a table: the row in <thead>, else a row of <th>, else the first row.
    heads: dict[int, tuple[int, int]] = {}
    bodies = Counter(r[0] for r in found if not r[2])
    for i, (table, _, all_th, in_head, _) in enumerate(found):
        rank = 0 if in_head else 1 if all_th else 2
        if table not in heads or rank < heads[table][0]:
            heads[table] = rank, i
    headers = {i for _, i in heads.values()}
    return [[*r, bodies[r[0]] if i in headers else None] for i, r in enumerate(found)]


def _tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, (name, content) in enumerate(zip(batch["source_file"].to_pylist(), batch["content"])):
            rows = _page_rows(content.as_py())
            if rows:
                columns = [pa.array(c, kind) for c, kind in zip([[name] * len(rows), *zip(*rows)], _CELL_TYPES)]
                period = batch["period"].take(pa.array([i] * len(rows)))
                yield pa.RecordBatch.from_arrays([*columns, period], _CELL_NAMES)


def html_cells(files: DataFrame) -> DataFrame:
    """All table rows of HTML files, file by file: (source_file, table_no, row_no, all_th, in_head, cells, td_rows, period).

    td_rows stands on the header row of a table only: how many of its rows are not all <th>. period is the page's.
    """
    period = dates.statement_period(page_text(F.col("content"))).alias("period")
    return files.select("source_file", "content", period).mapInArrow(_tokenize, CELLS)


def page_text(content):
    """Text of a page, one piece per line, scripts and styles left out."""
    bare = F.regexp_replace(content, r"(?is)<(script|style)\b.*?</\1\s*>", "\n")
    return F.regexp_replace(F.regexp_replace(bare, r"(?s)<[^>]*>", "\n"), r"&nbsp;", " ")


def statement_tables(cells: DataFrame) -> DataFrame:
    """(source_file, table_no, head, body) of the tables whose header reads like a statement."""
    heads = cells.where(F.col("td_rows").isNotNull() & st.is_header(F.col("cells")))
    return heads.select(
        "source_file", "table_no", F.struct("row_no", "cells").alias("head"),
        (F.col("td_rows") - F.when(F.col("all_th"), 0).otherwise(1)).alias("body"),
    )


def html_body(cells: DataFrame) -> DataFrame:
    """Body rows of the best statement table of each HTML file, with its column map.

    The best table has a header that reads like a statement and the most body rows.
    """
    heads = statement_tables(cells)
    best = heads.groupBy("source_file").agg(
        F.max_by(F.struct("table_no", "head"), F.struct("body", -F.col("table_no"))).alias("best")
    )
    chosen = best.select(
        "source_file",
        F.col("best.table_no").alias("table_no"),
        F.col("best.head.row_no").alias("head_no"),
        st.header_columns(F.col("best.head.cells")).alias("cols"),
    ).where("cols.date is not null and cols.description is not null")
    body = cells.join(chosen, ["source_file", "table_no"]).where("row_no <> head_no and not all_th")
    return body.select(
        "source_file",
        F.lit("html").alias("layout"),
        "row_no",
        "cells",
        F.year("period.start").alias("year_hint"),
        "cols",
        F.col("period.start").alias("period_start"),
        F.col("period.end").alias("period_end"),
    )


def _finish(body: DataFrame, scratch: Scratch, cfg: Settings) -> DataFrame:
    """Transactions of body rows. Typed rows are written once: numbering and bounds read them again."""
    typed = scratch.write(st.typed_rows(body), "typed")
    return st.statement_bounds(st.stable_refs(typed, cfg)).select(*st.TXN)


def parse_csv_lines(lines: DataFrame, cfg: Settings = DEFAULTS, default_year: int | None = None) -> DataFrame:
    scratch = Scratch(lines.sparkSession, "csv")
    rows = scratch.write(csv_rows(lines, default_year), "rows")
    return _finish(st.with_header(rows), scratch, cfg)


def parse_csv(files: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    return _parse_with(READERS[1], files, cfg)[0]


def parse_html(files: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    return _parse_with(READERS[0], files, cfg)[0]


_TXN_JSON = (
    "statement_start string, statement_end string, transactions array<struct<"
    "date:string,description:string,amount:string,direction:string,balance:string,ref:string>>"
)


def parse_responses(replies: DataFrame) -> DataFrame:
    """Transactions of structured statement replies(source_file, response).

    A row without a date, a description, a direction or an amount is left out; `file#n` counts all
    listed rows, kept or not.
    """
    body = replies.select("source_file", F.from_json(text.json_object(F.col("response")), _TXN_JSON).alias("reply"))
    rows = body.select(
        "source_file",
        dates.parse_date(F.col("reply.statement_start")).alias("statement_start"),
        dates.parse_date(F.col("reply.statement_end")).alias("statement_end"),
        F.posexplode("reply.transactions").alias("at", "txn"),
    )
    own = F.concat("source_file", F.lit("#"), (F.col("at") + 1).cast("string"))
    typed = rows.select(
        "source_file",
        (F.col("at") + 1).cast("bigint").alias("row_no"),
        dates.parse_date(F.col("txn.date")).alias("date"),
        F.col("txn.description").alias("description"),
        money.round_money(money.to_number(F.trim("txn.amount"))).alias("amount"),
        F.col("txn.direction").alias("direction"),
        F.coalesce(F.when(F.col("txn.ref") != "", F.col("txn.ref")), own).alias("ref"),
        money.round_money(money.to_number(F.trim("txn.balance"))).alias("balance"),
        "statement_start",
        "statement_end",
    )
    valid = "date is not null and description <> '' and amount is not null and direction in ('debit', 'credit')"
    return typed.where(valid).select(*st.TXN)


@dataclass(frozen=True)
class Reader:
    """One statement format: table rows of files, the files it claims, and body rows with a column map."""

    name: str
    suffixes: tuple[str, ...]
    rows: Callable[[DataFrame], DataFrame]
    claims: Callable[[DataFrame], DataFrame]
    body: Callable[[DataFrame, DataFrame], DataFrame]
    strict_bytes: bool = False


def _csv_claims(rows: DataFrame) -> DataFrame:
    return rows.where(st.is_header(F.col("cells"))).select("source_file").distinct()


HTML = Reader(
    "html", (".html", ".htm"), html_cells, lambda cells: statement_tables(cells).select("source_file").distinct(),
    lambda cells, files: html_body(cells),
)
CSV = Reader("csv", (".csv",), csv_file_rows, _csv_claims, lambda rows, files: st.with_header(rows), True)
READERS: list[Reader] = [HTML, CSV]


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Whole files reach a Python task in batches of a few megabytes, so its memory does not grow with the files of a split."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(BATCH_BYTES))
    try:  # a write keeps the setting it started with
        yield
    finally:
        spark.conf.set(key, before)


def _parse_with(reader: Reader, files: DataFrame, cfg: Settings) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(transactions, claimed files, files that failed with their error) of one reader; its table rows are written once."""
    scratch = Scratch(files.sparkSession, reader.name)
    with _small_batches(files.sparkSession):
        read = scratch.write(reader.rows(files), "rows")
    rows, failed = read.where("row_no >= 0"), read.where("row_no < 0")
    errors = failed.select("source_file", F.get("cells", F.lit(0)).alias("error"))
    return _finish(reader.body(rows, files), scratch, cfg), reader.claims(rows), errors


def parse_statements(
    files: DataFrame, cfg: Settings = DEFAULTS, replies: DataFrame | None = None, readers: list[Reader] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(transactions, files with reader, flagged and error). Readers are tried in order and the first to
    claim a file wins; a file no reader claims is flagged and taken from `replies` when listed there.

    A file whose reader fails has an error and no rows; the others go on. A column `valid` tells whether the
    bytes were UTF-8: CSV files that were not are flagged, HTML is read with replacement characters.
    """
    if "valid" not in files.columns:
        files = files.withColumn("valid", F.lit(True))
    files = Scratch(files.sparkSession, "files").write(files.select("source_file", "content", "valid"), "content")
    suffix = F.lower(text.file_suffix(text.file_name(F.col("source_file"))))
    txns: DataFrame | None = None
    taken: DataFrame | None = None
    failed: DataFrame | None = None
    for reader in READERS if readers is None else readers:
        mine = files.where(suffix.isin(*reader.suffixes) & (F.col("valid") | F.lit(not reader.strict_bytes))).drop("valid")
        if taken is not None:
            mine = mine.join(taken, "source_file", "left_anti")
        parsed, claimed, errors = _parse_with(reader, mine, cfg)
        claimed = claimed.withColumn("reader", F.lit(reader.name))
        txns = parsed if txns is None else txns.unionByName(parsed)
        taken = claimed if taken is None else taken.unionByName(claimed)
        failed = errors if failed is None else failed.unionByName(errors)
    status = files.select("source_file").join(taken, "source_file", "left").join(failed, "source_file", "left").select(
        "source_file", "reader", (F.col("reader").isNull() & F.col("error").isNull()).alias("flagged"), "error"
    )
    if replies is not None:
        open_files = status.where("flagged").select("source_file")
        txns = txns.unionByName(parse_responses(replies.join(open_files, "source_file", "left_semi")))
    return txns, status


#: Statement formats by name: functions from the text of a file to its rows of cells. Add a bank's format here.
FORMATS: dict[str, Callable[[str], Iterator[list[str]]]] = {
    name: (lambda content, mark=mark: csv.reader(io.StringIO(content.lstrip("\ufeff"), newline=""), delimiter=mark))
    for name, mark in DELIMITERS.items()
}


class _ParseStatement:
    """Table function: the rows of cells of one file, numbered from 0; none for an empty text or an unknown format."""

    def eval(self, content: str, format: str) -> Iterator[tuple[int, list[str]]]:
        if content and format in FORMATS:
            yield from enumerate(FORMATS[format](content))


def register_parser(spark: SparkSession, name: str = "parse_statement") -> None:
    """Make the formats callable from SQL: `FROM files, LATERAL parse_statement(content, format)`."""
    spark.udtf.register(name, F.udtf(_ParseStatement, returnType="row_no bigint, cells array<string>"))


def parse_cells(rows: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Transactions of rows(source_file, row_no, cells) whose files have a header row, as parse_statement gives them."""
    scratch = Scratch(rows.sparkSession, "cells")
    named = rows.select("source_file", F.lit("csv").alias("layout"), "row_no", "cells", F.lit(None).cast("int").alias("year_hint"))
    return _finish(st.with_header(scratch.write(named, "rows")), scratch, cfg)
