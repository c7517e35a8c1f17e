"""Statement rows to transactions.

Input is one row per table line: (source_file, layout, row_no, cells), whatever file it came from.
The header line names the columns; the rest is typed with the same expressions for every layout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import dates, money, text
from tallyloom.functions.bind import let
from tallyloom.operators import ordered
from tallyloom.settings import DEFAULTS, Settings

# Header and cell wording. Each list keeps its meaning's order of trial.
COLUMN_WORDS = (
    ("date", ("date", "posted", "posting date", "transaction date", "post date")),
    ("debit", ("debit", "withdrawal", "withdrawals")),
    ("credit", ("credit", "deposit", "deposits")),
    ("amount", ()),
    ("type", ("type",)),
    ("ref", ("reference", "ref", "id")),
    ("balance", ("balance",)),
    ("description", ("description", "details", "payee", "memo", "transaction", "merchant")),
)
REQUIRED_WORDS = (
    ("date", "posted", "transaction date", "post date"),
    ("amount", "debit", "credit", "withdrawal", "deposit", "withdrawals", "deposits"),
    ("description", "details", "payee", "memo", "transaction", "merchant"),
)
SKIP_WORDS = ("total", "balance", "opening", "closing")
CREDIT_TEXT = ("PAYMENT", "CREDIT", "REFUND", "DEPOSIT")
CREDIT_TYPES = ("credit", "payment", "deposit")
DEBIT_TYPES = ("debit", "purchase", "withdrawal", "sale")

ROLES = [role for role, _ in COLUMN_WORDS]


def _has_any(value: Column, words: tuple[str, ...], whole_words: bool = False) -> Column:
    if not words:
        return F.lit(False)
    rx = "|".join(words)
    return F.rlike(value, F.lit(rf"\b(?:{rx})\b" if whole_words else f"(?:{rx})"))


def _some_cell(cells: Column, words: tuple[str, ...]) -> Column:
    return F.exists(cells, lambda c: _has_any(text.one_line(c), words))


def is_header(cells: Column) -> Column:
    """True where some cell reads like a date, some like an amount and some like a description."""
    dated, priced, described = (_some_cell(cells, words) for words in REQUIRED_WORDS)
    return dated & priced & described


def may_be_header(line: Column) -> Column:
    """True for every line that some delimiter can cut into a header, and for few others."""
    low = text.one_line(line)
    dated, priced, described = (_has_any(low, words) for words in REQUIRED_WORDS)
    return dated & priced & described


def header_columns(cells: Column, strict: bool = False) -> Column:
    """Map role -> 0-based column index. Columns are read left to right and each takes the first
    role still free whose words it holds; `strict` asks for whole words."""
    none = F.array().cast("array<string>")

    def claim(roles: Column, head: Column) -> Column:
        role = F.lit(None)
        for name, words in reversed(COLUMN_WORDS):
            fits = (head == "amount") if name == "amount" else _has_any(head, words, strict)
            role = F.when(fits & ~F.array_contains(roles, name), name).otherwise(role)
        return F.concat(roles, F.array(F.coalesce(role, F.lit(""))))

    def spare_amount(heads: Column, roles: Column) -> Column:
        # Without a plain "amount" column, the first unclaimed header that holds the word.
        loose = F.zip_with(
            heads, roles, lambda h, r: F.when((r == "") & F.contains(h, F.lit("amount")), "amount").otherwise(r)
        )
        return F.when(F.array_contains(roles, "amount"), roles).otherwise(loose)

    def indexes(heads: Column, roles: Column) -> Column:
        def at(role: str) -> Column:
            return F.when(F.array_contains(roles, role), (F.array_position(roles, role) - 1).cast("int"))

        named = F.transform(heads, lambda h: F.contains(h, F.lit("transaction date")))
        by_name = F.when(F.array_contains(named, True), (F.array_position(named, True) - 1).cast("int"))
        return F.struct(*[at(r).alias(r) for r in ROLES], F.coalesce(by_name, at("date")).alias("transaction_date"))

    return let(
        F.transform(cells, text.one_line),
        lambda heads: let(
            F.aggregate(heads, none, claim),
            lambda roles: let(spare_amount(heads, roles), lambda final: indexes(heads, final)),
        ),
    )


def with_header(rows: DataFrame, strict: bool = False) -> DataFrame:
    """Body rows of files that hold a header, with the column map in `cols`.

    The header is the first qualifying line; lines above it are preamble, however many.
    """
    head = (
        rows.where(is_header(F.col("cells")))
        .groupBy("source_file")
        .agg(F.min_by(F.struct("row_no", "cells"), "row_no").alias("head"))
        .select(
            "source_file",
            F.col("head.row_no").alias("head_no"),
            header_columns(F.col("head.cells"), strict).alias("cols"),
            F.size("head.cells").alias("width"),
        )
    )
    return rows.join(head, "source_file").where(F.col("row_no") > F.col("head_no")).drop("head_no")


def _cell(role: str) -> Column:
    return F.trim(F.coalesce(F.get(F.col("cells"), F.col(f"cols.{role}")), F.lit("")))


def direction_of(amount: Column, kind: Column, description: Column) -> Column:
    """Direction of a single amount column: CR/DR mark, type words, description words, else debit."""
    low, up = F.lower(kind), F.upper(description)
    return (
        F.when(amount["explicit_direction"].isNotNull(), amount["explicit_direction"])
        .when(_has_any(low, CREDIT_TYPES), "credit")
        .when(_has_any(low, DEBIT_TYPES), "debit")
        .when(_has_any(up, CREDIT_TEXT), "credit")
        .otherwise("debit")
    )


def typed_rows(body: DataFrame) -> DataFrame:
    """(source_file, row_no, date, description, amount, direction, bank_ref, balance, ...) of the rows
    that are transactions. Expects layout, cells, cols and year_hint."""
    first = F.lower(F.trim(F.coalesce(F.get(F.col("cells"), F.lit(0)), F.lit(""))))
    date_text = F.when(
        F.col("layout") == "csv",
        F.trim(F.coalesce(F.get(F.col("cells"), F.col("cols.transaction_date")), F.lit(""))),
    ).otherwise(_cell("date"))
    split = F.col("cols.debit").isNotNull() | F.col("cols.credit").isNotNull()
    debit, credit = _cell("debit"), _cell("credit")
    some_side = (debit != "") | (credit != "")
    # A CSV with debit/credit columns never looks at the amount column; HTML does when both are empty.
    by_side = split & ((F.col("layout") == "csv") | some_side)
    side = F.when(debit != "", debit).otherwise(credit)

    read = body.select(
        "source_file",
        "row_no",
        "layout",
        first.alias("first_cell"),
        date_text.alias("date_text"),
        "year_hint",
        _cell("description").alias("description"),
        by_side.alias("by_side"),
        (debit != "").alias("is_debit"),
        F.when(by_side, side).otherwise(_cell("amount")).alias("amount_text"),
        _cell("type").alias("kind"),
        _cell("balance").alias("balance_text"),
        _cell("ref").alias("bank_ref"),
        *[c for c in ("period_start", "period_end") if c in body.columns],
    )
    read = read.where(~_has_any(F.col("first_cell"), SKIP_WORDS) & (F.col("description") != ""))
    read = dates.with_date(read, "date_text", "date", F.col("year_hint"))
    read = money.with_amount(money.with_amount(read, "amount_text", "parsed"), "balance_text", "printed")
    kept = read.where(F.col("date").isNotNull() & F.col("parsed").isNotNull())
    return kept.withColumn("balance", F.col("printed.magnitude")).select(
        "source_file",
        "row_no",
        "date",
        "description",
        F.col("parsed.magnitude").alias("amount"),
        F.when(F.col("by_side"), F.when(F.col("is_debit"), "debit").otherwise("credit"))
        .otherwise(direction_of(F.col("parsed"), F.col("kind"), F.col("description")))
        .alias("direction"),
        "balance",
        "bank_ref",
        *[c for c in ("period_start", "period_end") if c in body.columns],
    )


def stable_refs(txns: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """`ref`: the bank's reference, else `file#n` with n counting the file's transactions."""
    numbered = ordered.row_number(
        txns, ["source_file"], ordered.block_of(F.col("row_no"), cfg.segment_rows), [F.col("row_no")], "__n"
    )
    own = F.concat("source_file", F.lit("#"), F.col("__n").cast("string"))
    return numbered.withColumn("ref", F.coalesce(F.when(F.col("bank_ref") != "", F.col("bank_ref")), own)).drop("__n")


def statement_bounds(txns: DataFrame) -> DataFrame:
    """`statement_start` / `statement_end`: the printed period where there is one, else first and last date."""
    printed = {"period_start", "period_end"} <= set(txns.columns)
    spans = txns.groupBy("source_file").agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    start, end = F.col("lo"), F.col("hi")
    if printed:
        start, end = F.coalesce("period_start", "lo"), F.coalesce("period_end", "hi")
    out = txns.join(spans, "source_file").withColumn("statement_start", start).withColumn("statement_end", end)
    return out.drop("lo", "hi", "period_start", "period_end")


TXN = [
    "source_file", "row_no", "date", "description", "amount", "direction", "ref", "balance",
    "statement_start", "statement_end",
]


def to_transactions(body: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    return statement_bounds(stable_refs(typed_rows(body), cfg)).select(*TXN)
