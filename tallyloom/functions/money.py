"""Amounts: parsing, rounding and the net/tax/total check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.bind import let

MONEY = "decimal(18,2)"
_NUMBER = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"


def to_number(text: Column) -> Column:
    """Exact decimal for a plain number text, else null."""
    return F.when(F.rlike(text, F.lit(_NUMBER)), text).try_cast("decimal(30,10)")


def round_money(value: Column) -> Column:
    """Two decimals, ties to the even digit."""
    return F.bround(value, 2).cast(MONEY)


def cents(value: Column) -> Column:
    return (F.bround(value, 2) * 100).cast("bigint")


def from_cents(value: Column) -> Column:
    return (value.cast("decimal(18,0)") / F.lit(100).cast("decimal(3,0)")).cast(MONEY)


def _amount_steps(cell: Column) -> list[tuple[str, Callable[[Callable[[str], Column]], Column]]]:
    """The steps of reading an amount, each from the values of the steps before it."""
    return [
        ("raw", lambda v: F.trim(F.coalesce(cell, F.lit("")))),
        # Only the first mark is taken out of the text.
        ("body", lambda v: F.trim(F.regexp_replace(v("raw"), r"(?i)^(.*?)\b(?:CR|DR)\b", "$1"))),
        ("paren", lambda v: F.startswith(v("body"), F.lit("(")) & F.endswith(v("body"), F.lit(")")) & (F.length(v("body")) >= 2)),
        ("inner", lambda v: F.trim(F.regexp_replace(
            F.when(v("paren"), F.substring(v("body"), F.lit(2), F.length(v("body")) - 2)).otherwise(v("body")), "[$,]", ""))),
        ("size", lambda v: to_number(F.trim(F.regexp_replace(v("inner"), "^-+", "")))),
        ("mark", lambda v: F.upper(F.regexp_extract(v("raw"), r"(?i)\b(CR|DR)\b", 1))),
    ]


def _amount(v: Callable[[str], Column]) -> Column:
    return F.when(
        v("size").isNotNull(),
        F.struct(
            round_money(v("size")).alias("magnitude"),
            F.when(v("mark") == "CR", "credit").when(v("mark") == "DR", "debit").alias("explicit_direction"),
            (v("paren") | F.startswith(v("inner"), F.lit("-"))).alias("negative"),
        ),
    )


def parse_amount(cell: Column) -> Column:
    """struct(magnitude, explicit_direction, negative) of a statement cell; null where it is no amount."""

    def step(at: int, known: dict[str, Column]) -> Column:
        steps = _amount_steps(cell)
        if at == len(steps):
            return _amount(known.__getitem__)
        name, value = steps[at]
        return let(value(known.__getitem__), lambda v: step(at + 1, {**known, name: v}))

    return step(0, {})


def with_amount(frame: DataFrame, cell: str, out: str) -> DataFrame:
    """The frame with parse_amount() of a text column as `out`; each step is a column, so all of it is compiled."""
    steps = _amount_steps(F.col(cell))

    def of(name: str) -> Column:
        return F.col(f"__{name}")

    for name, value in steps:
        frame = frame.withColumn(f"__{name}", value(of))
    return frame.withColumn(out, _amount(of)).drop(*[f"__{name}" for name, _ in steps])


def loose_decimal(text: Column) -> Column:
    """Number from a JSON scalar given as text: blanks, `$` and `,` are ignored."""
    return to_number(F.regexp_replace(F.trim(text), r"[$,]", ""))


def loose_notes(raw_json: Column) -> Column:
    """Array of non-blank notes from a JSON value that is a list, one string or absent."""
    as_list = F.from_json(raw_json, "array<string>")
    return F.when(raw_json.isNull(), F.array().cast("array<string>")).when(
        F.startswith(F.trim(raw_json), F.lit("[")),
        F.filter(F.coalesce(as_list, F.array().cast("array<string>")), lambda n: F.trim(n) != ""),
    ).otherwise(F.filter(F.array(raw_json), lambda n: F.trim(n) != ""))


def check_mark(net: Column, tax: Column, total: Column) -> Column:
    return F.when(F.round(net + tax, 2) == F.round(total, 2), "ok").otherwise("!!!!")
