"""Dates in free text, month first. Text is brought to ISO form by pattern and cast once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.bind import let

_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_TAIL = r"(?:[T ]\d{1,2}:.*)?$"
_YMD = r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})" + _TAIL
_MDY = r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4}|\d{2})" + _TAIL
_PACKED = r"^(\d{4})(\d{2})(\d{2})$"
_NAME_FIRST = r"^(?:[A-Za-z]{3,9},\s+)?([A-Za-z]{3,9})\.?\s+(\d{1,2})(?:st|nd|rd|th)?(?:,?\s+(\d{4}|\d{2}))?$"
_DAY_FIRST = r"^(\d{1,2})(?:st|nd|rd|th)?[\s\-]+([A-Za-z]{3,9})\.?(?:,?[\s\-]+(\d{4}|\d{2}))?$"
_NO_YEAR = r"^(\d{1,2})[-/](\d{1,2})$"


def _month_number(word: Column) -> Column:
    at = F.position(F.lower(F.substring(word, 1, 3)), F.lit(_MONTHS))
    return F.when(at % 3 == 1, ((at + 2) / 3).cast("int").cast("string"))


def parse_date(text: Column, default_year: Column | None = None, pivot: int = 76) -> Column:
    """Date of a cell, or null. Text without a year takes `default_year`; two-digit years below
    `pivot` are 20xx. A first number above 12 is read as the day."""
    year = (F.lit(None) if default_year is None else default_year).cast("int").cast("string")
    return let(F.trim(F.coalesce(text, F.lit(""))), lambda raw: _iso_text(raw, year, pivot)).try_cast("date")


def with_date(frame: DataFrame, cell: str, out: str, default_year: Column | None = None, pivot: int = 76) -> DataFrame:
    """The frame with parse_date() of a text column as `out`; the trimmed text is a column, so all of it is compiled."""
    year = (F.lit(None) if default_year is None else default_year).cast("int").cast("string")
    trimmed = frame.withColumn("__text", F.trim(F.coalesce(F.col(cell), F.lit(""))))
    return trimmed.withColumn(out, _iso_text(F.col("__text"), year, pivot).try_cast("date")).drop("__text")


def _iso_text(raw: Column, year: Column, pivot: int) -> Column:

    def get(rx: str, i: int) -> Column:
        return F.regexp_extract(raw, rx, i)

    def iso(y: Column, m: Column, d: Column) -> Column:
        return F.when(y.isNull() | m.isNull(), F.lit(None)).otherwise(
            F.concat(F.lpad(y, 4, "0"), F.lit("-"), m, F.lit("-"), d)
        )

    def month_day(y: Column, a: Column, b: Column) -> Column:
        swap = (F.length(a) == 2) & (a > "12")
        return F.when(swap, iso(y, b, a)).otherwise(iso(y, a, b))

    def full(found: Column) -> Column:
        """The year as printed; none is the default year, two digits take their century from the pivot."""
        century = F.when(found < f"{pivot:02d}", "20").otherwise("19")
        return F.when(found == "", year).when(F.length(found) == 2, F.concat(century, found)).otherwise(found)

    # Each branch only builds text for values its own pattern accepted.
    return (
        F.when(F.rlike(raw, F.lit(_YMD)), iso(get(_YMD, 1), get(_YMD, 2), get(_YMD, 3)))
        .when(F.rlike(raw, F.lit(_MDY)), month_day(full(get(_MDY, 3)), get(_MDY, 1), get(_MDY, 2)))
        .when(F.rlike(raw, F.lit(_PACKED)), iso(get(_PACKED, 1), get(_PACKED, 2), get(_PACKED, 3)))
        .when(F.rlike(raw, F.lit(_NO_YEAR)), month_day(year, get(_NO_YEAR, 1), get(_NO_YEAR, 2)))
        .when(
            F.rlike(raw, F.lit(_NAME_FIRST)),
            iso(full(get(_NAME_FIRST, 3)), _month_number(get(_NAME_FIRST, 1)), get(_NAME_FIRST, 2)),
        )
        .when(
            F.rlike(raw, F.lit(_DAY_FIRST)),
            iso(full(get(_DAY_FIRST, 3)), _month_number(get(_DAY_FIRST, 2)), get(_DAY_FIRST, 1)),
        )
    )


# Text that looks like a date, as statements print it: with digits only, or with the name of a month.
_DIGITS = r"\d{4}-\d{1,2}-\d{1,2}|\d{1,2}/\d{1,2}(?:/\d{4}|/\d{2})?"
_NAMED = r"[A-Z][a-z]{2,8}\.? +\d{1,2}(?:st|nd|rd|th)?(?:,? +\d{4})?|\d{1,2}(?:st|nd|rd|th)? +[A-Z][a-z]{2,8}\.?(?:,? +\d{4})?"
_DATE_RUN = rf"(?<![\w/])({_NAMED}|{_DIGITS})(?![\w/])"
#: What may stand between the first and the last day of a period, and before the first.
_BETWEEN = r"\s*(?:[-\u2013\u2014]|\b(?:to|through|until)\b)\s*"
_BEFORE = r"\b(?:period|from)\b[\s:]*"


def statement_period(text: Column) -> Column:
    """struct(start, end) of the statement's period, or null.

    Of all neighbouring pairs of dates joined by a dash or by to, through or until, the first one behind the word
    period or from counts, else the first one at all. Both must be dates; an end printed without a year takes
    the year of the start. Only whole date runs are read: where other words stand between lead and date, or
    a weekday before a date, there is no pair.
    """
    pair = f"(?i){_DATE_RUN}{_BETWEEN}{_DATE_RUN}"
    led = f"(?i){_BEFORE}{_DATE_RUN}{_BETWEEN}{_DATE_RUN}"

    def first(rx: str, body: Column) -> Column:
        starts, ends = (F.regexp_extract_all(body, F.lit(rx), F.lit(i)) for i in (1, 2))
        read = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda p: let(
            parse_date(p["a"]), lambda start: F.struct(start.alias("start"), parse_date(p["b"], F.year(start)).alias("end"))))
        return F.get(F.filter(read, lambda p: p["start"].isNotNull() & p["end"].isNotNull()), F.lit(0))

    return let(text, lambda body: F.coalesce(first(led, body), first(pair, body)))


def row_year(date: Column, run_ts: Column) -> Column:
    return F.year(F.coalesce(date, F.to_date(run_ts)))
