"""Reconciliation of receipts and bank transactions.

Tables
    rows       row_id, date, company, total, notes, payment_method, source_file, status, bank_ref, ...
    txns       txn_seq, date, description, amount, direction, source_file, ref, statement_start, statement_end
    purchases  all saved purchase rows, to find the bank-only rows of earlier runs
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.durable import Scratch
from tallyloom.functions import money, text
from tallyloom.functions.scorers import scorer
from tallyloom.operators import matching, ordered
from tallyloom.operators.expenses import PURCHASE, canonical_category
from tallyloom.settings import DEFAULTS, NO_BANK_TXN_NOTE, NO_RECEIPT_NOTE, RECEIPT_ARRIVED, Settings


def bank_only_rows(purchases: DataFrame) -> DataFrame:
    """Live rows an earlier run made from a debit without receipt; the last row of a reference wins."""
    live = purchases.where(
        (F.col("bank_ref") != "") & (F.col("status") != "Superseded") & F.contains(F.col("notes"), F.lit(NO_RECEIPT_NOTE))
    )
    return ordered.first_per_key(live, ["source_file", "bank_ref"], [F.col("row_id")], last=True)


def mark_old(txns: DataFrame, purchases: DataFrame) -> DataFrame:
    """`is_old`: the transaction already owns a bank-only row. Key: statement file and reference."""
    held = bank_only_rows(purchases).select("source_file", F.col("bank_ref").alias("ref"), F.lit(True).alias("is_old"))
    return txns.join(held, ["source_file", "ref"], "left").withColumn("is_old", F.coalesce("is_old", F.lit(False)))


def repeated_refs(txns: DataFrame) -> DataFrame:
    """References printed more than once, with how often."""
    return txns.groupBy("source_file", "ref").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def ref_warnings(txns: DataFrame) -> DataFrame:
    """One `warning` per reference a statement prints more than once; such rows share their bank-only row."""
    told = F.concat("source_file", F.lit(": reference "), "ref", F.lit(" printed "), F.col("n").cast("string"), F.lit(" times"))
    return repeated_refs(txns).select(told.alias("warning"))


def ignored(txns: DataFrame, cfg: Settings = DEFAULTS) -> Column:
    """New transactions that take no part: credits and descriptions with an ignore term."""
    low = F.lower("description")
    hit = F.col("direction") == "credit"
    for term in cfg.ignore_terms:
        hit = hit | F.contains(low, F.lit(term.lower()))
    return hit & ~F.col("is_old") if "is_old" in txns.columns else hit


def open_rows(purchases: DataFrame) -> DataFrame:
    """Rows still free to match."""
    return purchases.where("status <> 'Superseded' and bank_ref = ''")


def match_items(txns: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides in the shape the matcher reads."""
    t = txns.select(
        F.col("txn_seq").alias("seq"), "date", money.cents(F.col("amount")).alias("cents"),
        text.ascii_fold(F.col("description")).alias("text"),
    )
    r = rows.select(
        F.col("row_id").alias("seq"), "date", money.cents(F.col("total")).alias("cents"),
        text.ascii_fold(F.col("company")).alias("text"),
    )
    return t, r


def merge_periods(periods: DataFrame, keys: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """Overlapping or touching day ranges of a key as one range.

    Works on distinct days, so a key never orders more rows than the calendar has days.
    """
    days = (
        periods.where(F.col(start) <= F.col(end))
        .select(*keys, start, end)
        .distinct()
        .select(*keys, F.explode(F.sequence(F.col(start), F.col(end))).alias("day"))
        .distinct()
    )
    by_day = Window.partitionBy(*keys).orderBy("day")
    island = days.withColumn("island", F.date_sub("day", F.row_number().over(by_day)))
    return island.groupBy(*keys, "island").agg(F.min("day").alias(start), F.max("day").alias(end)).drop("island")


def covered_days(txns: DataFrame) -> DataFrame:
    """Distinct days inside a statement period; bounded by the calendar."""
    spans = txns.select("statement_start", "statement_end").distinct()
    spans = spans.where("statement_start <= statement_end")
    return spans.select(F.explode(F.sequence("statement_start", "statement_end")).alias("date")).distinct()


def uncovered(rows: DataFrame, txns: DataFrame) -> DataFrame:
    """Rows dated inside a statement period of the given transactions."""
    return rows.join(covered_days(txns), "date", "left_semi")


@dataclass
class Reconciled:
    matched: DataFrame  # txn_seq, row_id, score, gap, ref, txn_file, source_file, is_old
    updated_rows: DataFrame  # matched or annotated rows, whole
    superseded_rows: DataFrame  # bank-only rows a receipt replaced, whole
    unmatched_txns: DataFrame  # new debits without receipt
    ignored_txns: DataFrame
    unmatched_rows: DataFrame  # annotated rows only


def reconcile(
    rows: DataFrame,
    txns: DataFrame,
    purchases: DataFrame,
    cfg: Settings = DEFAULTS,
    score: Callable[[Column, Column], Column] | str = "partial",
) -> Reconciled:
    marked = mark_old(txns, purchases)
    skip = ignored(marked, cfg)
    active = marked.where(~skip)
    free = rows.where("bank_ref = ''")
    t, r = match_items(active, free)
    how = scorer(score) if isinstance(score, str) else score
    pairs = matching.match_one_to_one(t, r, cfg.match_window_days, how, cfg.segment_rows)
    # Five results read the matches, so they are computed once and written.
    matched = Scratch(txns.sparkSession, "reconcile").write(
        pairs.withColumnsRenamed({"t_seq": "txn_seq", "r_seq": "row_id"})
        .join(active.select("txn_seq", "ref", F.col("source_file").alias("txn_file"), "is_old"), "txn_seq")
        .join(free.select("row_id", "source_file"), "row_id"),
        "matched",
    )
    claimed = (
        free.join(matched.select("row_id", "ref"), "row_id")
        .withColumn("bank_ref", F.col("ref"))
        .withColumn(
            "payment_method",
            F.when(F.col("payment_method") == "", cfg.statement_payment_method).otherwise(F.col("payment_method")),
        )
        .select(*rows.columns)
    )
    arrived = matched.where("is_old").select(
        F.col("txn_file").alias("source_file"), F.col("ref").alias("bank_ref"), F.col("source_file").alias("receipt")
    )
    superseded = (
        bank_only_rows(purchases)
        .join(arrived, ["source_file", "bank_ref"])
        .withColumn("status", F.lit("Superseded"))
        .withColumn("notes", text.add_note(F.col("notes"), F.concat(F.lit(RECEIPT_ARRIVED), F.col("receipt"))))
        .select(*purchases.columns)
    )
    unmatched = active.where(~F.col("is_old")).join(matched.select("txn_seq"), "txn_seq", "left_anti")
    noted = (
        uncovered(free.join(matched.select("row_id"), "row_id", "left_anti"), marked.where(~F.col("is_old")))
        .withColumn("notes", text.add_note(F.col("notes"), F.lit(NO_BANK_TXN_NOTE), once=True))
        .select(*rows.columns)
    )
    return Reconciled(
        matched, claimed.unionByName(noted), superseded, unmatched, marked.where(skip), noted
    )


def bank_only_purchases(
    unmatched: DataFrame, categories: DataFrame, run_ts: str, cfg: Settings = DEFAULTS
) -> DataFrame:
    """Review rows for debits without receipt. `unmatched` carries canonical, default_category, is_new."""
    known = canonical_category(unmatched, "default_category", categories, "category")
    amount = money.round_money(F.col("amount"))
    return known.select(
        "txn_seq",
        "date",
        F.when(F.col("is_new"), F.trim("description")).otherwise(F.col("canonical")).alias("company"),
        "category",
        amount.alias("net"),
        F.lit(0).cast(money.MONEY).alias("sales_tax"),
        amount.alias("total"),
        F.lit(0).cast("decimal(9,3)").alias("tax_rate"),
        F.lit(cfg.statement_payment_method).alias("payment_method"),
        F.lit(NO_RECEIPT_NOTE).alias("notes"),
        F.year("date").alias("year"),
        "source_file",
        F.lit(run_ts).cast("timestamp").alias("processed_on"),
        F.lit("Review").alias("status"),
        F.col("ref").alias("bank_ref"),
        F.lit("").alias("copied_to_master"),
    ).select("txn_seq", *PURCHASE)


def bank_rows(txns: DataFrame, matched: DataFrame, ignored_txns: DataFrame, run_ts: str) -> DataFrame:
    """Bank table rows of new transactions with their status."""
    hits = matched.select("txn_seq", F.col("source_file").alias("matched_source"))
    skip = ignored_txns.select("txn_seq", F.lit(True).alias("skipped"))
    joined = txns.join(hits, "txn_seq", "left").join(skip, "txn_seq", "left")
    status = (
        F.when(F.col("matched_source").isNotNull(), "Matched").when(F.col("skipped"), "Ignored").otherwise("No receipt")
    )
    return joined.select(
        "txn_seq", "date", "description", "amount", "direction", status.alias("status"),
        F.coalesce("matched_source", F.lit("")).alias("matched_source"), "ref",
        F.col("source_file").alias("statement_file"), "statement_start", "statement_end",
        F.lit(run_ts).cast("timestamp").alias("processed_on"),
    )


def to_txns(bank: DataFrame) -> DataFrame:
    """Bank table rows back as transactions."""
    keys = [c for c in ("txn_seq",) if c in bank.columns]
    return bank.select(
        *keys, "date", "description", "amount", "direction", F.col("statement_file").alias("source_file"), "ref",
        "statement_start", "statement_end",
    )
