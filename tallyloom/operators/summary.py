"""Counters of a run, kept as rows (section, item, value) so that no list has to fit one record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Text of the report, in its order.
SECTIONS = (
    ("files_found", "Files found:     "),
    ("files_new", "Files new:       "),
    ("files_flagged", "Files flagged:   "),
    ("files_errored", "Files errored:   "),
    ("rows_added", "Rows added:      "),
    ("rows_review", "Review rows:     "),
    ("rows_superseded", "Superseded rows: "),
    ("new_supplier", "New suppliers:   "),
    ("unmatched_bank", "Unmatched bank:  "),
    ("unmatched_expense", "Unmatched expense: "),
    ("error", "Errors:"),
    ("warning", "Warnings:"),
)


def stage_counters(files: DataFrame) -> DataFrame:
    """Per stage: found, new, flagged, errored, rows_added of files(stage, is_new, status, rows_added)."""
    return files.groupBy("stage").agg(
        F.count(F.lit(1)).alias("found"),
        F.count_if(F.col("is_new")).alias("new"),
        F.count_if(F.col("is_new") & (F.col("status") == "Flagged")).alias("flagged"),
        F.count_if(F.col("is_new") & (F.col("status") == "Error")).alias("errored"),
        F.coalesce(F.sum(F.when(F.col("is_new"), F.col("rows_added"))), F.lit(0)).cast("bigint").alias("rows_added"),
    )


def counter_map(counters: DataFrame) -> DataFrame:
    """One row: `stages`, a map from stage to its counters. Stages are those of the settings, so the map is small."""
    fields = [c for c in counters.columns if c != "stage"]
    entry = F.struct("stage", F.struct(*fields))
    return counters.agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("stages"))


def rows_per_file(files: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Files with `rows_added`: how many new rows name them."""
    counts = new_rows.groupBy(F.col("source_file").alias("relative_path")).agg(F.count(F.lit(1)).alias("n"))
    return (
        files.drop("rows_added")
        .join(counts, "relative_path", "left")
        .withColumn("rows_added", F.coalesce("n", F.lit(0)).cast("int"))
        .drop("n")
    )


def blocked(rows: DataFrame, statements: DataFrame) -> DataFrame:
    """One row: whether a Review row or a flagged statement holds the run back."""
    hits = rows.select((F.col("status") == "Review").alias("hit")).unionByName(
        statements.select(F.col("flagged").alias("hit"))
    )
    return hits.agg(F.coalesce(F.bool_or("hit"), F.lit(False)).alias("blocked"))


def count_row(frame: DataFrame, section: str) -> DataFrame:
    return frame.agg(F.count(F.lit(1)).alias("value")).select(
        F.lit(section).alias("section"), F.lit("").alias("item"), "value"
    )


def item_rows(frame: DataFrame, section: str, item: Column) -> DataFrame:
    """Distinct items with how often each occurs."""
    return frame.groupBy(item.alias("item")).agg(F.count(F.lit(1)).alias("value")).select(
        F.lit(section).alias("section"), "item", "value"
    )


def counter_rows(counters: DataFrame) -> DataFrame:
    """Stage counters as (section, item, value)."""
    fields = [("files_found", "found"), ("files_new", "new"), ("files_flagged", "flagged"), ("files_errored", "errored"), ("rows_added", "rows_added")]
    entries = F.array(*[F.struct(F.lit(s).alias("section"), F.col("stage").alias("item"), F.col(c).cast("bigint").alias("value")) for s, c in fields])
    return counters.select(F.explode(entries).alias("e")).select("e.*")


def run_summary(
    counters: DataFrame,
    rows: DataFrame,
    replaced: DataFrame,
    new_suppliers: DataFrame,
    unmatched_txns: DataFrame,
    unmatched_rows: DataFrame,
    errors: DataFrame,
    warnings: DataFrame,
) -> DataFrame:
    """All counters of a run; new suppliers, errors and warnings are listed item by item."""
    parts = [
        counter_rows(counters),
        count_row(rows.where("status = 'Review'"), "rows_review"),
        count_row(replaced, "rows_superseded"),
        item_rows(new_suppliers, "new_supplier", F.col("company")),
        count_row(unmatched_txns, "unmatched_bank"),
        count_row(unmatched_rows, "unmatched_expense"),
        item_rows(errors, "error", F.col("error")),
        item_rows(warnings, "warning", F.col("warning")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def as_json(summary: DataFrame) -> DataFrame:
    """One JSON object per counter."""
    return summary.select(F.to_json(F.struct("section", "item", "value")).alias("json"))


def summary_lines(summary: DataFrame) -> DataFrame:
    """Readable report rows (line_no, item, line), sorted by line number and item."""
    label, number = F.lit(""), F.lit(0)
    for i, (section, title) in enumerate(SECTIONS, start=1):
        label = F.when(F.col("section") == section, title).otherwise(label)
        number = F.when(F.col("section") == section, i).otherwise(number)
    value = F.col("value").cast("string")
    body = (
        F.when(F.col("section").isin("new_supplier", "error", "warning"), F.col("item"))
        .when(F.col("item") == "", value)
        .otherwise(F.concat("item", F.lit(": "), value))
    )
    return summary.select(number.cast("bigint").alias("line_no"), "item", F.concat(label, body).alias("line")).orderBy(
        "line_no", "item"
    )
