"""Supplier and category profiles of a purchase history (idx, date, company, category, payment_method)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import text


def tidy_history(history: DataFrame) -> DataFrame:
    return history.select(
        "idx",
        "date",
        F.trim(F.coalesce("company", F.lit(""))).alias("company"),
        F.trim(F.coalesce("category", F.lit(""))).alias("category"),
        F.trim(F.coalesce("payment_method", F.lit(""))).alias("payment_method"),
    )


def purchase_rows(sheet: DataFrame) -> DataFrame:
    """Data rows of sheet(pos, date, company, ...): up to the Total row, without blank rows."""
    total = F.lower(F.trim(F.coalesce("date", F.lit("")))) == "total"
    total = total | (F.col("date").isNull() & (F.lower(F.trim(F.coalesce("company", F.lit("")))) == "total"))
    stop = sheet.where(total).agg(F.min("pos").alias("stop")).first()["stop"]
    kept = sheet if stop is None else sheet.where(F.col("pos") < stop)
    return kept.where("date is not null or company is not null")


def spelling_profiles(history: DataFrame) -> DataFrame:
    """(supplier, count, first_idx, last_date, last_category) per spelling; of equal dates the later row counts."""
    named = tidy_history(history).where("company <> ''")
    dated = F.col("date").isNotNull()
    # Without any date the first non-empty category stands in.
    return named.groupBy(F.col("company").alias("supplier")).agg(
        F.count(F.lit(1)).alias("count"),
        F.min("idx").alias("first_idx"),
        F.max("date").alias("last_date"),
        F.coalesce(
            F.max_by(F.when(dated, F.col("category")), F.when(dated, F.struct("date", "idx"))),
            F.min_by(F.when(F.col("category") != "", F.col("category")), F.when(F.col("category") != "", F.col("idx"))),
        ).alias("last_category"),
    )


def fold_spellings(profiles: DataFrame) -> DataFrame:
    """(supplier, canonical): spellings equal without case and punctuation go to the most frequent,
    then the earliest one."""
    keyed = profiles.withColumn("key", text.ascii_fold(F.col("supplier")))
    best = keyed.groupBy("key").agg(F.max_by("supplier", F.struct("count", -F.col("first_idx"))).alias("canonical"))
    return keyed.join(best, "key").select("supplier", "canonical")


def detected_aliases(folded: DataFrame) -> DataFrame:
    return folded.where("supplier <> canonical").select(
        F.col("supplier").alias("alias"), F.col("canonical").alias("supplier")
    )


def category_counts(history: DataFrame, folded: DataFrame) -> DataFrame:
    """(supplier, category, n) over canonical suppliers."""
    per_spelling = (
        tidy_history(history)
        .where("company <> '' and category <> ''")
        .groupBy(F.col("company").alias("supplier"), "category")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        per_spelling.join(folded, "supplier")
        .groupBy(F.col("canonical").alias("supplier"), "category")
        .agg(F.sum("n").alias("n"))
    )


def supplier_profiles(history: DataFrame) -> DataFrame:
    """The supplier table: supplier, default_category, other_categories, count, last_date."""
    profiles = spelling_profiles(history)
    folded = fold_spellings(profiles)
    joined = profiles.join(folded, "supplier")
    # Spellings are folded in order of count; on equal last dates the one folded later counts.
    folded_order = F.struct("last_date", -F.col("count"), F.col("first_idx"))
    merged = joined.groupBy(F.col("canonical").alias("supplier")).agg(
        F.sum("count").alias("count"),
        F.max("last_date").alias("last_date"),
        F.coalesce(
            F.max_by("last_category", F.when(F.col("last_date").isNotNull(), folded_order)),
            F.max(F.when(F.col("supplier") == F.col("canonical"), F.col("last_category"))),
        ).alias("last_category"),
    )
    counts = category_counts(history, folded).join(merged.select("supplier", "last_category"), "supplier")
    # One row per category of a supplier; the category list is closed, so this window stays small.
    order = Window.partitionBy("supplier").orderBy(
        F.desc("n"), F.desc(F.coalesce(F.col("category") == F.col("last_category"), F.lit(False))), "category"
    )
    ranked = counts.withColumn("rank", F.row_number().over(order))
    lists = ranked.groupBy("supplier").agg(
        F.max(F.when(F.col("rank") == 1, F.col("category"))).alias("default_category"),
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.when(F.col("rank") > 1, F.struct((-F.col("n")).alias("less"), "category")))),
                lambda s: s["category"],
            ),
            ";",
        ).alias("other_categories"),
    )
    return merged.join(lists, "supplier", "left").select(
        "supplier",
        F.coalesce("default_category", F.lit("")).alias("default_category"),
        F.coalesce("other_categories", F.lit("")).alias("other_categories"),
        "count",
        "last_date",
    )


def category_totals(purchases: DataFrame) -> DataFrame:
    """Sum of totals per year and category."""
    return purchases.groupBy("year", "category").agg(F.sum("total").alias("total"))


def with_tax_line(rows: DataFrame, categories: DataFrame) -> DataFrame:
    """Rows with the tax line of their category, empty where the category is not known. Case and blanks do not count."""
    known = categories.groupBy(F.lower(F.trim("category")).alias("__key")).agg(F.min("tax_line").alias("tax_line"))
    joined = rows.join(known, F.lower(F.trim("category")) == F.col("__key"), "left").drop("__key")
    return joined.withColumn("tax_line", F.coalesce("tax_line", F.lit("")))


def payment_counts(history: DataFrame) -> DataFrame:
    """(payment_method, count) with cheque numbers dropped, sorted by name."""
    used = tidy_history(history).where("payment_method <> ''")
    return (
        used.groupBy(text.drop_cheque_number(F.col("payment_method")).alias("payment_method"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("payment_method")
    )


def seed_statistics(history: DataFrame, categories: DataFrame, existing_aliases: DataFrame) -> DataFrame:
    """One row: purchase_rows, suppliers, categories, payment_methods, aliases_added."""
    folded = fold_spellings(spelling_profiles(history))
    parts = [
        history.agg(F.count(F.lit(1)).alias("purchase_rows")),
        folded.agg(F.countDistinct("canonical").alias("suppliers")),
        categories.agg(F.count(F.lit(1)).alias("categories")),
        payment_counts(history).agg(F.count(F.lit(1)).alias("payment_methods")),
        detected_aliases(folded)
        .join(existing_aliases.select("alias").distinct(), "alias", "left_anti")
        .agg(F.count(F.lit(1)).alias("aliases_added")),
    ]
    out = parts[0].withColumn("one", F.lit(1))
    for part in parts[1:]:
        out = out.join(part.withColumn("one", F.lit(1)), "one")
    return out.drop("one")
