"""Receipts: structured replies to validated purchase rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import dates, money, text
from tallyloom.operators import ordered
from tallyloom.settings import AMOUNT_DEFAULTED, DATE_DEFAULTED, DEFAULTS, NO_TAX_NOTE, NOT_RECONCILED, Settings

REPLY = (
    "date string, supplier_name string, total string, sales_tax string, net string, tax_rate string, "
    "currency string, payment_method_hint string, line_summary string, confidence string, notes string"
)
_RATE = "decimal(9,3)"


def read_replies(replies: DataFrame) -> DataFrame:
    """Typed fields of replies(source_file, response); `error` is set where no JSON object is found."""
    parsed = replies.withColumn("body", text.json_object(F.col("response"))).withColumn("reply", F.from_json("body", REPLY))
    parsed = dates.with_date(parsed.withColumn("date_text", F.col("reply.date")), "date_text", "date")
    field = F.col("reply")
    unread = F.col("body").isNull()

    def filled(name: str) -> Column:
        return F.when(field[name] != "", field[name])

    return parsed.select(
        "source_file",
        "date",
        filled("supplier_name").alias("supplier_name"),
        *[money.loose_decimal(field[c]).cast("decimal(18,6)").alias(c) for c in ("total", "sales_tax", "net")],
        money.loose_decimal(field["tax_rate"]).cast(_RATE).alias("tax_rate"),
        filled("currency").alias("currency"),
        filled("payment_method_hint").alias("payment_method_hint"),
        filled("line_summary").alias("line_summary"),
        F.coalesce(field["confidence"].try_cast("double"), F.lit(0.0)).alias("confidence"),
        F.when(unread, F.array(F.lit("extraction failed: no JSON object in reply")))
        .otherwise(money.loose_notes(field["notes"]))
        .alias("notes"),
        F.when(unread, "no JSON object in reply").alias("error"),
    )


def with_hints(extracts: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Add hint_date and hint_supplier read from the file name."""
    hint = text.filename_hint(text.file_name(F.col("source_file")))
    return extracts.withColumn("hint_date", hint["date"]).withColumn(
        "hint_supplier", text.strip_phrases(hint["supplier"], cfg.filename_strip)
    )


def validate(extracts: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Fill what can be derived and list notes and problems. Problems flag a row, notes do not."""
    t, n, x = F.col("total"), F.col("net"), F.col("sales_tax")
    zero = F.lit(0).cast("decimal(18,6)")
    has_t, has_n, has_x = t.isNotNull(), n.isNotNull(), x.isNotNull()
    only_total = has_t & ~has_n & ~has_x
    only_net = ~has_t & has_n & ~has_x
    total_net = has_t & has_n & ~has_x
    negative_tax = total_net & (t - n < 0)
    new_t = F.when(only_net, n).when(~has_t & has_n & has_x, n + x).otherwise(t)
    new_n = F.when(only_total, t).when(has_t & ~has_n & has_x, t - x).otherwise(n)
    new_x = F.when(only_total | only_net, zero).when(total_net & ~negative_tax, t - n).otherwise(x)
    filled = extracts.select(
        *[c for c in extracts.columns if c not in ("total", "net", "sales_tax", "date", "supplier_name", "tax_rate")],
        new_t.cast("decimal(18,6)").alias("total"),
        new_n.cast("decimal(18,6)").alias("net"),
        new_x.cast("decimal(18,6)").alias("sales_tax"),
        F.when(only_total, F.lit(0).cast(_RATE)).otherwise(F.col("tax_rate")).alias("given_rate"),
        F.coalesce("date", "hint_date").alias("date"),
        F.coalesce("supplier_name", "hint_supplier").alias("supplier_name"),
        (only_total | only_net).alias("no_tax"),
        negative_tax.alias("negative_tax"),
    )
    t, n, x = F.col("total"), F.col("net"), F.col("sales_tax")
    off = F.coalesce(F.abs(n + x - t) > F.lit(cfg.amount_tolerance).cast("decimal(18,6)"), F.lit(False))
    derived = F.when(
        F.col("given_rate").isNull() & (n > 0) & x.isNotNull(),
        F.when(x == 0, F.lit(0)).otherwise(F.bround((x * 100 / n).cast("decimal(24,10)"), 3)).cast(_RATE),
    )
    currency = F.col("currency")
    # A not reconciling amount can be found twice: by the derived tax and by the final check.
    problems = F.array_compact(
        F.array(
            F.when(F.col("negative_tax"), F.lit(NOT_RECONCILED)),
            F.when(off, F.lit(NOT_RECONCILED)),
            F.when(
                currency.isNotNull() & (currency != cfg.default_currency),
                F.concat(F.lit("currency "), currency, F.lit(f": convert to {cfg.default_currency} and note the rate")),
            ),
            F.when(F.col("date").isNull(), F.lit("date missing")),
            F.when(F.coalesce("supplier_name", F.lit("")) == "", F.lit("supplier missing")),
            F.when(t.isNull() & n.isNull(), F.lit("total missing")),
        )
    )
    no_tax = F.when(F.col("no_tax"), F.array(F.lit(NO_TAX_NOTE))).otherwise(F.array().cast("array<string>"))
    return (
        filled.withColumn("problems", problems)
        .withColumn("notes", F.concat("notes", no_tax, "problems"))
        .withColumn("tax_rate", F.coalesce("given_rate", derived))
        .drop("given_rate", "no_tax", "negative_tax")
    )


def canonical_category(frame: DataFrame, column: str, categories: DataFrame, out: str) -> DataFrame:
    """Spelling of the category table for `column`, matched without case; empty where unknown."""
    key = F.lower(F.trim("category"))
    # The last row of a category wins, as with any keyed load.
    pos = F.col("pos") if "pos" in categories.columns else F.lit(0)
    table = (
        categories.where(F.trim("category") != "")
        .groupBy(key.alias("__key"))
        .agg(F.max_by(F.trim("category"), pos).alias("__spelled"))
    )
    return (
        frame.join(table, F.lower(F.trim(F.col(column))) == F.col("__key"), "left")
        .withColumn(out, F.coalesce("__spelled", F.lit("")))
        .drop("__key", "__spelled")
    )


PURCHASE = [
    "date", "company", "category", "net", "sales_tax", "total", "tax_rate", "payment_method", "notes", "year",
    "source_file", "processed_on", "status", "bank_ref", "copied_to_master",
]


def to_purchases(
    validated: DataFrame, categories: DataFrame, run_ts: str, cfg: Settings = DEFAULTS
) -> DataFrame:
    """Purchase rows. `validated` also carries canonical, default_category and is_new of its supplier."""
    known = canonical_category(validated, "default_category", categories, "category")
    stamp = F.lit(run_ts).cast("timestamp")
    run_date = F.lit(run_ts[:10]).cast("date")
    extra = [F.when(F.col(c).isNull(), F.lit(AMOUNT_DEFAULTED)) for c in ("net", "sales_tax", "total")]
    extra.append(F.when(F.col("date").isNull(), F.lit(DATE_DEFAULTED)))
    review = (
        F.col("is_new")
        | (F.col("category") == "")
        | (F.col("confidence") < cfg.min_confidence)
        | (F.col("confidence") <= 0)
        | F.col("total").isNull()
        | (F.size("problems") > 0)
    )
    keys = [c for c in ("seq", "batch_seq") if c in validated.columns]
    return known.select(
        *keys,
        F.coalesce("date", run_date).alias("date"),
        F.coalesce("canonical", "supplier_name", F.lit("")).alias("company"),
        "category",
        *[
            F.coalesce(money.round_money(F.col(c)), F.lit(0).cast(money.MONEY)).alias(c)
            for c in ("net", "sales_tax", "total")
        ],
        F.coalesce("tax_rate", F.lit(0).cast(_RATE)).alias("tax_rate"),
        text.payment_method(F.col("payment_method_hint"), cfg.payment_methods, cfg.payment_method_map).alias(
            "payment_method"
        ),
        F.array_join(F.concat("notes", F.array_compact(F.array(*extra))), "; ").alias("notes"),
        F.year(F.coalesce("date", run_date)).alias("year"),
        "source_file",
        stamp.alias("processed_on"),
        F.when(review, "Review").otherwise("OK").alias("status"),
        F.lit("").alias("bank_ref"),
        F.lit("").alias("copied_to_master"),
    )


def flag_duplicates(batch: DataFrame, saved: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Note and review rows of the batch whose date, company and total were met before.

    A row names the row before it in the batch; the first of a kind names the first saved row that
    is still live. `batch` has batch_seq, `saved` has row_id. Adds `duplicate_of`.
    """

    def keyed(df: DataFrame) -> DataFrame:
        return (
            df.withColumn("k_date", F.col("date"))
            .withColumn("k_company", text.normalise_name(F.col("company"), cfg.legal_suffixes))
            .withColumn("k_total", money.cents(F.col("total")))
        )

    key = ["k_date", "k_company", "k_total"]
    live = keyed(saved.where("status <> 'Superseded'"))
    earlier = live.groupBy(*key).agg(F.min_by("source_file", "row_id").alias("saved_source"))
    linked = ordered.previous(
        keyed(batch), key, ordered.block_of(F.col("batch_seq"), cfg.segment_rows), [F.col("batch_seq")],
        F.col("source_file"), "batch_source",
    )
    other = F.coalesce("batch_source", "saved_source")
    note = F.concat(F.lit("Possible duplicate of "), F.col("duplicate_of"))
    return (
        ordered.join_same(linked, earlier, key, "left")
        .withColumn("duplicate_of", other)
        .withColumn("notes", F.when(F.col("duplicate_of").isNotNull(), text.add_note(F.col("notes"), note)).otherwise(F.col("notes")))
        .withColumn("status", F.when(F.col("duplicate_of").isNotNull(), "Review").otherwise(F.col("status")))
        .drop(*key, "batch_source", "saved_source")
    )
