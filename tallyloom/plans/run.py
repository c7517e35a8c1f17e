"""One bookkeeping run: new files in, updated tables out.

`plan_run` turns the saved tables and the files of this run into the next version of every table.
`publish_run` stages them and makes them and the ledger visible together. A run that died before that
is done again from the start; one that died after it finds its files in the ledger and has nothing to do.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.durable import Scratch
from tallyloom.operators import expenses, ordered, reconcile, resolve, state, summary
from tallyloom.settings import DEFAULTS, Settings
from tallyloom.sources import files as file_source
from tallyloom.sources import statements


@dataclass
class Saved:
    ledger: DataFrame
    purchases: DataFrame
    bank: DataFrame
    suppliers: DataFrame
    aliases: DataFrame
    pending: DataFrame
    categories: DataFrame


@dataclass
class RunResult:
    nothing_to_do: bool
    blocked: bool
    ledger_entries: DataFrame | None
    purchases: DataFrame | None
    bank: DataFrame | None
    aliases: DataFrame | None
    pending: DataFrame | None
    review: DataFrame | None
    summary: DataFrame | None


def read_saved(store: state.Store, categories: DataFrame) -> Saved:
    return Saved(
        store.read_log("ledger", schemas.LEDGER),
        state.with_defaults(store.read("purchases", schemas.PURCHASES)),
        state.bank_with_defaults(store.read("bank", schemas.BANK)),
        store.read("suppliers", schemas.SUPPLIERS),
        store.read("aliases", schemas.ALIASES),
        store.read("pending", schemas.PENDING),
        categories,
    )


def _after(table: DataFrame, key: str) -> int:
    last = table.agg(F.max(key).alias("last")).first()["last"]
    return 0 if last is None else int(last) + 1


def plan_run(
    found: DataFrame,
    replies: DataFrame,
    saved: Saved,
    run_ts: str,
    cfg: Settings = DEFAULTS,
    decisions: DataFrame | None = None,
) -> RunResult:
    """Next tables after handling the files not in the ledger.

    found    inventory with content (see sources.files)
    replies  structured replies for receipts and for statements no reader claims
    """
    spark = found.sparkSession
    scratch = Scratch(spark, "run")
    stamp = F.lit(run_ts).cast("timestamp")
    # Contents stay where they are; only the statements among the new files are read again.
    fresh = scratch.write(state.new_files(found.drop("content"), saved.ledger), "fresh")
    if fresh.isEmpty():
        return RunResult(True, False, *[None] * 7)
    receipts = fresh.where("stage = 'expense'")
    bank_files = found.join(fresh.where("stage = 'bank'").select("relative_path", "sha256"), ["relative_path", "sha256"], "left_semi")

    # Re-uploads replace the rows of the earlier upload and free their bank rows.
    replaced = state.supersede(saved.purchases, state.reuploads(receipts, saved.ledger), run_ts[:10])
    replaced = scratch.write(replaced, "replaced")
    purchases = state.upsert(saved.purchases, replaced, ["row_id"])
    bank = state.upsert(saved.bank, state.release(saved.bank, replaced), ["bank_id"])

    # Receipts.
    ordered_receipts = scratch.write(
        ordered.sequence(receipts.select("relative_path"), [F.col("relative_path")], "seq"), "receipts"
    )
    batch = ordered_receipts.withColumnRenamed("relative_path", "source_file")
    heard = batch.join(replies, "source_file", "left").withColumn("response", F.coalesce("response", F.lit("")))
    extracts = expenses.validate(expenses.with_hints(expenses.read_replies(heard), cfg), cfg)
    extracts = scratch.write(extracts.join(batch, "source_file"), "extracts")
    book = resolve.Book(saved.suppliers, saved.aliases, saved.pending)
    names = extracts.select("seq", F.col("supplier_name").alias("name"), F.col("line_summary").alias("context"), "source_file")
    found_suppliers = resolve.resolve(names, book, cfg, decisions)
    matches = scratch.write(found_suppliers.matches, "receipt-suppliers")
    learned = scratch.write(found_suppliers.learned, "receipt-aliases")
    joined = extracts.join(matches.select("seq", "canonical", "default_category", "is_new"), "seq")
    rows = expenses.to_purchases(joined, saved.categories, run_ts, cfg).withColumnRenamed("seq", "batch_seq")
    first_id = _after(purchases, "row_id")
    rows = expenses.flag_duplicates(rows, purchases, cfg).withColumn("row_id", F.col("batch_seq") + first_id)
    rows = scratch.write(rows, "receipt-rows")

    # Statements; open bank rows of earlier runs stay in play, so a late receipt still finds its debit.
    contents = file_source.text_content(bank_files)
    parsed, status = statements.parse_statements(contents, cfg, replies)
    status = scratch.write(status, "statement-status")
    old = bank.where("status = 'No receipt'").select(
        F.col("bank_id"), "date", "description", "amount", "direction",
        F.col("statement_file").alias("source_file"), "ref", "statement_start", "statement_end",
        F.lit(1).alias("old"), F.lit("").alias("file"), F.col("bank_id").alias("no"),
    )
    new = parsed.select(
        F.lit(None).cast("bigint").alias("bank_id"), "date", "description", "amount", "direction", "source_file",
        "ref", "statement_start", "statement_end", F.lit(0).alias("old"), F.col("source_file").alias("file"),
        F.col("row_no").alias("no"),
    )
    txns = ordered.sequence(new.unionByName(old), [F.col("old"), F.col("file"), F.col("no")], "txn_seq")
    txns = scratch.write(txns.drop("file", "no"), "txns")

    open_rows = reconcile.open_rows(purchases).select(*schemas.names(schemas.PURCHASES))
    eligible = open_rows.unionByName(rows.select(*open_rows.columns))
    result = reconcile.reconcile(eligible, txns, purchases, cfg)
    matched = scratch.write(result.matched, "matched")
    updated = scratch.write(result.updated_rows.unionByName(result.superseded_rows.select(*eligible.columns)), "updated")
    unmatched = scratch.write(result.unmatched_txns, "unmatched")

    # Suppliers of debits without receipt, with what the receipts have taught.
    next_pos = _after(saved.aliases, "pos")
    aliases = saved.aliases.unionByName(learned.select((F.col("seq") + next_pos).alias("pos"), "alias", "supplier"))
    pending = resolve.accumulate_pending(matches, saved.pending, run_ts, cfg)
    pending = scratch.write(pending, "pending")
    later = resolve.resolve(
        unmatched.select(F.col("txn_seq").alias("seq"), F.col("description").alias("name"), F.col("description").alias("context"), "source_file"),
        resolve.Book(saved.suppliers, aliases, pending), cfg, decisions,
    )
    later_matches = scratch.write(later.matches, "debit-suppliers")
    later_learned = scratch.write(later.learned, "debit-aliases")
    named = unmatched.join(
        later_matches.select(F.col("seq").alias("txn_seq"), "canonical", "default_category", "is_new"), "txn_seq"
    )
    debit_id = _after(rows, "row_id") if not rows.isEmpty() else first_id
    debit_rows = reconcile.bank_only_purchases(named, saved.categories, run_ts, cfg).withColumn(
        "row_id", F.col("txn_seq") + debit_id
    )
    debit_rows = scratch.write(debit_rows, "debit-rows")
    last_pos = _after(aliases, "pos")
    aliases = aliases.unionByName(later_learned.select((F.col("seq") + last_pos).alias("pos"), "alias", "supplier"))
    pending = resolve.accumulate_pending(later_matches, pending, run_ts, cfg)

    # Next tables.
    columns = schemas.names(schemas.PURCHASES)
    next_purchases = state.upsert(
        purchases.select(*columns).unionByName(rows.select(*columns)), updated.select(*columns), ["row_id"]
    ).unionByName(debit_rows.select(*columns))
    new_txns = txns.where("old = 0")
    first_bank = _after(saved.bank, "bank_id")
    entries = reconcile.bank_rows(new_txns, matched, result.ignored_txns, run_ts).withColumn(
        "bank_id", F.col("txn_seq") + first_bank
    )
    claimed = matched.join(txns.where("old = 1").select("txn_seq", "bank_id"), "txn_seq").select(
        "bank_id", F.col("source_file").alias("receipt")
    )
    bank_columns = schemas.names(schemas.BANK)
    settled = bank.join(claimed, "bank_id").withColumn("status", F.lit("Matched")).withColumn("matched_source", F.col("receipt"))
    next_bank = state.upsert(bank.select(*bank_columns), settled.select(*bank_columns), ["bank_id"]).unionByName(
        entries.select(*bank_columns)
    )

    # Ledger, gate and summary.
    review_files = rows.select(F.col("source_file").alias("relative_path"), F.col("status").alias("row_status"))
    handled = summary.rows_per_file(
        fresh.join(review_files, "relative_path", "left")
        .join(status.select(F.col("source_file").alias("relative_path"), "flagged", "error"), "relative_path", "left")
        .withColumn(
            "status",
            F.when(F.col("error").isNotNull(), "Error").when((F.col("row_status") == "Review") | F.col("flagged"), "Flagged").otherwise("Processed"),
        ),
        rows.select("source_file").unionByName(debit_rows.select("source_file")),
    )
    entries_log = handled.select(
        "filename", "relative_path", "sha256", "size", stamp.alias("date_processed"), "stage", "status", "rows_added",
        F.coalesce("error", F.lit("")).alias("notes"),
    )
    files = (
        found.select("relative_path", "stage")
        .join(handled.select("relative_path", "status", "rows_added"), "relative_path", "left")
        .withColumn("is_new", F.col("status").isNotNull())
    )
    every = rows.select("status").unionByName(debit_rows.select("status"))
    replaced_rows = replaced.select("status").unionByName(result.superseded_rows.select("status"))
    new_names = (
        rows.join(matches.where("is_new").select(F.col("seq").alias("batch_seq")), "batch_seq")
        .select("company")
        .unionByName(debit_rows.where("category = ''").select("company"))
    )
    gate = summary.blocked(every, status).first()["blocked"] if cfg.block_on_flags else False
    failed = status.where("error is not null").select(F.concat_ws(": ", "source_file", "error").alias("error"))
    gates = spark.createDataFrame([("blocked: flags present",)] if gate else [], "error string")
    told = summary.run_summary(
        summary.stage_counters(files), every, replaced_rows, new_names, unmatched, result.unmatched_rows,
        failed.unionByName(gates), reconcile.ref_warnings(new_txns),
    )
    review = found_suppliers.review.unionByName(later.review)
    return RunResult(False, gate, entries_log, next_purchases, next_bank, aliases, pending, review, told)


def publish_run(store: state.Store, result: RunResult, run_id: str) -> None:
    """Store the tables of a run; an empty or blocked run stores nothing, and a dry run skips this call."""
    if result.nothing_to_do or result.blocked:
        return
    store.stage("purchases", result.purchases, run_id)
    store.stage("bank", result.bank, run_id)
    store.stage("aliases", result.aliases, run_id)
    store.stage("pending", result.pending, run_id)
    store.stage_log("ledger", result.ledger_entries, run_id)
    if store.publish(run_id) % store.EVERY == 0:
        store.compact("ledger", schemas.LEDGER)
