"""Whole runs over files derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.catalog.base import query, sql_fold, sql_partial
from tallyloom.catalog.matching import mutual_best
from tallyloom.catalog.readers import _csv_files
from tallyloom.durable import Scratch, measured_joins
from tallyloom.operators import state
from tallyloom.plans import run as plan
from tallyloom.plans import seed as seed_plan
from tallyloom.streaming import intake as streams


def _files(t):
    """One receipt per order and the CSV statements, in the shape of the file inventory."""
    receipts = t.v_replies.select(F.col("source_file").alias("relative_path"), F.lit("expense").alias("stage"), F.col("response").alias("body"))
    banks = _csv_files(t).select(F.col("source_file").alias("relative_path"), F.lit("bank").alias("stage"), F.col("content").alias("body"))
    return receipts.unionByName(banks).select(
        "relative_path", F.substring_index("relative_path", "/", -1).alias("filename"), "stage", F.sha2("body", 256).alias("sha256"),
        F.octet_length("body").cast("bigint").alias("size"), F.encode("body", "UTF-8").alias("content"),
    )


# Receipts and debits carry the numbers a run gives them: receipts by path, transactions by file and line.
_PAIRS = f"""SELECT txn_seq, row_id, gap, {sql_partial('x', 'y')} AS score FROM (
        SELECT d.seq AS txn_seq, r.seq AS row_id, abs(date_diff('day', d.date, r.date)) AS gap,
               {sql_fold('d.description')} AS x, {sql_fold('r.company')} AS y
        FROM debits d JOIN receipts r ON d.cents = r.cents AND abs(date_diff('day', d.date, r.date)) <= 5)"""
_RUN = f"""WITH receipts AS (SELECT *, row_number() OVER (ORDER BY source_file) AS seq,
        row_number() OVER (PARTITION BY date, lower(company), cents ORDER BY source_file) AS copy
        FROM (SELECT date, company, source_file, mark, cents + CASE mark WHEN 'O' THEN 125 ELSE 0 END AS cents FROM v_purchases)),
    debits AS (SELECT date, cents, description, row_number() OVER (ORDER BY stem || '.csv', txn_seq) AS seq FROM v_bank WHERE direction = 'debit'),
    {mutual_best(_PAIRS, 16)},
    judged AS (SELECT CASE WHEN mark = 'P' OR copy > 1 THEN 'Review' ELSE 'OK' END AS status FROM receipts),
    open_debits AS (SELECT seq FROM debits WHERE seq NOT IN (SELECT txn_seq FROM matched))
    SELECT kind, status, count(*) AS n FROM (
        SELECT 'purchases' AS kind, status FROM judged UNION ALL SELECT 'purchases', 'Review' FROM open_debits
        UNION ALL SELECT 'bank', 'Matched' FROM matched UNION ALL SELECT 'bank', 'No receipt' FROM open_debits
        UNION ALL SELECT 'bank', 'Ignored' FROM v_bank WHERE direction = 'credit'
        UNION ALL SELECT 'ledger', CASE status WHEN 'OK' THEN 'Processed' ELSE 'Flagged' END FROM judged
        UNION ALL SELECT 'ledger', 'Processed' FROM (SELECT DISTINCT stem FROM v_bank)) GROUP BY kind, status"""


@query("STM-8", _RUN)
def _(t):
    """Files arrive as a stream; every batch of new files is one run over the published tables."""
    scratch = Scratch(t.spark, "books")
    store = state.Store(t.spark, f"{scratch.root}/store")
    suppliers = t.customer.select(
        F.col("c_custkey").alias("pos"), F.col("c_name").alias("supplier"), F.col("c_mktsegment").alias("default_category"),
        F.lit(1).cast("bigint").alias("count"),
    )
    store.stage("suppliers", suppliers, "seed")
    store.publish("seed")
    categories = t.customer.select(F.col("c_mktsegment").alias("category")).distinct().withColumn("tax_line", F.lit(""))
    replies = t.v_replies.select("source_file", "response")
    with measured_joins(t.spark):
        scratch.write(_files(t), "files")

    def run(batch, run_id, number):
        saved = plan.read_saved(store, categories)
        plan.publish_run(store, plan.plan_run(batch, replies, saved, "2024-05-06 07:08:09"), run_id)

    arriving = t.spark.readStream.schema(schemas.FILES).parquet(f"{scratch.root}/*-files")
    streams.sweep_then_follow(arriving, streams.run_per_batch(store, run), f"{scratch.root}/checkpoint").awaitTermination()
    rows = store.read("purchases", schemas.PURCHASES).select(F.lit("purchases").alias("kind"), "status")
    bank = store.read("bank", schemas.BANK).select(F.lit("bank").alias("kind"), "status")
    log = store.read_log("ledger", schemas.LEDGER).select(F.lit("ledger").alias("kind"), "status")
    return rows.unionByName(bank).unionByName(log).groupBy("kind", "status").agg(F.count(F.lit(1)).alias("n"))


@query("seed", """SELECT supplier, count FROM (SELECT arg_max(company, (n, -f)) AS supplier, sum(n)::BIGINT AS count FROM (
    SELECT company, trim(regexp_replace(lower(company), '[^a-z0-9]+', ' ', 'g')) AS key, count(*) AS n, min(idx) AS f
    FROM v_history GROUP BY company) GROUP BY key)""")
def _(t):
    """Dimension tables from the purchase history."""
    none = t.v_aliases.limit(0).select("alias", "supplier")
    return seed_plan.seed(t.v_history, t.v_categories, none).suppliers.select("supplier", "count")
