"""Status tables: upserts, supersession, ledger look-ups and published snapshots."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyloom.functions import text
from tallyloom.operators import ordered


def new_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files whose hash the ledger has never seen, whatever came of it."""
    return files.join(ledger.select("sha256").distinct(), "sha256", "left_anti")


def reuploads(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """New files whose path, collision suffix aside, is already in the ledger."""
    seen = ledger.select(text.canonical_path(F.col("relative_path")).alias("canonical")).distinct()
    return files.withColumn("canonical", text.canonical_path(F.col("relative_path"))).join(
        seen, "canonical", "left_semi"
    )


def supersede(purchases: DataFrame, replaced: DataFrame, run_date: str) -> DataFrame:
    """Changed purchase rows: rows of a re-uploaded path become Superseded and let go of their bank row.

    Adds `released_ref`. Columns people own pass through untouched.
    """
    paths = replaced.select("canonical").distinct()
    hit = (
        purchases.where("status <> 'Superseded'")
        .withColumn("canonical", text.canonical_path(F.col("source_file")))
        .join(paths, "canonical", "left_semi")
        .drop("canonical")
    )
    return (
        hit.withColumn("released_ref", F.col("bank_ref"))
        .withColumn("bank_ref", F.lit(""))
        .withColumn("status", F.lit("Superseded"))
        .withColumn("notes", text.add_note(F.col("notes"), F.lit(f"Superseded by re-upload on {run_date}")))
    )


def release(bank: DataFrame, superseded: DataFrame) -> DataFrame:
    """Changed bank rows: the rows superseded receipts had claimed are open again.

    A reference may be printed twice, so the row must also name the receipt that let go.
    """
    claims = superseded.where("released_ref <> ''").select(
        F.col("released_ref").alias("ref"), F.col("source_file").alias("matched_source")
    )
    return (
        bank.join(claims.distinct(), ["ref", "matched_source"], "left_semi")
        .withColumn("status", F.lit("No receipt"))
        .withColumn("matched_source", F.lit(""))
        .select(*bank.columns)
    )


def upsert(base: DataFrame, changed: DataFrame, key: list[str]) -> DataFrame:
    """Base with rows of equal key replaced by the changed rows."""
    return base.join(changed.select(*key), key, "left_anti").select(*base.columns).unionByName(
        changed.select(*base.columns)
    )


def unknown_keys(base: DataFrame, changed: DataFrame, key: list[str]) -> DataFrame:
    """Changed rows that name no row of the base; an update must have none."""
    return changed.join(base.select(*key), key, "left_anti")


def update(base: DataFrame, changed: DataFrame, key: list[str]) -> DataFrame:
    """upsert() that fails when a changed row has no counterpart."""
    missing = unknown_keys(base, changed, key)
    if not missing.isEmpty():
        raise ValueError(f"update names rows that do not exist, by {key}")
    return upsert(base, changed, key)


def insert_or_ignore(base: DataFrame, rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """Base plus the first row of every key it does not hold yet."""
    fresh = ordered.first_per_key(rows, key, order)
    return base.unionByName(fresh.join(base.select(*key), key, "left_anti").select(*base.columns))


def missing_sources(ledger: DataFrame, files: DataFrame) -> DataFrame:
    """Ledger entries whose file is gone."""
    return ledger.join(files.select("relative_path").distinct(), "relative_path", "left_anti")


def merge_aliases(existing: DataFrame, detected: DataFrame) -> DataFrame:
    """All existing (alias, supplier) rows plus detected ones whose alias text is not there yet."""
    mine = detected.join(existing.select("alias").distinct(), "alias", "left_anti")
    return existing.select("alias", "supplier").unionByName(mine.select("alias", "supplier"))


def append_rows(table: DataFrame, rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The table with rows added at its end: keys go on after the largest one, in the order given."""
    last = table.agg(F.max(key).alias("last")).first()["last"]
    first = 0 if last is None else int(last) + 1
    numbered = ordered.sequence(rows.drop(key), order, "__place")
    added = numbered.withColumn(key, F.col("__place") + first).select(*table.columns)
    return table.unionByName(added)


def rewrite_paths(frame: DataFrame, columns: list[str], old: str, new: str, words: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Frame with path prefixes and whole words rewritten; `changed` marks touched rows."""
    out, touched = frame, F.lit(False)
    for name in columns:
        swapped = text.swap_prefix(F.col(name), old, new)
        touched = touched | (swapped != F.col(name))
    for name, (was, _) in (words or {}).items():
        touched = touched | (F.col(name) == was)
    out = out.withColumn("changed", touched)
    for name in columns:
        out = out.withColumn(name, text.swap_prefix(F.col(name), old, new))
    for name, (was, becomes) in (words or {}).items():
        out = out.withColumn(name, F.when(F.col(name) == was, becomes).otherwise(F.col(name)))
    return out


def review_queue(purchases: DataFrame, bank: DataFrame) -> DataFrame:
    """What needs a look: Review purchases and bank rows without a receipt."""
    rows = purchases.where("status = 'Review'").select(
        F.lit("purchase").alias("kind"), "date", F.col("company").alias("label"),
        F.col("total").alias("amount"), F.col("notes").alias("detail"),
    )
    open_rows = bank.where("status = 'No receipt'").select(
        F.lit("bank").alias("kind"), "date", F.col("description").alias("label"),
        F.col("amount").alias("amount"), F.lit("").alias("detail"),
    )
    return rows.unionByName(open_rows)


def totals(purchases: DataFrame, keep: Column | None = None) -> DataFrame:
    """Sums of net, tax and total over the rows shown."""
    shown = purchases if keep is None else purchases.where(keep)
    return shown.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("decimal(28,2)").alias(c) for c in ("net", "sales_tax", "total")])


class Store:
    """Tables and logs as plain Parquet folders, and `runs`, which points at the folders that count. One writer.

    Every write is a folder of its own, `<name>/<run>-<unique>`, so nothing published is ever overwritten. A run
    is published by appending one file to `runs`, with a row for each folder: all it wrote appears together.
    A run that died before that left nothing visible, one that died after it is complete. Folders that no
    longer count stay until someone deletes them.
    """

    #: Logs are compacted whenever so many more runs have been published.
    EVERY = 32
    RUNS = "number bigint, run_id string, name string, folder string, whole boolean"

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._staged: dict[str, dict[str, tuple[str, bool]]] = {}

    def runs(self) -> DataFrame:
        """A row for each folder of each published run; a `whole` one stands for all of its name before it."""
        try:
            return self.spark.read.schema(self.RUNS).parquet(f"{self.root}/runs")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.RUNS)

    def _last(self, name: str) -> Row:
        """Number and folder of the newest whole folder of a table or log, nulls if there is none."""
        rows = self.runs().where((F.col("name") == name) & F.col("whole"))
        return rows.agg(F.max("number").alias("number"), F.max_by("folder", "number").alias("folder")).first()

    def _parquet(self, schema: StructType | str, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{folder}" for folder in folders])

    def read(self, name: str, schema: StructType | str) -> DataFrame:
        """Published rows of a table; columns an older version lacks are null."""
        folder = self._last(name)["folder"]
        return self._parquet(schema, [] if folder is None else [folder])

    def _logged(self, name: str, schema: StructType | str) -> DataFrame:
        """Rows of a log with the run that wrote them, `_run`."""
        whole = self._last(name)
        since = self.runs().where((F.col("name") == name) & (F.col("number") > F.lit(whole["number"] or 0)))
        parts = since.groupBy("run_id").agg(F.max_by("folder", "number").alias("folder")).collect()
        fields = StructType([*(schema if isinstance(schema, StructType) else StructType.fromDDL(schema)).fields, StructField("_run", StringType())])
        rows = self._parquet(fields, [p["folder"] for p in parts])
        if whole["folder"] is None:
            return rows
        kept = ~F.col("_run").isin([p["run_id"] for p in parts])  # a run repeated since then has replaced its rows
        return self._parquet(fields, [whole["folder"]]).where(kept).unionByName(rows)

    def read_log(self, name: str, schema: StructType | str, besides: str | None = None) -> DataFrame:
        """All appended rows, or all but those of one run."""
        rows = self._logged(name, schema)
        return (rows if besides is None else rows.where(F.col("_run") != besides)).drop("_run")

    def _stage(self, name: str, rows: DataFrame, run_id: str, whole: bool) -> None:
        folder = f"{name}/{run_id}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.root}/{folder}")
        self._staged.setdefault(run_id, {})[name] = (folder, whole)

    def stage(self, name: str, rows: DataFrame, run_id: str) -> None:
        """Write the next version of a table; publish() makes it visible."""
        self._stage(name, rows, run_id, True)

    def stage_log(self, name: str, rows: DataFrame, run_id: str) -> None:
        """Write rows to add to a log; publish() makes them visible, in place of earlier rows of this run."""
        self._stage(name, rows.withColumn("_run", F.lit(run_id)), run_id, False)

    def publish(self, run_id: str) -> int:
        """Make all that was staged for the run visible together; the number of the run."""
        number = (self.runs().agg(F.max("number").alias("last")).first()["last"] or 0) + 1
        rows = [(number, run_id, name, folder, whole) for name, (folder, whole) in self._staged.pop(run_id, {}).items()]
        self.spark.createDataFrame(rows, self.RUNS).coalesce(1).write.mode("append").parquet(f"{self.root}/runs")
        return number

    def append(self, name: str, rows: DataFrame, run_id: str) -> int:
        """Append once per run: a repeated run replaces its own rows."""
        self.stage_log(name, rows, run_id)
        return self.publish(run_id)

    def compact(self, name: str, schema: StructType | str) -> None:
        """Rewrite a log as one folder, published as a run of its own; a run repeated later still replaces its rows."""
        run_id = f"compact-{name}"
        self._stage(name, self._logged(name, schema), run_id, True)
        self.publish(run_id)


def with_defaults(purchases: DataFrame) -> DataFrame:
    """Purchase rows as read back: missing texts are empty, missing amounts zero, missing status OK."""
    out = purchases
    for name in ("company", "category", "payment_method", "notes", "source_file", "bank_ref"):
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit("")))
    for name in ("net", "sales_tax", "total", "tax_rate", "year"):
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(0).cast(purchases.schema[name].dataType)))
    out = out.withColumn("status", F.when(F.coalesce("status", F.lit("")) == "", "OK").otherwise(F.col("status")))
    return out.withColumn("copied_to_master", F.trim(F.coalesce("copied_to_master", F.lit(""))))


def bank_with_defaults(bank: DataFrame) -> DataFrame:
    out = bank
    for name, value in (("direction", "debit"), ("status", "No receipt")):
        out = out.withColumn(name, F.when(F.coalesce(F.col(name), F.lit("")) == "", value).otherwise(F.col(name)))
    for name in ("description", "matched_source", "ref", "statement_file"):
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit("")))
    return out.withColumn("amount", F.coalesce("amount", F.lit(0).cast("decimal(18,2)")))
