"""Whole runs over a store: receipts, statements, late receipts, re-uploads, duplicates."""

import json

import pytest
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.operators.state import Store
from tallyloom.plans import run as plan
from tallyloom.sources import files as source

CATEGORIES = [(0, "Cloth", "22"), (1, "Food", "24")]
SUPPLIERS = [(0, "Loom Works", "cloth", 3), (1, "Mill", "Cloth", 1)]


def reply(**fields):
    return json.dumps({"confidence": 0.9, "currency": "USD", **fields})


class Books:
    def __init__(self, spark, root):
        self.spark, self.root, self.n = spark, root, 0
        self.imports = root / "imports"
        self.store = Store(spark, f"file:{root}/store")
        self.store.stage("suppliers", spark.createDataFrame(SUPPLIERS, schemas.SUPPLIERS), "seed")
        self.store.publish("seed")
        self.categories = spark.createDataFrame(CATEGORIES, schemas.CATEGORIES)
        self.replies = []

    def receipt(self, name, content, **fields):
        path = self.imports / "expenses" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(content)
        self.replies.append((f"expenses/{name}", reply(**fields)))

    def statement(self, name, body):
        path = self.imports / "bank" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(body)

    def run(self):
        self.n += 1
        saved = plan.read_saved(self.store, self.categories)
        replies = self.spark.createDataFrame(self.replies, schemas.REPLIES)
        result = plan.plan_run(source.discover(self.spark, str(self.imports)), replies, saved, f"2024-04-0{self.n} 10:00:00")
        plan.publish_run(self.store, result, f"run{self.n}")
        return result

    def purchases(self):
        rows = self.store.read("purchases", schemas.PURCHASES).orderBy("row_id").collect()
        return [(r.company, str(r.total), r.status, r.bank_ref, r.notes) for r in rows]

    def bank(self):
        return [(r.ref, r.status, r.matched_source) for r in self.store.read("bank", schemas.BANK).orderBy("bank_id").collect()]


def test_runs(spark, tmp_path):
    books = Books(spark, tmp_path)
    books.receipt("2024-03-01 Loom.pdf", "one", date="2024-03-01", supplier_name="Loom Works Inc", total="12.50", sales_tax=0)
    books.statement(
        "march.csv",
        "Date,Description,Amount,Reference\n2024-03-03,SQ *LOOM WORKS,12.50,A1\n2024-03-09,MILL NORTH 12,7.00,A2\n2024-03-10,PAYMENT,50.00,A3\n",
    )
    first = books.run()
    assert not first.nothing_to_do
    assert books.purchases() == [
        ("Loom Works", "12.50", "OK", "A1", ""),
        ("Mill", "7.00", "Review", "A2", "From bank statement; no receipt"),
    ]
    assert books.bank() == [
        ("A1", "Matched", "expenses/2024-03-01 Loom.pdf"), ("A2", "No receipt", ""), ("A3", "Ignored", ""),
    ]
    assert books.run().nothing_to_do

    # A late receipt claims the open debit; a copy of the first receipt is noted as a double.
    books.receipt("late.pdf", "two", date="2024-03-08", supplier_name="Mill", total=7, sales_tax=0)
    books.receipt("copy.pdf", "three", date="2024-03-01", supplier_name="Loom Works", total=12.5, sales_tax=0)
    books.run()
    rows = {(c, s): (ref, notes) for c, _, s, ref, notes in books.purchases()}
    assert rows[("Mill", "OK")][0] == "A2"
    assert rows[("Mill", "Superseded")][1].endswith("Receipt arrived: expenses/late.pdf")
    assert rows[("Loom Works", "Review")][1] == "Possible duplicate of expenses/2024-03-01 Loom.pdf"
    assert ("A2", "Matched", "expenses/late.pdf") in books.bank()

    # A corrected upload under a collision name replaces the row, frees its debit, and claims it again.
    books.receipt("2024-03-01 Loom__0a1b2c3d.pdf", "four", date="2024-03-02", supplier_name="Loom Works", total=12.5, sales_tax=0)
    books.run()
    old = [r for r in books.purchases() if r[2] == "Superseded" and r[0] == "Loom Works"]
    assert old == [("Loom Works", "12.50", "Superseded", "", "Superseded by re-upload on 2024-04-04")]
    matched = {ref: src for ref, status, src in books.bank() if status == "Matched"}
    assert set(matched) == {"A1", "A2"} and matched["A1"] != "expenses/2024-03-01 Loom.pdf"
    ledger = books.store.read_log("ledger", schemas.LEDGER)
    assert ledger.count() == 5
    assert {r.relative_path for r in ledger.where("status = 'Flagged'").collect()} == {"expenses/copy.pdf"}


def test_a_run_that_dies_is_repeated_under_its_id(spark, tmp_path):
    books = Books(spark, tmp_path)
    books.receipt("2024-03-01 Loom.pdf", "one", date="2024-03-01", supplier_name="Loom Works Inc", total="12.50", sales_tax=0)
    books.statement("march.csv", "Date,Description,Amount,Reference\n2024-03-03,SQ *LOOM WORKS,12.50,A1\n2024-03-09,MILL NORTH 12,7.00,A2\n")

    class Died(Exception):
        pass

    def attempt(die_before: str | None) -> None:
        """One attempt by a fresh process; die_before names the step that never happens."""
        store = Store(spark, books.store.root)
        if die_before:
            def dead(*_):
                raise Died

            setattr(store, die_before, dead)
        saved = plan.read_saved(store, books.categories)
        replies = spark.createDataFrame(books.replies, schemas.REPLIES)
        result = plan.plan_run(source.discover(spark, str(books.imports)), replies, saved, "2024-04-01 10:00:00")
        plan.publish_run(store, result, "run1")

    with pytest.raises(Died):
        attempt("publish")  # everything is staged by then
    assert books.purchases() == [] and books.store.read_log("ledger", schemas.LEDGER).isEmpty()
    attempt(None)
    rows, bank = books.purchases(), books.bank()
    assert len(rows) == 2 and len(bank) == 2 and books.store.read_log("ledger", schemas.LEDGER).count() == 2
    attempt(None)  # died after publishing, before the caller noted it
    assert (books.purchases(), books.bank()) == (rows, bank) and books.store.read_log("ledger", schemas.LEDGER).count() == 2
    books.store.compact("ledger", schemas.LEDGER)
    attempt(None)
    assert (books.purchases(), books.bank()) == (rows, bank) and books.store.read_log("ledger", schemas.LEDGER).count() == 2


def test_a_compacted_log_keeps_its_rows(spark, tmp_path):
    store = Store(spark, f"file:{tmp_path}/store")
    assert store.read_log("log", "v int").isEmpty() and store.runs().isEmpty()
    add = lambda v, run: store.append("log", spark.createDataFrame([(v,)], "v int"), run)
    held = lambda besides=None: sorted(r.v for r in store.read_log("log", "v int", besides).collect())
    assert [add(i, f"b{i}") for i in range(4)] == [1, 2, 3, 4]
    add(30, "b3")  # repeated before the log is compacted
    store.compact("log", "v int")
    assert held() == [0, 1, 2, 30] and held("b3") == [0, 1, 2]
    add(20, "b2")  # and after it
    add(5, "b5")
    assert held() == [0, 1, 5, 20, 30] and held("b2") == [0, 1, 5, 30]
    store.compact("log", "v int")
    assert held() == [0, 1, 5, 20, 30] and held("b5") == [0, 1, 20, 30]
    # Staged rows count only once they are published, all of a run together.
    store.stage("table", spark.createDataFrame([(1,)], "v int"), "late")
    store.stage_log("log", spark.createDataFrame([(7,)], "v int"), "late")
    assert store.read("table", "v int").isEmpty() and 7 not in held()
    store.publish("late")
    assert store.read("table", "v int").count() == 1 and 7 in held()


def test_release_needs_reference_and_receipt(spark):
    from tallyloom.operators.state import release

    bank = spark.createDataFrame([(1, "A", "Matched", "x.pdf"), (2, "A", "Matched", "y.pdf"), (3, "B", "Matched", "x.pdf")], "bank_id long, ref string, status string, matched_source string")
    gone = spark.createDataFrame([("A", "x.pdf"), ("", "y.pdf")], "released_ref string, source_file string")
    assert [tuple(r) for r in release(bank, gone).collect()] == [(1, "A", "No receipt", "")]


def test_update_needs_its_rows(spark):
    from tallyloom.operators.state import update

    base = spark.createDataFrame([(1, "a")], "row_id long, v string")
    with pytest.raises(ValueError):
        update(base, spark.createDataFrame([(2, "b")], "row_id long, v string"), ["row_id"])
    assert [tuple(r) for r in update(base, base.withColumn("v", F.lit("z")), ["row_id"]).collect()] == [(1, "z")]


def test_a_failing_file_has_an_error_and_the_rest_goes_on(spark, tmp_path):
    import csv

    books = Books(spark, tmp_path)
    books.receipt("2024-03-01 Loom.pdf", "one", date="2024-03-01", supplier_name="Loom Works Inc", total="12.50", sales_tax=0)
    books.statement("good.csv", "Date,Description,Amount,Reference\n2024-03-03,SQ *LOOM WORKS,12.50,A1\n2024-03-09,MILL NORTH 12,7.00,A2\n2024-03-09,MILL NORTH 13,8.00,A2\n")
    books.statement("huge.csv", 'Date,Description,Amount\n2024-01-02,"two\n' + "y" * (csv.field_size_limit() + 10) + '",7.00\n')
    result = books.run()
    ledger = {r.relative_path: (r.status, r.notes) for r in books.store.read_log("ledger", schemas.LEDGER).collect()}
    assert ledger["bank/huge.csv"][0] == "Error" and "limit" in ledger["bank/huge.csv"][1]
    assert {s for p, (s, _) in ledger.items() if p != "bank/huge.csv"} == {"Processed"}
    told = {(r.section, r.item): r.value for r in result.summary.collect()}
    assert told["files_errored", "bank"] == 1 and [i for s, i in told if s == "error"][0].startswith("bank/huge.csv: ")
    assert ("warning", "bank/good.csv: reference A2 printed 2 times") in told
    assert "A1" in [ref for ref, status, _ in books.bank() if status == "Matched"]


def test_written_tables_of_a_batch_are_dropped(spark):
    import os

    from tallyloom import durable
    from tallyloom.streaming import intake as streams

    seen = []

    def run(batch, run_id, number):
        scratch = durable.Scratch(spark, "inside")
        seen.append(scratch.root.removeprefix("file://"))
        assert scratch.write(batch, "rows").count() == 1

    streams.run_per_batch(None, run)(spark.range(1), 0)
    assert seen and not os.path.exists(seen[0])
