"""Stream forms against plain loops and batch forms."""

import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F

from tallyloom.durable import Scratch
from tallyloom.operators import intake
from tallyloom.operators.state import Store
from tallyloom.settings import Settings
from tallyloom.streaming import intake as streams

START = dt.datetime(2024, 1, 1)
SCHEMA = "event_id long, folder string, ts timestamp_ntz"


def events(spark, root):
    rnd = random.Random(2)
    rows, at = [], {f: 0 for f in ("expenses", "bank")}
    for i in range(300):
        folder = rnd.choice(list(at))
        at[folder] += rnd.choice([1, 5, 30, 130, 400])
        rows.append((i, folder, START + dt.timedelta(seconds=at[folder])))
    rows.append((300, "expenses", START + dt.timedelta(seconds=max(at.values()) + 1000)))
    path = str(root / "events")
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(path)
    return rows, path


def drain(spark, frame, root, name):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", streams.ROCKSDB)
    query = (
        frame.writeStream.format("memory").queryName(name).option("checkpointLocation", str(root / name))
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.table(name).collect()


def plain_spells(rows, quiet):
    out, waiting = [], {}
    for _, folder, ts in sorted(rows, key=lambda r: r[2]):
        if folder in waiting and (ts - waiting[folder][1]).total_seconds() < quiet:
            waiting[folder][1:] = [ts, waiting[folder][2] + 1]
        else:
            if folder in waiting:
                out.append((folder, *waiting[folder]))
            waiting[folder] = [ts, ts, 1]
    return sorted(out), sorted((f, *w) for f, w in waiting.items())


def test_quiet_batches(spark, tmp_path):
    rows, path = events(spark, tmp_path)
    closed, still_open = plain_spells(rows, 120)
    batch = intake.quiet_batches(spark.read.parquet(path), 120)
    got = sorted((r.folder, r.first_event, r.last_event, r.events) for r in batch.collect())
    assert got == sorted(closed + still_open)
    stream = spark.readStream.schema(SCHEMA).parquet(path)
    fired = drain(spark, streams.quiet_batches(stream, 120, "0 seconds"), tmp_path, "spells")
    assert {(r.folder, r.first_event, r.last_event, r.events) for r in fired} <= set(closed + still_open)
    assert set(closed) - {(r.folder, r.first_event, r.last_event, r.events) for r in fired} == set()


def test_debounce_waits_while_busy(spark, tmp_path):
    rows, path = events(spark, tmp_path)
    stream = spark.readStream.schema(SCHEMA).parquet(path)
    idle = drain(spark, streams.debounce(stream, 120, "0 seconds"), tmp_path, "idle")
    closed, _ = plain_spells(rows, 120)
    assert {(r.folder, r.events) for r in idle} >= {(f, n) for f, _, _, n in closed}
    # One folder ends long before the other, so its last batch is fired by the clock alone.
    ends = {f: max(ts for _, g, ts in rows if g == f) for f in ("expenses", "bank")}
    early = min(ends, key=ends.get)
    assert (max(ends.values()) - ends[early]).total_seconds() > 120
    last_ms = int((ends[early] - dt.datetime(1970, 1, 1)).total_seconds() * 1000)
    assert [r.fired_ms for r in idle if r.folder == early and r.last_ms == last_ms] == [last_ms + 120_000]
    # While the consumer is always busy nothing fires before the busy time ends.
    end = int((START + dt.timedelta(days=2) - dt.datetime(1970, 1, 1)).total_seconds() * 1000)
    busy = drain(spark, streams.debounce(spark.readStream.schema(SCHEMA).parquet(path), 120, "0 seconds", [(0, end)]), tmp_path, "busy")
    assert all(r.fired_ms >= end for r in busy)


def test_settled_stream_equals_batch(spark, tmp_path):
    polls = [("bank", i, START + dt.timedelta(minutes=i), f"f{n}", 1, "h") for i, n in enumerate([1, 1, 2, 3, 3, 3])]
    frame = spark.createDataFrame(polls, "folder string, poll_id long, polled_at timestamp, name string, size long, content_hash string")
    prints = intake.fingerprints(frame)
    batch = [r.run_length for r in intake.settled(prints, Settings(stable_polls=3)).orderBy("poll_id").collect()]
    assert batch == [1, 2, 1, 1, 2, 3]
    outcome = intake.settle_outcome(prints, Settings(stable_polls=3)).collect()
    assert [(r.folder, r.settled_at, r.gave_up) for r in outcome] == [("bank", START + dt.timedelta(minutes=5), False)]
    path = str(tmp_path / "prints")
    prints.write.parquet(path)
    stream = spark.readStream.schema(prints.schema).parquet(path)
    got = drain(spark, streams.settled(stream, "0 seconds", Settings(stable_polls=3)), tmp_path, "settle")
    assert [r.run_length for r in sorted(got, key=lambda r: r.poll_id)] == batch


def test_settle_gives_up_by_the_clock_and_waits_anew(spark, tmp_path):
    at = lambda m: START + dt.timedelta(minutes=m)
    polls = [("bank", 1, at(0), "f1", 1, "h"), ("bank", 2, at(10), "f2", 1, "h"), ("bank", 3, at(500), "f3", 1, "h"), ("bank", 4, at(501), "f3", 1, "h"),
             ("bank", 5, at(900), "f4", 1, "h"), ("idle", 6, at(0), "f1", 1, "h"), ("late", 7, at(2000), "f1", 1, "h")]
    frame = spark.createDataFrame(polls, "folder string, poll_id long, polled_at timestamp, name string, size long, content_hash string")
    path = str(tmp_path / "prints")
    prints = intake.fingerprints(frame)
    prints.where("poll_id < 3 or poll_id = 6").coalesce(1).write.parquet(path)
    prints.where("poll_id between 3 and 5 or poll_id = 7").coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(prints.schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(path)
    got = drain(spark, streams.settled(stream, "0 seconds", Settings(stable_polls=2)), tmp_path, "deadline")
    by = {r.poll_id: (r.run_length, r.is_settled, r.over_time) for r in got if r.poll_id is not None}
    assert by[4] == (2, True, False)
    assert by[5] == (1, False, False)  # a new wait began after the settled poll
    given_up = [(r.folder, r.over_time) for r in got if r.poll_id is None]
    assert ("idle", True) in given_up


def test_a_late_listing_row_is_still_imported(spark, tmp_path):
    store = Store(spark, f"file:{tmp_path}/store")
    schema = "folder string, name string, content_hash string, polled_at timestamp"
    path = str(tmp_path / "listing")
    write = streams.record_imports(store, schema)
    for i, hour in enumerate((15, 11)):
        spark.createDataFrame([("bank", f"n{i}", "h", START + dt.timedelta(hours=hour))], schema).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(schema).parquet(path)
        streams.sweep_then_follow(stream, write, str(tmp_path / "check")).awaitTermination()
    assert sorted(r.name for r in store.read_log("imported", schema).collect()) == ["n0", "n1"]


def test_a_repeated_batch_imports_nothing_twice(spark, tmp_path):
    store = Store(spark, f"file:{tmp_path}/store")
    schema = "folder string, name string, content_hash string, polled_at timestamp"
    rows = spark.createDataFrame([("bank", "a", "h", START), ("bank", "a", "h", START), ("bank", "b", "h", START)], schema)
    write = streams.record_imports(store, schema)
    store.EVERY = 2  # the table is compacted in between
    write(rows, 0)
    write(rows, 1)
    assert store.read_log("imported", schema).count() == 2
    write(rows, 0)  # the same batch again, after a restart
    assert sorted(r.name for r in store.read_log("imported", schema).collect()) == ["a", "b"]
    assert {r.run_id for r in store.runs().where("whole").collect()} == {"compact-imported"}


def test_sweep_then_incremental_runs(spark, tmp_path):
    seen = []
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "expenses").mkdir()
    (tmp_path / "in" / "expenses" / "a.pdf").write_text("a")
    from tallyloom.sources import files

    def run(batch, run_id, number):
        seen.append(sorted(r.relative_path for r in batch.select("relative_path").collect()))

    for name in ("b.pdf", None):
        stream = files.discover_stream(spark, str(tmp_path / "in"))
        handle = streams.run_per_batch(None, run)
        streams.sweep_then_follow(stream, handle, str(tmp_path / "check")).awaitTermination()
        if name:
            (tmp_path / "in" / "expenses" / name).write_text("b")
    assert seen == [["expenses/a.pdf"], ["expenses/b.pdf"]]


def test_joins_of_a_run_go_by_measured_sizes(spark, tmp_path):
    """A table of one text is small in its file and large in memory: the driver must not gather it."""
    limit, plans = "spark.sql.autoBroadcastJoinThreshold", []

    def run(batch, run_id, number):
        scratch = Scratch(spark, "sizes")
        wide = scratch.write(spark.range(60_000).select("id", F.lit("loom " * 40).alias("text")), "wide")
        few = scratch.write(spark.range(9).select("id", F.lit("mill").alias("word")), "few")
        for other in (wide.select("id", F.col("text").alias("word")), few):
            joined = wide.join(other, "id").agg(F.sum(F.length(F.concat("text", "word"))).alias("n"))
            plans.append((joined.collect()[0]["n"], joined))

    before = spark.conf.get(limit)
    spark.conf.set(limit, "1m")
    try:
        streams.run_per_batch(Store(spark, f"file:{tmp_path}/books"), run)(spark.range(1), 0)
        assert spark.conf.get(limit) == "1m" and spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None) is None
    finally:
        spark.conf.set(limit, before)
    assert [n for n, _ in plans] == [60_000 * 400, 9 * 204]
    shown = [joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0] for _, joined in plans]
    assert "BroadcastHashJoin" not in shown[0] and "BroadcastHashJoin" in shown[1]


def test_a_repeat_is_held_back_and_a_late_row_passes(spark, tmp_path):
    """Repeats within a batch, in a later batch and after a restart are dropped by bounded state; a late row is not."""
    schema = "folder string, name string, content_hash string, polled_at timestamp"
    path, got = str(tmp_path / "listing"), []

    def sink(batch, batch_id):
        got.extend(r.name for r in batch.collect())

    for rows in ([("a", 15), ("a", 15), ("b", 15)], [("a", 16), ("late", 1)], [("b", 17)]):
        frame = spark.createDataFrame([("bank", n, "h", START + dt.timedelta(hours=h)) for n, h in rows], schema)
        frame.coalesce(1).write.mode("append").parquet(path)
        stream = streams.first_sightings(spark.readStream.schema(schema).parquet(path), "1 day")
        streams.sweep_then_follow(stream, sink, str(tmp_path / "check")).awaitTermination()
    assert sorted(got) == ["a", "b", "late"]


def test_changes_on_a_stream_equal_the_batch(spark, tmp_path):
    rnd = random.Random(6)
    rows = [(f"f{rnd.randrange(2)}", f"n{rnd.randrange(3)}", i, rnd.randrange(2), rnd.randrange(2), rnd.choice("xy")) for i in range(120)]
    schema = "folder string, name string, seq long, size long, mtime long, sha256 string"
    want = {(r.seq, r.outcome) for r in intake.changed_content(spark.createDataFrame(rows, schema)).collect()}
    path, got = str(tmp_path / "seen"), []
    for part in range(3):  # a restart between the parts: state goes on from the checkpoint
        spark.createDataFrame(rows[40 * part:40 * part + 40], schema).coalesce(1).write.mode("append").parquet(path)
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", streams.ROCKSDB)
        out = streams.changed_content(spark.readStream.schema(schema).parquet(path))
        streams.sweep_then_follow(out, lambda batch, _: got.extend((r.seq, r.outcome) for r in batch.collect()), str(tmp_path / "check")).awaitTermination()
    assert set(got) == want and len(got) == 120


class _OneList:
    """A list state kept in memory that counts its calls."""

    def __init__(self):
        self.rows, self.calls = [], 0

    def getListState(self, name, schema):
        return self

    def exists(self):
        self.calls += 1
        return bool(self.rows)

    def get(self):
        self.calls += 1
        return iter(self.rows)

    def put(self, rows):
        self.calls, self.rows = self.calls + 1, list(rows)

    def appendList(self, rows):
        self.calls, self.rows = self.calls + 1, self.rows + rows


def test_a_bucket_of_many_names_costs_few_state_calls():
    rnd = random.Random(8)
    held, last = _OneList(), {}
    for batch in range(6):
        processor = streams._Changes()
        processor.init(held)
        rows = [("f", f"n{rnd.randrange(200)}", 1000 * batch + i, rnd.randrange(2), 0, rnd.choice("xy")) for i in range(300)]
        want = set()
        for _, name, seq, *now in rows:
            was = last.get(name)
            want.add((seq, "new" if was is None else "same" if was[:2] == now[:2] else "touched" if was[2] == now[2] else "changed"))
            last[name] = now
        held.calls = 0
        frame = pd.DataFrame(rows, columns=["folder", "name", "seq", "size", "mtime", "sha256"]).sample(frac=1, random_state=batch)
        got = pd.concat(processor.handleInputRows((0,), iter([frame]), None))
        assert set(zip(got["seq"], got["outcome"])) == want and held.calls <= 3
        assert len(held.rows) <= 2 * len(last)
