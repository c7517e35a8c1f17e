"""Stream forms of the intake: quiet-period batches, settled listings, exactly-once import, runs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from tallyloom.durable import dropped_after, measured_joins
from tallyloom.operators import intake, ordered, state
from tallyloom.settings import DEFAULTS, Settings

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def quiet_batches(events: DataFrame, quiet_seconds: int, lateness: str) -> DataFrame:
    """One row per folder and busy spell, emitted once no event came for `quiet_seconds`.

    `lateness` is how far events may lag behind the newest one of any folder; later ones are not seen,
    so it must cover the slowest source. A larger value costs delay, not rows.
    """
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    spell = F.session_window("ts", f"{quiet_seconds} seconds")
    return (
        timed.groupBy("folder", spell.alias("spell"))
        .agg(F.count(F.lit(1)).alias("events"), F.min("ts").alias("first_event"), F.max("ts").alias("last_event"))
        .select("folder", "first_event", "last_event", "events", F.col("spell.end").alias("fires_at"))
    )


def touched_folders(changes: DataFrame, every: str, folders: tuple[str, ...] = DEFAULTS.folders) -> DataFrame:
    """Watched folders touched per time window of a change feed."""
    timed = changes.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", every)
    return (
        timed.withColumn("folder", intake.direct_child(F.col("path_lower"), folders))
        .where("folder is not null")
        .groupBy(F.window("ts", every).alias("span"), "folder")
        .agg(F.count(F.lit(1)).alias("changes"))
        .select(F.col("span.start").alias("since"), "folder", "changes")
    )


def first_sightings(listing: DataFrame, hold: str) -> DataFrame:
    """A listing stream without rows whose key was seen within `hold`.

    The watermark follows the arrival of rows, not the time they tell, so state is bounded by `hold` and no row
    is ever too late. A key that comes again after `hold` passes; the import table then knows it.
    """
    arrived = listing.withColumn("arrived_at", F.current_timestamp()).withWatermark("arrived_at", hold)
    return arrived.dropDuplicatesWithinWatermark(intake.KEY).drop("arrived_at")


def record_imports(store: state.Store, schema: str, table: str = "imported") -> Callable[[DataFrame, int], None]:
    """foreachBatch sink that adds rows the import table does not hold, however late they come.

    The table alone decides what was seen before. Repeating a batch changes nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # A repeated batch is compared with the others only, then replaces its own rows.
        own = f"{batch_id:010d}"
        known = store.read_log(table, schema, besides=own)
        rows = ordered.first_per_key(batch, intake.KEY, [F.col("polled_at")])
        number = store.append(table, rows.join(known.select(*intake.KEY), intake.KEY, "left_anti"), own)
        if number % store.EVERY == 0:
            store.compact(table, schema)

    return write


class _Debounce(StatefulProcessor):
    """Per folder: remember the last event, fire once the pause is over, or a quarter of it later
    while the consumer is busy."""

    def __init__(self, quiet_ms: int, busy: list[tuple[int, int]]) -> None:
        self.quiet_ms, self.busy = quiet_ms, busy

    # Argument names are those Spark passes by.
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getValueState("waiting", "due bigint, events bigint, last bigint")

    def _arm(self, due: int, events: int, last: int) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.waiting.update((due, events, last))
        self.handle.registerTimer(due)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        slots: dict[int, list[int]] = {}
        for pdf in rows:
            for slot, lo, hi, n in zip(pdf["slot"], pdf["lo"], pdf["hi"], pdf["n"]):
                kept = slots.setdefault(int(slot), [int(lo), int(hi), 0])
                kept[0], kept[1], kept[2] = min(kept[0], int(lo)), max(kept[1], int(hi)), kept[2] + int(n)
        due, events, last = self.waiting.get() if self.waiting.exists() else (None, 0, None)
        fired = []
        for _, (lo, hi, n) in sorted(slots.items()):
            # An event after the pause opens a new batch even when both arrive together.
            if due is not None and lo >= due:
                moved = self._free_at(due)
                if moved <= lo:
                    fired.append((key[0], events, last, moved))
                    events = 0
            events, last, due = events + n, hi, hi + self.quiet_ms
        if due is not None:
            self._arm(due, events, last)
        yield pd.DataFrame(fired, columns=["folder", "events", "last_ms", "fired_ms"])

    def _free_at(self, due: int) -> int:
        moved = True
        while moved:
            moved = False
            for start, end in self.busy:
                if start <= due < end:
                    due, moved = due + max(1, self.quiet_ms // 4), True
        return due

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        out = []
        if self.waiting.exists():
            due, events, last = self.waiting.get()
            free = self._free_at(due)
            if free > due:
                self._arm(free, events, last)
            else:
                self.waiting.clear()
                out.append((key[0], events, last, due))
        yield pd.DataFrame(out, columns=["folder", "events", "last_ms", "fired_ms"])

    def close(self) -> None:
        pass


def _slots(quiet_ms: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """First, last and number of events per folder and slot of one pause length, for the rows of a task.

    Events inside one slot never part, so that is all the state needs; a busy folder's events are summed
    up before they meet.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = pdf.groupby(["folder", pdf["ms"] // quiet_ms], dropna=False)["ms"].agg(["min", "max", "count"]).reset_index()
            found.columns = ["folder", "slot", "lo", "hi", "n"]
            yield found

    return run


def debounce(events: DataFrame, quiet_seconds: int, lateness: str, busy: list[tuple[int, int]] = ()) -> DataFrame:
    """(folder, events, last_ms, fired_ms): quiet-period batches that wait while the consumer is busy.

    `busy` lists (from, until) in epoch milliseconds; `lateness` as in quiet_batches. Needs the RocksDB
    state store.
    """
    timed = events.select("folder", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms")).where("ms is not null")
    slots = timed.mapInPandas(_slots(quiet_seconds * 1000), "folder string, slot bigint, lo bigint, hi bigint, n bigint")
    slots = slots.withColumn("ts", F.timestamp_millis("hi")).withWatermark("ts", lateness)
    return slots.groupBy("folder").transformWithStateInPandas(
        _Debounce(quiet_seconds * 1000, list(busy)),
        "folder string, events bigint, last_ms bigint, fired_ms bigint",
        "append",
        "eventTime",
    )


class _Settle(StatefulProcessor):
    """Per folder: last fingerprint, how many polls in a row carried it, and since when the wait lasts."""

    def __init__(self, stable: int, wait_ms: int) -> None:
        self.stable, self.wait_ms = stable, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "n bigint, h1 bigint, h2 bigint, run bigint, started bigint")

    def _arm(self, started: int | None) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if started is not None:
            self.handle.registerTimer(started + self.wait_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        polls = sorted(
            (int(ms), int(poll), int(n), int(h1), int(h2))
            for pdf in rows
            for ms, poll, n, h1, h2 in zip(pdf["ms"], pdf["poll_id"], pdf["n"], pdf["h1"], pdf["h2"])
        )
        held = self.seen.get() if self.seen.exists() else None
        out = []
        for ms, poll, *mark in polls:
            same = held is not None and list(held[:3]) == mark
            run = held[3] + 1 if same else 1
            # A wait starts with the first poll after a settled one, and ends with it or by giving up.
            started = held[4] if held is not None and held[4] >= 0 else ms
            settled, over = run >= self.stable, ms - started > self.wait_ms
            held = (*mark, run, -1 if settled or over else started)
            out.append((key[0], poll, run, settled, over))
        if held is not None:
            self.seen.update(held)
            self._arm(held[4] if held[4] >= 0 else None)
        yield pd.DataFrame(out, columns=SETTLED)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """The longest wait is over and no poll came to tell: the folder is given up, the next poll waits anew."""
        out = []
        held = self.seen.get() if self.seen.exists() else None
        if held is not None and held[4] >= 0:
            self.seen.update((*held[:4], -1))
            out.append((key[0], None, held[3], False, True))
        yield pd.DataFrame(out, columns=SETTLED).astype({"poll_id": "Int64"})

    def close(self) -> None:
        pass


SETTLED = ["folder", "poll_id", "run_length", "is_settled", "over_time"]


def settled(prints: DataFrame, lateness: str, cfg: Settings = DEFAULTS) -> DataFrame:
    """(folder, poll_id, run_length, is_settled, over_time) for a stream of poll fingerprints.

    One row per poll, and one without poll_id for a wait that ran out between polls. `lateness` is how far
    polls may lag behind the newest one. Needs the RocksDB state store.
    """
    polled = F.col("polled_at").cast("timestamp")
    flat = prints.select(
        "folder", F.col("poll_id").cast("bigint").alias("poll_id"), polled.alias("ts"), F.unix_millis(polled).alias("ms"),
        F.col("print.n").alias("n"), F.col("print.h1").alias("h1"), F.col("print.h2").alias("h2"),
    )
    return flat.withWatermark("ts", lateness).groupBy("folder").transformWithStateInPandas(
        _Settle(cfg.stable_polls, cfg.settle_max_wait_minutes * 60_000),
        "folder string, poll_id bigint, run_length bigint, is_settled boolean, over_time boolean",
        "append",
        "eventTime",
    )


class _Changes(StatefulProcessor):
    """Per bucket of names: size, time stamp and hash of each name at its last sighting.

    Sightings are appended to one list and the last of a name counts, so a bucket costs one call to read and one to
    write, whatever its names. A list of over twice as many entries as names is written anew.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getListState("last", "folder string, name string, size bigint, mtime bigint, sha256 string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        sightings: dict[tuple, list[tuple]] = {}
        for pdf in rows:
            for folder, name, *seen in zip(*[pdf[c].tolist() for c in ("folder", "name", "seq", "size", "mtime", "sha256")]):
                sightings.setdefault((folder, name), []).append(tuple(seen))
        out, fresh, entries = [], [], 0
        last: dict[tuple, tuple] = {}
        for folder, name, *held in self.last.get() if self.last.exists() else ():
            last[folder, name] = tuple(held)
            entries += 1
        for file, seen in sightings.items():
            held = known = last.get(file)
            for seq, *now in sorted(seen):
                if held is None:
                    outcome = "new"
                elif held[:2] == tuple(now[:2]):
                    outcome = "same"
                else:
                    outcome = "touched" if held[2] == now[2] else "changed"
                held = tuple(now)
                out.append((*file, seq, outcome))
            if held != known:
                last[file] = held
                fresh.append((*file, *held))
        if entries + len(fresh) > 2 * len(last):
            self.last.put([(*file, *held) for file, held in last.items()])
        elif fresh:
            self.last.appendList(fresh)
        yield pd.DataFrame(out, columns=["folder", "name", "seq", "outcome"])

    def close(self) -> None:
        pass


def changed_content(seen: DataFrame, buckets: int = 1_024) -> DataFrame:
    """(folder, name, seq, outcome) for a stream of sightings (folder, name, seq, size, mtime, sha256).

    Outcomes are those of operators.intake.changed_content(). State is at most two entries per name, whatever the number of
    sightings; sightings of a name must not arrive in an earlier batch than older ones. Names share a Python call by
    bucket, as a call for each name costs more than its rows. A batch orders the sightings of one bucket in memory, so a
    backlog is read in batches of bounded size. A checkpoint belongs to its number of buckets, and a batch
    reads the state of every bucket it has sightings for. Needs the RocksDB state store.
    """
    rows = seen.select("folder", "name", F.col("seq").cast("bigint").alias("seq"), F.col("size").cast("bigint").alias("size"), F.col("mtime").cast("bigint").alias("mtime"), "sha256")
    bucket = F.pmod(F.xxhash64("folder", "name"), F.lit(buckets)).cast("int")
    return rows.withColumn("bucket", bucket).groupBy("bucket").transformWithStateInPandas(
        _Changes(), "folder string, name string, seq bigint, outcome string", "append", "none"
    )


def sweep_then_follow(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, follow: bool = False
) -> StreamingQuery:
    """Run `handle` on everything present, once; with follow=True keep going on what arrives later.

    Both modes share the checkpoint, so a sweep after a stop picks up where the last one ended.
    """
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer if follow else writer.trigger(availableNow=True)).start()


def run_per_batch(store: state.Store | None, run: Callable[[DataFrame, str, int], None]) -> Callable[[DataFrame, int], None]:
    """foreachBatch handler that gives each batch of new files a run id of its own.

    `run` stores what it finds; the tables it wrote on the way are dropped when it is done. Its joins go by measured sizes,
    in the session of the batch and in that of the store.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            with measured_joins(batch.sparkSession, *([store.spark] if store else [])), dropped_after():
                run(batch, f"batch-{batch_id:010d}", batch_id)

    return handle
