"""Batch operators of the file intake.

Tables
    listing   folder, name, path_lower, size, content_hash [, poll_id, polled_at]
    imported  folder, name, content_hash, size, imported_at, local_name
    on_disk   folder, name, size, content_hash
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import text
from tallyloom.operators import ordered
from tallyloom.settings import DEFAULTS, Settings

KEY = ["folder", "name", "content_hash"]


def eligible(name: Column, size: Column | None = None, desktop: bool = False) -> Column:
    """File names worth reading: not hidden, not half written, not empty."""
    low = F.lower(name)
    ok = (name != "") & ~F.startswith(low, F.lit("."))
    if desktop:
        ok = ok & ~F.startswith(low, F.lit("~$")) & ~F.rlike(low, F.lit(r"\.(tmp|part|crdownload)$"))
    else:
        ok = ok & ~F.endswith(name, F.lit(".partial"))
    return ok if size is None else ok & (size > 0)


def direct_child(path: Column, folders: tuple[str, ...] = DEFAULTS.folders) -> Column:
    """Folder the path lies directly in, or null."""
    parts = F.split(path, "/")
    folder = F.get(parts, F.lit(1))
    return F.when((F.size(parts) == 3) & (F.get(parts, F.lit(0)) == "") & folder.isin(*folders), folder)


def top_level(listing: DataFrame, folders: tuple[str, ...] = DEFAULTS.folders) -> DataFrame:
    return listing.withColumn("folder", direct_child(F.col("path_lower"), folders)).where(
        F.col("folder").isNotNull() & (F.substring_index("path_lower", "/", -1) != "")
    )


def touched_folders(changes: DataFrame, folders: tuple[str, ...] = DEFAULTS.folders) -> DataFrame:
    """Watched folders a change feed touches; nested paths do not count."""
    return changes.select(direct_child(F.col("path_lower"), folders).alias("folder")).where("folder is not null").distinct()


def plan(listing: DataFrame, imported: DataFrame) -> DataFrame:
    """Listed files not imported yet, by folder, name and hash."""
    return listing.join(imported.select(*KEY).distinct(), KEY, "left_anti")


def known_hashes(imported: DataFrame) -> DataFrame:
    """(folder, name, lo, hi, n) of the distinct hashes of a name: enough to tell whether some differ."""
    return imported.groupBy("folder", "name").agg(
        F.min("content_hash").alias("lo"), F.max("content_hash").alias("hi")
    )


def name_hashes(imported: DataFrame) -> DataFrame:
    """One row per distinct hash of a name."""
    return imported.select(*KEY).distinct()


def local_names(planned: DataFrame, imported: DataFrame, on_disk: DataFrame) -> DataFrame:
    """`local_name` that never overwrites: the name, else `stem__<8 hex>.ext`, else the full hash."""
    known = known_hashes(imported)
    disk = on_disk.select("folder", "name", F.col("content_hash").alias("disk_hash"))
    h = F.col("content_hash")
    joined = planned.join(known, ["folder", "name"], "left").join(disk, ["folder", "name"], "left")
    clash = (
        F.coalesce(F.col("lo") != h, F.lit(False))
        | F.coalesce(F.col("hi") != h, F.lit(False))
        | F.coalesce(F.col("disk_hash") != h, F.lit(False))
    )
    stem, suffix = text.file_stem(F.col("name")), text.file_suffix(F.col("name"))
    short = F.concat(stem, F.lit("__"), F.substring(h, 1, 8), suffix)
    named = joined.withColumn("candidate", F.when(clash, short).otherwise(F.col("name"))).withColumn("clash", clash)
    taken = on_disk.select("folder", F.col("name").alias("candidate"), F.col("content_hash").alias("taken_hash"))
    full = F.concat(stem, F.lit("__"), h, suffix)
    return (
        named.join(taken, ["folder", "candidate"], "left")
        .withColumn(
            "local_name",
            F.when(F.col("clash") & (F.col("taken_hash") != h), full).otherwise(F.col("candidate")),
        )
        .select(*planned.columns, "local_name")
    )


def adopt(planned: DataFrame, on_disk: DataFrame) -> DataFrame:
    """Planned files already on disk with equal size and hash."""
    have = on_disk.select("folder", F.col("name").alias("local_name"), "size", "content_hash").distinct()
    return planned.join(have, ["folder", "local_name", "size", "content_hash"], "left_semi")


def verify(planned: DataFrame, staged: DataFrame) -> DataFrame:
    """Planned files with `ok`, `problem` and `batch_ok`: one bad file holds back its whole folder."""
    got = staged.select(
        "folder", "local_name", F.col("size").alias("got_size"), F.col("content_hash").alias("got_hash")
    )
    checked = planned.join(got, ["folder", "local_name"], "left")
    problem = (
        F.when(F.col("got_hash").isNull(), "file missing")
        .when(F.col("got_size") != F.col("size"), F.concat(F.lit("size mismatch: expected "), F.col("size").cast("string"), F.lit(", got "), F.col("got_size").cast("string")))
        .when(F.col("got_hash") != F.col("content_hash"), F.concat(F.lit("content hash mismatch: expected "), F.col("content_hash"), F.lit(", got "), F.col("got_hash")))
    )
    checked = checked.withColumn("problem", problem).withColumn("ok", problem.isNull()).drop("got_size", "got_hash")
    gate = checked.groupBy("folder").agg(F.bool_and("ok").alias("batch_ok"))
    return checked.join(gate, "folder")


def batch_log(done: DataFrame) -> DataFrame:
    """Files and bytes per folder."""
    return done.groupBy("folder").agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size"), F.lit(0)).cast("bigint").alias("bytes")
    )


def fingerprints(polls: DataFrame) -> DataFrame:
    """One row per poll with an order-free fingerprint of its listing; no listing is collected."""
    item = F.xxhash64("name", "size", "content_hash")
    again = F.xxhash64(F.lit("~"), "name", "size", "content_hash")
    return polls.groupBy("folder", "poll_id").agg(
        F.min("polled_at").alias("polled_at"),
        F.struct(F.count(F.lit(1)).alias("n"), F.bit_xor(item).alias("h1"), F.bit_xor(again).alias("h2")).alias("print"),
    )


def settled(prints: DataFrame, cfg: Settings = DEFAULTS, segment: Column | None = None) -> DataFrame:
    """(folder, poll_id, polled_at, run_length, is_settled): length of the run of equal fingerprints
    ending at each poll. A folder is settled once a run reaches `stable_polls`."""
    cut = F.date_trunc("day", F.col("polled_at")) if segment is None else segment
    order = [F.col("polled_at"), F.col("poll_id")]
    linked = ordered.previous(prints, ["folder"], cut, order, F.col("print"), "before")
    opened = linked.withColumn("opens", F.when(F.col("before").eqNullSafe(F.col("print")), 0).otherwise(1)).drop("before")
    runs = ordered.running_total(opened, ["folder"], cut, order, F.col("opens"), "run")
    # A run is cut by day as well, so its length is counted over segments like any other key.
    counted = ordered.row_number(runs, ["folder", "run"], cut, order, "run_length")
    return counted.select(
        "folder", "poll_id", "polled_at", "run_length", (F.col("run_length") >= cfg.stable_polls).alias("is_settled")
    )


def settle_outcome(prints: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """(folder, settled_at, gave_up): first settled poll of each folder within the allowed wait."""
    marked = settled(prints, cfg)
    spans = marked.groupBy("folder").agg(
        F.min("polled_at").alias("started"),
        F.min(F.when(F.col("is_settled"), F.col("polled_at"))).alias("first_settled"),
    )
    waited = F.unix_timestamp("first_settled") - F.unix_timestamp("started")
    in_time = F.coalesce(waited <= cfg.settle_max_wait_minutes * 60, F.lit(False))
    return spans.select(
        "folder", F.when(in_time, F.col("first_settled")).alias("settled_at"), (~in_time).alias("gave_up")
    )


def quiet_batches(events: DataFrame, quiet_seconds: int, segment: Column | None = None) -> DataFrame:
    """(folder, first_event, last_event, events, fires_at): one batch per folder after a pause.

    Batch form of the session window, cut by day so that a busy folder spreads over tasks.
    """
    cut = F.to_date("ts") if segment is None else segment
    order = [F.col("ts"), F.col("event_id")]
    linked = ordered.previous(events, ["folder"], cut, order, F.col("ts"), "before")
    apart = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("before").cast("timestamp"))
    opened = linked.withColumn(
        "opens", F.when(F.col("before").isNull() | (apart >= quiet_seconds * 1_000_000), 1).otherwise(0)
    )
    numbered = ordered.running_total(opened, ["folder"], cut, order, F.col("opens"), "batch_no")
    return (
        numbered.groupBy("folder", "batch_no")
        .agg(F.min("ts").alias("first_event"), F.max("ts").alias("last_event"), F.count(F.lit(1)).alias("events"))
        .withColumn("fires_at", F.col("last_event") + F.make_dt_interval(secs=F.lit(quiet_seconds)))
    )


def changed_content(seen: DataFrame) -> DataFrame:
    """Outcome per sighting (folder, name, seq, size, mtime, sha256): new, changed, touched or same.

    `touched` has another size or time stamp than the sighting before, but the same content.
    """
    now = F.struct("size", "mtime", "sha256")
    linked = ordered.previous(
        seen, ["folder", "name"], ordered.block_of(F.col("seq"), 1 << 20), [F.col("seq")], now, "before"
    )
    b = F.col("before")
    outcome = (
        F.when(b.isNull(), "new")
        .when((b["size"] == F.col("size")) & (b["mtime"] == F.col("mtime")), "same")
        .when(b["sha256"] == F.col("sha256"), "touched")
        .otherwise("changed")
    )
    return linked.withColumn("outcome", outcome).drop("before")
