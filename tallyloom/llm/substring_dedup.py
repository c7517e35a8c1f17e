"""Substring dedup by level-wise doubling.

A run of `window` words that also starts in a document with a smaller id is removed. Levels look at
windows of growing length: 4 words, then 8, up to the full window. Only windows whose two halves were
both repeated at one level are looked at on the next, so most of the corpus is out after the first.

Documents lie in blocks of a few megabytes, in a table bucketed by the task that wrote them. At each
level a block sends the hashes of its candidate windows, each once, to hash buckets; a bucket answers
with one bit per hash: seen in another place or not. Answers are joined to the blocks without moving
any text, and a block works out its candidates anew from the answers so far. A hash that a third of
all documents share reaches its bucket once per block. On the last level hashes have 96 bits and
carry the block's smallest doc_id, and the bit says whether a smaller one exists elsewhere.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.durable import Scratch
from tallyloom.llm.base import partitions_for, table
from tallyloom.llm.registry import query

WINDOW = 13
FIRST_LEVEL = 4
#: Text of one block, and blocks of one task that share a file.
BLOCK_BYTES = 3 << 20
FILES_PER_TASK = 4
#: Bytes of text per hash bucket; a bucket's hashes meet in one task.
BUCKET_BYTES = 6 << 20
MOST_TABLE_BUCKETS = 100_000
#: Bytes hashed at once.
SLAB = 1 << 20
LAST_ID = np.iinfo(np.int64).max

_rng = np.random.default_rng(20240601)
_BYTE = _rng.integers(0, 1 << 64, 256, dtype=np.uint64)
_PLACE = _rng.integers(0, 1 << 64, 64, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def lengths(window: int = WINDOW, first: int = FIRST_LEVEL) -> list[int]:
    """Window lengths of the levels: doubled until the full window is reached."""
    out = [min(first, window)]
    while out[-1] < window:
        out.append(min(2 * out[-1], window))
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def _joined(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    return _mixed(a * np.uint64(0x9E3779B97F4A7C15) + (b ^ np.uint64(salt)) * np.uint64(0xC2B2AE3D27D4EB4F))


class Words:
    """The words of one block: place and hash of each, and the document it is in."""

    def __init__(self, data: np.ndarray, ends: np.ndarray) -> None:
        space = _SPACE[data]
        edge = np.flatnonzero(np.diff(space.astype(np.int8), prepend=1, append=1))
        # Documents end in a separator byte, so no word reaches over an end.
        self.start, stop = edge[::2], edge[1::2]
        self.size = stop - self.start
        self.doc = np.searchsorted(ends, self.start, side="right")
        self.hash = self._hashes(data)

    def _hashes(self, data: np.ndarray) -> np.ndarray:
        out = np.empty(len(self.start), np.uint64)
        at = 0
        while at < len(self.start):
            to = max(at + 1, int(np.searchsorted(self.start, self.start[at] + SLAB)))
            size = self.size[at:to]
            first = np.cumsum(size) - size
            place = np.arange(int(size.sum())) - np.repeat(first, size)
            bytes_ = data[place + np.repeat(self.start[at:to], size)]
            weight = _PLACE[place & 63]
            far = np.flatnonzero(place > 63) if int(size.max()) > 64 else []
            if len(far):  # beyond the table, weights are made from it
                weight[far] = _mixed(weight[far] + (place[far] >> 6).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
            out[at:to] = np.add.reduceat(_mixed(_BYTE[bytes_] * weight), first)
            at = to
        return _mixed(out + self.size.astype(np.uint64))


def first_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of `length` words, built by doubling."""
    out, have = words, 1
    while have < length:
        step = min(have, length - have)
        out, have = _joined(out[: len(out) - step] if len(out) > step else out[:0], out[step:], have), have + step
    return out


class Level:
    """Candidate windows of one length in a block: where they start, and their distinct hashes in order."""

    def __init__(self, at: np.ndarray, hashes: np.ndarray, more: np.ndarray | None, ids: np.ndarray | None) -> None:
        self.at = at
        order = np.argsort(hashes, kind="stable") if more is None else np.lexsort((more, hashes))
        self.order, found = order, hashes[order]
        new = np.ones(len(found), bool)
        new[1:] = found[1:] != found[:-1]
        if more is not None:
            new[1:] |= more[order][1:] != more[order][:-1]
        first = np.flatnonzero(new)
        self.group = np.cumsum(new) - 1
        self.hashes, self.more = found[first], None if more is None else more[order][first]
        self.count = np.diff(np.append(first, len(found)))
        self.least = None if ids is None or not len(first) else np.minimum.reduceat(ids[order], first)

    def buckets(self, count: int) -> np.ndarray:
        """Where each bucket's hashes begin; the bucket follows the high bits."""
        bounds = (np.arange(count + 1, dtype=object) << 64) // count
        low = np.array([min(int(b), (1 << 64) - 1) for b in bounds[:-1]], np.uint64)
        return np.append(np.searchsorted(self.hashes, low), len(self.hashes))

    def spread(self, per_group: np.ndarray) -> np.ndarray:
        """Values of distinct hashes, back at the windows in `at` order."""
        out = np.empty(len(self.order), per_group.dtype)
        out[self.order] = per_group[self.group]
        return out


def replay(words: Words, ids: np.ndarray, answers: dict[int, dict[int, bytes]], buckets: int, steps: list[int]):
    """Levels from the answers so far. Returns the open level, or at the end the removed words."""
    n = len(words.hash)
    hashes = first_hashes(words.hash, steps[0])
    alive = None
    for level, length in enumerate(steps):
        last = level == len(steps) - 1
        if level:
            step = length - steps[level - 1]
            more = _joined(hashes[: len(hashes) - step], hashes[step:], 1 << 20 | length) if len(hashes) > step else hashes[:0]
            hashes = _joined(hashes[: len(hashes) - step], hashes[step:], length) if len(hashes) > step else hashes[:0]
            ok = alive[: len(hashes)] & alive[step: step + len(hashes)]
        else:
            more, ok = _mixed(hashes + np.uint64(1)), np.ones(len(hashes), bool)
        if len(hashes):
            ok = ok & (words.doc[: len(hashes)] == words.doc[length - 1: length - 1 + len(hashes)])
        at = np.flatnonzero(ok)
        own = ids[words.doc[at]]
        found = Level(at, hashes[at], (more[at] & np.uint64(0xFFFFFFFF)) if last else None, own if last else None)
        if level not in answers:
            return found
        edges = found.buckets(buckets)
        bits = np.zeros(len(found.hashes), bool)
        for bucket, packed in answers[level].items():
            a, b = edges[bucket], edges[bucket + 1]
            bits[a:b] = np.unpackbits(np.frombuffer(packed, np.uint8), count=b - a).astype(bool)
        if not last:
            alive = np.zeros(n, bool)
            alive[at] = found.spread(bits | (found.count > 1))
        else:
            gone = np.zeros(n + 1, np.int64)
            if len(at):
                removed = at[found.spread(bits) | (own > found.spread(found.least))]
                np.add.at(gone, removed, 1)
                np.add.at(gone, removed + length, -1)
            return np.cumsum(gone)[:n] > 0
    raise AssertionError("the last level returns")


def _blocks(block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        ids, parts, size = [], [], 0

        def row() -> pa.RecordBatch:
            ends = np.cumsum([len(p) + 1 for p in parts])
            cells = [[task * FILES_PER_TASK + made % FILES_PER_TASK], [made], [size]]
            return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cells], pa.array([ids], pa.list_(pa.int64())), pa.array([ends], pa.list_(pa.int64())),
                                               pa.array([b"\n".join([*parts, b""])], pa.binary())], ["home", "block", "size", "ids", "ends", "data"])

        for batch in batches:
            texts = pc.fill_null(batch.column("text").cast(pa.binary()), b"")
            for i, text in zip(batch.column("doc_id").to_pylist(), texts):
                text = text.as_buffer().to_pybytes()
                ids.append(i)
                parts.append(text)
                size += len(text) + 1
                if size >= block_bytes:
                    yield row()
                    ids, parts, size, made = [], [], 0, made + 1
        if ids:
            yield row()

    return run


def _opened(batch: pa.RecordBatch):
    """Each block of a batch: ids with null as the last one, its words, its bytes, answers by level and bucket."""
    for r in range(batch.num_rows):
        ids = pc.fill_null(batch.column("ids")[r].values, LAST_ID).to_numpy(zero_copy_only=False)
        ends = batch.column("ends")[r].values.to_numpy(zero_copy_only=False)
        data = np.frombuffer(batch.column("data")[r].as_buffer(), np.uint8)
        answers: dict[int, dict[int, bytes]] = {}
        for a in (batch.column("answers")[r].as_py() or []) if "answers" in batch.schema.names else []:
            answers.setdefault(a["level"], {})[a["bucket"]] = a["bits"]
        yield r, ids, Words(data, ends), data, answers


def _sender(level: int, buckets: int, steps: list[int]):
    last = level == len(steps) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r, ids, words, _, answers in _opened(batch):
                for done in range(level):
                    answers.setdefault(done, {})
                found = replay(words, ids, {k: v for k, v in answers.items() if k < level}, buckets, steps)
                edges = found.buckets(buckets)
                full = np.flatnonzero(np.diff(edges))
                keys, least = [], []
                for b in full:
                    a, z = edges[b], edges[b + 1]
                    if last:
                        keys.append(found.hashes[a:z].tobytes() + found.more[a:z].astype("<u4").tobytes())
                        own = found.least[a:z]
                        base = int(own.min())
                        width = np.min_scalar_type(int(own.max()) - base)
                        least.append(base.to_bytes(8, "little", signed=True) + (own.astype(object) - base).astype(width).tobytes() if base < 0 else base.to_bytes(8, "little") + (own - base).astype(width).tobytes())
                    else:
                        keys.append((found.hashes[a:z] & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes())
                        least.append(None)
                k = len(full)
                yield pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.repeat(batch.column("home")[r], k), pa.repeat(batch.column("block")[r], k), pa.array(keys, pa.binary()), pa.array(least, pa.binary())],
                                                 ["bucket", "home", "block", "keys", "least"])

    return run


def _matcher(level: int, last: bool):
    def run(rows: pa.Table) -> pa.Table:
        keys = rows.column("keys").to_pylist()
        if last:
            sizes = np.array([len(k) // 12 for k in keys])
            a = np.concatenate([np.frombuffer(k, "<u8", n) for k, n in zip(keys, sizes)])
            b = np.concatenate([np.frombuffer(k, "<u4", n, 8 * n) for k, n in zip(keys, sizes)])
            own = []
            for x, n in zip(rows.column("least").to_pylist(), sizes):
                own.append(int.from_bytes(x[:8], "little", signed=True) + np.frombuffer(x, f"<u{(len(x) - 8) // n}", n, 8).astype(np.int64))
            own = np.concatenate(own)
            order = np.lexsort((b, a))
            new = np.ones(len(order), bool)
            new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
            least = np.minimum.reduceat(own[order], np.flatnonzero(new))[np.cumsum(new) - 1]
            bits = np.empty(len(order), bool)
            bits[order] = least < own[order]
        else:
            sizes = np.array([len(k) // 4 for k in keys])
            a = np.concatenate([np.frombuffer(k, "<u4") for k in keys])
            order = np.argsort(a, kind="stable")
            same = a[order][1:] == a[order][:-1]
            bits = np.empty(len(order), bool)
            bits[order] = np.append(same, False) | np.append(False, same)
        ends = np.cumsum(sizes)
        packed = [np.packbits(bits[e - n:e]).tobytes() if bits[e - n:e].any() else None for e, n in zip(ends, sizes)]
        out = pa.table([rows.column("home"), rows.column("block"), pa.array([level] * len(keys), pa.int32()), rows.column("bucket").cast(pa.int32()), pa.array(packed, pa.binary())],
                       names=["home", "block", "level", "bucket", "bits"])
        return out.filter(pc.is_valid(out.column("bits")))

    return run


def _finisher(buckets: int, steps: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r, ids, words, data, answers in _opened(batch):
                for done in range(len(steps)):
                    answers.setdefault(done, {})
                gone = replay(words, ids, answers, buckets, steps)
                docs = len(ids)
                n_words = np.bincount(words.doc, minlength=docs)
                n_gone = np.bincount(words.doc[gone], minlength=docs)
                yield pa.RecordBatch.from_arrays([batch.column("ids")[r].values, pa.array(n_words, pa.int64()), pa.array(n_gone, pa.int64()), _spans(words, gone, docs), _kept(words, gone, data, docs)],
                                                 ["doc_id", "n_words", "n_removed", "removed", "kept"])

    return run


SPAN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))


def _spans(words: Words, gone: np.ndarray, docs: int) -> pa.Array:
    """Removed stretches of each document, as first word and number of words."""
    first = np.searchsorted(words.doc, np.arange(docs))
    new_doc = np.ones(len(gone), bool)
    new_doc[1:] = words.doc[1:] != words.doc[:-1]
    begins = np.flatnonzero(gone & (new_doc | ~np.append(False, gone[:-1])[: len(gone)]))
    stops = np.flatnonzero(gone & (np.append(new_doc[1:], True)[: len(gone)] | ~np.append(gone[1:], False)[: len(gone)])) + 1
    of = words.doc[begins]
    values = pa.StructArray.from_arrays([pa.array(begins - first[of], pa.int64()), pa.array(stops - begins, pa.int64())], ["start", "length"])
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.bincount(of, minlength=docs))), pa.int32()), values)


def _kept(words: Words, gone: np.ndarray, data: np.ndarray, docs: int) -> pa.Array:
    """The words that stay, joined by one space, for each document."""
    stay = np.flatnonzero(~gone)
    start, size, doc = words.start[stay], words.size[stay], words.doc[stay]
    tail = np.zeros(len(stay), np.int64)
    tail[:-1] = doc[1:] == doc[:-1]
    to = np.cumsum(size + tail) - size - tail
    out = np.full(int((size + tail).sum()), 32, np.uint8)
    at = 0
    while at < len(stay):
        z = max(at + 1, int(np.searchsorted(start, start[at] + SLAB)))
        own = size[at:z]
        place = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
        out[place + np.repeat(to[at:z], own)] = data[place + np.repeat(start[at:z], own)]
        at = z
    ends = np.append(0, np.cumsum(np.bincount(doc, weights=size + tail, minlength=docs).astype(np.int64)))
    return pa.LargeStringArray.from_buffers(docs, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(out)).cast(pa.string())


def remove_repeats(docs: DataFrame, window: int = WINDOW, first_level: int = FIRST_LEVEL, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_removed, removed (spans of words), kept (text).

    Removed is every word covered by `window` words in a row that also start in a row with a smaller
    doc_id, judged on the input. Null and empty texts have no words. A null doc_id comes after all
    others; rows of one id do not remove from one another. Other columns are ignored; an empty table
    gives an empty result. kept has the words that stay, joined by one space.
    """
    spark, steps = docs.sparkSession, lengths(window, first_level)
    scratch = Scratch(spark, "substring-dedup")
    name = f"substring_dedup_{uuid.uuid4().hex}"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks = rows.mapInArrow(_blocks(block_bytes), "home long, block long, size long, ids array<long>, ends array<long>, data binary")
    files = min(MOST_TABLE_BUCKETS, partitions_for(spark, rows.count(), 5000))
    blocks.write.format("parquet").option("compression", "zstd").option("path", f"{scratch.root}/blocks").bucketBy(files, "home").saveAsTable(name)
    blocks = spark.table(name)
    total = blocks.agg(F.sum("size")).first()[0] or 0
    buckets = partitions_for(spark, total, bucket_bytes) * 2
    answers = None
    for level in range(len(steps)):
        sent = _answered(blocks, answers).mapInArrow(_sender(level, buckets, steps), "bucket long, home long, block long, keys binary, least binary")
        matched = sent.groupBy("bucket").applyInArrow(_matcher(level, level == len(steps) - 1), "home long, block long, level int, bucket int, bits binary")
        matched = scratch.write(matched, f"answers-{steps[level]}")
        answers = matched if answers is None else answers.union(matched)
    out = _answered(blocks, answers).mapInArrow(_finisher(buckets, steps), "doc_id long, n_words long, n_removed long, removed array<struct<start:long,length:long>>, kept string")
    spark.sql(f"DROP TABLE {name}")  # the name alone; the files stay under the scratch folder
    return out


def _answered(blocks: DataFrame, answers: DataFrame | None) -> DataFrame:
    """Blocks with their answers; only the answers move, to where the blocks of their task lie."""
    if answers is None:
        return blocks.select("home", "block", "ids", "ends", "data")
    by_home = answers.groupBy("home").agg(F.collect_list(F.struct("block", "level", "bucket", "bits")).alias("found"))
    found = F.filter("found", lambda a: a["block"] == F.col("block"))
    return blocks.join(by_home.hint("shuffle_hash"), "home", "left").select("home", "block", "ids", "ends", "data", found.alias("answers"))


SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
g AS (
  SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS gram
  FROM w, LATERAL (SELECT unnest(range(1, len(words) - 11)) AS i)),
m AS (SELECT gram, min(doc_id) AS least FROM g GROUP BY gram HAVING count(*) > 1),
r AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM g JOIN m USING (gram) WHERE least < doc_id),
c AS (SELECT doc_id, list(i) AS gone FROM r GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(len(gone), 0) AS n_removed,
       sha256(array_to_string(list_transform(list_filter(range(1, len(words) + 1), lambda i: gone IS NULL OR NOT list_contains(gone, i)), lambda i: words[i]), ' ')) AS kept_sha256
FROM w LEFT JOIN c USING (doc_id)
"""


@query("op2_substring_dedup", SQL)
def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = remove_repeats(table(spark, folder, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
