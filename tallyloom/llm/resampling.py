"""Importance resampling towards a target corpus, over hashed n-gram features.

Every feature (a run of consecutive words) falls into a bucket by its crc32. A bucket's gain compares
how often the target and the corpus use it; a document's weight is the mean gain of its features.
Gumbel noise, keyed by the document's id, turns the highest scores into a draw without replacement.

Features of a batch are interned in an open-addressed table held in numpy arrays: a feature's
xxhash64 gives its first slot, equal hashes are verified byte by byte, and all occurrences probe at
once. A slot keeps the feature's bucket and how often it occurred, so the crc32 and the bucket are made
once per distinct feature, and occurrences gather their gain by slot number.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.durable import Scratch
from tallyloom.llm.base import table
from tallyloom.llm.registry import query

LONGEST = 1
BUCKETS = 10_000
LEAST_WORDS = 20
DRAW_PERCENT = 10
SEED = 2024
#: Bytes of text worked on at once; longer texts are cut between words.
SLAB = 1 << 20
#: Unit of weights and scores: a thousandth.
UNIT = 1000

_BYTE = np.arange(256, dtype=np.uint8)
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
_LOWERED = np.where(_UPPER, _BYTE + 32, _BYTE).astype(np.uint8)
#: Bytes of words: digits, letters and everything beyond ASCII.
_IN_WORD = (_BYTE >= 0x80) | ((_BYTE >= 0x30) & (_BYTE <= 0x39)) | ((_LOWERED >= 0x61) & (_LOWERED <= 0x7A))


class Table:
    """Open-addressed table of the features of one slab.

    Slots hold the number of a feature's first occurrence, its bucket and its count. Occurrences that
    meet a slot of another feature go on to the next one, all in step.
    """

    def __init__(self, data: bytes, starts: np.ndarray, ends: np.ndarray, buckets: int, hashing=None) -> None:
        hashes = _hashes(data, starts, ends) if hashing is None else hashing(data, starts, ends)
        size = 1 << max(4, int(2 * len(starts)).bit_length())
        self.owner = np.full(size, -1, np.int64)
        self.slot = np.empty(len(starts), np.int64)
        left, at = np.arange(len(starts)), (hashes & np.uint64(size - 1)).astype(np.int64)
        while len(left):
            free = self.owner[at] < 0
            self.owner[at[free]] = left[free]  # of several that want a free slot, one gets it
            holder = self.owner[at]
            same = hashes[holder] == hashes[left]
            same[same] = _equal(data, starts, ends, holder[same], left[same])
            self.slot[left[same]] = at[same]
            left, at = left[~same], (at[~same] + 1) & (size - 1)
        self.count = np.bincount(self.slot, minlength=size)
        used = np.flatnonzero(self.owner >= 0)
        first = self.owner[used]
        self.bucket = np.zeros(size, np.int64)
        self.bucket[used] = [zlib.crc32(data[s:e]) % buckets for s, e in zip(starts[first].tolist(), ends[first].tolist())]

    def per_bucket(self, buckets: int) -> np.ndarray:
        out = np.zeros(buckets, np.int64)
        np.add.at(out, self.bucket, self.count)
        return out


def _hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    own = xxhash.xxh64_intdigest
    return np.fromiter((own(data[s:e]) for s, e in zip(starts.tolist(), ends.tolist())), np.uint64, len(starts))


def _equal(data: bytes, starts: np.ndarray, ends: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether features x[i] and y[i] have the same bytes."""
    size = ends[x] - starts[x]
    out = size == ends[y] - starts[y]
    # Sixteen bytes at a time, for the pairs that are still equal and longer.
    flat = np.frombuffer(data, np.uint8)
    look = np.flatnonzero(out & (x != y))
    done = 0
    while len(look):
        step = np.arange(done, done + 16)
        inside = step < size[look, None]
        a = flat[np.minimum(starts[x[look], None] + step, len(flat) - 1)]
        b = flat[np.minimum(starts[y[look], None] + step, len(flat) - 1)]
        good = ((a == b) | ~inside).all(axis=1)
        out[look[~good]] = False
        done += 16
        look = look[good & (size[look] > done)]
    return out


class Slab:
    """Words of some texts: lower-cased bytes with one space behind each word, and whose text it is in."""

    def __init__(self, texts: list[bytes], carried: list[int], longest: int) -> None:
        raw = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
        sizes = np.array([len(t) + 1 for t in texts])
        word = _IN_WORD[raw]
        kept = word.copy()
        kept[1:] |= word[:-1]
        self.data = np.where(word, _LOWERED[raw], 32)[kept].astype(np.uint8).tobytes()
        edge = np.flatnonzero(kept & ~word)
        self.doc_of_word = np.searchsorted(np.cumsum(sizes), edge, side="right")
        ends = np.cumsum(kept)[edge] - 1
        starts = np.append(0, ends[:-1] + 1) if len(ends) else ends
        self.words = np.bincount(self.doc_of_word, minlength=len(texts))
        first = np.cumsum(self.words) - self.words
        # Words that an earlier part of the same text has counted already.
        old = np.arange(len(ends)) - first[self.doc_of_word] < np.array(carried, np.int64)[self.doc_of_word]
        spans = []
        for n in range(1, longest + 1):
            head, tail = np.arange(len(ends) - n + 1), np.arange(n - 1, len(ends))
            good = (self.doc_of_word[head] == self.doc_of_word[tail]) & ~old[tail]
            spans.append((starts[head[good]], ends[tail[good]], self.doc_of_word[tail[good]]))
        self.starts, self.ends, self.doc = (np.concatenate(x) for x in zip(*spans))
        self.words = self.words - np.array(carried, np.int64)


_CUT = bytes(i for i in range(256) if not _IN_WORD[i])


def _parts(text: bytes, slab: int, longest: int) -> Iterator[tuple[bytes, int]]:
    """A text in parts of about `slab` bytes, cut between words, and how many words each part repeats."""
    if len(text) <= slab:
        yield text, 0
        return
    at, lead = 0, b""
    while at < len(text):
        end = min(at + slab, len(text))
        while end < len(text) and text[end] not in _CUT:
            end += 1
        part = text[at:end]
        words = lead.split()
        yield (lead + b" " + part if words else part), len(words)
        if longest > 1:
            clean = bytes(_LOWERED[np.frombuffer(part, np.uint8)] * _IN_WORD[np.frombuffer(part, np.uint8)]).replace(b"\0", b" ")
            lead = b" ".join([*words, *clean.split()][-(longest - 1):])
        at = end


def _slabs(texts: list[str | None], slab: int, longest: int) -> Iterator[tuple[list[int], Slab]]:
    """(numbers of the texts, words) for parts of texts that make up a slab each."""
    held: list[tuple[int, bytes, int]] = []
    size = 0
    for i, text in enumerate(texts):
        for part, carried in _parts((text or "").encode("utf-8"), slab, longest):
            if held and size + len(part) > slab:
                yield [h[0] for h in held], Slab([h[1] for h in held], [h[2] for h in held], longest)
                held, size = [], 0
            held.append((i, part, carried))
            size += len(part)
    if held:
        yield [h[0] for h in held], Slab([h[1] for h in held], [h[2] for h in held], longest)


def _counted(longest: int, buckets: int, slab: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, part in _slabs(batch.column("text").to_pylist(), slab, longest):
                total += Table(part.data, part.starts, part.ends, buckets).per_bucket(buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, slab: int = SLAB) -> DataFrame:
    """(bucket, n): features of all texts by bucket. A task sends at most one row per bucket."""
    return texts.select("text").mapInArrow(_counted(longest, buckets, slab), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, unit: int = UNIT) -> DataFrame:
    """(bucket, gain) for every bucket: how much more the target uses it than the corpus, in whole units."""
    spark = docs.sparkSession
    s = bucket_counts(docs, longest, buckets).withColumnRenamed("n", "s")
    t = bucket_counts(target, longest, buckets).withColumnRenamed("n", "t")
    every = spark.range(buckets).withColumnRenamed("id", "bucket").join(s, "bucket", "left").join(t, "bucket", "left").fillna(0, ["s", "t"])
    every = Scratch(spark, "buckets").write(every, "counts")
    all_s, all_t = every.agg(F.sum("s"), F.sum("t")).first()
    over = (F.col("t") + 1).cast("double") * (all_s + buckets)
    under = (F.col("s") + 1).cast("double") * (all_t + buckets)
    return every.select("bucket", F.floor(F.lit(float(unit)) * F.log(over / under)).alias("gain"))


def _weighed(longest: int, buckets: int, slab: int, gain: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            words, features, sums = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for numbers, part in _slabs(batch.column("text").to_pylist(), slab, longest):
                found = Table(part.data, part.starts, part.ends, buckets)
                mine = gain[found.bucket][found.slot]
                whose = np.array(numbers)[part.doc]
                np.add.at(words, numbers, part.words)
                features += np.bincount(whose, minlength=n)
                np.add.at(sums, whose, mine)
            weight = np.where(features > 0, sums // np.maximum(features, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(words), pa.array(features), pa.array(weight)], ["doc_id", "n_words", "n_features", "weight"])

    return run


def weights(docs: DataFrame, gain: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, slab: int = SLAB) -> DataFrame:
    """(doc_id, n_words, n_features, weight) for every row; weight is the mean gain, rounded down.

    `gain` has one row per bucket, so what the driver takes in and hands to the tasks is bounded by `buckets`.
    """
    held = np.zeros(buckets, np.int64)
    for row in gain.collect():
        held[row["bucket"]] = row["gain"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_weighed(longest, buckets, slab, held), f"doc_id {kind}, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED, unit: int = UNIT) -> Column:
    """Gumbel noise in whole units, keyed by seed and id."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(key, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(unit)) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def drawn(scored: DataFrame, number: int, scratch: Scratch) -> DataFrame:
    """`scored` with rank 1 .. number for its highest scores, ties to smaller doc_id, else null.

    Rows eligible are dealt into ranges of the order; a range's first rank follows from the sizes of the ranges
    before it, so no task orders them all.
    """
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features")]
    ranges = scored.filter("eligible").select("row", "doc_id", "score", "n_features").repartitionByRange(*order)
    placed = scratch.write(ranges.sortWithinPartitions(*order).select("row", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "order")
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    # One row per range of the order.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    skips = sizes.select("part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip")).filter(F.col("skip") < number)
    ranks = placed.join(skips, "part").select("row", (F.col("at") - F.col("first") + F.col("skip") + 1).alias("rank")).filter(F.col("rank") <= number)
    return scored.join(ranks, "row", "left")


def resample(docs: DataFrame, target: DataFrame, percent: int = DRAW_PERCENT, least_words: int = LEAST_WORDS, longest: int = LONGEST, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """Every row of `docs` as doc_id, n_words, n_features, weight, score, rank (null if not drawn).

    Words are runs of ASCII letters (in lower case), digits and characters beyond ASCII. Features are runs of 1 to
    `longest` words. Of the N rows with at least `least_words` words the draw takes floor(percent * N / 100).
    Null texts have no words: weight 0, never drawn unless least_words is 0. Rows without doc_id share one noise and
    come after others of their score. Repeated rows are rows of their own with equal scores and ranks in a row.
    Other columns are ignored, in both tables; an empty target or an empty table is fine.
    """
    scratch = Scratch(docs.sparkSession, "resampling")
    gain = scratch.write(gains(docs, target, longest, buckets), "gains")
    rows = weights(docs, gain, longest, buckets).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    rows = rows.withColumn("eligible", F.col("n_words") >= least_words).withColumn("row", F.monotonically_increasing_id())
    scored = scratch.write(rows, "scores")
    number = scored.filter("eligible").count() * percent // 100
    return drawn(scored, number, scratch).select("doc_id", "n_words", "n_features", "weight", "score", "rank")


SQL = r"""
WITH RECURSIVE crc(i, c, k) AS (
  SELECT i, i, 0 FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc WHERE k < 8),
steps AS (SELECT list(c ORDER BY i) AS step FROM crc WHERE k = 8),
d AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM documents),
b AS (SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
dn AS (SELECT doc_id, word, count(*) AS n FROM d GROUP BY ALL),
w AS (SELECT word, sum(s) AS s, sum(t) AS t FROM (SELECT word, n AS s, 0 AS t FROM dn UNION ALL SELECT word, 0, 1 FROM b) GROUP BY word),
bytes AS (SELECT word, s, t, hex(encode(word)) AS x FROM w),
named AS (SELECT word, s, t, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(x), 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT)),
    lambda r, v: xor(r >> 8, step[xor(r & 255, v) + 1])), 4294967295) % 10000 AS bucket FROM bytes, steps),
sums AS (SELECT bucket, sum(s) AS s, sum(t) AS t FROM named GROUP BY bucket),
total AS (SELECT coalesce(sum(s), 0) AS all_s, coalesce(sum(t), 0) AS all_t FROM sums),
gain AS (SELECT bucket, floor(1000::DOUBLE * ln((t + 1)::DOUBLE * (all_s + 10000) / ((s + 1)::DOUBLE * (all_t + 10000))))::BIGINT AS gain FROM sums, total),
doc AS (SELECT doc_id, sum(n)::BIGINT AS n, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight FROM dn JOIN named USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000::DOUBLE * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM documents LEFT JOIN doc USING (doc_id)),
placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS many FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= many * 10 // 100 THEN rank END AS rank FROM scored LEFT JOIN placed USING (doc_id)
"""


@query("op13_importance_resampling", SQL)
def op13_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    out = resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")
