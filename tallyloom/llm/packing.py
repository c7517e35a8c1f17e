"""Packing token sequences: first-fit decreasing with a tournament tree, in randomised groups.

A document's ids (its tokens, then the end id) are cut into full sequences and a rest. The rests of a
random group of documents go, largest first, into the first bin with room; a tournament tree over the
bins' room finds it. Then the emptiest bins are cut up to fill the others, so that a group leaves at
most one sequence that is not full. Groups are independent and bounded, so packing scales with them.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.durable import Scratch
from tallyloom.llm.base import table, text_mark
from tallyloom.llm.registry import query

CAPACITY = 1024
END_ID = 0
#: Documents of one group, on average.
GROUP_DOCS = 1000
SEED = 7
#: Copies of a repeated row written out by one task.
CHUNK = 5_000
#: Space-separated pieces of text whose ids a worker keeps, and how long one of them may be.
CACHE_ENTRIES, CACHE_CHARS = 200_000, 24
VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"


class Encoder:
    """Ids of whole texts by a byte-level BPE vocabulary, as the tokenizers library gives them for its file.

    The same vocabulary's ranks are merged by the faster tiktoken; a text that spells a special token goes
    to tokenizers itself. The splitting rule always parts a text before a single space between two marks
    that are not white space, so the units between are encoded once and remembered; a text with other
    white space at such a place is encoded as a whole.
    """

    def __init__(self, vocabulary: str, ranks: str) -> None:
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as lines:
            known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})
        self.opens = np.zeros(max(known.values()) + 1, bool)
        self.opens[[rank for token, rank in known.items() if token.startswith(b" ")]] = True
        self.vocabulary, self.exact = vocabulary, None
        with open(vocabulary, encoding="utf-8") as body:
            self.special = re.compile("|".join(re.escape(t["content"]) for t in json.load(body)["added_tokens"]) or "(?!)")
        self.known: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        if not self.special.search(text):
            return array("I", self.fast.encode_ordinary(text)).tobytes()
        if self.exact is None:
            from tokenizers import Tokenizer

            self.exact = Tokenizer.from_file(self.vocabulary)
        return array("I", self.exact.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        first, *units = text.split(" ")
        if len(units) < 8 or not first or first.strip() != first or self.special.search(text):
            return self.whole(text)
        found = list(map(self.known.get, units))
        if None in found:
            new = list({u for u, ids in zip(units, found) if ids is None})
            if any(not u or u.strip() != u for u in new):
                return self.whole(text)
            # Only the first token of a unit opens with a space, so one call serves all of them.
            ids = np.array(self.fast.encode_ordinary(" " + " ".join(new)), "<u4")
            cuts = np.append(np.flatnonzero(self.opens[ids]), len(ids)).tolist()
            if len(cuts) != len(new) + 1:
                return self.whole(text)
            data = ids.tobytes()
            made = {u: data[4 * a:4 * z] for u, a, z in zip(new, cuts, cuts[1:])}
            found = [ids if ids is not None else made[u] for u, ids in zip(units, found)]
            if len(self.known) < CACHE_ENTRIES:
                self.known.update((u, b) for u, b in made.items() if len(u) <= CACHE_CHARS)
        return self.whole(first) + b"".join(found)


@lru_cache(1)
def encoder(vocabulary: str, ranks: str) -> Encoder:
    """One encoder for each Python worker; its memory serves all tasks the worker runs."""
    return Encoder(vocabulary, ranks)


class Tournament:
    """A binary tree over bins; each node holds the most room below it."""

    def __init__(self, bins: int, room: int) -> None:
        self.size = 1 << max(0, bins - 1).bit_length()
        self.room = [room] * (2 * self.size)

    def take(self, need: int) -> int:
        """The first bin with room for `need`; its room shrinks."""
        room, at = self.room, 1
        while at < self.size:
            at = 2 * at if room[2 * at] >= need else 2 * at + 1
        room[at] -= need
        found = at - self.size
        while at > 1:
            at //= 2
            best = max(room[2 * at], room[2 * at + 1])
            if room[at] == best:
                break
            room[at] = best
        return found


def first_fit_decreasing(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Bins as lists of item numbers. Items are at most `capacity`; ties keep the order given."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    tree, bins = Tournament(len(sizes), capacity), []
    for i in order:
        at = tree.take(sizes[i])
        if at == len(bins):
            bins.append([])
        bins[at].append(i)
    return bins


def fill_up(bins: list[list[int]], sizes: list[int], capacity: int = CAPACITY) -> list[list[tuple[int, int, int]]]:
    """Sequences of (item, start, length): the emptiest bins are cut up to fill the fuller ones."""
    full = [[(i, 0, sizes[i]) for i in b] for b in bins]
    used = [sum(p[2] for p in b) for b in full]
    order = sorted(range(len(full)), key=lambda k: -used[k])
    left, right = 0, len(order) - 1
    while left < right:
        here, last = order[left], order[right]
        if used[here] == capacity:
            left += 1
            continue
        item, start, length = full[last].pop()
        moved = min(length, capacity - used[here])
        full[here].append((item, start, moved))
        used[here], used[last] = used[here] + moved, used[last] - moved
        if moved < length:
            full[last].append((item, start + moved, length - moved))
        elif not full[last]:
            right -= 1
    return [b for b in full if b]


def _encoded(vocabulary: str, ranks: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = encoder(vocabulary, ranks), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            tokens, crcs, rests = [], [], []
            for x in batch.column("text"):
                ids = own.encode(x.as_py() or "") + end
                cut = len(ids) // (4 * capacity) * 4 * capacity
                view = memoryview(ids)
                tokens.append(len(ids) // 4)
                crcs.append([zlib.crc32(view[a:a + 4 * capacity]) for a in range(0, cut, 4 * capacity)])
                rest = np.frombuffer(view[cut:], "<u4")
                rests.append(rest.astype("<u2").tobytes() if not len(rest) or rest.max() < 1 << 16 else rest.tobytes())
            columns = [batch.column("doc_id"), batch.column("pack"), pa.array(tokens, pa.int64()), pa.array(crcs, pa.list_(pa.int64())), pa.array(rests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "pack", "doc_tokens", "crcs", "rest"])

    return run


def _packed(capacity: int, kind: pa.DataType):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        group = key[0].as_py()
        # Any fixed order makes reruns agree; repeated rows are equal, so their order does not matter.
        rows = rows.sort_by([("doc_id", "ascending"), ("doc_tokens", "ascending"), ("rest", "ascending")])
        ids, tokens, crcs = rows.column("doc_id").to_pylist(), rows.column("doc_tokens").to_pylist(), rows.column("crcs").to_pylist()
        rests = [np.frombuffer(r, "<u2" if n % capacity * 2 == len(r) else "<u4").astype("<u4") for r, n in zip(rows.column("rest").to_pylist(), tokens)]
        out: list[tuple] = []
        sequence = group << 32
        for d, n, c in zip(ids, tokens, crcs):
            for k, crc in enumerate(c):
                out.append((d, k * capacity, capacity, crc, n, sequence, 0))
                sequence += 1
        items = [i for i, r in enumerate(rests) if len(r)]
        sizes = [len(rests[i]) for i in items]
        for bin_ in fill_up(first_fit_decreasing(sizes, capacity), sizes, capacity):
            offset = 0
            for item, start, length in bin_:
                i = items[item]
                crc = zlib.crc32(rests[i][start:start + length].tobytes())
                out.append((ids[i], len(crcs[i]) * capacity + start, length, crc, tokens[i], sequence, offset))
                offset += length
            sequence += 1
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        columns = list(zip(*out)) or [()] * len(names)
        return pa.table([pa.array(c, kind if n == "doc_id" else pa.int64()) for n, c in zip(names, columns)], names=names)

    return run


def numbered_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, text, mark, copy): the rows of docs(doc_id, text), equal ones numbered from 1 and all others 0.

    Equal rows are counted before they are shuffled, and written out again from one of them, in chunks, so a row
    repeated very often keeps no task busy alone.
    """
    named = docs.withColumn("mark", text_mark(F.col("text")))
    keys = named.groupBy(F.col("doc_id").alias("id"), F.col("mark").alias("m")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    repeats = Scratch(docs.sparkSession, "packing").write(keys, "repeats")
    if repeats.isEmpty():
        return named.withColumn("copy", F.lit(0).cast("long"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("mark") == F.col("m"))
    once = named.join(repeats, same, "left_anti").withColumn("copy", F.lit(0).cast("long"))
    kept = named.join(repeats, same, "left_semi").dropDuplicates(["doc_id", "mark"]).join(repeats, same)
    chunks = kept.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {CHUNK}"))))
    first = F.col("chunk") * CHUNK
    copies = F.explode(F.sequence(first + 1, F.least(first + CHUNK, F.col("n"))))
    spread = chunks.repartition("doc_id", "mark", "chunk").select("doc_id", "text", "mark", copies.alias("copy"))
    return once.unionByName(spread)


def pack(docs: DataFrame, vocabulary: str | None = None, ranks: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, group_docs: int = GROUP_DOCS, seed: int = SEED) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every row of `docs` is a document of its own, repeated rows too; null text is empty (the end id alone).
    A null doc_id is kept. Rows of one id fall into different groups, equal rows too. Other columns are ignored, an empty table gives an empty result. Sequences
    hold at most `capacity` ids; offsets in a sequence have no gap; reruns agree.
    vocabulary, ranks: one byte-level vocabulary as a file of tokenizers and as ranks; by default the public one.
    """
    import public_tokenizers
    from pyspark.sql.pandas.types import to_arrow_type

    files = vocabulary or str(public_tokenizers.path(VOCABULARY)), ranks or str(public_tokenizers.path(RANKS))
    kind = docs.schema["doc_id"].dataType
    groups = max(1, round(docs.count() / group_docs))
    dealt = numbered_copies(docs.select("doc_id", "text"))
    named = dealt.select("doc_id", "text", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "mark", "copy"), F.lit(groups)).alias("pack"))
    encoded = named.mapInArrow(_encoded(*files, capacity, end_id), f"doc_id {kind.simpleString()}, pack long, doc_tokens long, crcs array<long>, rest binary")
    schema = f"doc_id {kind.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return encoded.groupBy("pack").applyInArrow(_packed(capacity, to_arrow_type(kind)), schema)


@query("op5_packing")
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"))
