"""Alignment of two tokenizers over the same bytes, by pointer jumping.

The tokens of both tokenizers cover the same bytes of a text. Every token points to the token that
overlaps it and ends farthest right (itself, if none ends later; of two that end alike, the second
tokenizer's). Replacing each pointer by its target's pointer, over all tokens of a block at once,
doubles the distance covered, so after about log2 of the longest chain every token names the last token
of its connected component. That label is its group: two tokens share it exactly if a chain of overlaps
connects them, that is if no offset between them ends a token on both sides.

Corpus-wide counts of linked id pairs are made per block of texts first. A block's distinct pairs meet
the totals and come back to the block; texts hold their links as places in that list. So what travels
grows with the distinct pairs of the blocks, not with the links.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.durable import Scratch
from tallyloom.llm.base import table
from tallyloom.llm.registry import query

RANKS, PIECES = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
#: Characters of the texts that make up one block; a longer text is a block of its own.
BLOCK_CHARS = 1 << 20
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


class Side:
    """One tokenizer: bytes, byte length and printed id of every token."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.tokens = tokens
        self.size = np.array([len(t) for t in tokens], np.int64)

    def printed(self, lead: bytes) -> list[bytes]:
        return [lead + b"%d" % i for i in range(len(self.tokens))]


class Tokenizers:
    """Side A, a byte-level vocabulary given as ranks, and side B, a sentencepiece model."""

    def __init__(self, ranks: str, pieces: str) -> None:
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(ranks, "rb") as lines:
            known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        by_rank = [b""] * (max(known.values()) + 1)
        for token, rank in known.items():
            by_rank[rank] = token
        # No special tokens: text that spells one is ordinary text.
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})
        self.model = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.a, self.b = Side(by_rank), Side([_piece_bytes(self.model.id_to_piece(i)) for i in range(self.model.get_piece_size())])
        # Ids as they are printed in a group: the first of a group, further ones, the first of side B.
        forms = [*self.a.printed(b";"), *self.a.printed(b","), *self.b.printed(b"|"), *self.b.printed(b",")]
        self.forms = np.array(forms, object)

    def encode(self, texts: list[str | None]) -> list[tuple[list[int], list[int]]]:
        """Ids of both sides for every text; none where a side does not give back a space and the text."""
        full = [(" " + t).encode("utf-8") if t else None for t in texts]
        ours = [t or "" for t in texts]
        out = []
        for whole, text, b in zip(full, ours, self.model.encode(ours, num_threads=1)):
            if whole is None or b"".join(map(self.b.tokens.__getitem__, b)) != whole:
                out.append(([], []))
                continue
            a = self.fast.encode_ordinary(" " + text)
            out.append((a, b) if b"".join(map(self.a.tokens.__getitem__, a)) == whole else ([], []))
        return out


def _piece_bytes(piece: str) -> bytes:
    byte = _BYTE_PIECE.fullmatch(piece)
    return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode("utf-8")


@lru_cache(1)
def tokenizers(ranks: str, pieces: str) -> Tokenizers:
    """One pair of tokenizers for each Python worker."""
    return Tokenizers(ranks, pieces)


def successors(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """The farthest-right overlapping token of each token; A's tokens come first, then B's."""
    n = len(a_ends)
    # The token that covers a token's last byte is its farthest-right neighbour on the other side.
    over_a = n + np.searchsorted(b_ends, a_ends, side="left")
    over_b = np.searchsorted(a_ends, b_ends, side="left")
    own = n + np.arange(len(b_ends))
    return np.concatenate([over_a, np.where(a_ends[over_b] > b_ends, over_b, own) if n else own])


def jump(pointers: np.ndarray) -> np.ndarray:
    """Every pointer followed to its end, by doubling."""
    while True:
        further = pointers[pointers]
        if np.array_equal(further, pointers):
            return pointers
        pointers = further


class Block:
    """The tokens of some texts, laid end to end, and their groups and links.

    Each stretch between two ends of either side is one link of an A token and a B token. A link is kept as
    its pair's place among the block's distinct pairs, most frequent first, and by what it opens.
    """

    def __init__(self, encoded: list[tuple[list[int], list[int]]], own: Tokenizers) -> None:
        count_a, count_b = (np.array([len(x[side]) for x in encoded], np.int64) for side in (0, 1))
        a, b = (np.fromiter((i for x in encoded for i in x[side]), np.int64, int(n.sum())) for side, n in ((0, count_a), (1, count_b)))
        a_ends, b_ends = np.cumsum(own.a.size[a]), np.cumsum(own.b.size[b])
        label = jump(successors(a_ends, b_ends))
        ends = np.union1d(a_ends, b_ends)
        at_a, at_b = np.searchsorted(a_ends, ends, side="left"), np.searchsorted(b_ends, ends, side="left")
        self.n_links = np.diff(np.searchsorted(at_b, np.cumsum(count_b), side="left"), prepend=0)
        opens = [np.diff(x, prepend=-1) != 0 for x in (at_a, at_b, label[at_a])]
        self.opens = sum(flag.astype(np.uint8) << bit for bit, flag in enumerate(opens)) if len(ends) else np.empty(0, np.uint8)
        codes, slots, times = np.unique(a[at_a] << 32 | b[at_b], return_inverse=True, return_counts=True)
        order = np.argsort(-times, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.codes, self.times, self.slots = codes[order], times[order], place[slots]

    def columns(self) -> dict[str, bytes]:
        kind = "<u2" if len(self.codes) < 1 << 16 else "<u4"
        # Low and high bytes apart: the high ones are mostly zero.
        slots = np.ascontiguousarray(self.slots.astype(kind).view(np.uint8).reshape(len(self.slots), int(kind[-1])).T)
        packed = {"slots": slots, "opens": self.opens, "codes": self.codes.astype("<i8"), "times": self.times.astype("<i8")}
        return {name: zstandard.compress(values.tobytes()) for name, values in packed.items()}


def _unpacked(value: pa.Scalar, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(value.as_py()), kind)


def printed(a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, counts: np.ndarray, own: Tokenizers) -> list[bytes]:
    """The groups of each text as `a1,a2|b1;a3|b2,b3`; counts are its tokens of both sides."""
    first_a, first_b = np.diff(group_a, prepend=-1) > 0, np.diff(group_b, prepend=-1) > 0
    in_a, in_b = len(own.a.tokens), len(own.b.tokens)
    forms = np.empty(len(a) + len(b), np.int64)
    # An A token stands behind all tokens of earlier groups, a B token also behind the A tokens of its own.
    forms[np.arange(len(a)) + np.searchsorted(group_b, group_a, side="left")] = a + np.where(first_a, 0, in_a)
    forms[np.arange(len(b)) + np.searchsorted(group_a, group_b, side="right")] = b + 2 * in_a + np.where(first_b, 0, in_b)
    texts, ends = own.forms[forms].tolist(), np.cumsum(counts).tolist()
    return [b"".join(texts[s:e])[1:] for s, e in zip([0, *ends], ends)]


def _blocks(texts: list[str | None], chars: int) -> Iterator[tuple[int, int]]:
    start = held = 0
    for i, text in enumerate(texts):
        size = len(text or "")
        if i > start and held + size > chars:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(texts):
        yield start, len(texts)


def _aligned(ranks: str, pieces: str, chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, number = tokenizers(ranks, pieces), TaskContext.get().partitionId() << 32
        for batch in batches:
            texts, ids = batch.column("text").to_pylist(), batch.column("doc_id")
            for start, end in _blocks(texts, chars):
                block = Block(own.encode(texts[start:end]), own)
                lists = {"doc_ids": ids.slice(start, end - start), "n_links": pa.array(block.n_links, pa.int64())}
                columns = {"block": pa.array([number], pa.int64()), **{k: pa.ListArray.from_arrays(pa.array([0, end - start], pa.int32()), v) for k, v in lists.items()},
                           **{k: pa.array([v], pa.binary()) for k, v in block.columns().items()}}
                number += 1
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, codes, times in zip(batch.column("block"), batch.column("codes"), batch.column("times")):
            codes, times = _unpacked(codes, "<i8"), _unpacked(times, "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), block.as_py()), pa.int64()), pa.array(codes), pa.array(times)], ["block", "code", "times"])


def _scored(ranks: str, pieces: str):
    def run(blocks: pa.Table, totals: pa.Table) -> pa.Table:
        own, row = tokenizers(ranks, pieces), {name: blocks.column(name)[0] for name in blocks.column_names}
        codes, n_links = _unpacked(row["codes"], "<i8"), row["n_links"].values.to_numpy()
        slots = _unpacked(row["slots"], np.uint8).reshape(2 if len(codes) < 1 << 16 else 4, int(n_links.sum()))
        slots = sum(plane.astype(np.int64) << 8 * i for i, plane in enumerate(slots))
        totals = totals.sort_by("code")
        found = np.searchsorted(totals.column("code").to_numpy(), codes)
        count = totals.column("total").to_numpy()[found]
        best = count == totals.column("most").to_numpy()[found]
        opens, code = _unpacked(row["opens"], np.uint8), codes[slots]
        new_a, new_b, new_group = ((opens >> bit & 1).astype(bool) for bit in range(3))
        group = np.cumsum(new_group) - 1
        cuts = np.append(0, np.cumsum(n_links))

        def per_text(values: np.ndarray) -> np.ndarray:
            return np.diff(np.append(0, np.cumsum(values.astype(np.int64)))[cuts])

        n_a, n_b = per_text(new_a), per_text(new_b)
        groups = printed(code[new_a] >> 32, code[new_b] & 0xFFFFFFFF, group[new_a], group[new_b], n_a + n_b, own)
        numbers = {"n_a": n_a, "n_b": n_b, "n_groups": per_text(new_group), "n_links": n_links, "n_best": per_text(best[slots]), "count_sum": per_text(count[slots])}
        columns = [row["doc_ids"].values, *[pa.array(v, pa.int64()) for v in numbers.values()], pa.array(groups, pa.binary()).cast(pa.string())]
        return pa.table(columns, names=["doc_id", *numbers, "groups"])

    return run


def align(docs: DataFrame, ranks: str | None = None, pieces: str | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per row of `docs`: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups.

    A encodes a space and the text, B the text, to which it adds the space. groups lists the ids of each
    group in order, `a1,a2|b1;a3|b2,b3`. A link is a pair of overlapping tokens; an id pair's count is the
    number of its links in the corpus. count_sum adds the counts of the row's links; n_best are those
    links whose count is the highest of their B id. Null and empty texts, and texts that one side does not
    give back byte by byte, have zeros and empty groups. Repeated rows count each; null ids are kept. Other
    columns are ignored; an empty table gives an empty result. Whole texts are read, however long.
    ranks, pieces: the vocabulary files of both sides, by default the public ones.
    """
    import public_tokenizers

    files = ranks or str(public_tokenizers.path(RANKS)), pieces or str(public_tokenizers.path(PIECES))
    kind = docs.schema["doc_id"].dataType.simpleString()
    scratch = Scratch(docs.sparkSession, "alignment")
    schema = f"block long, doc_ids array<{kind}>, n_links array<long>, slots binary, opens binary, codes binary, times binary"
    # Written once, so that a block keeps its number and its texts, whichever executor is lost later.
    made = scratch.write(docs.select("doc_id", "text").mapInArrow(_aligned(*files, block_chars), schema), "blocks")
    found = made.select("block", "codes", "times").mapInArrow(_pairs, "block long, code long, times long")
    totals = scratch.write(found.groupBy("code").agg(F.sum("times").alias("total")), "totals")
    second = F.col("code").bitwiseAND(F.lit(0xFFFFFFFF))
    most = totals.groupBy(second.alias("b")).agg(F.max("total").alias("most"))
    totals = totals.withColumn("b", second).join(most, "b").select("code", "total", "most")
    answers = found.select("block", "code").join(totals, "code")
    rows = made.select("block", "doc_ids", "n_links", "slots", "opens", "codes")
    out = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_scored(*files), out)


@query("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    out = align(table(spark, folder, "documents"))
    digest = F.when(F.col("n_a") == 0, F.lit("")).otherwise(F.sha2(F.col("groups"), 256))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))
