"""Similarity search of names against a supplier dimension.

Best suppliers of a name. The tenth best score of a name may be low, and below about 70 two names need
not share a single pair of letters, so no index key is safe. Names and dimension are therefore dealt
into chunks and slices that meet by a cogroup, and a name is held against a whole slice at once: the
suppliers that share the same words with it are scored together, one numpy step per letter of what is
left of them. Names beyond one machine word get a bound and are scored one by one while it matters.

Only a score of 100 tells that all words of one name stand in the other; such pairs are found by an equi-join on
the rarest word of the contained name, so the work follows the pairs that share it.

Similar suppliers. A high score leaves traces: names that reach it share many letter pairs, or the
words of one make up most of the other. So each name is filed under its rarest letter pairs only, as many as
the score asks for, and meets the names that hold one of them by an equi-join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.durable import Scratch
from tallyloom.functions.bind import let
from tallyloom.functions.scorers import ratio, scorer, token_set_ratio

#: Letters of a name that fit one machine word; longer ones are scored one by one.
LONGEST = 63
#: Sets of shared words for which a slice remembers what is left of its names.
LEFTOVERS = 64
TOP = "norm string, pos bigint, place int, token_set double, plain double"
#: Keys a name has beyond the first that must be met.
EXTRA_KEYS = 4
#: Names that share a letter pair met by one task before the pair is split over several.
PAIR_ROWS = 2_000


class _Letters:
    """Texts as columns of letter numbers, for comparing one text with all of them in step."""

    def __init__(self, texts: list[str], alphabet: dict[str, int]) -> None:
        self.alphabet = alphabet
        self.size = np.array([len(t) for t in texts], np.int64)
        self.fits = self.size <= LONGEST
        self.cells = np.zeros((int(self.size[self.fits].max(initial=0)), len(texts)), np.int32)
        for i in np.flatnonzero(self.fits).tolist():
            self.cells[: self.size[i], i] = [alphabet[ch] for ch in texts[i]]

    def common(self, other: str, at: np.ndarray) -> np.ndarray:
        """Longest common subsequence of `other` with the texts `at`: one bit per letter, one step per place."""
        masks = np.zeros(len(self.alphabet) + 1, np.uint64)  # number 0 stands behind the end of a text
        for i, ch in enumerate(other):
            if ch in self.alphabet:
                masks[self.alphabet[ch]] |= np.uint64(1 << i)
        full = np.uint64((1 << len(other)) - 1)
        open_bits = np.full(len(at), full)
        for cell in self.cells:
            hit = open_bits & masks[cell[at]]
            open_bits = ((open_bits + hit) | (open_bits - hit)) & full
        return len(other) - np.bitwise_count(open_bits).astype(np.int64)


class _Slice:
    """Names of one slice of the dimension, laid out for scoring one name against all of them."""

    def __init__(self, pos: list[int], norms: list[str]) -> None:
        self.pos, self.norms = np.array(pos), norms
        self.sets = [sorted(set(n.split())) for n in norms]
        self.words = np.array([len(words) for words in self.sets])
        self.size = np.array([len(" ".join(words)) for words in self.sets])
        holders: dict[str, list[int]] = {}
        for i, words in enumerate(self.sets):
            for w in words:
                holders.setdefault(w, []).append(i)
        self.holders = {w: np.array(at) for w, at in holders.items()}
        self.alphabet = {ch: i + 1 for i, ch in enumerate(sorted(set("".join(norms)) | {" "}))}
        self.without = lru_cache(LEFTOVERS)(self._without)

    def _without(self, shared: tuple[str, ...]) -> tuple[np.ndarray, _Letters]:
        """The names that hold all these words, and what is left of them without."""
        at = np.arange(len(self.norms))
        for w in shared:
            at = np.intersect1d(at, self.holders[w], assume_unique=True)
        gone = set(shared)
        return at, _Letters([" ".join(w for w in self.sets[i] if w not in gone) for i in at.tolist()], self.alphabet)

    def scores(self, norm: str) -> tuple[np.ndarray, np.ndarray]:
        """(score or a bound on it, whether it is the score) of every name; only long names are left to bounds."""
        words = sorted(set(norm.split()))
        best, known = np.zeros(len(self.norms)), self.words == 0
        if not words:
            return best, np.ones(len(self.norms), bool)
        # Names by the words they share with this one.
        met, groups = [w for w in words if w in self.holders], np.zeros(len(self.norms), np.int64)
        which: dict[int, tuple[str, ...]] = {0: ()}
        for w in met:
            at = self.holders[w]
            new: dict[tuple[int, str], int] = {}
            for g in np.unique(groups[at]).tolist():
                new[g, w] = len(which)
                which[len(which)] = (*which[g], w)
                groups[at[groups[at] == g]] = new[g, w]
        for g in np.unique(groups).tolist():
            shared = which[g]
            mine = " ".join(w for w in words if w not in shared)
            holders, left = self.without(shared)
            here = np.flatnonzero(groups[holders] == g)
            at, b = holders[here], left.size[here]
            if shared and not mine:
                best[at], known[at] = 100.0, True
                continue
            a, same, gap = len(mine), len(" ".join(shared)), 1 if shared else 0
            fits = left.fits[here] & (a <= LONGEST)
            common = np.minimum(a, b)
            if fits.any():
                common[fits] = left.common(mine, here[fits])
            score = 100.0 * (1.0 - (a + b - 2 * common) / np.maximum(2 * (same + gap) + a + b, 1))
            if shared:
                for part in (a, b):
                    score = np.maximum(score, 100.0 * (1.0 - (gap + part) / (2 * same + gap + part)))
                whole = b == 0
                score[whole], fits[whole] = 100.0, True
            empty = known[at]
            best[at], known[at] = np.where(empty, 0.0, score), fits | empty
        return best, known

    def best(self, norm: str, k: int) -> list[tuple[int, float]]:
        """Index and score of the k best names, ties by position."""
        top, known = self.scores(norm)
        sure = np.flatnonzero(known)
        if len(sure) > k:
            sure = sure[top[sure] >= np.partition(top[sure], -k)[-k]]
        found = sorted((-float(top[i]), int(i)) for i in sure)[:k]
        floor = -found[-1][0] if len(found) >= k else -1.0
        open_ = np.flatnonzero(~known & (top >= floor - 1e-9))
        for i in open_[np.argsort(-top[open_], kind="stable")].tolist():
            if len(found) >= k and top[i] < -found[-1][0] - 1e-9:
                break
            found = sorted([*found, (-token_set_ratio(norm, self.norms[i]), i)])[:k]
        return [(i, -s) for s, i in found]


def _met(names: DataFrame, key: str, dim: DataFrame, slice_rows: int, run, schema: str) -> tuple[DataFrame, int]:
    """run(names, slice) over all pairs of a chunk of names and a slice of the dimension, and the number of slices.

    Chunks hold about `slice_rows` names too, or fewer where that leaves cores idle.
    """
    spark = dim.sparkSession
    wanted = names.count()
    if not wanted:  # the dimension need not travel
        return spark.createDataFrame([], schema), 1
    slices = max(1, math.ceil(dim.count() / slice_rows))
    cores = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    chunks = max(math.ceil(2 * cores / slices), math.ceil(wanted / slice_rows))

    def dealt(df: DataFrame, by: str, own: str, parts: int, other: str, others: int) -> DataFrame:
        numbered = df.withColumn(own, F.pmod(F.xxhash64(by), F.lit(parts)).cast("int"))
        return numbered.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    # New column instances: names may come from the dimension itself.
    left = dealt(names, key, "chunk", chunks, "slice", slices)
    left = left.select(*[F.col(c).alias(c) for c in left.columns])
    right = dealt(dim.select("pos", "norm"), "pos", "slice", slices, "chunk", chunks)
    # The rows are few and the work is not, so partitions must not be merged by their bytes.
    left, right = (side.repartition(slices * chunks, "slice", "chunk") for side in (left, right))
    pairs = left.groupBy("slice", "chunk").cogroup(right.groupBy("slice", "chunk"))

    def meet(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        columns = [c.split()[0] for c in schema.split(", ")]
        if not len(mine) or not len(theirs):
            return pd.DataFrame([], columns=columns)
        theirs = theirs.sort_values("pos", kind="stable")
        held = _Slice(theirs["pos"].tolist(), theirs["norm"].tolist())
        return pd.DataFrame(list(run(mine, held)), columns=columns)

    return pairs.applyInPandas(meet, schema), slices


def top_candidates(names: DataFrame, dim: DataFrame, k: int, slice_rows: int) -> DataFrame:
    """The k best dimension rows per `norm` by token-set ratio, ties by dimension order.

    `plain` carries the whole-string ratio where the dimension name is one word.
    """

    def run(mine: pd.DataFrame, held: _Slice) -> Iterator[tuple]:
        for norm in mine["norm"]:
            for place, (i, score) in enumerate(held.best(norm, k)):
                other = held.norms[i]
                yield norm, held.pos[i], place + 1, score, ratio(norm, other) if len(other.split()) == 1 else None

    out, slices = _met(names.select("norm"), "norm", dim, slice_rows, run, TOP)
    if slices > 1:
        # k rows per name and slice remain, so this window stays small for every name.
        order = Window.partitionBy("norm").orderBy(F.desc("token_set"), "pos")
        out = out.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    return out


def contained_names(inner: DataFrame, outer: DataFrame) -> DataFrame:
    """(inner, outer): all words of the one name stand among those of the other. Both frames hold id and norm.

    An inner name is filed under the one of its words that the fewest outer names hold.
    """

    def worded(df: DataFrame, own: str) -> DataFrame:
        words = F.array_distinct(F.filter(F.split("norm", " "), lambda w: w != ""))
        return df.select(F.col("id").alias(own), words.alias(f"{own}_words")).withColumn("word", F.explode(f"{own}_words"))

    inside, outside = worded(inner, "inner"), worded(outer, "outer")
    held = outside.groupBy("word").agg(F.count(F.lit(1)).alias("held"))
    # A word of many outer names is split: each part of them meets all inner names filed there.
    parts = F.ceil(F.col("held") / PAIR_ROWS)
    rarest = F.min_by(F.struct("word", "held"), F.struct("held", "word"))
    known = inside.join(held, "word", "left").withColumn("held", F.coalesce("held", F.lit(0)))
    filed = known.groupBy("inner").agg(F.first("inner_words").alias("inner_words"), rarest.alias("at")).select("inner", "inner_words", "at.*")
    filed = filed.where("held > 0").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("held")
    dealt = outside.join(held, "word").withColumn("part", F.pmod(F.xxhash64("outer"), parts)).drop("held")
    met = filed.join(dealt, ["word", "part"])
    return met.where(F.size(F.array_except("inner_words", "outer_words")) == 0).select("inner", "outer")


def whole_candidates(names: DataFrame, dim: DataFrame, k: int) -> DataFrame:
    """The rows of top_candidates() whose token-set ratio is 100: all words of one name stand in the other."""
    mine, theirs = names.select(F.col("norm").alias("id"), "norm"), dim.select(F.col("pos").alias("id"), "norm")
    in_name = contained_names(theirs, mine).select(F.col("outer").alias("norm"), F.col("inner").alias("pos"))
    in_dim = contained_names(mine, theirs).select(F.col("inner").alias("norm"), F.col("outer").alias("pos"))
    order = Window.partitionBy("norm").orderBy("pos")
    found = in_name.unionByName(in_dim).distinct().withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    other = F.col("other")
    plain = F.when(F.size(F.filter(F.split(other, " "), lambda w: w != "")) == 1, scorer("indel")(F.col("norm"), other))
    return found.join(dim.select("pos", F.col("norm").alias("other")), "pos").select(
        "norm", "pos", "place", F.lit(100.0).alias("token_set"), plain.alias("plain")
    )


def letter_pairs(dim: DataFrame) -> DataFrame:
    """(pos, size, gram, nth): neighbouring letters of each distinct word, a blank before and behind it; repeats are
    numbered. size is the length of the distinct words, joined."""
    words = F.array_distinct(F.filter(F.split("norm", " "), lambda w: w != ""))
    grams = F.flatten(F.transform(words, lambda w: let(F.concat(F.lit(" "), w, F.lit(" ")), lambda p: F.transform(
        F.sequence(F.lit(1), F.length(p) - 1), lambda i: F.substring(p, i, F.lit(2))))))
    each = dim.select("pos", F.length(F.array_join(words, " ")).alias("size"), F.explode(grams).alias("gram"))
    counted = each.groupBy("pos", "size", "gram").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("pos", "size", "gram", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("nth"))


def spare(size: Column, least: float) -> Column:
    """How many letter pairs of a name of `size` letters may stay out of the index for scores from `least` on.

    Where two names of x and y letters have m of them in common, in order, at most x + y - 2m places part
    neighbours, so at least 3m - x - y - 1 pairs of neighbours are shared; m is least / 200 * (x + y). Where
    shared words make the score, their pairs are as many as their letters and blanks, which is
    size * least / (200 - least) + 1. One pair fewer than either may be left out.
    """
    of_letters = 2 * size * (0.015 * least - 1) - 1
    of_words = size * least / (200 - least) + 1
    return F.greatest(F.lit(0), F.ceil(F.least(of_letters, of_words) - 1e-6) - 1)


def similar_candidates(dim: DataFrame, least: float, scratch: Scratch) -> DataFrame:
    """(pos_a < pos_b): every pair of names that may score `least`, for a `least` of 80 or more.

    A pair shares more letter pairs than the shorter of its names, or the one that the other's words make up,
    leaves out. So with `extra` fewer left out, more than `extra` of that name's keys are among all pairs of the
    other; that count tells most chance meetings apart.
    """
    if least < 80:
        raise ValueError("below 80 short names need not share letters")
    own = scratch.write(letter_pairs(dim), "letter-pairs")
    df = own.groupBy("gram", "nth").agg(F.count(F.lit(1)).alias("df"))
    rare_first = Window.partitionBy("pos").orderBy("df", "gram", "nth")
    ranked = own.join(df, ["gram", "nth"]).withColumn("rank", F.row_number().over(rare_first))
    ranked = ranked.withColumn("spare", spare(F.col("size"), least)).withColumn("extra", F.least(F.col("spare"), F.lit(EXTRA_KEYS)))
    keys = ranked.where(F.col("rank") <= F.col("size") + 1 - F.col("spare") + F.col("extra"))
    # A letter pair of many names is split: each part of its keys meets all names that hold it.
    parts = F.ceil(F.col("df") / PAIR_ROWS)
    left = keys.select(F.col("pos").alias("p"), "gram", "nth", F.pmod(F.xxhash64("pos"), parts).alias("part"), "extra")
    right = ranked.select(F.col("pos").alias("q"), "gram", "nth", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"))
    met = left.join(right, ["gram", "nth", "part"]).where("p <> q")
    met = met.groupBy("p", "q", "extra").agg(F.count(F.lit(1)).alias("n")).where("n > extra")
    return met.select(F.least("p", "q").alias("pos_a"), F.greatest("p", "q").alias("pos_b")).distinct()


def may_score(a: Column, b: Column, least: float) -> Column:
    """Whether names as words and letter pairs (structs of `words`, `grams`, `size`) can reach `least`; JVM-side."""
    total = a["size"] + b["size"]
    k = F.size(F.array_intersect(a["grams"], b["grams"]))
    both = F.array_intersect(a["words"], b["words"])
    shared = F.aggregate(both, F.lit(-1), lambda n, w: n + F.length(w) + 1)
    by_letters = 200.0 * (total + 1 + k) / (3 * total) >= least - 1e-6
    by_words = 200.0 * shared / (shared + F.least(a["size"], b["size"])) >= least - 1e-6
    return by_letters | ((F.size(both) > 0) & by_words)


def leading_pairs(dim: DataFrame) -> DataFrame:
    """(pos_a < pos_b): names of which one is the other's first words; the shorter has four letters at least."""
    short = dim.where(F.length("norm") >= 4).select(F.col("pos").alias("p"), F.col("norm").alias("lead"))
    words = F.split("norm", " ")
    runs = F.transform(F.sequence(F.lit(1), F.size(words)), lambda i: F.array_join(F.slice(words, F.lit(1), i), " "))
    long = dim.select(F.col("pos").alias("q"), F.explode(F.filter(runs, lambda r: F.length(r) >= 4)).alias("lead"))
    met = long.join(short, "lead").where("p <> q")
    return met.select(F.least("p", "q").alias("pos_a"), F.greatest("p", "q").alias("pos_b"))


def similar_pairs(dim: DataFrame, least: float) -> DataFrame:
    """(pos_a < pos_b, token_set, leads): pairs scoring at least `least`, or of which one leads the other.

    Only names that share an index key meet, and of those only the ones that can reach the score are scored.
    """
    scratch = Scratch(dim.sparkSession, "similar")
    dim = scratch.write(dim.where("norm <> ''").select("pos", "norm"), "names")
    found = similar_candidates(dim, least, scratch).unionByName(leading_pairs(dim)).distinct()
    words = F.array_distinct(F.filter(F.split("norm", " "), lambda w: w != ""))
    grams = letter_pairs(dim).groupBy("pos").agg(F.collect_list(F.concat("gram", F.col("nth").cast("string"))).alias("grams"))
    described = scratch.write(dim.join(grams, "pos").select("pos", "norm", F.struct(
        words.alias("words"), "grams", F.length(F.array_join(words, " ")).alias("size")).alias("traits")), "traits")
    a, b = (described.select(F.col("pos").alias(f"pos_{s}"), F.col("norm").alias(f"norm_{s}"), F.col("traits").alias(f"traits_{s}")) for s in "ab")
    pairs = found.join(a, "pos_a").join(b, "pos_b")

    def starts(x: str, y: str) -> Column:
        return F.startswith(F.concat(x, F.lit(" ")), F.concat(y, F.lit(" ")))

    leads = starts("norm_a", "norm_b") | starts("norm_b", "norm_a")
    pairs = pairs.where(leads | may_score(F.col("traits_a"), F.col("traits_b"), least)).withColumn("leads", leads)
    pairs = scratch.write(pairs.select("pos_a", "pos_b", "norm_a", "norm_b", "leads"), "candidates")
    scored = pairs.withColumn("token_set", scorer("token_set")(F.col("norm_a"), F.col("norm_b")))
    led = F.col("leads") & (F.least(F.length("norm_a"), F.length("norm_b")) >= 4)
    return scored.where((F.col("token_set") >= least) | led).select("pos_a", "pos_b", "token_set", "leads")
