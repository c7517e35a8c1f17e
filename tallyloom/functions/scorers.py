"""String similarity on a 0-100 scale, as published for indel distance, token sets and best windows.

The plain Python functions are small helpers; the `*_udf` forms run them over Arrow batches and
score each distinct pair of a batch once. Apply them after a join, never to a product.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence; one bit per letter of `a`, one step per letter of `b`."""
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    open_bits = full
    for ch in b:
        hit = open_bits & masks.get(ch, 0)
        open_bits = ((open_bits + hit) | (open_bits - hit)) & full
    return len(a) - open_bits.bit_count()


def ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 100.0 if total == 0 else 200.0 * lcs_length(a, b) / total


def token_set_ratio(a: str, b: str) -> float:
    left, right = set(a.split()), set(b.split())
    if not left or not right:
        return 0.0
    both = left & right
    only_a, only_b = " ".join(sorted(left - both)), " ".join(sorted(right - both))
    if both and (not only_a or not only_b):
        return 100.0
    shared = len(" ".join(sorted(both)))
    gap = 1 if shared else 0
    len_a, len_b = shared + gap + len(only_a), shared + gap + len(only_b)
    edits = len(only_a) + len(only_b) - 2 * lcs_length(only_a, only_b)
    best = 100.0 * (1.0 - edits / (len_a + len_b))
    if shared:
        best = max(
            best,
            100.0 * (1.0 - (gap + len(only_a)) / (shared + len_a)),
            100.0 * (1.0 - (gap + len(only_b)) / (shared + len_b)),
        )
    return best


def _best_window(needle: str, hay: str) -> float:
    if needle in hay:
        return 100.0
    n, best = len(needle), 0.0
    for end in range(1, len(hay) + n):
        window = hay[max(0, end - n) : end]
        # No window can beat 200*|w|/(n+|w|).
        if 200.0 * len(window) / (n + len(window)) > best:
            best = max(best, ratio(needle, window))
    return best


def partial_ratio(a: str, b: str) -> float:
    if not a or not b:
        return 100.0 if a == b else 0.0
    if len(a) == len(b):
        return max(_best_window(a, b), _best_window(b, a))
    return _best_window(a, b) if len(a) < len(b) else _best_window(b, a)


def _pairwise(score: Callable[[str, str], float]):
    @F.pandas_udf(DoubleType())
    def scored(left: pd.Series, right: pd.Series) -> pd.Series:
        seen: dict[tuple[str, str], float] = {}
        out = []
        for pair in zip(left, right):
            if pair[0] is None or pair[1] is None:
                out.append(None)
                continue
            if pair not in seen:
                seen[pair] = score(*pair)
            out.append(seen[pair])
        return pd.Series(out, dtype="float64")

    return scored


_SCORERS = {"indel": ratio, "token_set": token_set_ratio, "partial": partial_ratio}


def _holds(a: str, b: str) -> bool:
    return (a in b or b in a) if a and b else a == b


#: Which pairs score 100, the most there is, where that is cheaper to tell than the score.
_BEST = {"indel": str.__eq__, "levenshtein": str.__eq__, "partial": _holds}


def scorer(name: str) -> Callable[[Column, Column], Column]:
    """Column scorer by name: indel, token_set, partial (Arrow), levenshtein or none (JVM).

    The matcher reads three attributes: `constant`, the score of every pair, `best`, telling pairs that score 100, and
    `many`, the score of many pairs at once with a bound on it (see pairwise).
    """
    from tallyloom.functions.pairwise import MANY

    def score(a: Column, b: Column) -> Column:
        if name == "none":
            return F.lit(0.0)
        if name == "levenshtein":
            longest = F.greatest(F.length(a), F.length(b))
            return F.when(longest == 0, 100.0).otherwise(100.0 * (1.0 - F.levenshtein(a, b) / longest))
        return _pairwise(_SCORERS[name])(a, b)

    if name not in ("none", "levenshtein", *_SCORERS):
        raise KeyError(name)
    score.constant = 0.0 if name == "none" else None
    score.best = _BEST.get(name)
    score.many = MANY.get(name)
    return score
