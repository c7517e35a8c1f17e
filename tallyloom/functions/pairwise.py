"""Scores of many pairs of texts at once, in numpy: equal to those of `scorers`, and bounds that cost a fraction of them.

Texts are held as letter numbers. One step handles the same place of all pairs of a block, with a machine word of bits for
each pair; pairs with a text beyond one word are scored one by one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

from tallyloom.functions.scorers import partial_ratio

WORD = 64
#: Longest text that another of at most WORD letters is slid along in step.
LONGEST = 128
#: Pairs of a block, and cells of its letter masks.
BLOCK, CELLS = 1 << 15, 1 << 22
ONE = np.uint64(1)
_GUARD, _LOW = np.uint64(0x8888888888888888), np.uint64(0x0F0F0F0F0F0F0F0F)


class Texts:
    """Distinct texts as letter numbers from 1 on, with their sizes and bags of letters."""

    def __init__(self, texts: list[str]) -> None:
        self.texts = texts
        self.size = np.array([len(t) for t in texts], np.int64)
        letters = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        alphabet, codes, often = np.unique(letters, return_inverse=True, return_counts=True)
        self.letters = len(alphabet)
        at = np.cumsum(self.size) - self.size
        owner = np.repeat(np.arange(len(texts)), self.size)
        place = np.arange(len(letters)) - at[owner]
        self.cells = np.zeros((len(texts), int(self.size.clip(max=LONGEST).max(initial=0))), np.int32)
        near = place < LONGEST
        self.cells[owner[near], place[near]] = codes[near] + 1
        # A bag holds sixteen counts of up to seven; the commonest letters have one of their own.
        drawer = np.empty(len(alphabet), np.int64)
        drawer[np.argsort(-often, kind="stable")] = np.arange(len(alphabet)) % 16
        counts = np.bincount(owner * 16 + drawer[codes], minlength=16 * len(texts)).reshape(-1, 16).clip(max=7).astype(np.uint64)
        self.bag = (counts << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(axis=1, dtype=np.uint64)

    def masks(self, which: np.ndarray, backwards: bool = False) -> np.ndarray:
        """For each of these texts the places of each letter, one bit a place; letter 0 stands nowhere."""
        out = np.zeros((len(which), self.letters + 1), np.uint64)
        rows, size = np.arange(len(which)), self.size[which]
        for j in range(min(WORD, int(size.max(initial=0)))):
            here = rows[size > j]
            bit = (size[here] - 1 - j if backwards else np.full(len(here), j)).astype(np.uint64)
            out[here, self.cells[which[here], j]] |= ONE << bit
        out[:, 0] = 0
        return out


def _missing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """At most as many letters as bags `a` hold beyond bags `b`."""
    over = (a | _GUARD) - b
    full = over & _GUARD
    over &= full - (full >> np.uint64(3))
    over = (over & _LOW) + ((over >> np.uint64(4)) & _LOW)
    return ((over * np.uint64(0x0101010101010101)) >> np.uint64(56)).astype(np.int64)


def _full(n: np.ndarray) -> np.ndarray:
    """Words of n bits."""
    return np.where(n >= WORD, ~np.uint64(0), (ONE << np.minimum(n, WORD - 1).astype(np.uint64)) - ONE)


def _blocks(texts: Texts, at: np.ndarray) -> Iterator[np.ndarray]:
    step = max(1, min(BLOCK, CELLS // (texts.letters + 1)))
    for lo in range(0, len(at), step):
        yield at[lo : lo + step]


def _hits(masks: np.ndarray, row: np.ndarray, cells: np.ndarray, steps: int) -> np.ndarray:
    """For each place of a text and each pair: where in the other text, a row of `masks`, its letter stands."""
    at = np.ascontiguousarray(cells.T[:steps]) + row * masks.shape[1]
    return masks.ravel().take(at)


# --- Levenshtein -------------------------------------------------------------------------------


def _similar(edits: np.ndarray, longest: np.ndarray) -> np.ndarray:
    return np.where(longest == 0, 100.0, 100.0 * (1.0 - edits / np.maximum(longest, 1)))


def edits(a: str, b: str) -> int:
    """Levenshtein distance; one bit per letter of `a`, one step per letter of `b`."""
    if not a:
        return len(b)
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    up, down = full, 0
    for ch in b:
        hit = masks.get(ch, 0)
        x = hit | down
        same = ((((x & up) + up) & full) ^ up) | x
        right = down | (full & ~(same | up))
        left = up & same
        right = ((right << 1) | 1) & full
        left = (left << 1) & full
        up, down = left | (full & ~(same | right)), right & same
    return len(b) + up.bit_count() - down.bit_count()


def levenshtein(texts: Texts, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Scores of the texts `a` with the texts `b`."""
    out, m, n = np.zeros(len(a), np.int64), texts.size[a], texts.size[b]
    long = (m > WORD) | (n > WORD)
    for i in np.flatnonzero(long).tolist():
        out[i] = edits(texts.texts[a[i]], texts.texts[b[i]])
    for at in _blocks(texts, np.flatnonzero(~long)):
        at = at[np.argsort(-n[at], kind="stable")]
        which, row = np.unique(a[at], return_inverse=True)
        steps = n[at]
        hits = _hits(texts.masks(which), row, texts.cells[b[at]], int(steps.max(initial=0)))
        up, down = np.full(len(at), ~np.uint64(0)), np.zeros(len(at), np.uint64)
        for j, hit in enumerate(hits):
            live = slice(0, int(np.searchsorted(-steps, -j)))  # pairs whose text has such a place come first
            u = up[live]
            x = hit[live] | down[live]
            same = (((x & u) + u) ^ u) | x
            right = ((down[live] | ~(same | u)) << ONE) | ONE
            up[live] = ((u & same) << ONE) | ~(same | right)
            down[live] = right & same
        full = _full(m[at])
        out[at] = steps + np.bitwise_count(up & full).astype(np.int64) - np.bitwise_count(down & full).astype(np.int64)
    return _similar(out, np.maximum(m, n))


def levenshtein_bound(texts: Texts, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """No score is above this: every letter of one text that the other lacks is an edit."""
    x, y, m, n = texts.bag[a], texts.bag[b], texts.size[a], texts.size[b]
    least = np.maximum(np.maximum(_missing(x, y), _missing(y, x)), np.abs(m - n))
    return _similar(least, np.maximum(m, n))


# --- best window -------------------------------------------------------------------------------


def _slide(texts: Texts, needle: np.ndarray, hay: np.ndarray, n: int, h: int) -> np.ndarray:
    """Best ratio of needles of n letters with any window of hays of h letters, windows over the edges included."""
    which, row = np.unique(needle, return_inverse=True)
    full = _full(np.array([n]))[0]
    tops: dict[int, np.ndarray] = {}  # fewest letters of the needle left over by a window of each size

    def walk(hits, every: bool) -> None:
        open_bits = np.full(len(needle), full)
        for k, hit in enumerate(hits, 1):
            u = open_bits & hit
            open_bits = (open_bits + u) | (open_bits - u)
            if every or k == n:
                open_bits &= full
                closed = np.bitwise_count(open_bits)
                tops[k] = np.minimum(tops[k], closed) if k in tops else closed

    cells = texts.cells[hay]
    hits = _hits(texts.masks(which), row, cells, h)
    walk(hits[:n], True)  # the windows that begin with the hay, and the first whole one
    for start in range(1, h - n + 1):
        walk(hits[start : start + n], False)
    walk(_hits(texts.masks(which, backwards=True), row, cells, h)[: h - n : -1], True)
    best = np.zeros(len(needle))
    for k, closed in tops.items():
        np.maximum(best, 200.0 * (n - closed.astype(np.int64)) / (n + k), out=best)
    return best


def partial(texts: Texts, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Best-window scores of the texts `a` with the texts `b`."""
    m, n = texts.size[a], texts.size[b]
    swap = m > n
    short, long = np.where(swap, b, a), np.where(swap, a, b)
    m, n = np.minimum(m, n), np.maximum(m, n)
    out = np.where((m == 0) & (n == 0), 100.0, 0.0)
    far = (m > WORD) | ((n > LONGEST) & (m > 0))
    for i in np.flatnonzero(far).tolist():
        out[i] = partial_ratio(texts.texts[a[i]], texts.texts[b[i]])
    near = np.flatnonzero((m > 0) & ~far)
    near = near[np.lexsort((n[near], m[near]))]
    shape = m[near] * (LONGEST + 1) + n[near]
    starts = np.flatnonzero(np.diff(shape, prepend=-1))
    for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(near)]):
        for at in _blocks(texts, near[lo:hi]):
            size = int(m[at[0]]), int(n[at[0]])
            out[at] = _slide(texts, short[at], long[at], *size)
            if size[0] == size[1]:
                out[at] = np.maximum(out[at], _slide(texts, long[at], short[at], *size))
    return out


def partial_bound(texts: Texts, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """No score is above this: letters the longer text lacks are in none of its windows."""
    m, n = texts.size[a], texts.size[b]
    swap = m > n
    x, y = texts.bag[a], texts.bag[b]
    short, long = np.where(swap, y, x), np.where(swap, x, y)
    m, n = np.minimum(m, n), np.maximum(m, n)
    common = m - _missing(short, long)
    return np.where(n == 0, 100.0, 200.0 * common / np.maximum(m + common, 1))


#: (score, bound) by the name of the scorer.
MANY: dict[str, tuple[Callable, Callable]] = {
    "levenshtein": (levenshtein, levenshtein_bound), "partial": (partial, partial_bound),
}
