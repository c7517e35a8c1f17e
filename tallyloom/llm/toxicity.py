"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Folding lowers case, maps look-alike letters of other scripts and digits to Latin letters, and turns
punctuation of any script into spaces, so "1d10t" and "idiot" are one word. The lexicon holds beginnings
of words, short words as a whole, and runs of characters where a script writes no spaces, weighted by their log odds in toxic documents of a bounded, labelled sample. Hits inside an exception
phrase do not count; besides given ones, an entry and a word next to it are one if clean documents say them likelier. The sum of weights, plain and per word of text, gives the score by a logistic
curve fitted on the same sample.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.durable import Scratch
from tallyloom.llm.base import crc_of_id, table
from tallyloom.llm.registry import query

#: Labelled documents learned from at most: clean ones, toxic ones.
SAMPLE = {0: 6000, 1: 3000}
#: Shortest and longest beginning of a word that may be an entry; whole words may be shorter or longer.
SHORTEST, LONGEST = 4, 7
#: Characters in a row that may be an entry in a script without spaces.
LONGEST_RUN = 4
#: An entry stands in so many toxic sample documents, after so many different words, and is so much likelier there.
LEAST_DOCS, LEAST_CONTEXTS, LEAST_ODDS = 5, 4, 2.0
#: Words added to a text's length, so that a hit in a very short text is not all there is.
STEADY_WORDS = 50
#: A learned exception stands in so many clean sample documents.
LEAST_CLEAN = 5
EXCEPTIONS = ("trash can", "trash bag", "trash bin", "clown fish", "stupid question")

# Letters that look like Latin ones, next to what they look like.
LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h",
    "α": "a", "ε": "e", "ο": "o", "ρ": "p", "ι": "i", "κ": "k", "ν": "v", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ⅼ": "l", "ⅰ": "i", "ⅾ": "d", "ⅽ": "c", "ⅿ": "m",
}
DIGITS = {"0": "o", "1": "i", "l": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s"}

_FULL_WIDTH = {0xFF01 + i: 0x21 + i for i in range(94)}
_LETTERS = str.maketrans(LOOK_ALIKES) | _FULL_WIDTH | {0x200B: None, 0x200C: None, 0x200D: None, 0x00AD: None}
_SEEN = re.compile("[" + "".join(map(chr, _LETTERS)) + "]")
_BYTES = bytearray(range(256))
for _c in range(128):
    if not chr(_c).isalnum():
        _BYTES[_c] = 32
for _a, _b in DIGITS.items():
    _BYTES[ord(_a)] = ord(_b)
_BYTES = bytes(_BYTES)
_MARKS = re.compile(rb"[@$](?![A-Za-z0-9])")
#: Runs of what is neither ASCII nor a letter or number.
_ODD = re.compile(r"[^\w\x00-\x7f]+")
#: Thai, Lao, Myanmar, Khmer, Han and kana: each character, with the marks on it, is a word of its own.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\ua9e0-\ua9ff\uaa60-\uaa7f\uf900-\ufaff\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U0003ffff]" + r"[^\w\x00-\x7f]*")


def _spaced(run: re.Match) -> str:
    """Spaces for a run of odd characters; accents and vowel signs stay on their letter, invisible ones go."""
    out, on_letter = [], run.start() > 0 and run.string[run.start() - 1].isalnum()
    for c in run.group():
        kind = unicodedata.category(c)
        if kind == "Cf" or "\ufe00" <= c <= "\ufe0f" or "\U000e0100" <= c <= "\U000e01ef":
            continue
        on_letter = on_letter and kind[0] == "M"
        out.append(c if on_letter else " ")
    return "".join(out)


def _folded(text: str) -> bytes:
    text = text.lower()
    if _SEEN.search(text):
        text = text.translate(_LETTERS).lower()
    if not text.isascii():
        text = _UNSPACED.sub(r" \g<0> ", _ODD.sub(_spaced, text))
    data = text.encode("utf-8", "surrogatepass")
    if b"$" in data or b"@" in data:  # at the end of a word they are marks, not letters
        data = _MARKS.sub(b" ", data)
    return data.translate(_BYTES)


def fold(text: str) -> str:
    """Folded text between spaces, one character per UTF-8 byte."""
    return f" {_folded(text).decode('latin-1')} "


def folded_words(text: str) -> list[str]:
    """Words of the folded text. Split as bytes: two of the bytes inside letters are white space in Latin-1."""
    return [w.decode("latin-1") for w in _folded(text).split()]


def _unspaced(word: str) -> bool:
    return word[0] >= "\xe0" and _UNSPACED.match(word.encode("latin-1").decode()) is not None


def terms(words: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Place and possible entries of every word. An entry that ends in a space matches up to the end of a word."""
    alone = [_unspaced(w) for w in words]
    for at, word in enumerate(words):
        if alone[at]:
            sizes = range(1, LONGEST_RUN + 1)
            yield at, [" ".join(words[at:at + n]) + " " for n in sizes if at + n <= len(words) and all(alone[at:at + n])]
        elif len(word) < SHORTEST:
            yield at, [word + " "]
        else:
            yield at, [word[:n] for n in range(SHORTEST, min(len(word) - 1, LONGEST) + 1)] + [word]


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()
    learned: tuple[str, ...] = ()
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)
    machine: ahocorasick.Automaton | None = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {"weights": self.weights, "exceptions": self.exceptions, "learned": self.learned, "curve": self.curve, "machine": None}

    def build(self) -> ahocorasick.Automaton:
        machine = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            machine.add_word(f" {term}", (weight, len(term)))
        # Runs of spaces are one space in the matched text, so phrases match over any white space. Learned ones are folded.
        for own in {*(" ".join(folded_words(phrase)) for phrase in self.exceptions), *self.learned}:
            machine.add_word(f" {own} ", (None, len(own) + 1))
        if len(machine):
            machine.make_automaton()
        return machine

    def measure(self, text: str | None) -> tuple[float, int]:
        """Summed weight of the hits outside exception phrases, and the number of words."""
        words = folded_words(text or "")
        return sum(h[2] for h in self.hits(words)), len(words)

    def hits(self, words: list[str]) -> list[tuple[int, int, float]]:
        """Start, end and weight of the hits outside exception phrases, as places in the words between spaces."""
        if self.machine is None:
            self.machine = self.build()
        if not words or not len(self.machine):
            return []
        hits, spared = [], []
        for end, (weight, size) in self.machine.iter(f" {' '.join(words)} "):
            if weight is None:
                spared.append((end - size, end))
            else:
                hits.append((end - size, end, weight))
        if spared:
            at = np.array(sorted(spared))
            last = np.searchsorted(at[:, 0], [h[0] for h in hits], side="right") - 1
            reach = np.maximum.accumulate(at[:, 1])
            hits = [h for h, k in zip(hits, last) if k < 0 or reach[k] <= h[0]]
        return hits

    def around(self, words: list[str]) -> set[str]:
        """Phrases of a hit and the word before or after it, unless that word is hit as well."""
        hits = self.hits(words)
        if not hits:
            return set()
        starts = np.cumsum([1, *(len(w) + 1 for w in words)])[:-1]
        first = np.searchsorted(starts, [h[0] + 1 for h in hits])
        last = np.searchsorted(starts, [h[1] for h in hits], side="right") - 1
        hit = {k for a, b in zip(first, last) for k in range(a, b + 1)}
        spans = {(a - 1, b) for a, b in zip(first, last) if a and a - 1 not in hit}
        spans |= {(a, b + 1) for a, b in zip(first, last) if b + 1 < len(words) and b + 1 not in hit}
        return {" ".join(words[a:b + 1]) for a, b in spans}

    def score(self, text: str | None) -> float:
        return float(logistic(features(*self.measure(text)) @ np.array(self.curve)))


def features(weight, words) -> np.ndarray:
    weight, words = np.asarray(weight, float), np.asarray(words, float)
    return np.stack([np.log1p(weight), 100 * weight / (words + STEADY_WORDS), np.ones_like(weight)], axis=-1)


def logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def sample(docs: DataFrame, labels: DataFrame, sizes: dict[int, int] = SAMPLE) -> DataFrame:
    """(doc_id, text, toxic) of a bounded number of labelled documents, one text for an id, the same ones at every run."""
    known = labels.filter("toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    mark = F.xxhash64(F.col("doc_id"), F.lit(29))
    slot = F.pmod("mark", F.when(F.col("toxic") == 1, sizes[1]).otherwise(sizes[0]))
    one = known.withColumn("mark", mark).groupBy("toxic", slot.alias("slot")).agg(F.min(F.struct("mark", "doc_id")).alias("one"))
    chosen = one.select(F.col("one.doc_id").alias("id"), F.col("toxic").alias("label"))
    # Bounded by the sample's size, whatever the tables hold.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("id"))
    # One text of each id, however often the id is there.
    return rows.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("doc_id", "text", F.col("label").alias("toxic"))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per term: toxic and clean documents that hold it, and a bit set of the words before it in toxic ones."""
    docs, contexts = ({}, {}), {}
    for batch in batches:
        for x, label in zip(batch.column("text"), batch.column("toxic").to_pylist()):
            words = folded_words(x.as_py() or "")
            found = {}
            for at, entries in terms(words):
                bit = 1 << sum(words[at - 1].encode("latin-1") if at else b"") % 63
                for term in entries:
                    found[term] = found.get(term, 0) | bit
            own = docs[label]
            for term, bits in found.items():
                own[term] = own.get(term, 0) + 1
                if label:
                    contexts[term] = contexts.get(term, 0) | bits
    names = list(docs[0].keys() | docs[1].keys())
    for at in range(0, len(names), 50_000):
        part = names[at:at + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([docs[1].get(t, 0) for t in part], pa.int64()), pa.array([docs[0].get(t, 0) for t in part], pa.int64()),
                                          pa.array([contexts.get(t, 0) for t in part], pa.int64())], ["term", "toxic", "clean", "contexts"])


def _around(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column("toxic").to_pylist()
            found = [(p, label) for x, label in zip(batch.column("text"), labels) for p in lexicon.around(folded_words(x.as_py() or ""))]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int32())], ["phrase", "toxic"])

    return run


def log_odds(had: dict[int, int]) -> tuple[Column, Column]:
    """Log odds of standing in a toxic document, from columns toxic and clean, and their standard error."""
    toxic, clean = F.col("toxic") + 0.5, F.col("clean") + 0.5
    return F.log(toxic / (had[1] + 1 - toxic)) - F.log(clean / (had[0] + 1 - clean)), F.sqrt(1 / toxic + 1 / clean)


def learn(docs: DataFrame, labels: DataFrame, exceptions: tuple[str, ...] = EXCEPTIONS, sizes: dict[int, int] = SAMPLE) -> Lexicon:
    """A lexicon with its curve from the labelled rows given. Without toxic or clean rows it is empty."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    texts = scratch.write(sample(docs, labels, sizes), "sample")
    shares = labels.filter("toxic IN (0, 1)").groupBy("toxic").count().collect()  # two rows
    given = {r.toxic: r["count"] for r in shares}
    had = {r.toxic: r["count"] for r in texts.groupBy("toxic").count().collect()}
    if not had.get(0) or not had.get(1):
        return Lexicon({}, exceptions, (), (0.0, 0.0, -4.0 if had.get(0) or not had else 4.0))
    sums = texts.select("text", "toxic").mapInArrow(_counts, "term string, toxic long, clean long, contexts long")
    sums = sums.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.bit_or("contexts").alias("contexts"))
    odds, error = log_odds(had)
    least = min(LEAST_DOCS, max(2, had[1] // 20))
    found = sums.filter((F.col("toxic") >= least) & (F.bit_count("contexts") >= min(LEAST_CONTEXTS, least)))
    found = found.withColumn("weight", odds).filter(F.col("weight") - error >= LEAST_ODDS)
    rows = found.orderBy(F.col("weight").desc(), "term").select("term", "weight").collect()  # in LEAST_DOCS texts of the sample at least
    weights = dict(pruned({r.term: r.weight for r in rows}))
    said = texts.select("text", "toxic").mapInArrow(_around(Lexicon(weights, exceptions)), "phrase string, toxic int")
    said = said.groupBy("phrase").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))
    calm = said.filter((F.col("clean") >= LEAST_CLEAN) & (odds + error <= 0)).orderBy("phrase").select("phrase").collect()
    lexicon = Lexicon(weights, exceptions, tuple(r.phrase for r in calm))
    measured = texts.mapInArrow(_measured(lexicon), "toxic int, weight double, words long").toPandas()  # as many rows as the sample
    measured = measured.sort_values(["toxic", "weight", "words"], ignore_index=True)  # sums then agree between runs
    balance = np.where(measured.toxic == 1, given[1] / had[1], given[0] / had[0])
    lexicon.curve = tuple(fit_curve(features(measured.weight, measured.words), measured.toxic.to_numpy(float), balance))
    return lexicon


def pruned(weights: dict[str, float]) -> Iterator[tuple[str, float]]:
    """Entries without those that begin with a shorter entry: the shorter one matches them too."""
    for term in weights:
        if not any(term[:n] in weights for n in range(SHORTEST, len(term))):
            yield term, weights[term]


def fit_curve(x: np.ndarray, y: np.ndarray, balance: np.ndarray, ridge: float = 0.01) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = logistic(x @ w)
        g = x.T @ (balance * (p - y)) + ridge * w
        h = (x * (balance * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def _measured(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [lexicon.measure(x.as_py()) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("toxic").cast(pa.int32()), pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.int64())], ["toxic", "weight", "words"])

    return run


def scored(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, score, weight (of the hits), words. A null text is empty; an empty one has the score of no hits."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)  # as much as the bounded sample gave

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = shared.value
        for batch in batches:
            found = [lexicon.measure(x.as_py()) for x in batch.column("text")]
            weight, words = np.array([f[0] for f in found]), np.array([f[1] for f in found])
            score = logistic(features(weight, words) @ np.array(lexicon.curve))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score, pa.float64()), pa.array(weight, pa.float64()), pa.array(words.astype(np.int64), pa.int64())], ["doc_id", "score", "weight", "words"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, weight double, words long")


def rate(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of `docs`; labels: doc_id, toxic.

    Held out are rows whose crc32 of the doc_id modulo 5 is 0; their labels are not looked at. Labels
    that are null or neither 0 nor 1 are not used; a document labelled twice counts as toxic if one
    label says so. Repeated rows are returned as often as given, other columns are ignored, an empty
    table gives an empty result, and without labels every score is low.
    """
    seen = labels.select("doc_id", "toxic").filter(crc_of_id(F.col("doc_id")) % 5 != 0)
    out = scored(docs, learn(docs, seen))
    return out.select("doc_id", (crc_of_id(F.col("doc_id")) % 5 == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return rate(table(spark, folder, "documents"), table(spark, folder, "labels"))
