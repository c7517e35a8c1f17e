"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of 1 to 3 characters of the lower-cased text are hashed into a fixed number of features. A
feature's weight in a document is its share of the document's n-grams times its inverse document
frequency, counted over all documents the model may learn from. The classes are fitted one against all
others by follow-the-regularised-leader with elastic-net penalties, on a bounded sample of labelled
rows, jointly through the softmax; a temperature is then fitted on rows left out of the fit.

Term shares make a document's score a mean over its n-grams, so texts of any length are scored in
slices, whole and without any per-document table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.base import crc_of_id, table
from tallyloom.llm.registry import query

ORDERS = (1, 2, 3)
FEATURES = 1 << 15
#: Labelled rows fitted on at most, for each language: the bound of the training sample.
SAMPLE_PER_LANGUAGE = 400
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
#: Features are means of many small shares; scaled so that steps have a usual size.
SCALE = 20.0
#: Characters handled at once; bounds memory for very long texts.
SLAB = 1 << 20
LETTER = regex.compile(r"\p{L}")


def hashed(codes: np.ndarray, order: int, features: int = FEATURES) -> np.ndarray:
    """Feature of each n-gram that starts in a run of code points."""
    n = len(codes) - order + 1
    if n <= 0:
        return np.empty(0, np.int64)
    x = np.full(n, order, np.uint32)
    for k in range(order):
        x = (x ^ codes[k:k + n]) * np.uint32(0x9E3779B1)
        x ^= x >> np.uint32(15)
    return (x % np.uint32(features)).astype(np.int64)


def slices(text: str) -> Iterator[np.ndarray]:
    """Code points of the lower-cased text in slices that overlap by the longest n-gram less one."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    for at in range(0, max(1, len(codes)), SLAB):
        yield codes[at:at + SLAB + max(ORDERS) - 1]


def grams(text: str) -> np.ndarray:
    """All features of a whole text, each n-gram once per occurrence."""
    out = []
    for piece in slices(text):
        for order in ORDERS:
            # The overlap belongs to the next slice, but for the n-grams that start in this one.
            out.append(hashed(piece[: SLAB + order - 1], order))
    return np.concatenate(out) if out else np.empty(0, np.int64)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # features x languages, inverse document frequency included
    bias: np.ndarray
    temperature: float
    tested: bool = True  # rows left out of the fit were named right more often than by chance

    def scores(self, text: str) -> np.ndarray:
        total, count = np.zeros(len(self.languages)), 0
        for piece in slices(text):
            for order in ORDERS:
                found = hashed(piece[: SLAB + order - 1], order)
                total += np.bincount(found, minlength=len(self.weights)) @ self.weights if len(found) > len(self.weights) else self.weights[found].sum(axis=0, dtype=np.float64)
                count += len(found)
        return total * SCALE / max(1, count) + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not LETTER.search(text):
            return "und", 0.0
        z = self.scores(text) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def document_frequencies(docs: DataFrame, features: int = FEATURES) -> np.ndarray:
    """Documents that hold each feature, over all rows; last comes the number of documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, seen = np.zeros(features + 1, np.int64), np.zeros(features, bool)
        for batch in batches:
            for x in batch.column("text"):
                seen[grams(x.as_py())] = True
                df[:-1] += seen
                df[-1] += 1
                seen[:] = False
        yield pa.RecordBatch.from_arrays([pa.array(range(features + 1), pa.int32()), pa.array(df, pa.int64())], ["feature", "df"])

    sums = docs.filter(F.col("text").isNotNull()).select("text").mapInArrow(count, "feature int, df long").groupBy("feature").agg(F.sum("df").alias("df"))
    out = np.zeros(features + 1, np.int64)
    for r in sums.toLocalIterator():  # a fixed number of features, whatever the corpus
        out[r.feature] = r.df
    return out


def sample(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> list[tuple[str, str]]:
    """At most `per_language` labelled (lang, text) for each language, one for an id, the same ones at every run."""
    mark = F.xxhash64(F.col("doc_id"), F.lit(11))
    ids = docs.select("lang", "doc_id", mark.alias("mark")).groupBy("lang", F.pmod("mark", F.lit(per_language)).alias("slot")).agg(F.min(F.struct("mark", "doc_id")).alias("one"))
    chosen = ids.select(F.col("one.doc_id").alias("id"), F.col("lang").alias("language"))
    # Bounded by the sample's size, whatever the table holds.
    rows = docs.join(F.broadcast(chosen), (F.col("doc_id") == F.col("id")) & (F.col("lang") == F.col("language"))).select("doc_id", "lang", "text")
    # One text of each id, however often the id is there.
    rows = rows.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    return [(r.lang, r.text) for r in sorted(rows.collect(), key=lambda r: (str(r.doc_id), r.lang, r.text))]


def fit(rows: list[tuple[str, str]], df: np.ndarray) -> Model:
    """FTRL-proximal with elastic net over the rows, then a temperature on every fifth row, left out of the fit."""
    languages = sorted({lang for lang, _ in rows})
    if not languages:
        return Model([], np.zeros((FEATURES, 0), np.float32), np.zeros(0), 1.0)
    idf = np.log((1.0 + df[-1]) / (1.0 + df[:-1])) + 1.0
    data = []
    for lang, text in rows:
        found, counts = np.unique(grams(text), return_counts=True)
        if len(found):
            data.append((found, counts / counts.sum() * idf[found] * SCALE, languages.index(lang)))
    order = np.random.default_rng(3).permutation(len(data))
    held, kept = [data[i] for i in order[::5]], [data[i] for i in order if i not in set(order[::5].tolist())] or data
    z = np.zeros((FEATURES + 1, len(languages)))
    n = np.zeros_like(z)

    def weights(at: np.ndarray) -> np.ndarray:
        zs = z[at]
        return np.where(np.abs(zs) <= L1, 0.0, -(zs - np.sign(zs) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    def softmax(x: np.ndarray) -> np.ndarray:
        e = np.exp(x - x.max())
        return e / e.sum()

    for epoch in range(EPOCHS):
        for i in np.random.default_rng(epoch).permutation(len(kept)):
            found, values, lang = kept[i]
            at, x = np.append(found, FEATURES), np.append(values, 1.0)  # the last one is the bias
            w = weights(at)
            p = softmax(x @ w)
            p[lang] -= 1.0
            g = x[:, None] * p
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights(np.arange(FEATURES + 1))
    logits = [(x @ w[found] + w[-1], lang) for found, x, lang in held]

    def loss(t: float) -> float:
        return -sum(np.log(max(softmax(s / t)[lang], 1e-12)) for s, lang in logits)

    temperature = min(np.geomspace(0.05, 5.0, 60), key=loss) if logits else 1.0
    right = sum(int(np.argmax(s)) == lang for s, lang in logits)
    return Model(languages, (w[:-1] * idf[:, None]).astype(np.float32), w[-1], float(temperature), right * len(languages) > len(logits))


def train(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """A model from all rows of `docs` (doc_id, text, lang); frequencies from all of them, the fit from a bounded sample."""
    texts = docs.filter(F.col("text").isNotNull())
    return fit(sample(texts.filter(F.col("lang").isNotNull()), per_language), document_frequencies(texts))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of `docs` plus lang_pred and score; a null text or one without a letter is `und` with score 0."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # a fixed number of features for each language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = [model.predict(x.as_py()) for x in batch.column("text")]
            lang, score = pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())
            kept = [c for c in batch.schema.names if c not in ("lang_pred", "score")]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], lang, score], [*kept, "lang_pred", "score"])

    kept = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], "lang_pred string", "score double"])
    return docs.mapInArrow(run, schema)


def learnable(docs: DataFrame) -> DataFrame:
    return docs.filter(crc_of_id(F.col("doc_id")) % 4 != 2)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; learns from rows with a label that are not held out.

    Held out are rows whose crc32 of the doc_id modulo 4 is 2. Null or empty texts and texts without
    a letter are `und` with score 0; without any label all rows are. Repeated rows are returned as often
    as given, other columns are ignored, an empty table gives an empty result.
    """
    rows = docs.select("doc_id", "text")
    held = (crc_of_id(F.col("doc_id")) % 4 == 2).alias("held_out")
    out = predict(rows.select("doc_id", held, "text"), train(learnable(docs.select("doc_id", "text", "lang"))))
    return out.select("doc_id", "held_out", "lang_pred", "score")


#: A document whose best language is less likely than this multiple of chance is in none of them: 0.3 among four
#: languages. Short texts and texts in two of several languages score low but stay.
LEAST_OVER_CHANCE = 1.2


def least_score(model: Model, over_chance: float = LEAST_OVER_CHANCE) -> float:
    """The lowest score that is taken: none is too low if the model was not tested, and a single language scores 1."""
    return min(1.0, over_chance / len(model.languages)) if model.tested else 0.0


def in_a_language(docs: DataFrame, over_chance: float = LEAST_OVER_CHANCE) -> DataFrame:
    """The rows of `docs` whose text is in one of the learned languages, with all their columns.

    Where no language was learned, every row whose text has a letter stays.
    """
    model = train(learnable(docs))
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    own = {c: f"__{c}" for c in docs.columns if c in ("lang_pred", "score")}  # columns of that name are kept as they are
    found = predict(docs.withColumnsRenamed(own), model)
    kept = found.filter((F.col("lang_pred") != "und") & (F.col("score") >= least_score(model, over_chance)))
    return kept.select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])


@query("op4_language_id")
def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return identify(table(spark, folder, "documents"))
