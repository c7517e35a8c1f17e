"""Benchmark decontamination by winnowing; DataFrame functions only.

Every run of `gram` words is hashed. Of each window of `window - gram + 1` neighbouring hashes the
smallest is kept (of equal ones the first), so each run of `window` words leaves a hash that depends on those
words alone: a run shared by a document and an item always leaves the same hash in both. Kept hashes of
documents that no item has go first. Around each hash that stays, the runs of `window` words that
hold it are compared with those of the items, word for word, and the words they cover are hit.
An item shorter than a window is one run of its own; runs of such lengths are hashed whole.

A run of words meets one row: the distinct runs of all items. Runs with the same items form a
class, and documents are matched with items by their distinct sets of classes, so a passage that
stands in a large share of documents and items is never paired out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.durable import Scratch
from tallyloom.functions.bind import let
from tallyloom.llm.base import ascii_lower, keep_listed, table, text_mark
from tallyloom.llm.registry import query

WINDOW = 10
GRAM = 5
#: Words of a text hashed in one row; further words of the text are in further rows.
STRETCH = 4096
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words before lower-casing.
ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass
class Contamination:
    windows: DataFrame  # doc_id, mark, first, words, class_id: every occurrence of an item's window
    classes: DataFrame  # class_id, items: the items that share a window
    docs: DataFrame  # doc_id, mark, n_words, n_hit, item_ids: one row per row given


def words(text: Column) -> Column:
    """Words of a text in order, A to Z in lower case."""
    text = F.coalesce(text, F.lit(""))
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(ascii_lower(text))
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(0))


def _upto(first: Column, last: Column) -> Column:
    """first, first + 1 .. last; empty if last lies before first."""
    return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))


def stretches(docs: DataFrame, keys: list[str], window: int, stretch: int) -> DataFrame:
    """keys, base, ws: the words of each text in stretches; window - 1 words of the next one stand behind each."""
    parts = let(words(F.col("text")), lambda w: F.transform(
        F.when(F.size(w) > 0, F.sequence(F.lit(0), F.size(w) - 1, F.lit(stretch))).otherwise(F.array().cast("array<int>")),
        lambda b: F.struct(b.alias("base"), F.slice(w, b + 1, F.lit(stretch + window - 1)).alias("ws"))))
    return docs.select(*keys, F.explode(parts).alias("part")).select(*keys, "part.base", "part.ws")


def fingerprints(parts: DataFrame, keys: list[str], window: int, gram: int, short: list[int]) -> DataFrame:
    """keys, at, words, h: kept hashes by winnowing (words = window), and all hashes of runs of the short lengths."""
    ws, width = F.col("ws"), window - gram + 1
    grams = F.transform(_upto(F.lit(1), F.size(ws) - (gram - 1)), lambda i: F.xxhash64(F.slice(ws, i, F.lit(gram))))

    def smallest(g: Column, i: Column) -> Column:
        return let(F.slice(g, i, F.lit(width)), lambda some: i - 1 + F.array_position(some, F.array_min(some)).cast("int"))

    places = let(grams, lambda g: F.transform(
        F.array_distinct(F.transform(_upto(F.lit(1), F.size(g) - (width - 1)), lambda i: smallest(g, i))),
        lambda p: F.struct((p - 1).alias("at"), F.lit(window).alias("words"), F.get(g, p - 1).alias("h"))))
    def whole(m: int) -> Column:
        return F.transform(_upto(F.lit(1), F.size(ws) - (m - 1)), lambda i: F.struct(
            (i - 1).alias("at"), F.lit(m).alias("words"), F.xxhash64(F.slice(ws, i, F.lit(m))).alias("h")))

    found = parts.select(*keys, "base", F.explode(F.concat(places, *map(whole, short))).alias("f"))
    return found.select(*keys, (F.col("base") + F.col("f.at")).alias("at"), "f.words", "f.h")


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """item_id, words, run: the runs of each item; one, the whole item, where it is shorter than a window."""
    runs = let(words(F.col("text")), lambda w: F.transform(
        _upto(F.lit(1), F.when(F.size(w) > 0, F.greatest(F.lit(1), F.size(w) - (window - 1))).otherwise(0)),
        lambda i: F.struct(F.least(F.size(w), F.lit(window)).alias("words"), F.array_join(F.slice(w, i, F.lit(window)), " ").alias("run"))))
    return items.select(F.col("item_id").cast("string").alias("item_id"), F.explode(runs).alias("r")).select("item_id", "r.words", "r.run").distinct()


def runs_around(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """doc_id, mark, first, words, run for the runs that hold a hash found at one of `places`.

    texts: doc_id, mark, text, words, places. A run of a short length starts at its place.
    """
    width = F.when(F.col("words") == window, F.lit(window - gram + 1)).otherwise(F.lit(1))
    x = texts.withColumn("width", width).withColumn("ws", words(F.col("text")))
    last = F.size("ws") - F.col("words")
    around = F.transform("places", lambda p: _upto(F.greatest(p - F.col("width") + 1, F.lit(0)), F.least(p, last)))
    x = x.select("doc_id", "mark", "words", "ws", F.array_distinct(F.flatten(around)).alias("starts"))
    runs = F.transform("starts", lambda s: F.struct(s.alias("first"), F.array_join(F.slice("ws", s + 1, F.col("words")), " ").alias("run")))
    return x.select("doc_id", "mark", "words", F.explode(runs).alias("r")).select("doc_id", "mark", "r.first", "words", "r.run")


def covered(spans: Column) -> Column:
    """How many words the spans (first, words) cover together."""

    def add(acc: Column, s: Column) -> Column:
        stop = s["first"] + s["words"]
        more = F.greatest(F.lit(0), stop - F.greatest(s["first"], acc["upto"]))
        return F.struct((acc["n"] + more).cast("long").alias("n"), F.greatest(stop, acc["upto"]).alias("upto"))

    return F.aggregate(F.array_sort(spans), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto")), add, lambda acc: acc["n"])


def same_text(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on doc_id and mark, null ids included; keeps the left copy."""
    right = right.withColumnsRenamed({"doc_id": "right_id", "mark": "right_mark"})
    on = F.col("doc_id").eqNullSafe(F.col("right_id")) & (F.col("mark") == F.col("right_mark"))
    return left.join(right, on, how).drop("right_id", "right_mark")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM, stretch: int = STRETCH) -> Contamination:
    """Where the texts of `docs` (doc_id, text) repeat windows of `items` (item_id, text).

    Null and empty texts have no words; such an item never occurs. Rows of one id and one text are found once and
    reported for each row; one id with several texts, and null ids, keep their rows apart. Rows of one item_id are
    one item; an item without id marks words, but is in no list. item_ids are strings in string order. Other columns are
    ignored, in both tables; either may be empty. Texts of any length are read whole.
    """
    scratch = Scratch(docs.sparkSession, "decontamination")
    docs = docs.select("doc_id", "text")
    runs = scratch.write(item_windows(items.select("item_id", "text"), window), "item-runs")
    # At most window - 1 lengths.
    short = sorted(r["words"] for r in runs.filter(F.col("words") < window).select("words").distinct().collect())
    longer = stretches(items.select("text"), [], window, stretch)
    known = fingerprints(longer, [], window, gram, []).select("h").union(
        runs.filter(F.col("words") < window).select(F.xxhash64(F.split("run", " "))))
    known = scratch.write(known.distinct(), "item-hashes")

    listed = runs.groupBy("words", "run").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    listed = listed.withColumn("class_id", F.sha2(F.to_json("items"), 256))
    listed = scratch.write(listed, "distinct-runs")
    classes = scratch.write(listed.groupBy("class_id").agg(F.first("items").alias("items")), "classes")

    keyed = docs.select("doc_id", text_mark(F.col("text")).alias("mark"), "text")
    marks = fingerprints(stretches(keyed, ["doc_id", "mark"], window, stretch), ["doc_id", "mark"], window, gram, short)
    hits = marks.join(known, "h", "left_semi").groupBy("doc_id", "mark", "words").agg(F.collect_set("at").alias("places"))
    hits = scratch.write(hits, "hits")
    texts = keep_listed(docs, hits.select("doc_id", "mark").distinct()).withColumn("mark", text_mark(F.col("text")))
    around = runs_around(same_text(texts, hits, "inner"), window, gram)
    matched = scratch.write(around.join(listed.select("words", "run", "class_id"), ["words", "run"]).select("doc_id", "mark", "first", "words", "class_id"), "windows")

    found = matched.groupBy("doc_id", "mark").agg(
        covered(F.collect_set(F.struct("first", "words"))).alias("n_hit"), F.array_sort(F.collect_set("class_id")).alias("held"))
    found = scratch.write(found.withColumn("set_id", F.sha2(F.array_join("held", ","), 256)), "found")
    sets = found.groupBy("set_id").agg(F.first("held").alias("held")).select("set_id", F.explode("held").alias("class_id"))
    each = sets.join(classes, "class_id").select("set_id", F.explode_outer("items").alias("item_id"))
    lists = scratch.write(each.groupBy("set_id").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids")), "lists")

    n_words = F.coalesce(F.regexp_count("text", F.lit(ANY_CASE)), F.lit(0)).cast("long")
    rows = keyed.select("doc_id", "mark", n_words.alias("n_words"))
    out = same_text(rows, found.join(lists, "set_id").select("doc_id", "mark", "n_hit", "item_ids"), "left")
    none = F.array().cast("array<string>")
    out = out.select("doc_id", "mark", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("item_ids", none).alias("item_ids"))
    return Contamination(matched, classes, out)


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
k AS (SELECT item_id, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
i AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS run FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS s FROM k)),
g AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS run
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM i) WHERE len(w) >= n)),
h AS (SELECT doc_id, g.n, s, item_id FROM g JOIN i ON g.n = i.n AND g.run = i.run),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM h) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM h) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN l USING (doc_id)
"""


@query("op11_benchmark_decontamination", SQL)
def op11_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    out = decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark")).docs
    return out.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                      F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
