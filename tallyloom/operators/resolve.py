"""Supplier resolution: raw names to canonical suppliers, as set operations on distinct names.

Tables
    suppliers  pos, supplier, default_category, count
    aliases    pos, alias, supplier
    pending    supplier, suggested_category, first_seen, source_file, context, occurrences
    names      seq, name, context, source_file   (seq = order in which names are met)
    decisions  norm, choice                      (answers for the grey zone; choice null = none)
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.durable import Scratch
from tallyloom.functions import text
from tallyloom.operators import ordered, probe
from tallyloom.settings import DEFAULTS, Settings

TOP_K = 10
REVIEW_K = 5


@dataclass
class Book:
    suppliers: DataFrame
    aliases: DataFrame
    pending: DataFrame | None = None


@dataclass
class Resolution:
    by_name: DataFrame  # one row per distinct norm
    matches: DataFrame  # one row per input name
    learned: DataFrame  # aliases to add
    review: DataFrame  # grey-zone names with their candidates


def supplier_index(suppliers: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Suppliers with their normal form; the first row of a supplier wins."""
    tidy = suppliers.withColumn("supplier", F.trim("supplier")).where(F.col("supplier") != "")
    return ordered.first_per_key(tidy, ["supplier"], [F.col("pos")]).withColumn(
        "norm", text.normalise_name(F.col("supplier"), cfg.legal_suffixes)
    )


def alias_index(aliases: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """First alias row per normal form."""
    tidy = aliases.select("pos", F.trim("alias").alias("alias"), F.trim("supplier").alias("supplier"))
    tidy = tidy.where("alias <> '' and supplier <> ''").withColumn(
        "norm", text.normalise_name(F.col("alias"), cfg.legal_suffixes)
    )
    return ordered.first_per_key(tidy, ["norm"], [F.col("pos")])


def alias_tier(norms: DataFrame, aliases: DataFrame) -> DataFrame:
    """Names whose normal form is a known alias."""
    return norms.join(aliases.select("norm", F.col("supplier").alias("canonical")), "norm")


def exact_tier(norms: DataFrame, index: DataFrame) -> DataFrame:
    """Names whose normal form is that of a supplier; the earliest supplier wins."""
    first = index.groupBy("norm").agg(F.min_by("supplier", "pos").alias("canonical"))
    return norms.join(first, "norm")


def fuzzy_candidates(norms: DataFrame, index: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Ten best suppliers per name by token-set ratio, with the guard score for one-word suppliers."""
    return _named(probe.top_candidates(norms, index, TOP_K, cfg.dimension_slice_rows), index)


def whole_candidates(norms: DataFrame, index: DataFrame) -> DataFrame:
    """Those of fuzzy_candidates() that score 100, without holding names against the whole dimension."""
    return _named(probe.whole_candidates(norms, index, TOP_K), index)


def _named(found: DataFrame, index: DataFrame) -> DataFrame:
    dim = index.select("pos", F.col("supplier").alias("canonical"), F.col("norm").alias("canon_norm"))
    return found.join(dim, "pos")


def guard_single_word(found: DataFrame) -> DataFrame:
    """A one-word supplier must lead the descriptor, else the whole-string ratio counts."""
    single = (text.word_count(F.col("canon_norm")) == 1) & (text.word_count(F.col("norm")) > 1)
    strict = single & ~text.leads(F.col("norm"), F.col("canon_norm"))
    return found.withColumn("score", F.when(strict, F.col("plain")).otherwise(F.col("token_set")))


def compact_hits(norms: DataFrame, index: DataFrame, aliases: DataFrame) -> DataFrame:
    """(norm, canonical) where the first word is a supplier or alias written without blanks."""
    squeezed = index.select("pos", text.compact(F.col("norm")).alias("lead"), "supplier", F.lit(0).alias("src"))
    also = aliases.select("pos", text.compact(F.col("norm")).alias("lead"), "supplier", F.lit(1).alias("src"))
    first = (
        squeezed.unionByName(also)
        .where("lead is not null")
        .groupBy("lead")
        .agg(F.min_by("supplier", F.struct("src", "pos")).alias("canonical"))
    )
    lead = F.substring_index(text.strip_processor(F.col("norm")), " ", 1)
    return norms.select("norm", lead.alias("lead")).join(first, "lead").select("norm", "canonical")


def containment_hits(norms: DataFrame, index: DataFrame) -> DataFrame:
    """(norm, canonical): the longest supplier name standing as a run of words inside the name."""
    usable = index.where(F.length("norm") >= 4).select(
        F.col("norm").alias("canon_norm"), F.col("supplier").alias("canonical"), "pos"
    )
    usable = ordered.first_per_key(usable, ["canon_norm"], [F.col("pos")])
    longest = usable.agg(F.max(text.word_count(F.col("canon_norm")))).first()[0] or 1
    runs = norms.select("norm", F.explode(F.array_distinct(text.word_runs(F.col("norm"), longest))).alias("canon_norm"))
    hits = runs.join(usable, "canon_norm").where(
        (text.word_count(F.col("canon_norm")) > 1) | text.leads(F.col("norm"), F.col("canon_norm"))
    )
    return hits.groupBy("norm").agg(
        F.max_by("canonical", F.struct(F.length("canon_norm"), -F.col("pos"))).alias("canonical")
    )


def rank_candidates(
    guarded: DataFrame, compact: DataFrame, contained: DataFrame, index: DataFrame
) -> DataFrame:
    """Candidates with both boosts, ranked by score, supplier count, name length, then arrival."""
    every = (
        guarded.select("norm", "canonical", "score", F.col("place").alias("place"))
        .unionByName(compact.select("norm", "canonical", F.lit(96.0).alias("score"), F.lit(TOP_K + 1).alias("place")))
        .unionByName(contained.select("norm", "canonical", F.lit(-1.0).alias("score"), F.lit(TOP_K + 2).alias("place")))
    )
    # At most twelve rows per name: one per source and candidate.
    merged = every.groupBy("norm", "canonical").agg(
        F.max(F.when(F.col("place") <= TOP_K, F.col("score"))).alias("fuzzy"),
        F.max(F.when(F.col("place") == TOP_K + 1, F.lit(96.0))).alias("compact"),
        F.max(F.when(F.col("place") == TOP_K + 2, F.lit(95.0))).alias("contained"),
        F.min("place").alias("first_place"),
    )
    base = F.coalesce("compact", "fuzzy")
    arrival = F.when(F.col("compact").isNotNull(), TOP_K + 1).otherwise(F.col("first_place"))
    scored = merged.select(
        "norm",
        "canonical",
        F.greatest(base, F.col("contained")).alias("score"),
        arrival.alias("arrival"),
    )
    dim = index.select(
        F.col("supplier").alias("canonical"), F.col("count").alias("n"), F.length("norm").alias("len")
    )
    order = Window.partitionBy("norm").orderBy(
        F.desc("score"), F.desc(F.coalesce("n", F.lit(0))), F.desc(F.coalesce("len", F.lit(0))), "arrival"
    )
    return scored.join(dim, "canonical", "left").select(
        "norm", "canonical", "score", F.row_number().over(order).alias("rank")
    )


def route(ranked: DataFrame, norms: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """(norm, canonical, score, zone): fuzzy, review or new by the best score."""
    best = norms.select("norm").join(ranked.where("rank = 1"), "norm", "left")
    score = F.coalesce("score", F.lit(0.0))
    zone = (
        F.when(score >= cfg.auto_match_score, "fuzzy").when(score >= cfg.review_score, "review").otherwise("new")
    )
    return best.select("norm", "canonical", score.alias("score"), zone.alias("zone"))


def review_table(ranked: DataFrame, routed: DataFrame) -> DataFrame:
    """Grey-zone names with their five best candidates, for someone to decide."""
    open_names = routed.where("zone = 'review'").select("norm")
    top = ranked.where(F.col("rank") <= REVIEW_K).join(open_names, "norm")
    return top.groupBy("norm").agg(
        F.array_sort(F.collect_list(F.struct("rank", "canonical", "score"))).alias("candidates")
    )


def resolve_norms(
    norms: DataFrame, book: Book, cfg: Settings = DEFAULTS, decisions: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(norm, canonical, score, method) for distinct names, and the review table."""
    # Both indexes, names and candidates are read by several steps; each is computed once and written.
    scratch = Scratch(norms.sparkSession, "resolve")
    index = scratch.write(supplier_index(book.suppliers, cfg), "index")
    aliases = scratch.write(alias_index(book.aliases, cfg), "aliases")
    norms = scratch.write(norms, "norms")
    by_alias = alias_tier(norms, aliases)
    rest = norms.join(by_alias, "norm", "left_anti")
    by_exact = exact_tier(rest, index)
    rest = scratch.write(rest.join(by_exact, "norm", "left_anti"), "rest")

    def rank(names: DataFrame, found: DataFrame) -> DataFrame:
        return rank_candidates(
            guard_single_word(found), compact_hits(names, index, aliases), containment_hits(names, index), index
        )

    # No candidate scores more than 100, and each that scores it is among the whole ones: where one of them comes
    # first with 100 it is the best of all. The names left are held against the whole dimension.
    whole = rank(rest, whole_candidates(rest, index)).where(F.lit(cfg.auto_match_score <= 100.0) & (F.col("rank") == 1) & (F.col("score") == 100.0))
    whole = scratch.write(whole, "whole")
    left = scratch.write(rest.join(whole, "norm", "left_anti"), "left")
    ranked = scratch.write(rank(left, fuzzy_candidates(left, index, cfg)), "ranked").unionByName(whole)
    routed = route(ranked, rest, cfg)
    review = review_table(ranked, routed)

    if decisions is None:
        chosen = routed.select("norm", F.lit(None).cast("string").alias("choice"), F.lit(None).cast("double").alias("choice_score"))
    else:
        offered = ranked.where(F.col("rank") <= REVIEW_K).select(
            "norm", F.col("canonical").alias("choice"), F.col("score").alias("choice_score")
        )
        chosen = ordered.first_per_key(decisions.select("norm", "choice"), ["norm"], [F.col("choice")]).join(
            offered, ["norm", "choice"]
        )
    judged = routed.join(chosen, "norm", "left")
    by_model = (F.col("zone") == "review") & F.col("choice").isNotNull()
    late = judged.select(
        "norm",
        F.when(F.col("zone") == "fuzzy", F.col("canonical")).when(by_model, F.col("choice")).alias("canonical"),
        F.when(by_model, F.col("choice_score")).otherwise(F.col("score")).alias("score"),
        F.when(F.col("zone") == "fuzzy", "fuzzy").when(by_model, "model").otherwise("new").alias("method"),
    )
    early = by_alias.withColumn("method", F.lit("alias")).unionByName(by_exact.withColumn("method", F.lit("exact")))
    early = early.withColumn("score", F.lit(100.0))
    return early.select("norm", "canonical", "score", "method").unionByName(late), review


def resolve(
    names: DataFrame, book: Book, cfg: Settings = DEFAULTS, decisions: DataFrame | None = None
) -> Resolution:
    """Resolve every input name. The first use of a fuzzy or decided name reports that method;
    later uses of the same normal form find the alias it left behind."""
    keyed = names.withColumn("norm", text.normalise_name(F.col("name"), cfg.legal_suffixes)).withColumn(
        "blank", F.trim(F.coalesce("name", F.lit(""))) == ""
    )
    norms = keyed.where(~F.col("blank")).select("norm").distinct()
    by_name, review = resolve_norms(norms, book, cfg, decisions)
    first = keyed.where(~F.col("blank")).groupBy("norm").agg(
        F.min("seq").alias("first_seq"), F.min_by("name", "seq").alias("first_name")
    )
    by_name = by_name.join(first, "norm")

    categories = supplier_index(book.suppliers, cfg).select(
        F.col("supplier").alias("canonical"), F.trim("default_category").alias("supplier_category")
    )
    by_name = by_name.join(categories, "canonical", "left")
    if book.pending is not None:
        hints = (
            book.pending.select(
                text.normalise_name(F.col("supplier"), cfg.legal_suffixes).alias("norm"), "suggested_category"
            )
            .groupBy("norm")
            .agg(F.max("suggested_category").alias("suggested"))
        )
        by_name = by_name.join(hints, "norm", "left")
    else:
        by_name = by_name.withColumn("suggested", F.lit(None).cast("string"))

    is_new = F.coalesce(F.col("method"), F.lit("new")) == "new"
    later = F.col("method").isin("fuzzy", "model") & (F.col("seq") > F.col("first_seq"))
    category = F.when(is_new, F.col("suggested")).otherwise(F.col("supplier_category"))
    joined = keyed.join(by_name.withColumnRenamed("norm", "found_norm"), ~F.col("blank") & (F.col("norm") == F.col("found_norm")), "left")
    matches = joined.select(
        *names.columns,
        "norm",
        F.when(~is_new, F.col("canonical")).alias("canonical"),
        F.when(category != "", category).alias("default_category"),
        F.when(later, 100.0).otherwise(F.coalesce("score", F.lit(0.0))).alias("score"),
        F.when(later, "alias").otherwise(F.coalesce("method", F.lit("new"))).alias("method"),
        is_new.alias("is_new"),
    )
    learned = learn_aliases(by_name, book, cfg)
    return Resolution(by_name, matches, learned, review)


def learn_aliases(by_name: DataFrame, book: Book, cfg: Settings = DEFAULTS) -> DataFrame:
    """(alias, supplier) of fuzzy and decided names, once per normal form."""
    fresh = by_name.where(F.col("method").isin("fuzzy", "model")).where(
        F.col("norm") != text.normalise_name(F.col("canonical"), cfg.legal_suffixes)
    )
    known = alias_index(book.aliases, cfg).select("norm")
    return fresh.join(known, "norm", "left_anti").select(
        F.col("first_seq").alias("seq"), F.col("first_name").alias("alias"), F.col("canonical").alias("supplier")
    )


def accumulate_pending(
    matches: DataFrame, pending: DataFrame, run_ts: str, cfg: Settings = DEFAULTS
) -> DataFrame:
    """Pending suppliers after a run: occurrences add up, everything first seen is kept."""
    new = matches.where(F.col("is_new") & (F.trim(F.coalesce("name", F.lit(""))) != ""))
    met = new.groupBy("norm").agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by(F.struct(F.trim("name").alias("supplier"), "source_file", "context"), "seq").alias("first"),
    )
    old = pending.select(
        text.normalise_name(F.col("supplier"), cfg.legal_suffixes).alias("norm"),
        F.struct("supplier", "suggested_category", "first_seen", "source_file", "context").alias("kept"),
        "occurrences",
    )
    fresh = F.struct(
        F.col("first.supplier").alias("supplier"),
        F.lit("").alias("suggested_category"),
        F.lit(run_ts).cast("timestamp").alias("first_seen"),
        F.coalesce("first.source_file", F.lit("")).alias("source_file"),
        F.coalesce("first.context", F.lit("")).alias("context"),
    )
    occurrences = F.coalesce("occurrences", F.lit(0)) + F.coalesce("n", F.lit(0))
    return (
        old.join(met, "norm", "full_outer")
        .withColumn("row", F.coalesce("kept", fresh))
        .select("row.*", occurrences.cast("bigint").alias("occurrences"))
    )


def approve(
    approvals: DataFrame, suppliers: DataFrame, pending: DataFrame, categories: DataFrame, cfg: Settings = DEFAULTS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(suppliers, pending, rejected) after approving (seq, name, category) rows.

    A row with an unknown category is rejected; approved suppliers start with count 0.
    """
    known = categories.select(F.lower(F.trim("category")).alias("key"), F.trim("category").alias("spelled"))
    known = known.groupBy("key").agg(F.min("spelled").alias("spelled"))
    asked = approvals.withColumn("key", F.lower(F.trim("category"))).join(known, "key", "left")
    valid = F.col("spelled").isNotNull() & (F.trim("name") != "")
    ok = asked.where(valid)
    last = suppliers.agg(F.coalesce(F.max("pos"), F.lit(-1)).alias("last")).first()["last"]
    added = ok.select(
        (F.col("seq") + last + 1).alias("pos"),
        F.trim("name").alias("supplier"),
        F.col("spelled").alias("default_category"),
        F.lit(0).cast("bigint").alias("count"),
    )
    gone = ok.select(text.normalise_name(F.col("name"), cfg.legal_suffixes).alias("norm")).distinct()
    kept = (
        pending.withColumn("norm", text.normalise_name(F.col("supplier"), cfg.legal_suffixes))
        .join(gone, "norm", "left_anti")
        .drop("norm")
    )
    base = suppliers.select("pos", "supplier", "default_category", F.col("count").cast("bigint").alias("count"))
    return base.unionByName(added), kept, asked.where(~valid).select("seq", "name", "category")


def suggest_duplicates(suppliers: DataFrame, least: float = 85.0, cfg: Settings = DEFAULTS) -> DataFrame:
    """Likely double suppliers: (score, supplier_a, count_a, supplier_b, count_b, suggested_canonical)."""
    index = supplier_index(suppliers, cfg)
    pairs = probe.similar_pairs(index, least)

    def side(p: str) -> DataFrame:
        return index.select(
            F.col("pos").alias(f"pos_{p}"), F.col("supplier").alias(f"supplier_{p}"),
            F.coalesce("count", F.lit(0)).cast("bigint").alias(f"count_{p}"),
        )

    out = pairs.join(side("a"), "pos_a").join(side("b"), "pos_b")
    more_a = (F.col("count_a") > F.col("count_b")) | (
        (F.col("count_a") == F.col("count_b")) & (F.length("supplier_a") >= F.length("supplier_b"))
    )
    return out.select(
        F.when(F.col("leads"), 100.0).otherwise(F.col("token_set")).alias("score"),
        "supplier_a", "count_a", "supplier_b", "count_b",
        F.when(more_a, F.col("supplier_a")).otherwise(F.col("supplier_b")).alias("suggested_canonical"),
    )
