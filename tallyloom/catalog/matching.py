"""Entity resolution and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.catalog.base import day, query, sql_fold, sql_lcs, sql_norm, sql_partial, sql_strip_processor, sql_token_set
from tallyloom.durable import Scratch
from tallyloom.functions import money, scorers, text
from tallyloom.operators import matching, profile, reconcile, resolve, state
from tallyloom.settings import NO_BANK_TXN_NOTE, NO_RECEIPT_NOTE, Settings

RUN = "2024-05-06 07:08:09"

# --- resolver, in SQL, step by step -------------------------------------------------------------
_STEPS = f"""WITH dim AS (SELECT supplier, min(pos) AS pos, arg_min(default_category, pos) AS default_category,
                      arg_min(count, pos) AS n FROM v_suppliers GROUP BY supplier),
  dims AS (SELECT *, {sql_norm('supplier')} AS canon FROM dim),
  ali AS (SELECT norm, arg_min(supplier, pos) AS canonical, min(pos) AS pos FROM (SELECT pos, supplier, {sql_norm('alias')} AS norm
          FROM v_aliases) GROUP BY norm),
  nm AS (SELECT *, {sql_norm('name')} AS norm FROM v_names),
  norms AS (SELECT DISTINCT norm FROM nm),
  tier1 AS (SELECT norm, canonical FROM norms JOIN ali USING (norm)),
  exact AS (SELECT canon AS norm, arg_min(supplier, pos) AS canonical FROM dims GROUP BY canon),
  tier2 AS (SELECT norm, canonical FROM norms JOIN exact USING (norm) WHERE norm NOT IN (SELECT norm FROM tier1)),
  rest AS (SELECT norm, {sql_strip_processor('norm')} AS lead FROM norms WHERE norm NOT IN (SELECT norm FROM tier1)
           AND norm NOT IN (SELECT norm FROM tier2))"""
_BOOSTS = _STEPS + """,
  lead1 AS (SELECT norm, string_split(lead, ' ')[1] AS w FROM rest),
  compacts AS (SELECT c, arg_min(supplier, (src, pos)) AS canonical FROM (
      SELECT replace(canon, ' ', '') AS c, supplier, 0 AS src, pos FROM dims
      UNION ALL SELECT replace(norm, ' ', ''), canonical, 1, pos FROM ali) WHERE length(c) >= 5 GROUP BY c),
  comp AS (SELECT norm, canonical FROM lead1 JOIN compacts ON c = w),
  cont AS (SELECT norm, arg_max(supplier, (length(canon), -pos)) AS canonical FROM rest JOIN dims
           ON length(canon) >= 4 AND contains(' ' || norm || ' ', ' ' || canon || ' ')
           AND (contains(canon, ' ') OR starts_with(lead || ' ', canon || ' ')) GROUP BY norm)"""


_SINGLE = "NOT contains(canon, ' ') AND contains(norm, ' ') AND NOT starts_with(lead || ' ', canon || ' ')"


def _sql_guarded(names: str, dims: str) -> str:
    """DuckDB: (norm, pos, place, token_set, canonical, score): ten best of `dims` per name of `names`, one-word guard applied."""
    plain = f"200.0::DOUBLE * {sql_lcs('norm', 'canon')} / (length(norm) + length(canon))"
    return f"""SELECT norm, pos, place, token_set, supplier AS canonical, CASE WHEN {_SINGLE} THEN {plain} ELSE token_set END AS score
        FROM (SELECT norm, pos, score AS token_set, row_number() OVER (PARTITION BY norm ORDER BY score DESC, pos) AS place
              FROM ({sql_token_set(f"(SELECT norm, pos, norm AS x, canon AS y FROM {names} CROSS JOIN {dims})", "norm, pos")}))
             JOIN {dims} USING (pos) JOIN {names} USING (norm) WHERE place <= 10"""


_RANKED = f"""{_BOOSTS},
  guarded AS ({_sql_guarded("rest", "dims")}),
  every AS (SELECT norm, canonical, score, place FROM guarded UNION ALL SELECT norm, canonical, 96.0, 11 FROM comp UNION ALL SELECT norm, canonical, 95.0, 12 FROM cont),
  merged AS (SELECT norm, canonical, coalesce(max(score) FILTER (place = 11), max(score) FILTER (place <= 10)) AS base, max(score) FILTER (place = 12) AS contained,
             CASE WHEN bool_or(place = 11) THEN 11 ELSE min(place) END AS arrival FROM every GROUP BY norm, canonical),
  ranked AS (SELECT norm, canonical, greatest(base, contained) AS score, row_number() OVER (PARTITION BY norm
             ORDER BY greatest(base, contained) DESC, n DESC, length(canon) DESC, arrival) AS rank FROM merged JOIN dims ON supplier = canonical),
  routed AS (SELECT norm, canonical, coalesce(score, 0) AS score, CASE WHEN score >= 92 THEN 'fuzzy' WHEN score >= 70 THEN 'review' ELSE 'new' END AS zone
             FROM rest LEFT JOIN (SELECT * FROM ranked WHERE rank = 1) USING (norm)),
  resolved AS (SELECT norm, canonical, 100.0 AS score, 'alias' AS method FROM tier1 UNION ALL SELECT norm, canonical, 100.0, 'exact' FROM tier2
               UNION ALL SELECT norm, CASE zone WHEN 'fuzzy' THEN canonical END, score, CASE zone WHEN 'fuzzy' THEN 'fuzzy' ELSE 'new' END FROM routed),
  firsts AS (SELECT norm, min(seq) AS first_seq, arg_min(name, seq) AS first_name FROM nm GROUP BY norm)"""


class _Names:
    """Resolver inputs over the adapter views."""

    def __init__(self, t):
        self.book = resolve.Book(t.v_suppliers, t.v_aliases)
        self.names = t.v_names.select("seq", "name", "context", "source_file")
        scratch = Scratch(t.spark, "names")
        self.index = scratch.write(resolve.supplier_index(t.v_suppliers), "index")
        self.aliases = scratch.write(resolve.alias_index(t.v_aliases), "aliases")
        self.norms = self.names.select(text.normalise_name(F.col("name")).alias("norm")).distinct()
        known = resolve.alias_tier(self.norms, self.aliases)
        rest = self.norms.join(known, "norm", "left_anti")
        self.rest = scratch.write(rest.join(resolve.exact_tier(rest, self.index), "norm", "left_anti"), "rest")

    def ranked(self):
        return resolve.rank_candidates(
            resolve.guard_single_word(resolve.fuzzy_candidates(self.rest, self.index)),
            resolve.compact_hits(self.rest, self.index, self.aliases),
            resolve.containment_hits(self.rest, self.index), self.index,
        )


@query("E-1", f"{_STEPS} SELECT norm, canonical FROM tier1")
def _(t):
    n = _Names(t)
    return resolve.alias_tier(n.norms, n.aliases)


@query("E-2", f"{_STEPS} SELECT norm, canonical FROM norms JOIN exact USING (norm)")
def _(t):
    n = _Names(t)
    return resolve.exact_tier(n.norms, n.index)


@query("E-3", f"{_BOOSTS} SELECT norm, pos, place::INT AS place, round(token_set, 6) AS score FROM ({_sql_guarded('rest', 'dims')})")
def _(t):
    n = _Names(t)
    found = resolve.fuzzy_candidates(n.rest, n.index)
    return found.select("norm", "pos", "place", F.round("token_set", 6).alias("score"))


# Every name of the table against one-word suppliers: a word standing alone must lead the descriptor.
@query(
    "E-4",
    f"""{_STEPS}, word AS (SELECT supplier, min(pos) AS pos, {sql_norm('supplier')} AS canon FROM (
            SELECT pos, string_split(supplier, ' ')[-1] AS supplier FROM v_suppliers) GROUP BY supplier),
        named AS (SELECT norm, {sql_strip_processor('norm')} AS lead FROM norms)
        SELECT norm, canonical, round(score, 6) AS score FROM ({_sql_guarded('named', 'word')})""",
)
def _(t):
    single = t.v_suppliers.withColumn("supplier", F.substring_index("supplier", " ", -1))
    n = _Names(t)
    found = resolve.guard_single_word(resolve.fuzzy_candidates(n.norms, resolve.supplier_index(single)))
    return found.select("norm", "canonical", F.round("score", 6).alias("score"))


@query("E-5", f"{_BOOSTS} SELECT norm, canonical FROM comp")
def _(t):
    n = _Names(t)
    return resolve.compact_hits(n.rest, n.index, n.aliases)


@query("E-6", f"{_BOOSTS} SELECT norm, canonical FROM cont")
def _(t):
    n = _Names(t)
    return resolve.containment_hits(n.rest, n.index)


@query("E-7", f"{_RANKED} SELECT norm, canonical, round(score, 6) AS score, rank::INT AS rank FROM ranked")
def _(t):
    return _Names(t).ranked().select("norm", "canonical", F.round("score", 6).alias("score"), "rank")


@query("E-8", f"{_RANKED} SELECT norm, canonical, round(score, 6) AS score, zone FROM routed")
def _(t):
    n = _Names(t)
    return resolve.route(n.ranked(), n.rest).withColumn("score", F.round("score", 6))


@query("SRT-2", f"{_RANKED} SELECT norm, count(*) AS offered FROM ranked JOIN routed USING (norm) WHERE zone = 'review' AND rank <= 5 GROUP BY norm")
def _(t):
    n = _Names(t)
    ranked = Scratch(t.spark, "ranked").write(n.ranked(), "ranked")
    return resolve.review_table(ranked, resolve.route(ranked, n.rest)).select(
        "norm", F.size("candidates").cast("bigint").alias("offered")
    )


@query(
    "E-9",
    f"""{_RANKED} SELECT seq, coalesce(canonical, '') AS canonical, coalesce(trim(default_category), '') AS category,
            round(CASE WHEN method = 'fuzzy' AND seq > first_seq THEN 100.0 ELSE score END, 6) AS score,
            CASE WHEN method = 'fuzzy' AND seq > first_seq THEN 'alias' ELSE method END AS method
        FROM nm JOIN resolved USING (norm) JOIN firsts USING (norm) LEFT JOIN dim ON supplier = canonical""",
)
def _(t):
    n = _Names(t)
    return resolve.resolve(n.names, n.book).matches.select(
        "seq", F.coalesce("canonical", F.lit("")).alias("canonical"), F.coalesce("default_category", F.lit("")).alias("category"),
        F.round("score", 6).alias("score"), "method",
    )


@query(
    "E-10",
    f"""{_RANKED} SELECT first_seq AS seq, first_name AS alias, canonical AS supplier FROM resolved JOIN firsts USING (norm) JOIN dims ON supplier = canonical
        WHERE method = 'fuzzy' AND norm <> canon AND norm NOT IN (SELECT norm FROM ali)""",
)
def _(t):
    n = _Names(t)
    return resolve.resolve(n.names, n.book).learned


def _pending(t):
    return t.v_names.where("context = '4-NOT SPECIFIED'").groupBy("name").agg(F.min("source_file").alias("source_file")).select(
        F.col("name").alias("supplier"), F.lit("OFFICE").alias("suggested_category"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("first_seen"), "source_file", F.lit("before").alias("context"),
        F.lit(2).cast("bigint").alias("occurrences"),
    )


@query(
    "E-11",
    f"""{_STEPS}, seen AS (SELECT norm, count(*) AS n, arg_min(trim(name), seq) AS first_name FROM nm GROUP BY norm),
        old AS (SELECT {sql_norm('name')} AS norm, name FROM (SELECT DISTINCT name FROM v_names WHERE context = '4-NOT SPECIFIED'))
        SELECT coalesce(old.name, first_name) AS supplier, CASE WHEN old.norm IS NULL THEN '' ELSE 'OFFICE' END AS suggested_category,
               coalesce(n, 0) + CASE WHEN old.norm IS NULL THEN 0 ELSE 2 END AS occurrences FROM old FULL JOIN seen ON seen.norm = old.norm""",
)
def _(t):
    # Every name counts as new here, so the accumulation meets both known and unknown spellings.
    matches = t.v_names.withColumn("norm", text.normalise_name(F.col("name"))).withColumn("is_new", F.lit(True))
    return resolve.accumulate_pending(matches, _pending(t), RUN).select("supplier", "suggested_category", "occurrences")


@query(
    "E-12",
    f"""SELECT supplier, default_category, count FROM v_suppliers UNION ALL
        SELECT c_name, c_mktsegment, 0 FROM @customer WHERE c_mktsegment IN ('BUILDING', 'FURNITURE')""",
)
def _(t):
    asked = t.customer.select(F.col("c_custkey").alias("seq"), F.col("c_name").alias("name"), F.lower("c_mktsegment").alias("category"))
    known = t.customer.select(F.col("c_mktsegment").alias("category")).distinct().where("category in ('BUILDING', 'FURNITURE')")
    suppliers, _pend, _rejected = resolve.approve(asked, t.v_suppliers, _pending(t), known)
    return suppliers.select("supplier", "default_category", "count")


_DUP = f"""WITH dim AS (SELECT supplier, min(pos) AS pos, arg_min(count, pos) AS n FROM v_suppliers GROUP BY supplier),
  dims AS (SELECT *, {sql_norm('supplier')} AS canon FROM dim),
  pairs AS (SELECT a.pos AS pa, b.pos AS pb, a.canon AS x, b.canon AS y FROM dims a JOIN dims b ON a.pos < b.pos),
  scored AS ({sql_token_set('pairs', 'pa, pb')}),
  hits AS (SELECT *, starts_with(x || ' ', y || ' ') OR starts_with(y || ' ', x || ' ') AS led FROM scored),
  shown AS (SELECT CASE WHEN led THEN 100.0::DOUBLE ELSE score END AS score, a.supplier AS supplier_a, a.n AS count_a,
      b.supplier AS supplier_b, b.n AS count_b, CASE WHEN a.n > b.n OR (a.n = b.n AND length(a.supplier) >= length(b.supplier))
      THEN a.supplier ELSE b.supplier END AS suggested_canonical FROM hits JOIN dims a ON a.pos = pa JOIN dims b ON b.pos = pb
      WHERE score >= 85 OR (led AND least(length(x), length(y)) >= 4))"""


@query("E-13", f"{_DUP} SELECT * REPLACE (round(score, 6) AS score) FROM shown")
def _(t):
    return resolve.suggest_duplicates(t.v_suppliers).withColumn("score", F.round("score", 6))


@query("SRT-4", f"{_DUP} SELECT round(score, 4) AS score, supplier_a, supplier_b FROM shown ORDER BY score DESC, lower(supplier_a)")
def _(t):
    pairs = resolve.suggest_duplicates(t.v_suppliers).select(F.round("score", 4).alias("score"), "supplier_a", "supplier_b")
    return pairs.orderBy(F.desc("score"), F.lower("supplier_a"))


@query("SNK-7", f"{_DUP} SELECT printf('%.1f', score) AS score, supplier_a, count_a::VARCHAR AS count_a, supplier_b, count_b::VARCHAR AS count_b, suggested_canonical FROM shown")
def _(t):
    path = f"{Scratch(t.spark, 'report').root}/duplicates"
    pairs = resolve.suggest_duplicates(t.v_suppliers).withColumn("score", F.format_number("score", 1))
    pairs.write.option("header", "true").csv(path)
    return t.spark.read.option("header", "true").csv(path)


@query(
    "UDF-1",
    f"""WITH f AS (SELECT txn_seq, {sql_fold('description')} AS x, {sql_fold('company')} AS y FROM v_bank JOIN v_purchases ON row_id = txn_seq)
        SELECT txn_seq, round(200.0::DOUBLE * {sql_lcs('x', 'y')} / (length(x) + length(y)), 6) AS indel, round(score, 6) AS token_set, round({sql_partial('x', 'y')}, 6) AS partial,
               round(100.0::DOUBLE * (1.0::DOUBLE - levenshtein(x, y)::DOUBLE / greatest(length(x), length(y))), 6) AS levenshtein
        FROM f JOIN (SELECT txn_seq, score FROM ({sql_token_set('f', 'txn_seq')})) USING (txn_seq)""",
)
def _(t):
    fold = text.ascii_fold(F.col("description"))
    pairs = t.v_bank.join(t.v_purchases.select(F.col("row_id").alias("txn_seq"), text.ascii_fold(F.col("company")).alias("company")), "txn_seq")
    return pairs.select(
        "txn_seq", *[F.round(scorers.scorer(n)(fold, F.col("company")), 6).alias(n) for n in ("indel", "token_set", "partial", "levenshtein")]
    )


@query("UDF-3", f"{_RANKED} SELECT norm, ranked.canonical AS canonical FROM ranked JOIN routed USING (norm) WHERE zone = 'review' AND rank = 2")
def _(t):
    n = _Names(t)
    ranked = Scratch(t.spark, "ranked").write(n.ranked(), "ranked")
    grey = resolve.route(ranked, n.rest).where("zone = 'review'").select("norm")
    decisions = ranked.where("rank = 2").join(grey, "norm").select("norm", F.col("canonical").alias("choice"))
    by_norm, _review = resolve.resolve_norms(n.norms, n.book, decisions=decisions)
    return by_norm.where("method = 'model'").select("norm", "canonical")


@query(
    "E-14",
    f"""SELECT supplier, first_value(supplier) OVER (PARTITION BY {sql_fold('supplier')} ORDER BY n DESC, first_idx) AS canonical
        FROM (SELECT company AS supplier, count(*) AS n, min(idx) AS first_idx FROM v_history GROUP BY company)""",
)
def _(t):
    return profile.fold_spellings(profile.spelling_profiles(t.v_history))


# --- reconciliation ----------------------------------------------------------------------------
_CANDIDATES = """SELECT t.txn_seq, r.row_id, abs(date_diff('day', t.date, r.date)) AS gap FROM v_bank t JOIN v_purchases r
                 ON t.cents = r.cents AND abs(date_diff('day', t.date, r.date)) <= 5 WHERE t.direction = 'debit'"""


def mutual_best(candidates: str, n: int = 8) -> str:
    """DuckDB: rounds of mutually best pairs over (txn_seq, row_id, gap, score), unrolled, as `matched`; c<n> is what is left
    (tested to be empty)."""
    parts = [f"c0 AS ({candidates})"]
    order = "score DESC, gap, txn_seq, row_id"
    for i in range(n):
        parts.append(
            f"m{i} AS (SELECT txn_seq, row_id, gap, score FROM (SELECT *, row_number() OVER (PARTITION BY txn_seq ORDER BY {order}) AS a, "
            f"row_number() OVER (PARTITION BY row_id ORDER BY {order}) AS b FROM c{i}) WHERE a = 1 AND b = 1)"
        )
        parts.append(
            f"c{i + 1} AS (SELECT * FROM c{i} WHERE txn_seq NOT IN (SELECT txn_seq FROM m{i}) AND row_id NOT IN (SELECT row_id FROM m{i}))"
        )
    every = " UNION ALL ".join(f"SELECT * FROM m{i}" for i in range(n))
    return ",\n".join(parts) + f",\nmatched AS ({every})"


def _rounds(score: str) -> str:
    return "WITH " + mutual_best(
        f"SELECT k.txn_seq, k.row_id, k.gap, {score} AS score FROM ({_CANDIDATES}) k "
        "JOIN v_bank b ON b.txn_seq = k.txn_seq JOIN v_purchases p ON p.row_id = k.row_id"
    )


_BY_DATE = _rounds("0.0::DOUBLE")
_BY_TEXT = _rounds(
    f"""(SELECT 100.0::DOUBLE * (1.0::DOUBLE - levenshtein({sql_fold('b.description')}, {sql_fold('p.company')})::DOUBLE
        / greatest(length({sql_fold('b.description')}), length({sql_fold('p.company')}))))"""
)


_BY_WINDOW = _rounds(f"(SELECT {sql_partial('x', 'y')} FROM (SELECT {sql_fold('b.description')} AS x, {sql_fold('p.company')} AS y))")


def _match(t, how: str):
    active = t.txns(spans=False).where("direction = 'debit'")
    a, b = reconcile.match_items(active, t.purchases())
    return matching.match_one_to_one(a, b, 5, scorers.scorer(how))


@query("J-5", _CANDIDATES.replace("AS gap", "::INT AS gap"))
def _(t):
    a, b = reconcile.match_items(t.txns().where("direction = 'debit'"), t.purchases())
    pairs = matching.candidate_pairs(a, b, 5)
    return pairs.select(F.col("t_seq").alias("txn_seq"), F.col("r_seq").alias("row_id"), "gap")


@query("FIL-7", "SELECT cents, count(*) AS pairs, min(gap)::INT AS nearest FROM (" + _CANDIDATES.replace("SELECT t.txn_seq", "SELECT t.cents, t.txn_seq") + ") GROUP BY cents")
def _(t):
    a, b = reconcile.match_items(t.txns().where("direction = 'debit'"), t.purchases())
    classes = matching.candidate_classes(matching._side(a, "t"), matching._side(b, "r"), 5)
    return classes.groupBy("cents").agg(F.sum(F.col("t_n") * F.col("r_n")).alias("pairs"), F.min("gap").alias("nearest"))


@query("J-6", f"{_BY_DATE} SELECT txn_seq, row_id, gap::INT AS gap FROM matched")
def _(t):
    m = _match(t, "none")
    return m.select(F.col("t_seq").alias("txn_seq"), F.col("r_seq").alias("row_id"), "gap")


@query("J-6-levenshtein", f"{_BY_TEXT} SELECT txn_seq, row_id, gap::INT AS gap, round(score, 6) AS score FROM matched")
def _(t):
    m = _match(t, "levenshtein")
    return m.select(F.col("t_seq").alias("txn_seq"), F.col("r_seq").alias("row_id"), "gap", F.round("score", 6).alias("score"))


@query("J-6-partial", f"{_BY_WINDOW} SELECT txn_seq, row_id, gap::INT AS gap, round(score, 6) AS score FROM matched")
def _(t):
    m = _match(t, "partial")
    return m.select(F.col("t_seq").alias("txn_seq"), F.col("r_seq").alias("row_id"), "gap", F.round("score", 6).alias("score"))


@query("SRT-3", f"{_BY_TEXT} SELECT txn_seq, row_id, row_number() OVER (PARTITION BY txn_seq ORDER BY score DESC, gap, row_id)::INT AS rank FROM c0")
def _(t):
    a, b = reconcile.match_items(t.txns().where("direction = 'debit'"), t.purchases())
    ranked = matching.ranked_pairs(a, b, 5, scorers.scorer("levenshtein"))
    return ranked.select(F.col("t_seq").alias("txn_seq"), F.col("r_seq").alias("row_id"), "rank")


@query("WIN-6", f"""WITH days AS (SELECT DISTINCT cents, date FROM (SELECT cents, date FROM v_purchases UNION ALL SELECT cents, date FROM v_bank)),
   cut AS (SELECT *, CASE WHEN date_diff('day', lag(date) OVER (PARTITION BY cents ORDER BY date), date) > 5 THEN 1 ELSE 0 END AS opens FROM days)
   SELECT cents, CAST(date AS STRING) AS date, sum(opens) OVER (PARTITION BY cents ORDER BY date)::BIGINT AS session FROM cut""")
def _(t):
    days = t.v_purchases.select("cents", "date").unionByName(t.v_bank.select("cents", "date"))
    cut = matching.date_sessions(days.select("cents", F.unix_date("date").alias("day")), 5)
    return cut.select("cents", day(F.date_from_unix_date("day")).alias("date"), "session")


def _statuses(t):
    txns = t.txns(spans=False)
    skip = txns.where("direction = 'credit'")
    hits = _match(t, "none").select(F.col("t_seq").alias("txn_seq"), F.concat(F.lit("expenses/"), F.col("r_seq").cast("string"), F.lit(".pdf")).alias("source_file"))
    return reconcile.bank_rows(txns, hits, skip, RUN)


@query(
    "PRJ-4",
    f"""{_BY_DATE} SELECT b.txn_seq, CASE WHEN m.row_id IS NOT NULL THEN 'Matched' WHEN direction = 'credit' THEN 'Ignored' ELSE 'No receipt' END AS status,
        coalesce('expenses/' || m.row_id || '.pdf', '') AS matched_source FROM v_bank b LEFT JOIN matched m ON m.txn_seq = b.txn_seq""",
)
def _(t):
    return _statuses(t).select("txn_seq", "status", "matched_source")


@query(
    "flagship",
    f"""{_BY_DATE} SELECT status, count(*) AS txns, sum(cents)::BIGINT AS cents FROM (SELECT b.cents, CASE WHEN m.row_id IS NOT NULL THEN 'Matched'
        WHEN direction = 'credit' THEN 'Ignored' ELSE 'No receipt' END AS status FROM v_bank b LEFT JOIN matched m ON m.txn_seq = b.txn_seq) GROUP BY status""",
)
def flagship(t):
    """Bank status counts after ignoring credits and matching receipts one to one."""
    return _statuses(t).groupBy("status").agg(F.count(F.lit(1)).alias("txns"), F.sum(money.cents(F.col("amount"))).alias("cents"))


def _with_bank_only(t):
    """Purchases plus the rows earlier runs made for debits of orders with low priority."""
    old = t.txns().join(t.orders.where("o_orderpriority = '5-LOW'").select(F.col("o_orderkey").alias("txn_seq")), "txn_seq")
    made = reconcile.bank_only_purchases(
        old.where("direction = 'debit'").withColumn("canonical", F.lit("x")).withColumn("default_category", F.lit("x")).withColumn("is_new", F.lit(True)),
        t.v_categories, RUN,
    )
    made = made.withColumn("row_id", F.col("txn_seq") + 10**15).drop("txn_seq")
    return t.purchases().unionByName(made.select(*t.purchases().columns))


_OLD = "(direction = 'debit' AND txn_seq IN (SELECT o_orderkey FROM @orders WHERE o_orderpriority = '5-LOW'))"


@query("J-8", f"SELECT txn_seq, {_OLD}::INT AS is_old FROM v_bank")
def _(t):
    return reconcile.mark_old(t.txns(), _with_bank_only(t)).select("txn_seq", F.col("is_old").cast("int").alias("is_old"))


@query("FIL-3", f"SELECT txn_seq FROM v_bank WHERE NOT {_OLD} AND (direction = 'credit' OR contains(lower(description), '#00000012'))")
def _(t):
    marked = reconcile.mark_old(t.txns(), _with_bank_only(t))
    return marked.where(reconcile.ignored(marked, Settings(ignore_terms=("#00000012",)))).select("txn_seq")


@query("FIL-4", "SELECT row_id FROM v_purchases WHERE mark = 'O'")
def _(t):
    marks = t.v_purchases.select("row_id", "mark")
    rows = t.purchases().join(marks, "row_id").withColumn("status", F.when(F.col("mark") == "F", "Superseded").otherwise("OK"))
    rows = rows.withColumn("bank_ref", F.when(F.col("mark") == "P", "R1").otherwise(""))
    return reconcile.open_rows(rows).select("row_id")


@query("J-7", f"{_BY_DATE} SELECT txn_seq FROM v_bank WHERE direction = 'debit' AND NOT {_OLD} AND txn_seq NOT IN (SELECT txn_seq FROM matched)")
def _(t):
    result = reconcile.reconcile(t.purchases(), t.txns(), _with_bank_only(t), score="none")
    return result.unmatched_txns.select("txn_seq")


@query("J-13", f"""{_BY_DATE} SELECT txn_seq + 1000000000000000 AS row_id, 'Superseded' AS status,
        '{NO_RECEIPT_NOTE}; Receipt arrived: expenses/' || row_id || '.pdf' AS notes FROM matched WHERE txn_seq IN (SELECT txn_seq FROM v_bank WHERE {_OLD})""")
def _(t):
    result = reconcile.reconcile(t.purchases(), t.txns(), _with_bank_only(t), score="none")
    return result.superseded_rows.select("row_id", "status", "notes")


@query("STM-9", f"""{_BY_DATE} SELECT txn_seq, row_id FROM matched WHERE txn_seq IN (SELECT txn_seq FROM v_bank WHERE {_OLD})""")
def _(t):
    """Debits of earlier runs, read back from the bank table, claimed by receipts that came later."""
    result = reconcile.reconcile(t.purchases(), t.txns(), _with_bank_only(t), score="none")
    return result.matched.where("is_old").select("txn_seq", "row_id")


@query("J-10", f"""{_BY_DATE}, spans AS (SELECT DISTINCT min(date) OVER (PARTITION BY stem) AS lo, max(date) OVER (PARTITION BY stem) AS hi FROM v_bank)
        SELECT row_id, '{NO_BANK_TXN_NOTE}' AS notes FROM v_purchases p WHERE row_id NOT IN (SELECT row_id FROM matched)
        AND EXISTS (SELECT 1 FROM spans WHERE p.date BETWEEN lo AND hi)""")
def _(t):
    result = reconcile.reconcile(t.purchases(), t.txns(), t.purchases(), score="none")
    return result.unmatched_rows.select("row_id", "notes")


@query("PRJ-6", f"SELECT txn_seq, CASE WHEN lower(description) LIKE '%1 ny' THEN 'Known' ELSE description END AS company, CASE WHEN lower(description) LIKE '%1 ny' THEN 'PROMO' ELSE '' END AS category, cents, '{NO_RECEIPT_NOTE}' AS notes, 'Review' AS status, ref AS bank_ref FROM v_bank WHERE direction = 'debit'")
def _(t):
    known = F.rlike(F.lower("description"), F.lit("1 ny$"))
    unmatched = (
        t.txns().where("direction = 'debit'").withColumn("is_new", ~known).withColumn("canonical", F.when(known, "Known"))
        .withColumn("default_category", F.when(known, "promo").otherwise("no such category"))
    )
    rows = reconcile.bank_only_purchases(unmatched, t.v_categories, RUN)
    return rows.select("txn_seq", "company", "category", money.cents(F.col("total")).alias("cents"), "notes", "status", "bank_ref")


@query("WIN-5", """WITH spans AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS s, CAST(o_orderdate AS DATE) + 20 AS e FROM @orders),
   prior AS (SELECT *, max(e) OVER (PARTITION BY o_custkey ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM spans),
   isl AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM prior)
   SELECT o_custkey, CAST(min(s) AS STRING) AS first_day, CAST(max(e) AS STRING) AS last_day FROM isl GROUP BY o_custkey, g""")
def _(t):
    d = F.to_date("o_orderdate")
    spans = t.orders.select("o_custkey", d.alias("start"), F.date_add(d, 20).alias("end"))
    return reconcile.merge_periods(spans, ["o_custkey"]).select("o_custkey", day("start").alias("first_day"), day("end").alias("last_day"))


@query("SET-1", f"SELECT 'txn' AS kind, count(*) AS n FROM v_bank WHERE direction = 'debit' UNION ALL SELECT 'row', count(*) FROM v_purchases WHERE mark <> 'F'")
def _(t):
    bank = reconcile.bank_rows(t.txns(), t.txns().limit(0).select("txn_seq", F.lit("").alias("source_file")), t.txns().where("direction = 'credit'").select("txn_seq"), RUN)
    old = reconcile.to_txns(bank.where("status = 'No receipt'")).select(F.lit("txn").alias("kind"))
    marks = t.v_purchases.select("row_id", "mark")
    rows = t.purchases().join(marks, "row_id").withColumn("status", F.when(F.col("mark") == "F", "Superseded").otherwise("OK"))
    eligible = reconcile.open_rows(rows.where("mark = 'P'")).unionByName(rows.where("mark = 'O'"))
    return old.unionByName(eligible.select(F.lit("row").alias("kind"))).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
