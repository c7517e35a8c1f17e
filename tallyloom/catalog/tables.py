"""Status tables, profiles, intake, summaries and stream twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.catalog.base import day, query, sql_fold, sql_norm
from tallyloom.durable import Scratch
from tallyloom.functions import money, text
from tallyloom.operators import expenses, intake, ordered, profile, reconcile, resolve, state, summary
from tallyloom.settings import Settings
from tallyloom.sources import files as file_source
from tallyloom.streaming import intake as streams

RUN = "2024-05-06 07:08:09"

# --- ledger and status tables ------------------------------------------------------------------


@query("J-1", "SELECT doc_id FROM v_files WHERE sha256 NOT IN (SELECT sha256 FROM v_ledger)")
def _(t):
    return state.new_files(t.v_files.drop("text"), t.v_ledger).select("doc_id")


_SEEN = "concat(source, '/', floor(n_chars / 100.0)::BIGINT, '.txt')"


def _paths(t):
    """New files under collision names next to ledger entries under plain names."""
    folder = F.concat("source", F.lit("/"), F.floor(F.col("n_chars") / 100).cast("string"))
    mark = F.substring(F.sha2("text", 256), 1, 8)
    files = t.documents.where("lang <> 'en'").select("doc_id", F.concat(folder, F.lit("__"), mark, F.lit(".txt")).alias("relative_path"))
    ledger = t.documents.where("lang = 'en'").select(F.concat(folder, F.lit(".txt")).alias("relative_path"))
    return files, ledger


@query("J-2", f"SELECT doc_id FROM @documents WHERE lang <> 'en' AND {_SEEN} IN (SELECT {_SEEN} FROM @documents WHERE lang = 'en')")
def _(t):
    return state.reuploads(*_paths(t)).select("doc_id")


def _replaced(t):
    """Receipts of P orders come in again; F receipts had claimed a bank row."""
    again = t.v_purchases.where("mark <> 'O'").select(text.canonical_path(F.col("source_file")).alias("canonical"))
    rows = t.purchases().withColumn("bank_ref", F.when(F.col("category") == "BUILDING", F.concat(F.lit("R"), F.col("row_id").cast("string"))).otherwise(""))
    rows = rows.withColumn("copied_to_master", F.lit("yes"))
    return rows, state.supersede(rows, again, "2024-05-06")


@query(
    "J-3",
    """SELECT row_id, 'Superseded' AS status, 'Superseded by re-upload on 2024-05-06' AS notes, 'yes' AS copied_to_master
       FROM v_purchases WHERE mark <> 'O'""",
)
def _(t):
    return _replaced(t)[1].select("row_id", "status", "notes", "copied_to_master")


def _bank_table(t):
    return t.txns().select(
        F.col("txn_seq").alias("bank_id"), "date", "description", "amount", "direction", F.lit("Matched").alias("status"),
        F.concat(F.lit("expenses/"), F.col("txn_seq").cast("string"), F.lit(".pdf")).alias("matched_source"), "ref", F.col("source_file").alias("statement_file"),
        "statement_start", "statement_end", F.lit(RUN).cast("timestamp").alias("processed_on"),
    )


@query("J-4", "SELECT row_id AS bank_id, 'No receipt' AS status, '' AS matched_source FROM v_purchases WHERE mark <> 'O' AND category = 'BUILDING'")
def _(t):
    """References are printed a hundred times each; only the receipt tells their rows apart."""
    repeated = F.concat(F.lit("R"), (F.col("bank_id") % 100).cast("string"))
    gone = _replaced(t)[1].withColumn("released_ref", F.when(F.col("released_ref") == "", "").otherwise(F.concat(F.lit("R"), (F.col("row_id") % 100).cast("string"))))
    return state.release(_bank_table(t).withColumn("ref", repeated), gone).select("bank_id", "status", "matched_source")


@query("J-11", "SELECT relative_path FROM v_ledger WHERE relative_path NOT IN (SELECT relative_path FROM v_files WHERE stage = 'bank')")
def _(t):
    return state.missing_sources(t.v_ledger, t.v_files.where("stage = 'bank'")).select("relative_path")


_UPSERT = "SELECT row_id, CASE WHEN mark = 'P' THEN 'Review' ELSE 'OK' END AS status, cents FROM v_purchases"


def _changed(t):
    rows = t.purchases()
    return rows, rows.join(t.v_purchases.where("mark = 'P'").select("row_id"), "row_id").withColumn("status", F.lit("Review"))


def _brief(rows):
    return rows.select("row_id", "status", money.cents(F.col("total")).alias("cents"))


@query("J-12", _UPSERT)
def _(t):
    return _brief(state.upsert(*_changed(t), ["row_id"]))


@query("SNK-3", _UPSERT)
def _(t):
    return _brief(state.update(*_changed(t), ["row_id"]))


@query("J-17", "SELECT idx, coalesce(tax_line, '') AS tax_line FROM v_history h LEFT JOIN v_categories c ON lower(trim(c.category)) = lower(h.category)")
def _(t):
    return profile.with_tax_line(t.v_history, t.v_categories).select("idx", "tax_line")


@query("FIL-5", "SELECT 'purchase' AS kind, company AS label, cents FROM v_purchases WHERE mark = 'P' UNION ALL SELECT 'bank', description, cents FROM v_bank WHERE direction = 'debit'")
def _(t):
    rows = state.upsert(*_changed(t), ["row_id"])
    bank = _bank_table(t).withColumn("status", F.when(F.col("direction") == "debit", "No receipt").otherwise("Ignored"))
    return state.review_queue(rows, bank).select("kind", "label", money.cents(F.col("amount")).alias("cents"))


@query(
    "WIN-1",
    f"""SELECT idx, coalesce(lag(idx) OVER w, -1) AS duplicate_of, CASE WHEN lag(idx) OVER w IS NULL THEN 'OK' ELSE 'Review' END AS status
        FROM (SELECT *, {sql_norm('company')} AS c FROM v_history) WINDOW w AS (PARTITION BY date, c ORDER BY idx)""",
)
def _(t):
    batch = t.v_history.select(
        F.col("idx").alias("batch_seq"), "idx", "date", "company", F.lit(1).cast("decimal(18,2)").alias("total"),
        F.col("idx").cast("string").alias("source_file"), F.lit("").alias("notes"), F.lit("OK").alias("status"),
    )
    saved = batch.limit(0).withColumnRenamed("batch_seq", "row_id")
    flagged = expenses.flag_duplicates(batch, saved, Settings(segment_rows=4096))
    return flagged.select("idx", F.coalesce(F.col("duplicate_of").cast("bigint"), F.lit(-1)).alias("duplicate_of"), "status")


@query("WIN-2", "SELECT company, arg_min(idx, idx) AS first_idx, arg_max(category, idx) AS last_category FROM v_history GROUP BY company")
def _(t):
    first = ordered.first_per_key(t.v_history, ["company"], [F.col("idx")]).select("company", F.col("idx").alias("first_idx"))
    last = ordered.first_per_key(t.v_history, ["company"], [F.col("idx")], last=True).select("company", F.col("category").alias("last_category"))
    return first.join(last, "company")


@query("SET-2", "SELECT sha256, count(*) AS copies FROM v_files WHERE sha256 NOT IN (SELECT sha256 FROM v_ledger) GROUP BY sha256")
def _(t):
    return state.new_files(t.v_files.drop("text"), t.v_ledger).groupBy("sha256").agg(F.count(F.lit(1)).alias("copies"))


_ALIASES = f"""WITH c AS (SELECT company AS supplier, count(*) AS n, min(idx) AS f FROM v_history GROUP BY company),
  det AS (SELECT supplier AS alias, first_value(supplier) OVER (PARTITION BY {sql_fold('supplier')} ORDER BY n DESC, f) AS supplier FROM c),
  hand AS (SELECT DISTINCT upper(p_name) AS alias, 'by hand' AS supplier FROM @part)
  SELECT * FROM hand UNION ALL SELECT * FROM det WHERE alias <> supplier AND alias NOT IN (SELECT alias FROM hand)"""


def _merged(t):
    hand = t.part.select(F.upper("p_name").alias("alias"), F.lit("by hand").alias("supplier")).distinct()
    folded = profile.fold_spellings(profile.spelling_profiles(t.v_history))
    return state.merge_aliases(hand, profile.detected_aliases(folded))


@query("SET-3", _ALIASES)
def _(t):
    return _merged(t)


@query("SRT-5", f"SELECT * FROM ({_ALIASES}) ORDER BY lower(alias)")
def _(t):
    return _merged(t).orderBy(F.lower("alias"))


@query("SET-4", "SELECT sha256, min(doc_id) AS doc_id FROM v_files GROUP BY sha256")
def _(t):
    known = t.v_files.where("stage = 'bank'").groupBy("sha256").agg(F.min("doc_id").alias("doc_id"))
    known = known.join(t.v_files.where("stage <> 'bank'").select("sha256"), "sha256", "left_anti")
    return state.insert_or_ignore(known, t.v_files.select("sha256", "doc_id"), ["sha256"], [F.col("doc_id")])


def _store(t, label):
    return state.Store(t.spark, Scratch(t.spark, label).root)


@query("SNK-1", "SELECT relative_path, sha256, status FROM v_ledger")
def _(t):
    entries = t.v_ledger.select(
        F.substring_index("relative_path", "/", -1).alias("filename"), "relative_path", "sha256", F.col("size").cast("bigint").alias("size"),
        F.lit(RUN).cast("timestamp").alias("date_processed"), "stage", "status", F.lit(1).alias("rows_added"), F.lit("").alias("notes"),
    )
    store = _store(t, "ledger")
    for stage in ("expense", "bank", "bank"):  # a repeated batch replaces its own rows
        store.append("ledger", entries.where(F.col("stage") == stage), stage)
    return store.read_log("ledger", schemas.LEDGER).select("relative_path", "sha256", "status")


@query("SNK-2", "SELECT row_id, 'OK' AS status, cents FROM v_purchases")
def _(t):
    """Rows with ids from 0 in the first version, the others appended to it and stored as the second."""
    rows = t.purchases()
    late = t.v_purchases.where("mark = 'P'").select("row_id")
    kept, added = rows.join(late, "row_id", "left_anti"), rows.join(late, "row_id", "left_semi")
    store = _store(t, "appended")
    store.stage("purchases", kept, "v1")
    store.publish("v1")
    base = store.read("purchases", kept.schema)
    store.stage("purchases", state.append_rows(base, added.withColumn("notes", F.col("row_id").cast("string")), "row_id", [F.col("source_file")]), "v2")
    store.publish("v2")
    # Appended rows have new ids; the note keeps the order key they came from.
    stored = store.read("purchases", kept.schema)
    return _brief(stored.withColumn("row_id", F.coalesce(F.col("notes").try_cast("bigint"), F.col("row_id"))))


@query("SNK-4", _UPSERT)
def _(t):
    """Two versions are published and a third only staged; readers see the second."""
    before, changed = _changed(t)
    store = _store(t, "versions")
    store.stage("purchases", before, "v1")
    store.publish("v1")
    store.stage("purchases", state.upsert(before, changed, ["row_id"]), "v2")
    store.publish("v2")
    store.stage("purchases", changed, "v3")
    return _brief(store.read("purchases", schemas.PURCHASES))


@query("SNK-5", f"SELECT * FROM ({_ALIASES})")
def _(t):
    store = _store(t, "aliases")
    store.stage("aliases", _merged(t).orderBy(F.lower("alias"), "alias"), "v1")
    store.publish("v1")
    return store.read("aliases", "alias string, supplier string")


@query("SNK-6", "SELECT sum(cents)::BIGINT AS net, 0::BIGINT AS tax, sum(cents)::BIGINT AS total FROM v_purchases WHERE category = 'BUILDING'")
def _(t):
    sums = state.totals(t.purchases(), F.col("category") == "BUILDING")
    return sums.select(*[money.cents(F.col(c)).alias(o) for c, o in (("net", "net"), ("sales_tax", "tax"), ("total", "total"))])


@query("AGG-9", "SELECT CAST(year(date) AS INT) AS year, category, sum(cents)::BIGINT AS total FROM v_purchases GROUP BY ALL")
def _(t):
    sums = profile.category_totals(t.purchases())
    return sums.select("year", "category", money.cents(F.col("total")).alias("total"))


# --- profiles ----------------------------------------------------------------------------------
_PROFILE = f"""WITH h AS (SELECT *, {sql_fold('company')} AS key FROM v_history),
  sp AS (SELECT key, company, count(*) AS n, min(idx) AS f, max(date) AS d, arg_max(category, (date, idx)) AS lastcat FROM h GROUP BY key, company),
  canon AS (SELECT key, arg_max(company, (n, -f)) AS supplier, sum(n)::BIGINT AS count, max(d) AS last_date,
            arg_max(lastcat, (d, -n, f)) AS lastcat FROM sp GROUP BY key),
  cc AS (SELECT key, category, count(*) AS n FROM h GROUP BY key, category),
  rk AS (SELECT cc.*, row_number() OVER (PARTITION BY cc.key ORDER BY cc.n DESC, (cc.category = lastcat) DESC, cc.category) AS r
         FROM cc JOIN canon USING (key)),
  prof AS (SELECT supplier, count, CAST(last_date AS STRING) AS last_date,
      (SELECT category FROM rk WHERE rk.key = canon.key AND r = 1) AS default_category,
      coalesce((SELECT string_agg(category, ';' ORDER BY n DESC, category) FROM rk WHERE rk.key = canon.key AND r > 1), '') AS other_categories
      FROM canon)"""


@query("AGG-1", f"{_PROFILE} SELECT supplier, count, last_date FROM prof")
def _(t):
    return profile.supplier_profiles(t.v_history).select("supplier", "count", day("last_date").alias("last_date"))


@query("AGG-2", f"{_PROFILE} SELECT supplier, default_category FROM prof")
def _(t):
    return profile.supplier_profiles(t.v_history).select("supplier", "default_category")


@query("AGG-3", f"{_PROFILE} SELECT supplier, other_categories FROM prof")
def _(t):
    return profile.supplier_profiles(t.v_history).select("supplier", "other_categories")


@query("AGG-4", "SELECT CASE WHEN payment_method LIKE 'Cheque%' THEN 'Cheque' ELSE trim(payment_method) END AS payment_method, count(*) AS count FROM v_history WHERE payment_method <> '' GROUP BY 1 ORDER BY 1")
def _(t):
    return profile.payment_counts(t.v_history)


@query(
    "AGG-5",
    f"""SELECT (SELECT count(*) FROM v_history) AS purchase_rows, (SELECT count(DISTINCT {sql_fold('company')}) FROM v_history) AS suppliers,
        (SELECT count(*) FROM v_categories) AS categories, 2::BIGINT AS payment_methods,
        (SELECT count(DISTINCT company) - count(DISTINCT {sql_fold('company')}) FROM v_history) AS aliases_added""",
)
def _(t):
    none = t.v_aliases.limit(0).select("alias", "supplier")
    return profile.seed_statistics(t.v_history, t.v_categories, none)


# --- run counters ------------------------------------------------------------------------------
_FILES = """(SELECT f.*, l.status, f.sha256 NOT IN (SELECT sha256 FROM v_ledger WHERE status = 'Processed') AS is_new
             FROM v_files f LEFT JOIN v_ledger l ON l.entry = f.doc_id)"""


def _handled(t):
    done = t.v_ledger.where("status = 'Processed'").select("sha256", F.lit(False).alias("fresh")).distinct()
    marks = t.v_ledger.select(F.col("entry").alias("doc_id"), "status")
    files = t.v_files.drop("text").join(marks, "doc_id", "left").join(done, "sha256", "left")
    return files.withColumn("is_new", F.col("fresh").isNull()).withColumn("rows_added", F.lit(1)).drop("fresh")


_COUNTS = f"""SELECT stage, count(*) AS found, count(*) FILTER (is_new) AS new, count(*) FILTER (is_new AND status = 'Flagged') AS flagged,
              count(*) FILTER (is_new AND status = 'Error') AS errored, count(*) FILTER (is_new) AS rows_added FROM {_FILES} GROUP BY stage"""


@query("AGG-7", _COUNTS)
def _(t):
    return summary.stage_counters(_handled(t))


@query("AGG-7-map", _COUNTS)
def _(t):
    """The counters as one record with a map by stage, read back by key."""
    one = summary.counter_map(summary.stage_counters(_handled(t)))
    return one.select(F.explode("stages").alias("stage", "c")).select("stage", "c.*")


@query("AGG-8", "SELECT stem || '.csv' AS relative_path, count(*) FILTER (direction = 'debit')::INT AS rows_added FROM v_bank GROUP BY stem")
def _(t):
    files = t.v_bank.select(F.concat("stem", F.lit(".csv")).alias("relative_path")).distinct()
    rows = t.txns().where("direction = 'debit'").select("source_file")
    return summary.rows_per_file(files, rows)


def _summary(t):
    rows = state.upsert(*_changed(t), ["row_id"])
    return summary.run_summary(
        summary.stage_counters(_handled(t)), rows, _replaced(t)[1], t.v_history.select("company"),
        t.v_bank.where("direction = 'debit'"), t.v_purchases.where("mark = 'F'"),
        t.v_ledger.where("status = 'Error'").select(F.concat("relative_path", F.lit(": unreadable")).alias("error")),
        # One statement, so references that repeat across files do so in one.
        reconcile.ref_warnings(t.v_bank.select(F.lit("all.csv").alias("source_file"), F.concat(F.lit("C"), F.col("cents").cast("string")).alias("ref")).where("cents % 97 = 0")),
    )


_SUMMARY = f"""WITH c AS ({_COUNTS}), s AS (
   SELECT 'files_found' AS section, stage AS item, found AS value FROM c UNION ALL SELECT 'files_new', stage, new FROM c
   UNION ALL SELECT 'files_flagged', stage, flagged FROM c UNION ALL SELECT 'files_errored', stage, errored FROM c
   UNION ALL SELECT 'rows_added', stage, rows_added FROM c UNION ALL SELECT 'rows_review', '', count(*) FROM v_purchases WHERE mark = 'P'
   UNION ALL SELECT 'rows_superseded', '', count(*) FROM v_purchases WHERE mark <> 'O'
   UNION ALL SELECT 'new_supplier', company, count(*) FROM v_history GROUP BY company
   UNION ALL SELECT 'unmatched_bank', '', count(*) FROM v_bank WHERE direction = 'debit'
   UNION ALL SELECT 'unmatched_expense', '', count(*) FROM v_purchases WHERE mark = 'F'
   UNION ALL SELECT 'error', relative_path || ': unreadable', count(*) FROM v_ledger WHERE status = 'Error' GROUP BY relative_path
   UNION ALL SELECT 'warning', 'all.csv: reference C' || cents || ' printed ' || count(*) || ' times', 1 FROM v_bank WHERE cents % 97 = 0 GROUP BY cents HAVING count(*) > 1)"""


@query("AGG-10", f"{_SUMMARY} SELECT * FROM s")
def _(t):
    return _summary(t)


@query("SNK-8", f"""{_SUMMARY} SELECT '{{"section":"' || section || '","item":"' || item || '","value":' || value || '}}' AS json FROM s""")
def _(t):
    path = f"{Scratch(t.spark, 'summary').root}/summary"
    summary.as_json(_summary(t)).write.text(path)
    return t.spark.read.text(path).withColumnRenamed("value", "json")


@query("AGG-11", "SELECT EXISTS (SELECT 1 FROM v_purchases WHERE mark = 'P')::INT AS blocked")
def _(t):
    rows = state.upsert(*_changed(t), ["row_id"])
    flagged = t.v_bank.select((F.col("direction") == "neither").alias("flagged"))
    return summary.blocked(rows, flagged).select(F.col("blocked").cast("int").alias("blocked"))


# --- intake ------------------------------------------------------------------------------------
# Listing: folder = source, name = language and size class, content hash of the text. Texts with a
# label were imported before.
_LISTING = """(SELECT doc_id, source AS folder, lang || '-' || CAST(floor(n_chars / 1000.0) AS BIGINT) || '.txt' AS name, n_chars AS size,
               sha256(text) AS content_hash FROM @documents)"""
_IMPORTED = f"(SELECT l.* FROM {_LISTING} l JOIN @labels b ON b.doc_id = l.doc_id)"


def _listing(t):
    name = F.concat("lang", F.lit("-"), F.floor(F.col("n_chars") / 1000).cast("string"), F.lit(".txt"))
    return t.documents.select("doc_id", F.col("source").alias("folder"), name.alias("name"), F.col("n_chars").alias("size"), F.sha2("text", 256).alias("content_hash"))


def _imported(t):
    return _listing(t).join(t.labels.select("doc_id"), "doc_id", "left_semi")


_PLANNED = f"SELECT * FROM {_LISTING} WHERE (folder, name, content_hash) NOT IN (SELECT (folder, name, content_hash) FROM {_IMPORTED})"


@query("J-14", f"SELECT doc_id, folder, name FROM ({_PLANNED})")
def _(t):
    return intake.plan(_listing(t), _imported(t)).select("doc_id", "folder", "name")


@query("STM-6", f"SELECT folder, count(*) AS missed FROM ({_PLANNED}) GROUP BY folder")
def _(t):
    """Full comparison of the newest listing, whatever a stream saw before."""
    return intake.plan(_listing(t), _imported(t)).groupBy("folder").agg(F.count(F.lit(1)).alias("missed"))


@query("J-9", f"""SELECT doc_id, EXISTS (SELECT 1 FROM {_IMPORTED} i WHERE i.folder = l.folder AND i.name = l.name AND i.content_hash <> l.content_hash)::INT AS clash
                  FROM {_LISTING} l""")
def _(t):
    known = intake.known_hashes(_imported(t))
    h = F.col("content_hash")
    clash = F.coalesce((F.col("lo") != h) | (F.col("hi") != h), F.lit(False))
    return _listing(t).join(known, ["folder", "name"], "left").select("doc_id", clash.cast("int").alias("clash"))


@query(
    "STR-17",
    f"""SELECT doc_id, CASE WHEN clash THEN replace(name, '.txt', '') || '__' || substr(content_hash, 1, 8) || '.txt' ELSE name END AS local_name
        FROM (SELECT *, EXISTS (SELECT 1 FROM {_IMPORTED} i WHERE i.folder = l.folder AND i.name = l.name AND i.content_hash <> l.content_hash) AS clash
              FROM {_LISTING} l)""",
)
def _(t):
    disk = _imported(t).limit(0).select("folder", "name", "size", "content_hash")
    return intake.local_names(_listing(t), _imported(t), disk).select("doc_id", "local_name")


@query("AGG-12", f"SELECT folder, name, count(DISTINCT content_hash) AS hashes FROM {_IMPORTED} GROUP BY folder, name")
def _(t):
    return intake.name_hashes(_imported(t)).groupBy("folder", "name").agg(F.count(F.lit(1)).alias("hashes"))


@query("AGG-13", f"SELECT folder, count(*) AS files, sum(size)::BIGINT AS bytes FROM {_IMPORTED} GROUP BY folder")
def _(t):
    return intake.batch_log(_imported(t))


@query("J-15", f"SELECT doc_id FROM {_LISTING} WHERE doc_id IN (SELECT doc_id FROM v_files WHERE sha256 IN (SELECT sha256 FROM v_files WHERE stage = 'bank'))")
def _(t):
    planned = _listing(t).withColumn("folder", F.lit("all")).withColumn("local_name", F.col("content_hash"))
    disk = t.v_files.where("stage = 'bank'").select(
        F.lit("all").alias("folder"), F.col("sha256").alias("name"), "size", F.col("sha256").alias("content_hash")
    )
    return intake.adopt(planned, disk).select("doc_id")


@query(
    "J-16",
    """SELECT doc_id, CASE WHEN lang = 'de' THEN 'file missing' WHEN lang = 'fr' THEN 'size mismatch: expected ' || n_chars || ', got ' || (n_chars + 1)
              ELSE '' END AS problem, bool_and(lang NOT IN ('de', 'fr')) OVER (PARTITION BY source)::INT AS batch_ok FROM @documents""",
)
def _(t):
    planned = t.documents.select(
        "doc_id", F.col("source").alias("folder"), F.col("doc_id").cast("string").alias("local_name"), F.col("n_chars").alias("size"),
        F.sha2("text", 256).alias("content_hash"), "lang",
    )
    staged = planned.where("lang <> 'de'").select(
        "folder", "local_name", F.when(F.col("lang") == "fr", F.col("size") + 1).otherwise(F.col("size")).alias("size"), "content_hash"
    )
    return intake.verify(planned, staged).select(
        "doc_id", F.coalesce("problem", F.lit("")).alias("problem"), F.col("batch_ok").cast("int").alias("batch_ok")
    )


# --- polls and streams -------------------------------------------------------------------------
_PRINTS = """SELECT folder, hour AS poll_id, hour AS polled_at, string_agg(DISTINCT seen, ',' ORDER BY seen) AS print
   FROM (SELECT folder, date_trunc('hour', ts) AS hour, CASE WHEN size > 20 THEN 'big' ELSE 'small' END AS seen FROM v_events) GROUP BY folder, hour"""
_SETTLED = f"""WITH p AS ({_PRINTS}), o AS (SELECT *, CASE WHEN print = lag(print) OVER (PARTITION BY folder ORDER BY poll_id) THEN 0 ELSE 1 END AS opens FROM p),
   r AS (SELECT *, sum(opens) OVER (PARTITION BY folder ORDER BY poll_id) AS run FROM o),
   n AS (SELECT folder, strftime(polled_at, '%Y-%m-%d %H') AS poll, row_number() OVER (PARTITION BY folder, run ORDER BY poll_id) AS run_length FROM r)"""


def _prints(t):
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    polls = t.v_events.select(
        "folder", F.unix_seconds(hour).alias("poll_id"), hour.alias("polled_at"),
        F.when(F.col("size") > 20, "big").otherwise("small").alias("name"), F.lit(1).cast("bigint").alias("size"), F.lit("").alias("content_hash"),
    ).distinct()
    return intake.fingerprints(polls)


@query("WIN-4", f"{_SETTLED} SELECT folder, poll, run_length, (run_length >= 2)::INT AS is_settled FROM n")
def _(t):
    runs = intake.settled(_prints(t))
    return runs.select("folder", F.date_format("polled_at", "yyyy-MM-dd HH").alias("poll"), "run_length", F.col("is_settled").cast("int").alias("is_settled"))


def _stream(t, columns: list[str]):
    """Events as a file stream, read once from the given table."""
    # The glob makes the single file readable as a stream source.
    raw = t.spark.readStream.schema(t.events.schema).parquet(f"{t.folder}/events.parque[t]")
    named = raw.select(
        "event_id", F.col("event_type").alias("folder"), F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("f"), F.col("user_id").cast("string"), F.lit(".pdf")).alias("name"),
        F.floor("value").alias("size"), F.sha2("props", 256).alias("content_hash"),
    )
    return named.select(*columns)


def _drain(t, frame, label: str, schema: str):
    """Run a stream over what is there and read the rows it wrote."""
    scratch = Scratch(t.spark, label)
    key = "spark.sql.streaming.stateStore.providerClass"
    before = t.spark.conf.get(key)
    t.spark.conf.set(key, streams.ROCKSDB)
    try:  # a query keeps the setting it started with
        query_ = (
            frame.writeStream.format("parquet").option("checkpointLocation", f"{scratch.root}/checkpoint")
            .option("path", f"{scratch.root}/rows").outputMode("append").trigger(availableNow=True).start()
        )
    finally:
        t.spark.conf.set(key, before)
    query_.awaitTermination()
    return t.spark.read.schema(schema).parquet(f"{scratch.root}/rows")


_QUIET = """WITH e AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 3600 SECOND THEN 0 ELSE 1 END AS opens FROM v_events WINDOW w AS (PARTITION BY folder ORDER BY ts, event_id)),
   g AS (SELECT *, sum(opens) OVER (PARTITION BY folder ORDER BY ts, event_id) AS batch_no FROM e)
   SELECT folder, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_event, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_event, count(*) AS events FROM g GROUP BY folder, batch_no"""


@query("STM-1", _QUIET)
def _(t):
    batches = intake.quiet_batches(t.v_events, 3600)
    show = "yyyy-MM-dd HH:mm:ss"
    return batches.select("folder", F.date_format("first_event", show).alias("first_event"), F.date_format("last_event", show).alias("last_event"), "events")


# A stream emits a batch once the newest event, less the lateness, is past its pause.
_CLOSED = _QUIET.replace("GROUP BY folder, batch_no", "GROUP BY folder, batch_no HAVING max(ts) + INTERVAL 3600 SECOND <= (SELECT max(ts) FROM v_events) - INTERVAL 1800 SECOND")


@query("STM-1-stream", _CLOSED)
def _(t):
    spells = streams.quiet_batches(_stream(t, ["folder", "ts"]), 3600, "30 minutes")
    out = _drain(t, spells, "quiet", "folder string, first_event timestamp, last_event timestamp, events bigint, fires_at timestamp")
    show = "yyyy-MM-dd HH:mm:ss"
    return out.select("folder", F.date_format("first_event", show).alias("first_event"), F.date_format("last_event", show).alias("last_event"), "events")


# An event after the pause closes a batch at once; the last one of a folder waits for the clock.
_FIRED = _QUIET.replace("SELECT folder, strftime(min", "SELECT * FROM (SELECT folder, max(ts) AS latest, lead(1) OVER (PARTITION BY folder ORDER BY batch_no) AS another, strftime(min")
_FIRED = f"""{_FIRED}) WHERE another = 1 OR latest + INTERVAL 3600 SECOND <= (SELECT max(ts) FROM v_events) - INTERVAL 1800 SECOND"""


@query("STM-2", f"SELECT folder, events, last_event, strftime(latest + INTERVAL 3600 SECOND, '%Y-%m-%d %H:%M:%S') AS fired FROM ({_FIRED})")
def _(t):
    fired = streams.debounce(_stream(t, ["folder", "ts"]), 3600, "30 minutes")
    out = _drain(t, fired, "debounce", "folder string, events bigint, last_ms bigint, fired_ms bigint")
    at = lambda c: F.date_format(F.timestamp_millis(c), "yyyy-MM-dd HH:mm:ss")
    return out.select("folder", "events", at("last_ms").alias("last_event"), at("fired_ms").alias("fired"))


@query("STM-3", "SELECT count(*) AS events FROM @events")
def _(t):
    """A sweep over everything present, then a second one that finds nothing new."""
    scratch = Scratch(t.spark, "sweep")
    store = state.Store(t.spark, scratch.root)

    def handle(batch, batch_id):
        store.append("seen", batch.agg(F.count(F.lit(1)).alias("events")), f"{batch_id:010d}")

    for _ in range(2):
        streams.sweep_then_follow(_stream(t, ["event_id"]), handle, f"{scratch.root}/checkpoint").awaitTermination()
    return store.read_log("seen", "events bigint").agg(F.sum("events").alias("events"))


@query("STM-4", "SELECT DISTINCT folder FROM v_events WHERE path_lower NOT LIKE '%/sub/%' AND folder IN ('click', 'purchase')")
def _(t):
    return intake.touched_folders(t.v_events, ("click", "purchase"))


@query("FIL-6", "SELECT event_id, CASE WHEN path_lower NOT LIKE '%/sub/%' AND folder IN ('click', 'purchase') THEN folder ELSE '' END AS watched FROM v_events")
def _(t):
    return t.v_events.select("event_id", F.coalesce(intake.direct_child(F.col("path_lower"), ("click", "purchase")), F.lit("")).alias("watched"))


_ONCE = "SELECT folder, name, sha256(props) AS content_hash FROM v_events GROUP BY ALL"


@query("STM-5", _ONCE)
def _(t):
    """A stream of listings, without repeats within a day, into an import table no batch can fill twice."""
    scratch = Scratch(t.spark, "imports")
    store = state.Store(t.spark, scratch.root)
    schema = "folder string, name string, content_hash string, polled_at timestamp"
    listing = _stream(t, ["folder", "name", "content_hash", "ts"]).withColumnRenamed("ts", "polled_at")
    sink = streams.record_imports(store, schema)
    streams.sweep_then_follow(streams.first_sightings(listing, "1 day"), sink, f"{scratch.root}/checkpoint").awaitTermination()
    return store.read_log("imported", schema).select("folder", "name", "content_hash")


@query("STM-7", f"{_SETTLED} SELECT folder, poll, run_length, (run_length >= 2)::INT AS is_settled FROM n")
def _(t):
    """Fingerprints written as a table, then followed as a stream."""
    scratch = Scratch(t.spark, "polls")
    prints = scratch.write(_prints(t), "prints")
    stream = t.spark.readStream.schema(prints.schema).parquet(f"{scratch.root}/*-prints")
    runs = _drain(
        t, streams.settled(stream, "0 seconds").where("poll_id is not null"), "settled",
        "folder string, poll_id bigint, run_length bigint, is_settled boolean, over_time boolean",
    )
    poll = F.date_format(F.timestamp_seconds("poll_id"), "yyyy-MM-dd HH")
    return runs.select("folder", poll.alias("poll"), "run_length", F.col("is_settled").cast("int").alias("is_settled"))


_OUTCOMES = """SELECT event_id, CASE WHEN lag(event_id) OVER w IS NULL THEN 'new' WHEN lag(size) OVER w = size THEN 'same'
              WHEN lag(props) OVER w = props THEN 'touched' ELSE 'changed' END AS outcome
       FROM v_events WINDOW w AS (PARTITION BY folder, name ORDER BY event_id)"""


@query("STM-10", _OUTCOMES)
def _(t):
    seen = t.v_events.select(
        "event_id", "folder", "name", F.col("event_id").alias("seq"), "size", F.lit(0).alias("mtime"), F.sha2("props", 256).alias("sha256")
    )
    return intake.changed_content(seen).select("event_id", "outcome")


@query("STM-10-stream", _OUTCOMES)
def _(t):
    """The same outcomes from a stream that keeps the last sighting of every name as state."""
    seen = _stream(t, ["event_id", "folder", "name", "size", "content_hash"]).select(
        "folder", "name", F.col("event_id").alias("seq"), "size", F.lit(0).alias("mtime"), F.col("content_hash").alias("sha256")
    )
    out = _drain(t, streams.changed_content(seen), "changes", "folder string, name string, seq bigint, outcome string")
    return out.select(F.col("seq").alias("event_id"), "outcome")
