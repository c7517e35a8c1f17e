"""Text, number and date operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.catalog.base import (
    day, query, sql_fold, sql_lcs, sql_partial, sql_norm, sql_strip_processor, sql_token_set,
)
from tallyloom.functions import dates, hashing, money, scorers, text
from tallyloom.operators import expenses, state, statements


@query("STR-1", f"SELECT seq, {sql_norm('name')} AS norm FROM v_names")
def _(t):
    return t.v_names.select("seq", text.normalise_name(F.col("name")).alias("norm"))


@query("STR-2", f"SELECT doc_id, sha256({sql_fold('text')}) AS folded FROM @documents")
def _(t):
    return t.documents.select("doc_id", F.sha2(text.ascii_fold(F.col("text")), 256).alias("folded"))


@query("STR-3", f"SELECT seq, {sql_strip_processor('norm')} AS stripped FROM (SELECT seq, {sql_norm('name')} AS norm FROM v_names)")
def _(t):
    return t.v_names.select("seq", text.strip_processor(text.normalise_name(F.col("name"))).alias("stripped"))


_PAIR = f"""(SELECT n.seq, {sql_norm('n.name')} AS norm, {sql_norm('s.supplier')} AS canon
             FROM v_names n JOIN v_suppliers s ON s.pos = n.pos)"""


def _pairs(t):
    canon = t.v_suppliers.select("pos", text.normalise_name(F.col("supplier")).alias("canon"))
    return t.v_names.join(canon, "pos").select("seq", text.normalise_name(F.col("name")).alias("norm"), "canon")


@query("STR-4", f"SELECT seq, CAST(position(' ' || canon || ' ' IN ' ' || norm || ' ') > 0 AS INT) AS contained FROM {_PAIR}")
def _(t):
    return _pairs(t).select("seq", text.contains_run(F.col("norm"), F.col("canon")).cast("int").alias("contained"))


@query(
    "STR-5",
    f"SELECT seq, CAST(string_split(lead, ' ')[1:len(string_split(canon, ' '))] = string_split(canon, ' ') AS INT) AS leading "
    f"FROM (SELECT seq, canon, {sql_strip_processor('norm')} AS lead FROM {_PAIR})",
)
def _(t):
    return _pairs(t).select("seq", text.leads(F.col("norm"), F.col("canon")).cast("int").alias("leading"))


@query(
    "STR-6",
    f"SELECT pos, CASE WHEN length(c) >= 5 THEN c ELSE '' END AS compact "
    f"FROM (SELECT pos, array_to_string(string_split({sql_norm('supplier')}, ' '), '') AS c FROM v_suppliers)",
)
def _(t):
    return t.v_suppliers.select(
        "pos", F.coalesce(text.compact(text.normalise_name(F.col("supplier"))), F.lit("")).alias("compact")
    )


# Every supplier against the next one of the table.
_NEXT = f"(SELECT a.pos, {sql_norm('a.supplier')} AS x, {sql_norm('b.supplier')} AS y FROM v_suppliers a JOIN v_suppliers b ON b.pos = a.pos + 1)"


def _neighbours(t):
    named = t.v_suppliers.select("pos", text.normalise_name(F.col("supplier")).alias("x"))
    return named.join(named.select((F.col("pos") - 1).alias("pos"), F.col("x").alias("y")), "pos")


@query("STR-7", f"SELECT pos, round(200.0::DOUBLE * {sql_lcs('x', 'y')} / (length(x) + length(y)), 6) AS score FROM {_NEXT}")
def _(t):
    return _neighbours(t).select("pos", F.round(scorers.scorer("indel")(F.col("x"), F.col("y")), 6).alias("score"))


@query("STR-8", f"SELECT pos, round(score, 6) AS score FROM ({sql_token_set(_NEXT, 'pos')})")
def _(t):
    return _neighbours(t).select("pos", F.round(scorers.scorer("token_set")(F.col("x"), F.col("y")), 6).alias("score"))


_FOLDED = f"(SELECT txn_seq, {sql_fold('description')} AS x, {sql_fold('company')} AS y FROM v_bank JOIN v_purchases ON row_id = txn_seq)"


@query("STR-9", f"SELECT txn_seq, round({sql_partial('x', 'y')}, 6) AS score FROM {_FOLDED}")
def _(t):
    return t.v_bank.join(t.v_purchases.select(F.col("row_id").alias("txn_seq"), "company"), "txn_seq").select(
        "txn_seq",
        F.round(
            scorers.scorer("partial")(text.ascii_fold(F.col("description")), text.ascii_fold(F.col("company"))), 6
        ).alias("score"),
    )


_COLLIDED = "(CASE WHEN lang = 'en' THEN source || '/' || doc_id || '__' || substr(sha256(text), 1, 8) || '.txt' ELSE source || '/' || doc_id || '__' || substr(sha256(text), 1, 7) || '.txt' END)"


@query(
    "STR-10",
    f"SELECT doc_id, CASE WHEN lang = 'en' THEN source || '/' || doc_id || '.txt' ELSE {_COLLIDED} END AS path FROM @documents",
)
def _(t):
    mark = F.sha2("text", 256)
    n = F.when(F.col("lang") == "en", 8).otherwise(7)
    path = F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit("__"), F.substring(mark, F.lit(1), n), F.lit(".txt"))
    return t.documents.select("doc_id", text.canonical_path(path).alias("path"))


@query(
    "STR-11",
    "SELECT row_id, CASE WHEN mark = 'P' THEN '' ELSE CAST(date AS STRING) END AS date, company AS supplier FROM v_purchases",
)
def _(t):
    shown = F.when(F.col("mark") == "F", day("date")).when(F.col("mark") == "O", F.date_format("date", "yyyyMMdd")).otherwise(
        F.concat(F.date_format("date", "yyyy"), F.lit("-13-45"))
    )
    name = F.concat(shown, F.lit(" - "), "company", F.lit(" receipt (copy) (1).pdf"))
    hint = text.filename_hint(name)
    return t.v_purchases.select(
        "row_id", F.coalesce(F.date_format(hint["date"], "yyyy-MM-dd"), F.lit("")).alias("date"), hint["supplier"].alias("supplier")
    )


@query("STR-12", "SELECT txn_seq, 'SQ *' || upper(c_name) AS hint FROM v_bank JOIN @orders ON o_orderkey = txn_seq JOIN @customer ON c_custkey = o_custkey")
def _(t):
    return t.v_bank.select("txn_seq", text.strip_phrases(F.col("description"), ["ny", "Jane Doe"]).alias("hint"))


@query("STR-13", r"SELECT doc_id, sha256(regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g')) AS clean FROM @documents")
def _(t):
    return t.documents.select("doc_id", F.sha2(text.strip_control(F.col("text")), 256).alias("clean"))


@query(
    "STR-14",
    """SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'Rush account' WHEN o_orderstatus = 'F' THEN 'Visa'
              WHEN o_orderstatus = 'O' THEN 'Cash' ELSE 'paid ' || o_orderpriority END AS method FROM @orders""",
)
def _(t):
    hint = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("VISA ****"), "o_orderpriority"))
        .when(F.col("o_orderstatus") == "O", F.concat("o_orderpriority", F.lit(" in cash ")))
        .otherwise(F.concat(F.lit("paid "), "o_orderpriority"))
    )
    return t.orders.select(
        "o_orderkey", text.payment_method(hint, ["Visa", "Cash", "Cheque"], [("urgent", "Rush account")]).alias("method")
    )


@query(
    "STR-15",
    "SELECT idx, CASE WHEN payment_method LIKE 'Cheque %' THEN 'Cheque' ELSE trim(payment_method) END AS method FROM v_history",
)
def _(t):
    return t.v_history.select("idx", text.drop_cheque_number(F.col("payment_method")).alias("method"))


@query(
    "STR-16",
    """SELECT doc_id, CASE WHEN starts_with(relative_path, 'src1/') THEN 'inbox/' || substr(relative_path, 6) ELSE relative_path END
              AS relative_path, CASE stage WHEN 'bank' THEN 'statement' ELSE stage END AS stage,
              CAST(starts_with(relative_path, 'src1/') OR stage = 'bank' AS INT) AS changed FROM v_files""",
)
def _(t):
    moved = state.rewrite_paths(
        t.v_files.select("doc_id", "relative_path", "stage"), ["relative_path"], "src1/", "inbox/", {"stage": ("bank", "statement")}
    )
    return moved.withColumn("changed", F.col("changed").cast("int"))


@query(
    "STR-18",
    """SELECT idx, coalesce(c.category, '') AS canonical FROM v_history h LEFT JOIN v_categories c ON lower(c.category) = lower(h.category)""",
)
def _(t):
    asked = t.v_history.select("idx", F.concat(F.lit(" "), F.lower("category"), F.lit(" ")).alias("asked"))
    return expenses.canonical_category(asked, "asked", t.v_categories, "canonical").select("idx", "canonical")


@query(
    "STR-19",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'seen' WHEN 'O' THEN o_orderpriority || '; seen'
              ELSE o_orderpriority || '; seen' END AS notes FROM @orders""",
)
def _(t):
    before = (
        F.when(F.col("o_orderstatus") == "F", "")
        .when(F.col("o_orderstatus") == "O", F.col("o_orderpriority"))
        .otherwise(F.concat("o_orderpriority", F.lit("; seen")))
    )
    return t.orders.select("o_orderkey", text.add_note(before, F.lit("seen"), once=True).alias("notes"))


@query(
    "STR-20",
    """SELECT DISTINCT source_file, 0 AS date_at,
              CASE k WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 1 END AS description_at, CASE k WHEN 0 THEN 2 ELSE -1 END AS amount_at,
              CASE k WHEN 0 THEN -1 WHEN 1 THEN 3 ELSE 2 END AS debit_at, CASE k WHEN 0 THEN -1 WHEN 1 THEN 4 ELSE 3 END AS credit_at,
              CASE k WHEN 0 THEN 3 ELSE -1 END AS type_at, CASE k WHEN 2 THEN 4 ELSE -1 END AS balance_at,
              CASE k WHEN 2 THEN 5 ELSE -1 END AS ref_at
       FROM (SELECT DISTINCT stem || '.csv' AS source_file, block % 3 AS k FROM v_bank)""",
)
def _(t):
    from tallyloom.sources import statements as source

    body = statements.with_header(source.csv_rows(t.v_csv_lines))
    cols = body.select("source_file", "cols").distinct()

    def at(role):
        return F.coalesce(F.col(f"cols.{role}"), F.lit(-1)).alias(f"{role}_at")

    return cols.select(
        "source_file", F.col("cols.transaction_date").alias("date_at"),
        *[at(r) for r in ("description", "amount", "debit", "credit", "type", "balance", "ref")],
    )


@query(
    "STR-21",
    """SELECT DISTINCT source_file, CAST(statement_start AS STRING) AS statement_start, CAST(statement_end AS STRING) AS statement_end FROM v_txns""",
)
def _(t):
    spans = t.v_txns.select("source_file", "statement_start", "statement_end").distinct()
    body = F.concat(
        F.lit("Your card\nStatement period: "), F.date_format("statement_start", "MMMM d, yyyy"), F.lit(" through "),
        F.date_format("statement_end", "MMMM d, yyyy"), F.lit("\nThank you"),
    )
    period = dates.statement_period(body)
    return spans.select(
        "source_file",
        F.date_format(period["start"], "yyyy-MM-dd").alias("statement_start"),
        F.date_format(period["end"], "yyyy-MM-dd").alias("statement_end"),
    )


@query("S-22", "SELECT doc_id, sha256(text) AS sha256, sha256(unhex(sha256(text))) AS block_hash FROM @documents")
def _(t):
    raw = F.encode("text", "UTF-8")
    return t.documents.select("doc_id", hashing.sha256(raw).alias("sha256"), hashing.block_hash(raw).alias("block_hash"))


@query(
    "NUM-1",
    """SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) * 100 + 5 AS cents,
              CASE o_orderpriority WHEN '1-URGENT' THEN 'credit' WHEN '2-HIGH' THEN 'debit' ELSE '' END AS direction,
              CAST(o_orderpriority IN ('3-MEDIUM', '5-LOW') AS INT) AS negative FROM @orders""",
)
def _(t):
    plain = F.concat(F.format_number(F.floor("o_totalprice"), 0), F.lit(".05"))
    cell = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(plain, F.lit(" CR")))
        .when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.lit("$"), plain, F.lit(" dr")))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(F.lit("("), plain, F.lit(")")))
        .when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("-$"), plain))
        .otherwise(F.concat(F.lit(" $"), plain))
    )
    return t.orders.select("o_orderkey", money.parse_amount(cell).alias("a")).select(
        "o_orderkey", money.cents(F.col("a.magnitude")).alias("cents"),
        F.coalesce("a.explicit_direction", F.lit("")).alias("direction"), F.col("a.negative").cast("int").alias("negative"),
    )


@query("NUM-2", "SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) * 100 + 25 AS cents, CAST(o_orderdate AS DATE)::VARCHAR AS date, 'a;b' AS notes FROM @orders")
def _(t):
    cell = F.concat(F.lit(" $"), F.format_number(F.floor("o_totalprice"), 0), F.lit(".25 "))
    notes = money.loose_notes(F.lit('["a", " ", "b"]'))
    return t.orders.select(
        "o_orderkey", money.cents(money.loose_decimal(cell)).alias("cents"),
        F.date_format(dates.parse_date(F.date_format("o_orderdate", "M/d/yyyy")), "yyyy-MM-dd").alias("date"),
        F.array_join(notes, ";").alias("notes"),
    )


@query(
    "NUM-3",
    """SELECT row_id, total, net, tax, CAST(round_even(tax * 100000.0 / net, 0) AS BIGINT) AS rate_thousandths,
              CASE WHEN mark = 'F' THEN 'no tax shown; net = total' WHEN mark = 'P' AND cents % 2 = 1 THEN
                   'amounts do not reconcile: net+tax != total' ELSE '' END AS notes,
              CASE WHEN mark = 'P' AND cents % 2 = 1 THEN 1 ELSE 0 END AS problems
       FROM (SELECT *, CASE mark WHEN 'F' THEN cents + 100 WHEN 'O' THEN cents + 225 ELSE cents + 300 END AS total, cents + 100 AS net,
                    CASE mark WHEN 'F' THEN 0 WHEN 'O' THEN 125 ELSE CASE WHEN cents % 2 = 1 THEN 150 ELSE 200 END END AS tax
             FROM v_purchases)""",
)
def _(t):
    base = money.from_cents(F.col("cents") + 100)
    mark = F.col("mark")
    six = "decimal(18,6)"
    given = t.v_purchases.select(
        "row_id", "date", F.col("company").alias("supplier_name"),
        F.when(mark == "F", base).when(mark == "P", money.from_cents(F.col("cents") + 300)).cast(six).alias("total"),
        F.when(mark != "F", base).cast(six).alias("net"),
        F.when(mark == "O", 1.25).when((mark == "P") & (F.col("cents") % 2 == 1), 1.50).cast(six).alias("sales_tax"),
        F.lit(None).cast("decimal(9,3)").alias("tax_rate"), F.lit("USD").alias("currency"),
        F.array().cast("array<string>").alias("notes"),
        F.lit(None).cast("date").alias("hint_date"), F.lit(None).cast("string").alias("hint_supplier"),
    )
    v = expenses.validate(given)
    return v.select(
        "row_id", *[money.cents(F.col(c)).alias(o) for c, o in (("total", "total"), ("net", "net"), ("sales_tax", "tax"))],
        (F.col("tax_rate") * 1000).cast("bigint").alias("rate_thousandths"),
        F.array_join("notes", "; ").alias("notes"), F.size("problems").alias("problems"),
    )


@query("NUM-4", "SELECT row_id, CAST(round_even(cents / 8.0::DOUBLE * 100, 0) AS BIGINT) AS hundredths FROM v_purchases")
def _(t):
    eighth = (F.col("cents").cast("decimal(18,0)") / F.lit(8).cast("decimal(3,0)")).cast("decimal(18,4)")
    return t.v_purchases.select("row_id", money.cents(money.round_money(eighth)).alias("hundredths"))


@query("NUM-5", "SELECT row_id, CASE WHEN mark = 'P' THEN '!!!!' ELSE 'ok' END AS mark FROM v_purchases")
def _(t):
    net = money.from_cents(F.col("cents"))
    total = F.when(F.col("mark") == "P", net + 1).otherwise(net + F.lit(0.25).cast("decimal(18,2)"))
    return t.v_purchases.select("row_id", money.check_mark(net, F.lit(0.25).cast("decimal(18,2)"), total).alias("mark"))


@query("DAT-1", "SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN '2020' || substr(CAST(o_orderdate AS DATE)::VARCHAR, 5) ELSE CAST(o_orderdate AS DATE)::VARCHAR END AS date FROM @orders")
def _(t):
    d, p = "o_orderdate", F.col("o_orderpriority")
    cell = (
        F.when(p == "1-URGENT", F.date_format(d, "M/d"))
        .when(p == "2-HIGH", F.date_format(d, "MM/dd/yyyy"))
        .when(p == "3-MEDIUM", F.date_format(d, "MMM d, yyyy"))
        .when(p == "5-LOW", F.when(F.col("o_orderkey") % 2 == 0, F.date_format(d, "d MMMM yyyy")).otherwise(F.date_format(d, "dd-MMM-yy")))
        .otherwise(F.date_format(d, "yyyyMMdd"))
    )
    parsed = dates.parse_date(cell, F.lit(2020))
    return t.orders.select("o_orderkey", F.date_format(parsed, "yyyy-MM-dd").alias("date"))


@query("DAT-2", "SELECT row_id, CASE WHEN mark = 'P' THEN 2024 ELSE CAST(year(date) AS INT) END AS year FROM v_purchases")
def _(t):
    date = F.when(F.col("mark") != "P", F.col("date"))
    return t.v_purchases.select("row_id", dates.row_year(date, F.lit("2024-05-06 07:08:09").cast("timestamp")).alias("year"))
