"""Registry of queries with their SQL counterpart, and adapter views over the given tables.

The views are written once in SQL both engines read. `@orders` names a given table; views refer to
one another by name and are put in front as common table expressions.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import money

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

VIEWS = {
    # Receipts: one per order. Cents are coarse so that amounts repeat.
    "v_purchases": """
        SELECT o_orderkey AS row_id, CAST(o_orderdate AS DATE) AS date, c_name AS company,
               c_mktsegment AS category, CAST(floor(o_totalprice / 100) AS BIGINT) AS cents,
               o_orderpriority AS payment_method, o_orderstatus AS mark,
               'expenses/' || CAST(o_orderkey AS STRING) || '.pdf' AS source_file
        FROM @orders JOIN @customer ON o_custkey = c_custkey""",
    # Statement lines for the same orders, some days off; statement files hold 512 order keys.
    "v_bank": """
        SELECT row_id AS txn_seq, date + CAST((row_id * 7) % 9 - 2 AS INT) AS date,
               'SQ *' || upper(company) || ' NY' AS description, cents,
               CASE WHEN mark = 'P' THEN 'credit' ELSE 'debit' END AS direction,
               CAST(floor(row_id / 512.0) AS BIGINT) AS block,
               'bank/stmt-' || CAST(CAST(floor(row_id / 512.0) AS BIGINT) AS STRING) AS stem,
               'R' || CAST(row_id AS STRING) AS ref
        FROM v_purchases""",
    # Statement text, line by line: amounts as printed by a bank.
    "v_money": """
        SELECT txn_seq, CAST(CAST(floor(cents / 100) AS BIGINT) AS STRING) || '.'
               || lpad(CAST(cents % 100 AS STRING), 2, '0') AS amount_text
        FROM v_bank""",
    # Supplier dimension, aliases, and raw names as they reach the resolver.
    "v_suppliers": """
        SELECT s_suppkey AS pos, p_name || ' ' || p_brand AS supplier, p_type AS default_category,
               CAST(floor(abs(s_acctbal)) AS BIGINT) AS count
        FROM @supplier JOIN @part ON p_partkey = s_suppkey""",
    "v_aliases": """
        SELECT pos, 'TILL ' || upper(supplier) AS alias, supplier FROM v_suppliers""",
    "v_names": """
        SELECT o_orderkey AS seq, CASE o_orderpriority
                 WHEN '1-URGENT' THEN p_name || ' ' || p_brand || ' Inc.'
                 WHEN '2-HIGH' THEN 'SQ *' || upper(p_name) || ' ' || p_brand || ' NY'
                 WHEN '3-MEDIUM' THEN 'Till ' || p_name || '-' || p_brand
                 WHEN '4-NOT SPECIFIED' THEN replace(p_name || p_brand, ' ', '')
                 ELSE 'PAYPAL *' || replace(replace(upper(p_name || p_brand), ' ', ''), '#', '') || ' AUTO PAY' END AS name,
               o_orderpriority AS context, 'expenses/' || CAST(o_orderkey AS STRING) || '.pdf' AS source_file,
               s_suppkey AS pos
        FROM (SELECT *, o_custkey % (SELECT count(*) FROM @supplier) AS supp FROM @orders)
             JOIN @supplier ON s_suppkey = supp JOIN @part ON p_partkey = supp""",
    "v_categories": """
        SELECT DISTINCT p_type AS category, 'Line ' || lower(p_type) AS tax_line FROM @part""",
    # CSV statements in three layouts: preamble, header, one line per transaction, a total line.
    "v_csv_lines": """
        SELECT stem || '.csv' AS source_file, 2 + txn_seq - block * 512 AS row_no,
               CASE block % 3
                 WHEN 0 THEN CAST(date AS STRING) || ',"' || description || '","$' || amount_text || '",'
                             || CASE direction WHEN 'credit' THEN 'Deposit' ELSE 'Sale' END
                 WHEN 1 THEN CAST(date AS STRING) || ';' || CAST(date AS STRING) || ';' || description || ';'
                             || CASE direction WHEN 'credit' THEN ';' || amount_text ELSE amount_text || ';' END
                 ELSE CAST(date AS STRING) || chr(9) || description || chr(9) || CASE direction WHEN 'credit'
                             THEN chr(9) || amount_text ELSE '(' || amount_text || ')' || chr(9) END || chr(9) || '1.00' || chr(9) || ref END AS line
        FROM v_bank JOIN v_money USING (txn_seq)
        UNION ALL SELECT DISTINCT stem || '.csv', CAST(0 AS BIGINT), 'Account summary' FROM v_bank
        UNION ALL SELECT DISTINCT stem || '.csv', CAST(1 AS BIGINT), CASE block % 3
                 WHEN 0 THEN 'Date,Description,Amount,Type'
                 WHEN 1 THEN 'Transaction Date;Posted Date;Details;Debit;Credit'
                 ELSE replace('Date~Description~Withdrawals~Deposits~Balance~Reference', '~', chr(9)) END FROM v_bank
        UNION ALL SELECT DISTINCT stem || '.csv', CAST(9999 AS BIGINT), 'Total' FROM v_bank""",
    # What the statements say: the reference is printed only in the third layout.
    "v_txns": """
        SELECT txn_seq, stem || '.csv' AS source_file, date, description, cents, direction,
               CASE WHEN block % 3 = 2 THEN ref ELSE stem || '.csv#'
                    || CAST(row_number() OVER (PARTITION BY block ORDER BY txn_seq) AS STRING) END AS ref,
               min(date) OVER (PARTITION BY block) AS statement_start, max(date) OVER (PARTITION BY block) AS statement_end
        FROM v_bank""",
    # Structured replies for receipts; which amounts are present depends on the order status.
    "v_replies": """
        SELECT row_id, source_file, cents, date, company, mark,
               'Here it is: {"date": "' || CAST(date AS STRING) || '", "supplier_name": "' || company || '"'
               || CASE mark WHEN 'F' THEN ', "total": "$' || amount_text || '"'
                            WHEN 'O' THEN ', "net": ' || amount_text || ', "sales_tax": 1.25'
                            ELSE ', "total": ' || amount_text || ', "net": "' || amount_text || '", "currency": "EUR"' END
               || ', "payment_method_hint": "' || payment_method || '", "line_summary": "' || category
               || '", "confidence": 0.9, "notes": ["seen"]}' AS response, category, payment_method
        FROM v_purchases JOIN v_money ON txn_seq = row_id""",
    # Purchase history with several spellings per company.
    "v_history": """
        SELECT o_orderkey AS idx, CAST(o_orderdate AS DATE) AS date,
               CASE o_orderpriority WHEN '1-URGENT' THEN upper(p_name) WHEN '2-HIGH' THEN replace(p_name, ' ', '-')
                 ELSE p_name END AS company,
               CASE o_orderstatus WHEN 'F' THEN p_type WHEN 'O' THEN 'OFFICE' ELSE p_brand END AS category,
               CASE o_orderstatus WHEN 'F' THEN 'Cheque ' || CAST(o_orderkey AS STRING) WHEN 'O' THEN ' Visa' ELSE '' END
                 AS payment_method
        FROM @orders JOIN @part ON p_partkey = o_custkey""",
    # Files: one per document; labelled documents have been handled before.
    "v_files": """
        SELECT d.doc_id, d.source || '/' || CAST(d.doc_id AS STRING) || '.txt' AS relative_path, d.text,
               sha256(d.text) AS sha256, d.n_chars AS size,
               CASE WHEN d.lang = 'en' THEN 'expense' ELSE 'bank' END AS stage
        FROM @documents d""",
    "v_ledger": """
        SELECT f.relative_path, f.sha256, f.size, f.stage, l.doc_id AS entry,
               CASE WHEN l.quality = 1 THEN 'Processed' WHEN l.toxic = 1 THEN 'Error' ELSE 'Flagged' END AS status
        FROM v_files f JOIN @labels l ON l.doc_id = f.doc_id""",
    # Folder polls and change feed from the event stream.
    "v_events": """
        SELECT event_id, event_type AS folder, ts, '/' || event_type || CASE WHEN value > 20 THEN '/sub/f' ELSE '/f' END
               || CAST(user_id AS STRING) AS path_lower,
               'f' || CAST(user_id AS STRING) || '.pdf' AS name, CAST(floor(value) AS BIGINT) AS size, props
        FROM @events""",
}

_NAME = re.compile(r"\bv_\w+\b")


def with_views(sql: str) -> str:
    """The statement with the views it needs in front."""
    ordered: list[str] = []

    def need(text: str) -> None:
        for name in _NAME.findall(text):
            if name in VIEWS and name not in ordered:
                need(VIEWS[name])
                if name not in ordered:
                    ordered.append(name)

    need(sql)
    if not ordered:
        return sql
    head = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in ordered)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"


class Tables:
    """Given tables and adapter views of one scale-factor folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("v_"):
            return self.sql(f"SELECT * FROM {name}")
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        full = with_views(text)
        full = re.sub(r"\bsha256\(d\.text\)", "sha2(d.text, 256)", full)
        full = re.sub(r"@(\w+)", rf"parquet.`{self.folder}/\1.parquet`", full)
        return self.spark.sql(full)

    def purchases(self) -> DataFrame:
        """v_purchases as a saved purchase table without bank references."""
        amount = money.from_cents(F.col("cents"))
        return self.v_purchases.select(
            "row_id", "date", "company", "category", amount.alias("net"),
            F.lit(0).cast("decimal(18,2)").alias("sales_tax"), amount.alias("total"),
            F.lit(0).cast("decimal(9,3)").alias("tax_rate"), "payment_method", F.lit("").alias("notes"),
            F.year("date").alias("year"), "source_file", F.lit("2024-01-01 00:00:00").cast("timestamp").alias("processed_on"),
            F.lit("OK").alias("status"), F.lit("").alias("bank_ref"), F.lit("").alias("copied_to_master"),
        )

    def txns(self, spans: bool = True) -> DataFrame:
        """v_bank as transactions, with the bounds of their statement where they are needed."""
        rows = self.v_bank.select(
            "txn_seq", "date", "description", money.from_cents(F.col("cents")).alias("amount"), "direction",
            F.concat("stem", F.lit(".csv")).alias("source_file"), "ref",
        )
        if not spans:
            none = F.lit(None).cast("date")
            return rows.withColumn("statement_start", none).withColumn("statement_end", none)
        bounds = rows.groupBy("source_file").agg(F.min("date").alias("statement_start"), F.max("date").alias("statement_end"))
        return rows.join(bounds, "source_file")


def query(key: str, sql: str | None = None):
    """Register fn(Tables) -> DataFrame under an operator id, with its SQL counterpart."""

    def keep(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[key] = with_views(sql).replace("@", "")
        return fn

    return keep


def day(column: str):
    """A date as text; both engines then hash the same value."""
    return F.date_format(column, "yyyy-MM-dd")


def sql_norm(x: str) -> str:
    """DuckDB: supplier normal form, by word lists."""
    from tallyloom.settings import LEGAL_SUFFIXES

    words = ", ".join(f"'{w}'" for w in LEGAL_SUFFIXES)
    split = rf"list_filter(regexp_split_to_array(lower({x}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"
    kept = f"list_filter({split}, lambda w: w NOT IN ({words}))"
    some = f"(CASE WHEN len({kept}) = 0 THEN {split} ELSE {kept} END)"
    return f"array_to_string(CASE WHEN len({some}) > 1 AND {some}[1] = 'the' THEN {some}[2:] ELSE {some} END, ' ')"


def sql_fold(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g'))"


def sql_strip_processor(norm: str) -> str:
    """DuckDB: normal form without leading processor words, by list position."""
    from tallyloom.settings import PROCESSOR_WORDS

    words = ", ".join(f"'{w}'" for w in PROCESSOR_WORDS)
    parts = f"string_split({norm}, ' ')"
    keep = f"list_position(list_transform({parts}, lambda w: w IN ({words})), false)"
    return f"array_to_string({parts}[coalesce(nullif({keep}, 0), len({parts})):], ' ')"


def sql_lcs(a: str, b: str) -> str:
    """DuckDB: length of the longest common subsequence of texts up to 120 letters, one bit per letter of b."""
    spots = f"list_transform(string_split({b}, ''), lambda c, i: CASE WHEN c = ch THEN 1::HUGEINT << (i - 1)::HUGEINT ELSE 0::HUGEINT END)"
    masks = f"list_transform(string_split({a}, ''), lambda ch: list_sum({spots})::HUGEINT)"
    full = f"((1::HUGEINT << length({b})::HUGEINT) - 1::HUGEINT)"
    step = f"lambda v, m: ((v + (v & m)) | (v - (v & m))) & {full}"
    return f"(CASE WHEN {a} = '' OR {b} = '' THEN 0 ELSE length({b}) - bit_count(list_reduce({masks}, {step}, {full})) END)"


def sql_partial(a: str, b: str) -> str:
    """DuckDB: best ratio of the shorter text with any window of the longer one, windows over its edges included."""

    def best(needle: str, hay: str) -> str:
        window = f"{hay}[greatest(1, e - length({needle}) + 1):e]"
        score = f"200.0::DOUBLE * {sql_lcs(needle, window)} / (length({needle}) + length({window}))"
        return f"list_max(list_transform(range(1, length({hay}) + length({needle})), lambda e: {score}))"

    return f"""(CASE WHEN {a} = '' OR {b} = '' THEN CASE WHEN {a} = {b} THEN 100.0 ELSE 0.0 END
        WHEN length({a}) < length({b}) THEN {best(a, b)} WHEN length({a}) > length({b}) THEN {best(b, a)}
        ELSE greatest({best(a, b)}, {best(b, a)}) END)"""


def sql_token_set(source: str, keys: str) -> str:
    """DuckDB: (keys, x, y, score) of source(keys, x, y) with the token-set ratio of x and y."""
    return f"""
        SELECT {keys}, x, y, CASE WHEN len(ta) = 0 OR len(tb) = 0 THEN 0.0::DOUBLE
            WHEN s > 0 AND (a = '' OR b = '') THEN 100.0::DOUBLE
            WHEN s = 0 THEN r0 ELSE greatest(r0, 100.0::DOUBLE * (1.0::DOUBLE - (1 + length(a))::DOUBLE / (2 * s + 1 + length(a))),
                 100.0::DOUBLE * (1.0::DOUBLE - (1 + length(b))::DOUBLE / (2 * s + 1 + length(b)))) END AS score
        FROM (SELECT *, 100.0::DOUBLE * (1.0::DOUBLE - (length(a) + length(b) - 2 * {sql_lcs('a', 'b')})::DOUBLE
                   / nullif(2 * s + 2 * CASE WHEN s > 0 THEN 1 ELSE 0 END + length(a) + length(b), 0)) AS r0
          FROM (SELECT {keys}, x, y, ta, tb, length(array_to_string(list_sort(list_intersect(ta, tb)), ' ')) AS s,
                   array_to_string(list_sort(list_filter(ta, lambda w: NOT list_contains(tb, w))), ' ') AS a,
                   array_to_string(list_sort(list_filter(tb, lambda w: NOT list_contains(ta, w))), ' ') AS b
            FROM (SELECT {keys}, x, y, list_filter(list_distinct(string_split(x, ' ')), lambda w: w <> '') AS ta,
                       list_filter(list_distinct(string_split(y, ' ')), lambda w: w <> '') AS tb FROM {source})))"""
