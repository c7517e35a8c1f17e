"""Statement and receipt readers, file inventory, dimension readers, and row projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.catalog.base import day, query
from tallyloom.durable import Scratch
from tallyloom.functions import money, text
from tallyloom.operators import expenses, intake, ordered, profile, reconcile, state, statements
from tallyloom.settings import NO_RECEIPT_NOTE
from tallyloom.sources import files as file_source
from tallyloom.sources import statements as source

_TXN_SQL = """SELECT source_file, ref, CAST(date AS STRING) AS date, description, cents, direction,
                     CAST(statement_start AS STRING) AS statement_start, CAST(statement_end AS STRING) AS statement_end FROM v_txns"""


def _shown(txns):
    return txns.select(
        "source_file", "ref", day("date").alias("date"), "description", money.cents(F.col("amount")).alias("cents"),
        "direction", day("statement_start").alias("statement_start"), day("statement_end").alias("statement_end"),
    )


def _raw_files(t):
    """Documents in the shape of a binary file listing, under two watched folders and one other."""
    folder = F.when(F.col("lang") == "de", "other").when(F.col("lang") == "en", "expenses").otherwise("bank")
    key = F.col("doc_id").cast("string")
    name = (
        F.when(F.col("source") == "src1", F.concat(key, F.lit(".partial")))
        .when(F.col("source") == "src2", F.concat(F.lit(".cache/"), key, F.lit(".txt")))
        .when(F.col("source") == "src3", F.concat(F.lit("sub/"), key, F.lit(" a+b.txt")))
        .otherwise(F.concat(key, F.lit(".txt")))
    )
    return t.documents.select(
        F.concat(F.lit("file:/data/imports/"), folder, F.lit("/"), F.replace(name, F.lit(" "), F.lit("%20"))).alias("path"),
        F.encode("text", "UTF-8").alias("content"),
    ).withColumn("length", F.octet_length("content").cast("bigint"))


@query(
    "SRC-1",
    """SELECT CASE lang WHEN 'en' THEN 'expenses/' ELSE 'bank/' END || CASE WHEN source = 'src3' THEN 'sub/' || doc_id || ' a+b.txt'
                ELSE doc_id || '.txt' END AS relative_path,
              CASE lang WHEN 'en' THEN 'expense' ELSE 'bank' END AS stage, sha256(text) AS sha256, CAST(strlen(text) AS BIGINT) AS size
       FROM @documents WHERE lang <> 'de' AND source NOT IN ('src1', 'src2') AND text <> ''""",
)
def _(t):
    found = file_source.inventory(_raw_files(t), "/data/imports")
    return found.select("relative_path", "stage", "sha256", "size")


@query("SRC-2", _TXN_SQL)
def _(t):
    """Statements written as one text file each, and read from there. Folder names are escaped, and once more in paths."""
    folder = f"{Scratch(t.spark, 'statements').root}/lines"
    named = t.v_csv_lines.select(F.col("source_file").alias("file"), "row_no", "line").repartition("file").sortWithinPartitions("file", "row_no")
    named.select("file", "line").write.partitionBy("file").text(folder)
    lines = source.read_lines(t.spark, folder)
    name = F.url_decode(F.url_decode(F.regexp_extract("source_file", "/file=([^/]+)/", 1)))
    return _shown(source.parse_csv_lines(lines.withColumn("source_file", name)))


def _html_files(t):
    """One HTML page per block of 512 order keys: a decoy table, then the transactions."""
    return t.sql(
        """SELECT stem || '.html' AS source_file,
                  '<html><body><script>var t="<table>";</script><table><tr><th>Card</th><th>Points</th></tr><tr><td>x</td><td>1</td></tr></table>'
                  || '<p>Thank you</p><table><thead><tr><th>Date</th><th>Description</th><th>Withdrawals</th><th>Deposits</th><th>Reference</th></tr></thead><tbody>'
                  || listagg('<tr><td>' || CAST(date AS STRING) || '</td><td> ' || description || ' </td><td>'
                       || CASE direction WHEN 'debit' THEN '($' || amount_text || ')' ELSE '' END || '</td><td>'
                       || CASE direction WHEN 'credit' THEN amount_text ELSE '' END || '</td><td>' || ref || '</td></tr>', '')
                       WITHIN GROUP (ORDER BY txn_seq)
                  || '<tr><td>Total</td><td>all</td><td>1.00</td><td></td><td></td></tr></tbody></table></body></html>' AS content
           FROM v_bank JOIN v_money USING (txn_seq) GROUP BY stem"""
    )


@query(
    "SRC-3",
    """SELECT stem || '.html' AS source_file, ref, CAST(date AS STRING) AS date, description, cents, direction,
              CAST(min(date) OVER (PARTITION BY stem) AS STRING) AS statement_start,
              CAST(max(date) OVER (PARTITION BY stem) AS STRING) AS statement_end FROM v_bank""",
)
def _(t):
    return _shown(source.parse_html(_html_files(t)))


def _csv_files(t):
    """Statement files as whole texts, bounded by their block of keys."""
    lines = t.v_csv_lines.groupBy("source_file").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("row_no", "line"))), lambda s: s["line"]), "\r\n"
        ).alias("content")
    )
    return lines


@query(
    "SRC-4",
    """SELECT source_file, 'csv' AS reader, 0 AS flagged FROM (SELECT DISTINCT source_file FROM v_csv_lines)
       UNION ALL SELECT source_file, 'html', 0 FROM (SELECT DISTINCT stem || '.html' AS source_file FROM v_bank)
       UNION ALL SELECT url || '#.html', '', 1 FROM @pages""",
)
def _(t):
    pages = t.pages.select(F.concat("url", F.lit("#.html")).alias("source_file"), F.col("html").alias("content"))
    every = _csv_files(t).unionByName(_html_files(t)).unionByName(pages)
    _, status = source.parse_statements(every)
    return status.select("source_file", F.coalesce("reader", F.lit("")).alias("reader"), F.col("flagged").cast("int").alias("flagged"))


@query(
    "SRC-5",
    """SELECT source_file, CAST(date AS STRING) AS date, company AS supplier_name,
              CASE mark WHEN 'O' THEN -1 ELSE cents END AS total_cents, CASE mark WHEN 'F' THEN -1 ELSE cents END AS net_cents,
              CASE mark WHEN 'O' THEN 125 ELSE -1 END AS tax_cents, CASE mark WHEN 'P' THEN 'EUR' ELSE '' END AS currency,
              0.9::DOUBLE AS confidence, 'seen' AS notes FROM v_replies""",
)
def _(t):
    read = expenses.read_replies(t.v_replies.select("source_file", "response"))

    def c(name):
        return F.coalesce(money.cents(F.col(name)), F.lit(-1))

    return read.select(
        "source_file", day("date").alias("date"), "supplier_name", c("total").alias("total_cents"), c("net").alias("net_cents"),
        c("sales_tax").alias("tax_cents"), F.coalesce("currency", F.lit("")).alias("currency"), "confidence",
        F.array_join("notes", ";").alias("notes"),
    )


def _statement_replies(t):
    return t.sql(
        """SELECT stem || '.pdf' AS source_file, 'Found: ' || to_json(named_struct(
                    'statement_start', CAST(min(date) AS STRING), 'statement_end', CAST(max(date) AS STRING),
                    'transactions', transform(array_sort(collect_list(struct(txn_seq, CAST(date AS STRING) AS date, description,
                        CAST(cents AS STRING) AS amount, direction, CASE direction WHEN 'credit' THEN '' ELSE ref END AS ref))),
                        x -> named_struct('date', x.date, 'description', x.description, 'amount', x.amount,
                                          'direction', x.direction, 'ref', x.ref)))) AS response
           FROM v_bank GROUP BY stem"""
    )


@query(
    "SRC-6",
    """SELECT stem || '.pdf' AS source_file, CASE direction WHEN 'credit' THEN stem || '.pdf#'
                || CAST(row_number() OVER (PARTITION BY stem ORDER BY txn_seq) AS STRING) ELSE ref END AS ref,
              CAST(date AS STRING) AS date, description, cents * 100 AS cents, direction,
              CAST(min(date) OVER (PARTITION BY stem) AS STRING) AS statement_start,
              CAST(max(date) OVER (PARTITION BY stem) AS STRING) AS statement_end FROM v_bank""",
)
def _(t):
    return _shown(source.parse_responses(_statement_replies(t)))


@query("SRC-7", "SELECT supplier, min(pos) AS pos, arg_min(default_category, pos) AS default_category FROM v_suppliers GROUP BY supplier")
def _(t):
    """The dimension written as a CSV file with blanks around its names, and read from there."""
    path = f"{Scratch(t.spark, 'dimension').root}/suppliers"
    shown = t.v_suppliers.orderBy("pos").coalesce(1).select(F.concat(F.lit(" "), "supplier", F.lit(" ")).alias("Supplier"), F.col("default_category").alias("Category"))
    shown.write.option("header", "true").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)
    named = file_source.read_dimension(t.spark, path, {"Supplier": "supplier", "Category": "default_category"}, "supplier")
    return named.select("supplier", "pos", "default_category")


@query(
    "SRC-8",
    """SELECT idx, company, CAST(date AS STRING) AS date FROM v_history
       WHERE idx < (SELECT max(o_orderkey) FROM @orders)""",
)
def _(t):
    last = t.orders.agg(F.max("o_orderkey").alias("pos"))
    sheet = t.v_history.select(F.col("idx").alias("pos"), day("date").alias("date"), "company")
    total = last.select("pos", F.lit(" Total ").alias("date"), F.lit(None).cast("string").alias("company"))
    blank = t.v_history.select("idx", F.lit(None).cast("string").alias("date"), F.lit(None).cast("string").alias("company"))
    rows = profile.purchase_rows(sheet.unionByName(blank.withColumnRenamed("idx", "pos")).unionByName(total))
    return rows.select(F.col("pos").alias("idx"), "company", "date")


@query(
    "SRC-9",
    """SELECT row_id, CASE mark WHEN 'F' THEN '' ELSE company END AS company, CASE mark WHEN 'O' THEN 'OK' ELSE 'Review' END AS status,
              CASE mark WHEN 'P' THEN 0 ELSE cents END AS cents, '' AS copied_to_master FROM v_purchases""",
)
def _(t):
    scratch = Scratch(t.spark, "older")
    old = t.purchases().join(t.v_purchases.select("row_id", "mark"), "row_id").select(
        "row_id", F.when(F.col("mark") != "F", F.col("company")).alias("company"),
        F.when(F.col("mark") != "P", F.col("total")).alias("total"),
        F.when(F.col("mark") != "O", "Review").alias("status"),
    )
    store = state.Store(t.spark, scratch.root)
    store.stage("purchases", old, "v1")
    store.publish("v1")
    rows = state.with_defaults(store.read("purchases", schemas.PURCHASES))
    return rows.select("row_id", "company", "status", money.cents(F.col("total")).alias("cents"), "copied_to_master")


@query(
    "SRC-10",
    """SELECT event_id, folder, name FROM v_events WHERE path_lower NOT LIKE '%/sub/%' AND folder IN ('click', 'view')""",
)
def _(t):
    return intake.top_level(t.v_events, ("click", "view")).select("event_id", "folder", "name")


@query(
    "PRJ-1",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'credit' WHEN '2-HIGH' THEN 'debit' WHEN '3-MEDIUM' THEN 'credit'
              WHEN '5-LOW' THEN 'credit' ELSE 'debit' END AS direction FROM @orders""",
)
def _(t):
    p = F.col("o_orderpriority")
    cell = F.when(p == "1-URGENT", "12.00 CR").when(p == "4-NOT SPECIFIED", "-12.00").otherwise("12.00")
    kind = F.when(p == "2-HIGH", "Purchase").when(p == "3-MEDIUM", "Direct deposit").otherwise("fee")
    words = F.when(p == "5-LOW", "Card refund").when(p == "2-HIGH", "PAYMENT x").otherwise("Shop")
    return t.orders.select("o_orderkey", statements.direction_of(money.parse_amount(cell), kind, words).alias("direction"))


@query("PRJ-2", "SELECT source_file, txn_seq, ref FROM v_txns")
def _(t):
    txns = t.v_bank.select(
        F.concat("stem", F.lit(".csv")).alias("source_file"), F.col("txn_seq").alias("row_no"), "txn_seq",
        F.when(F.col("block") % 3 == 2, F.col("ref")).otherwise("").alias("bank_ref"),
    )
    return statements.stable_refs(txns).select("source_file", "txn_seq", "ref")


@query(
    "PRJ-3",
    """SELECT source_file, company, CASE mark WHEN 'O' THEN cents + 125 ELSE cents END AS total, cents AS net,
              CASE mark WHEN 'O' THEN 125 ELSE 0 END AS tax, r.category || '' AS category,
              CASE WHEN mark = 'P' OR category = 'BUILDING' THEN 'Review' ELSE 'OK' END AS status, payment_method,
              CASE mark WHEN 'F' THEN 'seen; no tax shown; net = total' WHEN 'O' THEN 'seen'
                   ELSE 'seen; currency EUR: convert to USD and note the rate' END AS notes, CAST(year(date) AS INT) AS year
       FROM v_replies r""",
)
def _(t):
    read = expenses.with_hints(expenses.read_replies(t.v_replies.select("source_file", "response")))
    valid = expenses.validate(read)
    matched = valid.withColumn("canonical", F.col("supplier_name")).withColumn(
        "default_category", F.lower("line_summary")
    ).withColumn("is_new", F.col("line_summary") == "BUILDING")
    known = t.customer.select(F.col("c_mktsegment").alias("category")).distinct()
    rows = expenses.to_purchases(matched, known, "2024-05-06 07:08:09")
    return rows.select(
        "source_file", "company", *[money.cents(F.col(c)).alias(o) for c, o in (("total", "total"), ("net", "net"), ("sales_tax", "tax"))],
        "category", "status", "payment_method", "notes", "year",
    )


@query("PRJ-5", "SELECT txn_seq, ref, CAST(date AS STRING) AS date, cents, direction, source_file FROM (SELECT txn_seq, ref, date, cents, direction, stem || '.csv' AS source_file FROM v_bank)")
def _(t):
    txns = t.txns()
    none = txns.limit(0)
    bank = reconcile.bank_rows(
        txns, none.select("txn_seq", F.lit("").alias("source_file")), none.select("txn_seq"), "2024-05-06 07:08:09"
    )
    return reconcile.to_txns(bank).select(
        "txn_seq", "ref", day("date").alias("date"), money.cents(F.col("amount")).alias("cents"), "direction", "source_file"
    )


@query(
    "FIL-1",
    """SELECT doc_id, CAST(lang <> 'de' AND n_chars > 0 AND source <> 'src1' AS INT) AS server,
              CAST(source NOT IN ('src1', 'src2', 'src3') AS INT) AS desktop FROM @documents""",
)
def _(t):
    key, src = F.col("doc_id").cast("string"), F.col("source")
    name = F.when(src == "src1", F.concat(F.lit("."), key)).when(src == "src2", F.concat(F.lit("~$"), key))
    name = name.when(src == "src3", F.concat(key, F.lit(".CRDOWNLOAD"))).otherwise(key)
    server = F.when(F.col("lang") == "de", F.concat(name, F.lit(".partial"))).otherwise(name)
    return t.documents.select(
        "doc_id", intake.eligible(server, F.col("n_chars")).cast("int").alias("server"),
        intake.eligible(name, desktop=True).cast("int").alias("desktop"),
    )


@query(
    "FIL-2",
    """SELECT o_orderkey FROM @orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')""",
)
def _(t):
    p = F.col("o_orderpriority")
    first = F.when(p == "1-URGENT", "Opening balance").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    label = F.when(p == "2-HIGH", " ").otherwise(F.col("o_orderstatus"))
    amount = F.when(p == "3-MEDIUM", "n/a").otherwise(F.lit("5.00"))
    rows = t.orders.select(
        F.lit("a.csv").alias("source_file"), F.lit("csv").alias("layout"), F.col("o_orderkey").alias("row_no"),
        F.array(first, label, amount).alias("cells"), F.lit(None).cast("int").alias("year_hint"),
        statements.header_columns(F.array(F.lit("Date"), F.lit("Description"), F.lit("Amount"))).alias("cols"),
    )
    return statements.typed_rows(rows).select(F.col("row_no").alias("o_orderkey"))


@query(
    "AGG-6",
    "SELECT DISTINCT source_file, CAST(statement_start AS STRING) AS statement_start, CAST(statement_end AS STRING) AS statement_end FROM v_txns",
)
def _(t):
    rows = t.v_txns.select("source_file", "date")
    bounds = statements.statement_bounds(rows).select("source_file", "statement_start", "statement_end").distinct()
    return bounds.select("source_file", day("statement_start").alias("statement_start"), day("statement_end").alias("statement_end"))


@query("SRT-1", "SELECT relative_path, sha256 FROM v_files ORDER BY relative_path")
def _(t):
    return t.v_files.select("relative_path", "sha256").orderBy("relative_path")


@query("WIN-3", "SELECT txn_seq, row_number() OVER (PARTITION BY stem ORDER BY txn_seq) AS n FROM v_bank")
def _(t):
    return ordered.row_number(
        t.v_bank, ["stem"], ordered.block_of(F.col("txn_seq"), 128), [F.col("txn_seq")], "n"
    ).select("txn_seq", "n")


@query("UDF-2", "SELECT source_file, count(*) AS rows, sum(cents)::BIGINT AS cents FROM v_txns GROUP BY source_file")
def _(t):
    """A reader of its own: registered for one more suffix, used by the same dispatch."""
    own = source.Reader("bar", (".bar",), source.CSV.rows, source.CSV.claims, source.CSV.body)
    named = _csv_files(t).withColumn("source_file", F.regexp_replace("source_file", r"\.csv$", ".bar"))
    txns, _status = source.parse_statements(named, readers=[*source.READERS, own])
    back = F.regexp_replace("source_file", r"\.bar$", ".csv").alias("source_file")
    return txns.groupBy(back).agg(F.count(F.lit(1)).alias("rows"), F.sum(money.cents(F.col("amount"))).alias("cents"))


@query("UDF-2-sql", "SELECT source_file, count(*) AS rows, sum(cents)::BIGINT AS cents FROM v_txns GROUP BY source_file")
def _(t):
    """The same through SQL: a table function reads every file, by the format its header tells."""
    source.register_parser(t.spark)
    scratch = Scratch(t.spark, "parsed")
    files = scratch.write(_csv_files(t), "files")
    names = F.create_map(*[x for name, mark in source.DELIMITERS.items() for x in (F.lit(mark), F.lit(name))])
    marks = source.file_marks(source.lines_of(files)).select("source_file", names[F.col("mark")].alias("format"))
    cells = t.spark.sql(
        """SELECT f.source_file, p.row_no, p.cells FROM {files} f JOIN {marks} m ON f.source_file = m.source_file,
                  LATERAL parse_statement(f.content, m.format) p""", files=files, marks=marks,
    )
    return source.parse_cells(cells).groupBy("source_file").agg(F.count(F.lit(1)).alias("rows"), F.sum(money.cents(F.col("amount"))).alias("cents"))
