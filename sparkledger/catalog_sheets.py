"""Registered queries over statements, sheets and reports, each with the SQL that gives the same rows in DuckDB."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sparkledger import catalog
from sparkledger.functions import exprs, rules
from sparkledger.operators import checks, coverage, layout, matching, pages, quality, registry, summaries, transfers
from sparkledger.plans.register import register
from sparkledger.plans.shared import materialize
from sparkledger.sources import handoff, statements

QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES
_MONTHS = ["JAN", "FÉV", "MAR", "AVR", "MAI", "JUN", "JUL", "AOÛ", "SEP", "OCT", "NOV", "DÉC"]
_FORMATS = list(pages.LAYOUTS)


def _place(spark: SparkSession, name: str) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _cents(column: str) -> Column:
    return (F.col(column) * 100).cast("long")


#: A text that each layout passes over.
_PASSED_OVER = ["SOLDE REPORTÉ", "Solde de clôture", "NOUVEAU SOLDE", "SOUS-TOTAL", "NEW BALANCE", "TOTAL POINTS", "SOMMAIRE"]


def _statement_words(ledger: DataFrame, late: bool = False) -> DataFrame:
    """The ledger set as statements of all seven layouts: a document for each account and month, fifteen rows a page.

    With ``late``, statements are of the month after their rows where a layout can tell (so December's are of the next year), each
    page ends with a dated amount that the layout passes over, the two account layouts begin with a page that has a row but no
    header, and the first of them leaves its section for a row and enters it again.
    """
    rows = ledger.where("debit is not null or credit is not null").withColumns({"doc_id": F.concat_ws("-", "account", "month"), "kind": F.col("account").cast("int") % 7})
    rows = rows.withColumn("over", F.lit(False)).withColumn("nth", F.row_number().over(Window.partitionBy("doc_id").orderBy("txn_id")) - 1)
    if late:
        rows = rows.unionByName(rows.where("nth % 15 = 0").withColumn("over", F.lit(True)))
    place = F.when(F.col("over"), 15).otherwise(F.col("nth") % 15)
    cents, paid = F.coalesce("debit", "credit"), F.col("debit").isNotNull()
    whole, part = F.floor(cents / 100), F.lpad((cents % 100).cast("string"), 2, "0")
    day, month = F.lpad(F.dayofmonth("date").cast("string"), 2, "0"), F.lpad(F.month("date").cast("string"), 2, "0")
    name, english = F.element_at(F.array(*[F.lit(m) for m in _MONTHS]), F.month("date")), F.upper(F.date_format("date", "MMM"))
    dot, comma = F.concat(whole.cast("string"), F.lit("."), part), F.concat(whole.cast("string"), F.lit(","), part)
    grouped = F.concat(F.format_number(whole, 0), F.lit("."), part)
    back = F.when(paid, comma).otherwise(F.concat(comma, F.lit(" CR")))
    word = lambda text, x0, x1=None: F.struct((F.lit(text) if isinstance(text, str) else text).alias("text"), F.lit(float(x0)).alias("x0"), F.lit(float(x1 or x0 + 10)).alias("x1"))
    passed = F.element_at(F.array(*[F.lit(t) for t in _PASSED_OVER]), F.col("kind") + 1)
    said = lambda x: [word(F.when(F.col("over"), passed).otherwise("Item"), x), word(F.concat(F.lit("n"), F.col("txn_id").cast("string")), x + 30)]
    side = lambda a, b: F.when(paid, a).otherwise(b)
    thousand = F.when(whole >= 1000, F.floor(whole / 1000).cast("string")).otherwise("")
    rest = F.concat(F.when(whole >= 1000, F.lpad((whole % 1000).cast("string"), 3, "0")).otherwise(whole.cast("string")), F.lit(","), part)
    kinds = [
        [word(day, 20), word(name, 35), word("RA", 78), *said(110), side(word(dot, 295, 335), word(dot, 370, 410))],
        [word(day, 45), word(name, 58), *said(90), side(word(thousand, 318, 322), word(thousand, 405, 409)), side(word(rest, 325, 345), word(rest, 412, 440))],
        [word(day, 40), word(month, 60), *said(255), word(back, 480)],
        [word(day, 30), word(name, 60), *said(130), word(side(comma, F.concat(F.lit("("), comma, F.lit(")"))), 300), word("$", 340)],
        [word(month, 30), word(day, 50), *said(190), word(side(grouped, F.concat(grouped, F.lit("-"))), 440)],
        [word(english, 30), word(day, 50), *said(140), word(F.concat(side(F.lit("$"), F.lit("-$")), grouped), 300)],
        [word(day, 40), word(month, 60), *said(220), word(back, 470)],
    ]
    case = lambda values: F.element_at(F.array(*values), F.col("kind") + 1)
    body = rows.select("doc_id", "month", "kind", (F.floor(F.col("nth") / 15).cast("int") + (F.when(F.col("kind") < 2, 1).otherwise(0) if late else 0)).alias("page"), (100 + 12 * place).cast("double").alias("top"), (place * 20 + 1000).alias("_n"), case([F.array(*k) for k in kinds]).alias("_w"))
    began, begun_in = F.substring("month", 1, 4), F.element_at(F.array(*[F.lit(m) for m in _MONTHS]), F.substring("month", 6, 2).cast("int"))
    stated = F.date_format(F.add_months(F.to_date(F.concat("month", F.lit("-01"))), 1), "yyyy-MM") if late else F.col("month")
    stated = F.when(F.col("kind").isin(0, 5), F.col("month")).otherwise(stated)
    year, month = F.substring(stated, 1, 4), F.substring(stated, 6, 2)
    name = F.element_at(F.array(*[F.lit(m) for m in _MONTHS]), month.cast("int"))
    stamp = F.concat(F.lit("Jour 28 Mois "), month, F.lit(" Année "), year)
    heads = [
        F.concat(F.lit("CAISSE DESJARDINS Folio 12345 "), year), F.concat(F.lit("Banque Royale Du 1 "), begun_in, F.lit(" "), began, F.lit(" au 28 "), name, F.lit(" "), year), F.concat(F.lit("Desjardins AFFAIRES MARGE "), stamp),
        F.concat(F.lit("RBC Visa 28 "), name, F.lit(" "), year), F.lit("Solutions Mastercard"), F.concat(F.lit("TD Aeroplan Jan 1, "), year, F.lit(" to Jan 28, "), year), F.concat(F.lit("BONIDOLLARS "), stamp),
    ]
    line = lambda top, *words, page=0: F.struct(F.lit(page).alias("page"), F.lit(float(top)).alias("top"), F.array(*words).alias("_w"))
    first = [line(10, word(h, 20, 500)) for h in heads]
    bank = line(30, *[word(t, x) for t, x in [("Date", 20), ("Code", 80), ("Description", 110), ("Frais", 250), ("Retrait", 300), ("Dépôt", 380), ("Solde", 460)]], page=int(late))
    royal = line(30, *[word(t, a, b) for t, a, b in [("Date", 45, 60), ("Description", 90, 140), ("débits", 300, 330), ("($)", 332, 345), ("crédits", 400, 430), ("($)", 432, 445), ("Solde", 500, 530)]], page=int(late))
    stray = lambda top, x, amount, **on: line(top, word("05", x), word("JAN", x + 14), word("Stray", 112), word(amount, 295 if x < 40 else 325, 335), **on)
    enter = lambda top: line(top, word("EOP", 20), word("OPERATIONS", 60), page=int(late))
    account, company = [first[0], bank, enter(40)], [first[1], royal]
    if late:
        account += [line(50, word("SOMMAIRE DES FRAIS", 20), page=1), stray(60, 20, "9.00", page=1), enter(70), stray(60, 20, "9.00")]
        company += [stray(60, 45, "9,00")]
    top_lines = [F.array(*account), F.array(*company), *[F.array(h) for h in first[2:]]]
    head = body.select("doc_id", "month", "kind").distinct().select("doc_id", "month", "kind", F.posexplode(case(top_lines)).alias("_n", "_l"))
    head = head.select("doc_id", "month", "kind", F.col("_l.page").alias("page"), F.col("_l.top").alias("top"), (F.col("_n") * 20).cast("long").alias("_n"), F.col("_l._w").alias("_w"))
    lines = body.withColumn("_n", F.col("_n").cast("long")).unionByName(head)
    file = F.when(F.col("kind") == 3, F.concat(year, F.lit("."), month, F.lit(".pdf"))).otherwise(F.concat(stated, F.lit("-28_x.pdf"))) if late else F.concat(stated, F.lit("-28_x.pdf"))
    words = lines.select("doc_id", file.alias("file_name"), "page", "top", "_n", F.posexplode("_w").alias("_k", "_v"))
    return words.select("doc_id", "file_name", "page", (F.col("_n") + F.col("_k")).alias("word_seq"), "_v.text", "_v.x0", "_v.x1", "top").where("text <> ''")


_KIND = "CASE CAST(account AS INTEGER) % 7 " + " ".join(f"WHEN {k} THEN '{f}'" for k, f in enumerate(_FORMATS)) + " END"


_LISTED = f"SELECT account || '-' || month AS doc_id, {_KIND} AS format, date, 'Item n' || CAST(txn_id AS VARCHAR) AS description, debit, credit FROM ledger WHERE debit IS NOT NULL OR credit IS NOT NULL"


def _from_pages(words: DataFrame) -> DataFrame:
    # The words are read several times, so they are written as the table that they stand for.
    return pages.transactions(materialize(words, "words")).select("doc_id", "format", "date", "description", _cents("debit").alias("debit"), _cents("credit").alias("credit"))


@register(_LISTED, "ledger")
def pages_transactions(ledger):
    """Rows set as pages of seven layouts are read back."""
    return _from_pages(_statement_words(ledger))


@register(_LISTED, "ledger")
def pages_late_statements(ledger):
    """The same rows from statements of the month after, among lines, pages and sections that are to be passed over."""
    return _from_pages(_statement_words(ledger, late=True))


@register(f"SELECT DISTINCT account || '-' || month AS doc_id, {_KIND} AS format FROM ledger WHERE debit IS NOT NULL OR credit IS NOT NULL", "ledger")
def known_documents(ledger):
    words = _statement_words(ledger)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("word_seq", "text"))), lambda w: w["text"]), " ").alias("text")
    return layout.known_documents(words.where("page = 0").groupBy("doc_id").agg(text)).select("doc_id", "format")


@register(
    """SELECT doc_id, page, word_seq, CASE WHEN x0 < 130 AND x0 <= 450 THEN 'date' WHEN x0 > 450 THEN 'amount' WHEN x0 > 250 AND x0 < 470 THEN 'description' ELSE 'other' END AS role FROM words""",
    "words",
)
def token_roles(words):
    return words.select("doc_id", "page", "word_seq", layout.token_role("desjardins_cc_pdf", F.col("x0"), F.col("text")).alias("role"))


@register(
    """WITH r AS (SELECT doc_id, page, top, min(CASE WHEN event % 3 = 0 THEN DATE '2024-01-01' + CAST(event % 20 AS INTEGER) END) AS own FROM (SELECT doc_id, page, top, word_seq AS event FROM words) GROUP BY 1, 2, 3)
       SELECT doc_id, page, top, last_value(own IGNORE NULLS) OVER (PARTITION BY doc_id, page ORDER BY top ROWS UNBOUNDED PRECEDING) AS date FROM r""",
    "words",
)
def date_carry(words):
    own = F.min(F.when(F.col("word_seq") % 3 == 0, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("word_seq") % 20).cast("int")))).alias("date")
    return layout.carry_dates(words.groupBy("doc_id", "page", "top").agg(own).withColumnRenamed("top", "row"), "date").withColumnRenamed("row", "top")


def _texts(ledger: DataFrame) -> DataFrame:
    """A CSV text for each account and month, in four formats; behind two empty lines in even months, with a short row in every third."""
    month = F.substring("month", 6, 2).cast("int")
    money = lambda c: F.when(F.col(c).isNull(), "").otherwise(F.concat(F.floor(F.col(c) / 100).cast("string"), F.lit("."), F.lpad((F.col(c) % 100).cast("string"), 2, "0")))
    day, item = F.col("date").cast("string"), F.concat(F.lit('"Item, '), F.col("txn_id").cast("string"), F.lit('"'))
    slashed = F.replace(day, F.lit("-"), F.lit("/"))
    signed = F.concat(F.lit('"'), F.when(F.col("debit").isNull(), F.concat(F.lit("-"), F.replace(money("credit"), F.lit("."), F.lit(",")))).otherwise(F.replace(money("debit"), F.lit("."), F.lit(","))), F.lit('"'))
    kinds = [
        F.concat_ws(",", F.lit("Caisse 1"), F.lit("0123456"), F.lit("EOP"), slashed, F.col("txn_id").cast("string"), item, F.lit(""), money("debit"), money("credit"), F.lit(""), F.lit(""), F.lit(""), F.lit(""), F.lit("")),
        F.concat_ws(",", day, item, money("debit"), money("credit"), F.lit("")), F.concat_ws(",", day, day, item, signed, F.lit("M"), F.lit("R")), F.concat_ws(";", day, item),
    ]
    kind = F.col("account").cast("int") % 4
    heads = ["", "Date,Description,Debit,Credit,Balance\n", "Date,Date de traitement,Description,Montant,Marchand,Référence\n", "a;b\n"]
    rows = ledger.where("debit is not null or credit is not null").withColumn("_line", F.element_at(F.array(*kinds), kind + 1))
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("txn_id", "_line"))), lambda r: r["_line"]), "\n")
    docs = rows.groupBy("account", "month").agg(lines.alias("_t"))
    extra = F.when(month % 3 == 0, F.when(kind == 0, "\na,b").otherwise("")).otherwise("")
    text = F.concat(F.when(month % 2 == 0, "\n\n").otherwise(""), F.element_at(F.array(*[F.lit(h) for h in heads]), kind + 1), F.col("_t"), extra)
    return docs.select(F.concat_ws("-", "account", "month").alias("path"), text.alias("text"))


_CSV = "CASE CAST(account AS INTEGER) % 4 WHEN 0 THEN 'desjardins_csv' WHEN 1 THEN 'rbc_csv' WHEN 2 THEN 'amex_csv' ELSE 'unknown' END"
_DOCS = f"d AS (SELECT DISTINCT account || '-' || month AS path, {_CSV} AS format, CAST(substring(month, 6, 2) AS INTEGER) % 3 = 0 AND CAST(account AS INTEGER) % 4 = 0 AS short FROM ledger WHERE debit IS NOT NULL OR credit IS NOT NULL)"


@register(f"WITH {_DOCS} SELECT path, format, CASE format WHEN 'unknown' THEN 'low' ELSE 'high' END AS confidence FROM d", "ledger")
def statement_formats(ledger):
    return statements.detect_format(_texts(ledger))


@register(f"WITH {_DOCS} SELECT path, 'unknown format' AS warning FROM d WHERE format = 'unknown' UNION ALL SELECT path, '1 rows with too few columns' FROM d WHERE short", "ledger")
def statement_warnings(ledger):
    texts = _texts(ledger)
    return statements.file_warnings(texts, statements.detect_format(texts))


@register(f"SELECT account || '-' || month AS path, date, 'Item, ' || CAST(txn_id AS VARCHAR) AS description, debit, credit FROM ledger WHERE (debit IS NOT NULL OR credit IS NOT NULL) AND {_CSV} <> 'unknown'", "ledger")
def statement_rows(ledger):
    """Rows written as statements of three formats are read back."""
    texts = _texts(ledger)
    found = texts.join(statements.detect_format(texts), "path").select("path", F.regexp_replace("text", "^\\s+", "").alias("text"), "format")
    scans = [scan(found.where(F.col("format") == name)) for name, scan in (("desjardins_csv", statements.desjardins), ("rbc_csv", statements.rbc), ("amex_csv", statements.amex))]
    parts = [s.select(F.col("file_path").alias("path"), "date", "description", _cents("debit").alias("debit"), _cents("credit").alias("credit")) for s in scans]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


#: Header lines of account statements whose columns lie in other orders, or are not there, by the month's number modulo three.
_HEADERS = ["Date,Description,Credit,Debit,Balance", "Date, Credit ,Balance,Description,Debit,Note", "Date,Balance,Description,Debit"]


def _odd_texts(ledger: DataFrame) -> DataFrame:
    """Account statements with columns in three orders, quoted commas, quotes and line ends; bank files with short rows of quoted commas."""
    money = lambda c: F.when(F.col(c).isNull(), "").otherwise(F.concat(F.floor(F.col(c) / 100).cast("string"), F.lit("."), F.lpad((F.col(c) % 100).cast("string"), 2, "0")))
    kind, bank = F.substring("month", 6, 2).cast("int") % 3, F.col("account").cast("int") % 2 == 0
    day, item = F.col("date").cast("string"), F.concat(F.lit('"Item, ""'), F.col("txn_id").cast("string"), F.lit('""\nof two lines"'))
    debit, credit, none = money("debit"), money("credit"), F.lit("")
    orders = [(day, item, credit, debit, none), (day, credit, none, item, debit, F.lit('"a,b"')), (day, none, item, debit)]
    wide = F.concat_ws(",", F.lit("C"), F.lit("0123456"), F.lit("EOP"), F.replace(day, F.lit("-"), F.lit("/")), F.lit("1"), item, none, debit, credit, *[none] * 5)
    short = F.when(F.col("txn_id") % 5 == 0, F.lit('\n"x,1","y,2,3,4,5,6,7,8,9,10,11","z\n,"')).otherwise("")
    line = F.when(bank, F.concat(wide, short)).otherwise(F.element_at(F.array(*[F.concat_ws(",", *o) for o in orders]), kind + 1))
    rows = ledger.where("debit is not null or credit is not null").withColumn("_line", line)
    docs = rows.groupBy("account", "month").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("txn_id", "_line"))), lambda r: r["_line"]), "\r\n").alias("_t"))
    head = F.when(bank, "").otherwise(F.concat(F.element_at(F.array(*[F.lit(h) for h in _HEADERS]), kind + 1), F.lit("\r\n\r\n")))
    return docs.select(F.concat_ws("-", "account", "month").alias("path"), F.concat(head, "_t").alias("text"))


_ODD = "CAST(account AS INTEGER) % 2 = 0 AS bank, CAST(substring(month, 6, 2) AS INTEGER) % 3 AS kind"


@register(
    f"""SELECT path, date, 'Item, "' || txn_id || '"' || chr(10) || 'of two lines' AS description, debit, CASE WHEN bank OR kind <> 2 THEN credit END AS credit
        FROM (SELECT *, account || '-' || month AS path, {_ODD} FROM ledger WHERE debit IS NOT NULL OR credit IS NOT NULL)""",
    "ledger",
)
def statement_rows_by_name(ledger):
    """Columns are found by the header's names, whatever their order, and records keep quoted line ends."""
    texts = _odd_texts(ledger)
    found = texts.join(statements.detect_format(texts), "path").select("path", "text", "format")
    parts = [scan(found.where(F.col("format") == name)).select(F.col("file_path").alias("path"), "date", "description", _cents("debit").alias("debit"), _cents("credit").alias("credit")) for name, scan in (("desjardins_csv", statements.desjardins), ("rbc_csv", statements.rbc))]
    return parts[0].unionByName(parts[1])


@register(
    f"""SELECT path, 'missing columns: Credit' AS warning FROM (SELECT DISTINCT account || '-' || month AS path, {_ODD} FROM ledger WHERE debit IS NOT NULL OR credit IS NOT NULL) WHERE NOT bank AND kind = 2
        UNION ALL SELECT account || '-' || month, count(*) || ' rows with too few columns' FROM ledger WHERE (debit IS NOT NULL OR credit IS NOT NULL) AND CAST(account AS INTEGER) % 2 = 0 AND txn_id % 5 = 0 GROUP BY 1""",
    "ledger",
)
def statement_warnings_by_record(ledger):
    """Too few columns are counted on parsed records: line ends in quotes begin none, and commas in quotes part nothing."""
    texts = _odd_texts(ledger)
    return statements.file_warnings(texts, statements.detect_format(texts))


@register(
    f"""WITH {_DOCS} SELECT path, CASE WHEN there THEN format ELSE 'missing' END AS format, CASE WHEN there AND format <> 'unknown' THEN 'high' ELSE 'low' END AS confidence, CASE WHEN NOT there THEN 'no such file' END AS warning
        FROM (SELECT *, CAST(right(path, 2) AS INTEGER) % 4 <> 0 AS there FROM d)""",
    "ledger",
)
def statement_files_expected(ledger):
    """A statement is expected for each account and month with rows; those of every fourth month are not there."""
    texts = _texts(ledger)
    files = statements.detect_format(texts.where(F.substring("path", -2, 2).cast("int") % 4 != 0))
    return statements.with_missing(files.withColumn("warning", F.lit(None).cast("string")), texts.select("path")).select("path", "format", "confidence", "warning")


def _package(schedule: DataFrame) -> DataFrame:
    """The schedule as packages of four files for every twenty ids, columns in their own orders; every second package lacks some."""
    number, kind = F.floor(F.col("id") / 20).cast("int"), (F.col("id") % 4).cast("int")
    name = F.element_at(F.array(*[F.lit(n) for n in quality.AMOUNTS]), kind + 1)
    even, quoted = number % 2 == 0, F.concat(F.lit('"'), F.col("source"), F.lit('"'))
    money, text = F.col("amount").cast("string"), lambda *c: F.concat_ws(",", *c)
    heads = [
        F.lit("id,entity,amount,confidence_status,source_id,source,source_locator"), F.when(even, "entity,amount,note,confidence_status,source_id,source,source_locator").otherwise("entity,balance_owed,note,confidence_status,source_id,source,source_locator"),
        F.when(even, "source_locator,source_id,source,entity,confidence_status,amount").otherwise("source_id,entity,confidence_status,amount"), F.lit("source,source_locator,source_id,amount,entity,confidence_status"),
    ]
    lines = [
        text(F.col("id").cast("string"), "entity", money, "confidence_status", "source_id", "source", "source_locator"), text("entity", money, F.lit('"a,\n""b"""'), "confidence_status", "source_id", "source", "source_locator"),
        F.when(even, text("source_locator", "source_id", "source", "entity", "confidence_status", money)).otherwise(text("source_id", "entity", "confidence_status", money)), text(quoted, "source_locator", "source_id", money, "entity", "confidence_status"),
    ]
    pick = lambda values: F.element_at(F.array(*values), kind + 1)
    rows = schedule.select(F.concat(F.lit("p"), number.cast("string"), F.lit("/"), name).alias("path"), pick(heads).alias("head"), "id", pick(lines).alias("line"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "line"))), lambda r: r["line"]), "\n")
    return rows.groupBy("path", "head").agg(body.alias("body")).select("path", F.concat("head", F.lit("\n"), "body").alias("text"))


@register(
    f"""WITH {catalog._VIOLATIONS},
        f AS (SELECT id, id % 4 AS kind, id // 20 % 2 = 0 AS even, 'p' || id // 20 || '/' AS folder, CASE id % 4 WHEN 0 THEN 'employee-claims.csv' WHEN 1 THEN 'das-tax-schedule.csv' WHEN 2 THEN 'creditor-schedule.csv' ELSE 'personal-debt-schedule.csv' END AS name FROM schedule),
        g AS (SELECT *, row_number() OVER (PARTITION BY folder, name ORDER BY id) + 1 AS place FROM f)
        SELECT folder || name AS deliverable, name || ':row=' || place AS row_id, rule FROM v JOIN g USING (id) WHERE kind = 0 OR kind = 3 OR kind = 1 AND NOT even OR kind = 2 AND even
        UNION ALL SELECT DISTINCT folder || name, '', 'missing_column balance_owed' FROM f WHERE kind = 1 AND even
        UNION ALL SELECT DISTINCT folder || name, '', 'missing_column ' || c FROM f, (VALUES ('source'), ('source_locator')) x(c) WHERE kind = 2 AND NOT even""",
    "schedule", "registry_old",
)
def package_files(schedule, old):
    """Schedules are written as CSV texts and judged from their records: first their columns, then their rows."""
    found = quality.package_violations(statements.records(_package(schedule)), "handoff", old)
    return found.select("deliverable", "row_id", F.when(F.col("rule") == "missing_column", F.concat("rule", F.lit(" "), "detail")).otherwise(F.col("rule")).alias("rule"))


_KNOWN = {f"{k:07d}": f"NATION_{k % 25}" for k in (12345, 123456)}


def _legs(ledger: DataFrame) -> DataFrame:
    return transfers.legs(transfers.detect(ledger, _KNOWN), _KNOWN)


_LEGS = f"""
    t AS (SELECT date, description, file_name, entity, account, x.* EXCLUDE (txn_id) FROM ({catalog._detect_sql()}) x JOIN ledger USING (txn_id)),
    k AS (SELECT *, CASE WHEN transfer_type <> 'intercompany' THEN counterparty WHEN counterparty = '0012345' THEN 'NATION_20' WHEN counterparty = '0123456' THEN 'NATION_6' END AS other, CASE WHEN transfer_type = 'intercompany' THEN counterparty END AS other_account FROM t),
    legs AS (SELECT date, amount, CASE direction WHEN 'out' THEN entity ELSE other END AS source_entity, CASE direction WHEN 'out' THEN account ELSE other_account END AS source_account,
                    CASE direction WHEN 'out' THEN other ELSE entity END AS destination_entity, CASE direction WHEN 'out' THEN other_account ELSE account END AS destination_account,
                    transfer_type, direction, description, file_name AS file FROM k)
"""


def _read_back(sheet: DataFrame, name: str, load) -> DataFrame:
    spark = sheet.sparkSession
    path = _place(spark, name)
    handoff.write(sheet, path)
    return load(spark, path)


@register(f"WITH {_LEGS} SELECT date, amount, source_entity, source_account, destination_entity, destination_account, transfer_type, description, file FROM legs", "ledger")
def transfers_sheet(ledger):
    """The transfers sheet, written and read back."""
    back = _read_back(handoff.transfers_sheet(_legs(ledger)), "transfers-sheet", handoff.load_transfers)
    return back.withColumn("amount", F.col("amount").cast("long")).drop("matched")


@register(
    f"""SELECT date, entity, account, NULLIF(description, '') AS description, NULLIF(debit, 0) AS debit, NULLIF(credit, 0) AS credit, balance, {catalog._CATEGORY} AS category, {catalog._LABEL} AS category_label, file_name AS file
        FROM (SELECT l.*, b.balance FROM ledger l JOIN balances b USING (txn_id))""",
    "ledger", "balances",
)
def master_sheet(ledger, balances):
    """The master sheet, written and read back."""
    rows = rules.categorize(ledger.join(balances.select("txn_id", "balance"), "txn_id")).withColumn("file", F.col("file_name"))
    back = _read_back(handoff.master_sheet(rows), "master-sheet", handoff.load_transactions)
    return back.withColumns({c: F.col(c).cast("long") for c in ("debit", "credit", "balance")}).drop("source_type")


@register(
    f"""WITH {_LEGS} SELECT date, amount, source_entity AS "from", destination_entity AS "to", CASE transfer_type WHEN 'owner_a_reimbursement' THEN 'remboursement' ELSE 'avance_actionnaire' END AS type, description, file
        FROM legs WHERE transfer_type = 'owner_a_reimbursement' OR transfer_type = 'intercompany' AND destination_entity = 'NATION_20'""",
    "ledger",
)
def owner_a_sheet(ledger):
    repaid, advanced = transfers.owner_legs(_legs(ledger), "NATION_20")
    kind = F.when(F.col("transfer_type") == "owner_a_reimbursement", "remboursement").otherwise("avance_actionnaire")
    sheet = handoff.owner_sheet(repaid, advanced, kind)
    return sheet.withColumn("amount", F.col("amount").cast("long"))


@register(
    f"""WITH {_LEGS} SELECT date, amount, source_entity AS "from", destination_entity AS "to", 'remboursement' AS type, description, file FROM legs WHERE transfer_type = 'interac_out' AND regexp_matches(coalesce(NULLIF(destination_entity, ''), description), '(?i)Jean')
        UNION ALL SELECT date, coalesce(debit, 0), entity, 'Owner_B Holding', 'avance', description, file_name FROM ledger WHERE regexp_matches(description, '(?i)Owner_B\\s+Holding')""",
    "ledger",
)
def owner_b_sheet(ledger):
    repaid = transfers.payments_to(_legs(ledger), "Jean")
    advanced = transfers.advances(ledger, r"Owner_B\s+Holding", "Owner_B Holding", "owner_b_advance")
    kind = F.when(rules.matches(F.coalesce("destination_entity", F.lit("")), "Jean"), "remboursement").otherwise("avance")
    return handoff.owner_sheet(repaid, advanced, kind).withColumn("amount", F.col("amount").cast("long"))


@register(
    f"""WITH {_LEGS}, f AS (SELECT strftime(date, '%Y-%m') AS month, source_entity AS src, amount,
            CASE WHEN transfer_type = 'intercompany' AND direction = 'out' AND source_entity <> destination_entity OR transfer_type = 'owner_a_reimbursement' AND source_entity <> destination_entity THEN destination_entity
                 WHEN transfer_type = 'interac_out' AND contains(lower(destination_entity), 'acme') THEN 'NATION_1' END AS dst FROM legs)
        SELECT month, src AS "from", dst AS "to", sum(amount)::BIGINT AS amount FROM f WHERE dst IS NOT NULL GROUP BY 1, 2, 3 HAVING sum(amount) > 0""",
    "ledger",
)
def flows_sheet(ledger):
    """Monthly flows with an owner's repayments and named payments, as a sheet."""
    flows = transfers.monthly_flows(_legs(ledger), {"Acme": "NATION_1"})
    return handoff.matrix_sheet(flows).withColumn("amount", F.col("amount").cast("long"))


@register(f"WITH {_LEGS} SELECT date, amount, source_entity, destination_entity FROM legs WHERE source_entity <> destination_entity AND source_entity LIKE 'NATION_%' AND destination_entity LIKE 'NATION_%'", "ledger")
def business_transfers(ledger):
    entities = ledger.select("entity").distinct()
    return transfers.business_only(_legs(ledger), entities).select("date", "amount", "source_entity", "destination_entity")


@register(f"WITH {_LEGS} SELECT source_entity AS entity FROM legs WHERE source_entity IS NOT NULL UNION SELECT destination_entity FROM legs WHERE destination_entity IS NOT NULL", "ledger")
def transfer_axis(ledger):
    return transfers.axis(_legs(ledger))


@register(
    f"""WITH {catalog._card_sql()} SELECT card, description, CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE cents END AS cents, substring(CAST(date AS VARCHAR), 1, 7) AS month, l_orderkey % 50 = 0 AS bad_amount FROM card""",
    "card",
)
def card_master(card):
    """The card master with decimal commas, signs, missing months and amounts that cannot be read, written and read back."""
    number = F.concat(F.floor(F.col("cents") / 100).cast("string"), F.lit(","), F.lpad((F.col("cents") % 100).cast("string"), 2, "0"))
    amount = F.when(F.col("l_orderkey") % 50 == 0, "n/a").when(F.col("l_orderkey") % 3 == 0, F.concat(F.lit("-"), number)).otherwise(number)
    rows = card.select(F.col("date").cast("string").alias("\ufeffdate"), "description", amount.alias("montant"), F.col("card").alias("carte"), F.when(F.col("l_orderkey") % 2 == 0, F.substring(F.col("date").cast("string"), 1, 7)).alias("mois"))
    back = _read_back(rows, "card-master", handoff.load_cards)
    return back.select("card", "description", _cents("amount").alias("cents"), "month", "bad_amount")


@register(f"WITH {catalog._card_sql()} SELECT CAST(date AS VARCHAR) AS date, card, description, cents, class, business_cents, strftime(date, '%Y-%m') AS month FROM classified", "card")
def card_sheet(card):
    rows = catalog._cards(card).withColumns({"amount": F.col("cents") / 100, "business_amount": F.col("business_cents") / 100, "month": exprs.month_of(F.col("date")), "date": F.col("date").cast("string")})
    sheet = handoff.card_sheet(rows)
    return sheet.select("date", "card", "description", _cents("amount").alias("cents"), "class", _cents("business_amount").alias("business_cents"), "month")


_PATHS = """CASE doc_id % 6 WHEN 0 THEN 'entities/e' || CAST(doc_id % 40 AS VARCHAR) || '/bank-statement_' || CAST(doc_id AS VARCHAR) || '_2024-0' || CAST(1 + doc_id % 9 AS VARCHAR) || '.pdf'
            WHEN 1 THEN 'invoices/facture ' || CAST(doc_id AS VARCHAR) || '.pdf' WHEN 2 THEN 'tax/tvq_etat-2023-11-0' || CAST(1 + doc_id % 9 AS VARCHAR) || '-' || CAST(doc_id AS VARCHAR) || '.csv'
            WHEN 3 THEN 'visa/' || CAST(doc_id AS VARCHAR) || '.csv' WHEN 4 THEN 'notes/' || CAST(doc_id AS VARCHAR) || '.tsv' ELSE 'output/' || CAST(doc_id AS VARCHAR) || '.csv' END"""


_REGISTRY = f"""WITH p AS (SELECT {_PATHS} AS path, doc_id, coalesce(text, '') AS text FROM documents)
    SELECT CASE WHEN doc_id % 7 = 0 THEN 'SRC-' || CAST(doc_id AS VARCHAR) ELSE 'PATH:' || path END AS source_id, path, sha256(text) AS sha256, octet_length(encode(text))::BIGINT AS size_bytes,
           CASE WHEN doc_id % 6 = 0 THEN 'e' || CAST(doc_id % 40 AS VARCHAR) ELSE 'global' END AS entity,
           CASE doc_id % 6 WHEN 0 THEN 'bank' WHEN 1 THEN 'creditor' WHEN 2 THEN 'tax' WHEN 3 THEN 'cc' ELSE 'other' END AS domain,
           CASE doc_id % 6 WHEN 0 THEN 'bank_statement_pdf' WHEN 1 THEN 'supplier_invoice_pdf' WHEN 2 THEN 'etat_compte_TVQ' WHEN 3 THEN 'cc_statement_pdf' END AS document_type,
           CASE doc_id % 6 WHEN 0 THEN '2024-0' || CAST(1 + doc_id % 9 AS VARCHAR) || '-01' WHEN 2 THEN '2023-11-0' || CAST(1 + doc_id % 9 AS VARCHAR) END AS date_on_document FROM p WHERE doc_id % 6 <> 5"""


def _registry(documents: DataFrame) -> DataFrame:
    """Documents scanned into a registry, every seventh with a source_id."""
    n = F.col("doc_id")
    text = lambda c: c.cast("string")
    kind, digit = n % 6, text(1 + n % 9)
    paths = (
        F.when(kind == 0, F.concat(F.lit("entities/e"), text(n % 40), F.lit("/bank-statement_"), text(n), F.lit("_2024-0"), digit, F.lit(".pdf"))).when(kind == 1, F.concat(F.lit("invoices/facture "), text(n), F.lit(".pdf")))
        .when(kind == 2, F.concat(F.lit("tax/tvq_etat-2023-11-0"), digit, F.lit("-"), text(n), F.lit(".csv"))).when(kind == 3, F.concat(F.lit("visa/"), text(n), F.lit(".csv")))
        .when(kind == 4, F.concat(F.lit("notes/"), text(n), F.lit(".tsv"))).otherwise(F.concat(F.lit("output/"), text(n), F.lit(".csv")))
    )
    content = F.encode(F.coalesce("text", F.lit("")), "utf-8")
    files = documents.select(F.concat(F.lit("file:/root/docs/"), paths).alias("path"), F.octet_length(content).cast("long").alias("length"), content.alias("content"), n.alias("doc_id"))
    found = registry.scan_documents(files, "/root/docs").join(files.select(F.regexp_replace("path", "^file:/root/docs/", "").alias("path"), "doc_id"), "path")
    found = found.withColumn("source_id", F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("SRC-"), text(F.col("doc_id")))))
    return found.withColumn("document_type", F.nullif("document_type", F.lit("")))


def _registered(documents: DataFrame, kind: str, registry: DataFrame) -> DataFrame:
    place = _place(documents.sparkSession, "registry")
    handoff.write_registry(registry, place, kind)
    return handoff.load_registry(documents.sparkSession, place, kind).select("source_id", "path", "sha256", "size_bytes", "entity", "domain", "document_type", "date_on_document")


@register(_REGISTRY, "documents")
def registry_round_trip(documents):
    """A registry is written as JSON lines and read back."""
    return _registered(documents, "json", _registry(documents))


@register(_REGISTRY, "documents")
def registry_object_round_trip(documents):
    """A registry is written as JSON objects keyed by path and read back."""
    return _registered(documents, "object", _registry(documents))


@register(f"SELECT * FROM ({_REGISTRY}) WHERE source_id NOT LIKE 'PATH:%'", "documents")
def registry_csv_round_trip(documents):
    """A registry is written as CSV and read back; rows without a source_id are left out."""
    found = _registered(documents, "csv", _registry(documents))
    return found.select(*[F.nullif(c, F.lit("")).alias(c) if kind == "string" else F.col(c) for c, kind in found.dtypes])



_REVERSE = """WITH p AS (SELECT id * 10 + k AS id, card, date + CAST(k AS INTEGER) AS date, CASE k WHEN 0 THEN cents // 3 ELSE cents - cents // 3 END AS cents FROM stmt, range(2) r(k)),
            near AS (SELECT b.id AS left_id, b.cents AS whole, p.id, p.cents FROM book b JOIN p ON b.tab = p.card AND abs(b.date - p.date) <= 3 AND p.cents <= b.cents + 5),
            s AS (SELECT a.left_id, [a.id, b.id] AS part_ids, abs(a.cents + b.cents - a.whole) AS diff FROM near a JOIN near b ON a.left_id = b.left_id AND a.id < b.id
                  UNION ALL SELECT a.left_id, [a.id, b.id, c.id], abs(a.cents + b.cents + c.cents - a.whole) FROM near a JOIN near b ON a.left_id = b.left_id AND a.id < b.id JOIN near c ON a.left_id = c.left_id AND b.id < c.id)
       SELECT left_id, array_to_string(part_ids, ',') AS parts, diff FROM s WHERE diff <= 5 QUALIFY row_number() OVER (PARTITION BY left_id ORDER BY diff, len(part_ids), part_ids) = 1"""


def _reversed(stmt, book):
    third = F.floor(F.col("cents") / F.lit(3)).cast("long")
    cut = stmt.select("card", "date", "id", F.posexplode(F.array(third, F.col("cents") - third)).alias("k", "part"))
    parts = cut.select((F.col("id") * 10 + F.col("k")).alias("id"), "card", F.date_add("date", F.col("k")).alias("date"), F.col("part").alias("cents"))
    found = matching.reverse_split(parts, book, ("card", "tab"))
    return found.select("left_id", F.array_join(F.col("part_ids").cast("array<string>"), ",").alias("parts"), "diff")


@register(_REVERSE, "stmt", "book")
def reverse_split(stmt, book):
    """Statement rows cut in two, on two days, make up book entries within three days."""
    return _reversed(stmt, book)


@register(_REVERSE, "stmt", "book")
def reverse_split_all(stmt, book):
    """The same rows, under the name they had while ``reverse_split`` read half of them."""
    return _reversed(stmt, book)


@register(
    """WITH o AS (SELECT leg_id, date, cents % 3 AS cents, src, dst, row_number() OVER (PARTITION BY date, cents % 3, src, dst ORDER BY leg_id) AS nth FROM legs_out),
            i AS (SELECT leg_id, date, cents % 3 AS cents, src, dst, row_number() OVER (PARTITION BY date, cents % 3, src, dst ORDER BY leg_id) AS nth FROM legs_in)
       SELECT o.leg_id AS left_id, i.leg_id AS right_id FROM o JOIN i USING (date, cents, src, dst, nth)""",
    "legs_out", "legs_in",
)
def match_contended(outs, ins):
    """Legs with three amounts only, so that many compete: of one day and amount the n-th takes the n-th."""
    few = lambda df: df.withColumn("cents", F.col("cents") % 3).withColumnRenamed("leg_id", "id")
    return matching.two_pass(few(outs), few(ins), cents=0, days=0).select("left_id", "right_id")


@register(
    """WITH s AS (SELECT card, strftime(date, '%Y-%m') AS month, cents AS a, 0::BIGINT AS b FROM stmt UNION ALL SELECT tab, strftime(date, '%Y-%m'), 0, cents FROM book)
       SELECT coalesce(card, 'ALL') AS card, coalesce(month, 'ALL') AS month, sum(a)::BIGINT AS stmt_cents, sum(b)::BIGINT AS book_cents, (sum(a) - sum(b))::BIGINT AS diff FROM s GROUP BY GROUPING SETS ((), (card), (month))""",
    "stmt", "book",
)
def total_differences(stmt, book):
    return matching.total_differences(stmt, book)


@register(
    """WITH f AS (SELECT * FROM book QUALIFY row_number() OVER (PARTITION BY tab ORDER BY date, id) <= 20),
       h AS (SELECT f.tab, s.card, count(DISTINCT f.id) AS n_matched FROM f JOIN stmt s ON abs(f.cents - s.cents) <= 4 AND abs(f.date - s.date) <= 5 GROUP BY 1, 2)
       SELECT h.tab, card, n_matched, n_sample, round(n_matched / n_sample, 6) AS confidence FROM h JOIN (SELECT tab, count(*) AS n_sample FROM f GROUP BY 1) USING (tab) QUALIFY row_number() OVER (PARTITION BY h.tab ORDER BY n_matched DESC, card) = 1""",
    "stmt", "book",
)
def fingerprint_confidence(stmt, book):
    return matching.with_confidence(matching.fingerprint(stmt, book))


@register("SELECT id, left_text, right_text FROM (SELECT s.id, lower(s.description) AS left_text, lower(b.supplier || CASE WHEN b.id % 3 = 0 THEN ' and much more' ELSE '' END) AS right_text FROM stmt s JOIN book b USING (id)) WHERE 1 - levenshtein(left_text, right_text)::DOUBLE / greatest(length(left_text), length(right_text)) < 0.6", "stmt", "book")
def description_mismatch(stmt, book):
    said = F.concat(F.col("supplier"), F.when(F.col("id") % 3 == 0, " and much more").otherwise(""))
    pairs = stmt.select("id", F.lower("description").alias("left_text")).join(book.select("id", F.lower(said).alias("right_text")), "id")
    return matching.description_mismatch(pairs)


@register(f"WITH c AS (SELECT entity, category, count(*) AS n, coalesce(sum(debit), 0)::BIGINT AS debit, coalesce(sum(credit), 0)::BIGINT AS credit FROM (SELECT *, {catalog._CATEGORY} AS category FROM ledger) GROUP BY 1, 2) SELECT *, (row_number() OVER (PARTITION BY entity ORDER BY debit DESC, category))::INTEGER AS place FROM c", "ledger")
def category_report(ledger):
    return summaries.category_report(rules.categorize(ledger))


@register(f"SELECT counterparty, sum(amount)::BIGINT AS cents, count(*) AS n, min(date) AS first_date, max(date) AS last_date FROM ({catalog._detect_sql()}) JOIN ledger USING (txn_id) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3", "ledger")
def recipients_top3(ledger):
    return summaries.recipient_report(transfers.detect(ledger), 3)


@register("SELECT leg_id AS id, date, cents, src, dst FROM legs_in ORDER BY cents DESC, date, leg_id LIMIT 30", "legs_in")
def inflows_top30(ins):
    return summaries.largest(ins.withColumnRenamed("leg_id", "id")).select("id", "date", "cents", "src", "dst")


@register(
    """WITH f AS (SELECT DISTINCT account || '.csv' AS file_name, 'NATION_' || CAST(CAST(account AS INTEGER) % 20 AS VARCHAR) AS entity, CAST(account AS INTEGER) % 3 AS w, CAST(account AS INTEGER) % 4 <> 0 AS ok FROM ledger)
       SELECT s.entity, n, coalesce(r, 0) AS n_reports, coalesce(w, 0)::BIGINT AS n_warnings, coalesce(failed, '') AS failed FROM (SELECT entity, count(*) AS n FROM ledger GROUP BY 1) s
       LEFT JOIN (SELECT entity, count(*) AS r, sum(w) AS w, array_to_string(list_sort(list(file_name) FILTER (NOT ok)), ',') AS failed FROM f GROUP BY 1) USING (entity)""",
    "ledger",
)
def entity_reports(ledger):
    number = F.col("account").cast("int")
    warned = F.array_repeat(F.lit("w"), number % 3)
    files = ledger.select("account").distinct().select(F.concat(F.col("account"), F.lit(".csv")).alias("file_name"), F.concat(F.lit("NATION_"), (number % 20).cast("string")).alias("entity_hint"), warned.alias("warnings"), (number % 4 != 0).alias("ok"))
    found = summaries.attach_reports(ledger.groupBy("entity").agg(F.count("*").alias("n")), files)
    return found.withColumns({"failed": F.array_join("failed", ","), "n_warnings": F.col("n_warnings").cast("long")})


@register("SELECT id, entity, CASE confidence_status WHEN 'CONFIRMED' THEN 'confirmed' WHEN 'INFERRED' THEN 'inferred' ELSE 'blocked' END AS section FROM schedule WHERE confidence_status IN ('CONFIRMED', 'INFERRED', 'BLOCKED')", "schedule")
def briefing_sections(schedule):
    return quality.briefing_sections(schedule).select("id", "entity", "section")


@register("SELECT id, entity, amount FROM schedule WHERE confidence_status = 'BLOCKED'", "schedule")
def blocked_items(schedule):
    return quality.blocked(schedule).select("id", "entity", "amount")


@register("SELECT txn_id, date, file_name FROM (SELECT txn_id, date, 'x_' || strftime(date + CAST(txn_id % 9 AS INTEGER), '%Y-%m') || '.csv' AS file_name, month FROM ledger) WHERE substring(file_name, 3, 7) <> month", "ledger")
def wrong_months(ledger):
    named = F.concat(F.lit("x_"), exprs.month_of(F.date_add("date", (F.col("txn_id") % 9).cast("int"))), F.lit(".csv"))
    return quality.wrong_month(ledger.withColumn("file_name", named)).select("txn_id", "date", "file_name")


@register(
    """WITH p AS (SELECT DISTINCT file_name, CAST(txn_id AS VARCHAR) AS e FROM ledger WHERE debit IS NULL AND credit IS NULL), f AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY file_name ORDER BY e) <= 5)
       SELECT file_name, (SELECT count(*) FROM ledger l WHERE l.file_name = f.file_name AND debit IS NULL AND credit IS NULL) AS n, string_agg(e, ',' ORDER BY e) AS examples FROM f GROUP BY file_name""",
    "ledger",
)
def missing_amount_examples(ledger):
    found = checks.examples(ledger, "file_name", F.col("debit").isNull() & F.col("credit").isNull(), F.col("txn_id"))
    return found.withColumn("examples", F.array_join("examples", ","))


@register("SELECT account, array_to_string(list_sort(list(DISTINCT trim(s)) FILTER (trim(s) <> 'EOP')), ',') AS excluded FROM (SELECT account, CASE txn_id % 4 WHEN 0 THEN ' VIS' WHEN 1 THEN 'MCA' ELSE 'EOP ' END AS s FROM ledger) GROUP BY 1", "ledger")
def excluded_types(ledger):
    kind = F.when(F.col("txn_id") % 4 == 0, " VIS").when(F.col("txn_id") % 4 == 1, "MCA").otherwise("EOP ")
    return checks.excluded_types(ledger.withColumn("kind", kind), "account", "kind").withColumn("excluded", F.array_join("excluded", ","))


@register("SELECT account, month, sum(coalesce(credit, 0) - coalesce(debit, 0))::BIGINT AS left_net, sum(coalesce(credit, 0) - coalesce(debit, 0) + CASE WHEN txn_id % 100 = 0 THEN 5 ELSE 0 END)::BIGINT AS right_net, -sum(CASE WHEN txn_id % 100 = 0 THEN 5 ELSE 0 END)::BIGINT AS variance FROM ledger GROUP BY 1, 2", "ledger")
def extraction_variance(ledger):
    other = ledger.withColumn("credit", F.coalesce("credit", F.lit(0)) + F.when(F.col("txn_id") % 100 == 0, 5).otherwise(0))
    return coverage.extraction_variance(ledger, other)


@register("SELECT file_name, month, coalesce(description, '-') AS description, count(*) AS n_ids FROM ledger GROUP BY file_name, month, description", "ledger")
def repeated_row_ids(ledger):
    """True repeats have ids of their own: as many ids as rows, and a null text is not an empty one."""
    rows = exprs.with_ids(ledger.select("file_name", "month", "description"), ["file_name", "month", "description"], "row_hash")
    return rows.groupBy("file_name", "month", "description").agg(F.count_distinct("row_hash").alias("n_ids")).withColumn("description", F.coalesce("description", F.lit("-")))


@register("SELECT account, CASE WHEN contains(path, 'acme') THEN 'Acme' WHEN contains(path, 'siam') THEN 'Siam' END AS hint FROM (SELECT DISTINCT account, 'root/' || CASE CAST(account AS INTEGER) % 3 WHEN 0 THEN 'Siam House/ACME' WHEN 1 THEN 'siam' ELSE 'x' END || '/' || account || '.csv' AS p, lower(p) AS path FROM ledger)", "ledger")
def path_hints(ledger):
    part = F.element_at(F.array(F.lit("Siam House/ACME"), F.lit("siam"), F.lit("x")), F.col("account").cast("int") % 3 + 1)
    path = F.concat(F.lit("root/"), part, F.lit("/"), F.col("account"), F.lit(".csv"))
    return ledger.select("account").distinct().select("account", exprs.entity_by_rules(path, [("acme", "Acme"), ("siam", "Siam")]).alias("hint"))


_ENTERED = "(SELECT account, txn_id, month, txn_id * 60 + txn_id % 7 * 400 AS s FROM ledger)"


@register(f"WITH e AS {_ENTERED}, n AS (SELECT a.account, a.txn_id, count(DISTINCT b.month)::INTEGER AS n_months FROM e a JOIN e b ON a.account = b.account AND b.s BETWEEN a.s - 3600 AND a.s + 3600 GROUP BY 1, 2) SELECT * FROM n WHERE n_months >= 5", "ledger")
def back_dated_bursts(ledger):
    """Entries of an account that were made within an hour of others about five months or more."""
    entered = F.timestamp_seconds(F.col("txn_id") * 60 + F.col("txn_id") % 7 * 400)
    found = summaries.bursts(ledger.select("account", "txn_id", "date", entered.alias("entered")), "account", "entered", "date", months=5)
    return found.select("account", "txn_id", "n_months")


@register("SELECT doc_id, string_agg(upper(text), ' ' ORDER BY word_seq) AS holder FROM words WHERE page = 0 AND x0 > 160 AND x0 < 250 AND top + 200 > 280 AND top + 200 < 310 GROUP BY 1", "words")
def card_holders(words):
    return layout.holders(words.withColumn("text", F.upper("text")).withColumn("top", F.col("top") + 200))
