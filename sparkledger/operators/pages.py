"""Transactions from positioned words (doc_id, page, word_seq, text, x0, x1, top), for every known layout.

A document's layout and period come from its text (its file name, if there is one, where the text lacks
them); its words are put in rows; the layout's x limits, or the columns that its header names, tell what a
word is; rows become transactions.  All layouts go through the same joins, groups and windows: a layout is
an entry of ``LAYOUTS`` and a branch of the CASE expressions.  Windows are by page or by document.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkledger.functions import exprs
from sparkledger.operators import layout as L
from sparkledger.plans.shared import materialize


@dataclass(frozen=True)
class Layout:
    """How one kind of statement is laid out; ``dates`` is named, either, day_month or month_day."""

    tolerance: float
    style: str
    dates: str
    date_x: float | None = None
    description: tuple[float, float] | None = None
    amount_x: float | None = None
    widest: float | None = None
    not_described: str | None = None
    amount: str = r"\d"
    skips: tuple[str, ...] = ()
    skip_pattern: str | None = None
    year: int = 2024


#: X limits, marks of amounts, texts of rows that are no transactions, and years where none is found.
LAYOUTS: dict[str, Layout] = {
    "desjardins_pdf": Layout(
        3, "plain", "named", amount=r"^[\d\s]+\.\d{2}-?$", year=2025,
        skips=("SOLDE REPORTÉ", "SOLDE REPORTE", "CAISSE DESJARDINS", "RELEVÉ DE COMPTE", "EPARGNE AVEC", "PAGE"),
    ),
    "rbc_pdf": Layout(
        2, "french", "named", amount=r"^[\d\s,().]+$", year=2025, skip_pattern=r"^\d+\s*de\s*\d+$",
        skips=(
            "Relevé de compte", "d'entreprise", "Numéro de compte", "Solde d'ouverture", "Solde de clôture", "Total des", "Détails des opérations", "Sommaire du compte",
            "forfait bancaire", "Banque Royale", "Pour nous joindre", "www.rbcbanqueroyale", "1-800-Royal", "Frais sur compte",
        ),
    ),
    "desjardins_cc_pdf": Layout(
        2, "credit", "day_month", 130, (250, 470), 450, amount=".", year=2025,
        skips=(
            "AFFAIRES", "MARGE DE CREDIT", "RELEVÉ", "DATE DU", "DESCRIPTION DES TRANSACTIONS", "DATE DE TRANSACTION", "NUMÉRO DE", "OPÉRATIONS AU COMPTE", "PROGRAMME",
            "VOLUME", "REMISE", "NOUVEAU SOLDE", "PAIEMENT DÛ", "PAIEMENT MINIMUM", "ATTENTION", "LE MONTANT", "SERA APPLIQUÉ", "AUTOMATIQUEMENT", "PAGE", "QUÉBEC INC",
            "OWNER_A", "SOLDE COURANT", "REDRESSEMENT",
        ),
    ),
    "rbc_visa_pdf": Layout(
        2, "french", "named", 90, (125, 300), 295, widest=360, not_described=r"^[\d(),$.\s]+$", amount=r"[^$\s]", year=2025,
        skips=("DESCRIPTION DE", "MONTANT", "DATE DE", "SOUS-TOTAL", "RELEVÉ", "INSCRIPTION"), skip_pattern=r"^[\d ]{15,}$|^[A-Z]+\s+[A-Z]+$|^\d{4}\s+\d{2}\*",
    ),
    "bdc_mc_pdf": Layout(
        2, "english", "month_day", 65, (180, 430), 430, amount=".", skip_pattern=r"\*\*\*\*",
        skips=(
            "SOLUTIONS MASTERCARD", "TRANSACTION", "PORTÉ AU RELEVÉ", "REFERENCE", "DESCRIPTION", "DEBITS", "MO.", "J.-D.", "NOUVEAU SOLDE", "NEW BALANCE", "PAIEMENT MIN",
            "DATE DU RELEVÉ", "STATEMENT DATE", "A.-Y.", "PAGE", "POINTS", "RECOMPENSES", "SOLDE REPORTE", "ECHANGES", "ACCUMULES", "EPICERIES", "ESSENCE", "FACTURES",
            "RECURRENTES", "DÉTACHER", "SOLDE PRÉCÉDENT", "PREVIOUS BALANCE", "COMPTE", "ACCOUNT",
        ),
    ),
    "td_visa_pdf": Layout(
        2, "auto", "either", 90, (130, 290), 290, widest=350, not_described=r"^-?[\d\s,.]+\$$", skip_pattern=r"^\d{7,}",
        skips=(
            "PÉRIODE", "DATE DE", "L'OPÉRATION", "PASSATION", "DESCRIPTION DE", "L'ACTIVITÉ", "MONTANT", "SOLDE DU RELEVÉ", "PRÉCÉDENT", "TOTAL", "NOUVEAU SOLDE", "NEW BALANCE",
            "RENSEIGNEMENTS SUR", "LIMITE DE", "TAUX D'INTÉR", "TEMPS ESTIMATIF", "CHAQUE MOIS", "DATE D'ÉCHÉANCE", "CRÉDIT DISPONIBLE", "TRANSACTION DATE", "POSTING DATE",
            "ACTIVITY DESCRIPTION", "AMOUNT($)", "PREVIOUS STATEMENT", "STATEMENT PERIOD", "PAYMENT INFORMATION", "MINIMUM PAYMENT", "PAYMENT DUE", "CREDIT LIMIT",
            "AVAILABLE CREDIT", "ANNUAL INTEREST", "CASH ADVANCES", "ESTIMATED TIME", "YEAR(S)", "MONTH(S)", "POINTS EARNED", "BONUS/ADJUSTMENT", "TOTAL POINTS",
        ),
    ),
    "desj_visa_perso_pdf": Layout(
        2, "credit", "day_month", 130, (210, 425), 465,
        skips=(
            "DESJARDINS VISA", "DATE DU RELEVÉ", "PAGE", "TRANSACTIONS EFFECTUÉES", "CARTE :", "DATE DE TRANSACTION", "DATE  D'INSCRIPTION", "DESCRIPTION", "MONTANT", "BONIDOLLARS",
            "SOMMAIRE", "ESTIMATION", "PAIEMENT MINIMUM", "LIMITE DE CRÉDIT", "TAUX D'INTÉRÊT", "OWNER_A", "NUMÉRO DE COMPTE", "RELEVÉ DE COMPTE", "RENSEIGNEMENTS", "DÉTAILS À LA SECTION",
        ),
    ),
}
#: Header words of the two layouts whose columns are read from their headers.
HEADER = {"Date": "date_x", "Code": "code_x", "Description": "desc_x", "Frais": "frais_x", "Retrait": "retrait_x", "Dépôt": "depot_x", "Solde": "solde_x"}
DEBIT_WORDS, CREDIT_WORDS = ["chèques", "cheques", "débits", "debits"], ["dépôts", "depots", "crédits", "credits"]
_BY_HEADER = ("desjardins_pdf", "rbc_pdf")
_X = ["code_x", "desc_x", "frais_x", "first_limit", "second_limit", "debit_x"]


def _by_layout(value, format: Column | None = None) -> Column:
    """A CASE over the layouts of what ``value`` gives for each; null where it gives none."""
    format, found = F.col("format") if format is None else format, None
    for name, spec in LAYOUTS.items():
        got = value(name, spec)
        if got is not None:
            got = got if isinstance(got, Column) else F.lit(got)
            found = F.when(format == name, got) if found is None else found.when(format == name, got)
    return found


def documents(words: DataFrame) -> DataFrame:
    """By document: format, statement year and month, the period's first month and year, card and account.

    A document's first page decides its layout.  Later pages are looked at for what the first one lacks.
    """
    named = "file_name" if "file_name" in words.columns else None
    joined = lambda sort, text: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(sort, text))), lambda w: w[text]), " ")
    pages = words.groupBy("doc_id", "page").agg(joined("word_seq", "text").alias("text"), (F.max(named) if named else F.lit("")).alias("file_name"))
    docs = pages.groupBy("doc_id").agg(F.min_by("text", "page").alias("text"), joined("page", "text").alias("whole"), F.max("file_name").alias("file_name"))
    docs = docs.join(L.detect_pdf_format(docs.select("doc_id", "text")), "doc_id")

    def pick(pattern: str, group: int = 1, text: str = "text") -> Column:
        return F.nullif(F.regexp_extract(text, "(?iu)" + pattern, group), F.lit(""))

    number = lambda c: c.try_cast("int")
    file = lambda pattern, group=1: pick(pattern, group, "file_name")
    filled_in = r"Jour\s+(\d+)\s+Mois\s+(\d+)\s+Ann[ée]e\s+(\d{4})"
    french = r"du\s+\d+\s+(\p{L}+)\s+(\d{4})\s+au\s+\d+\s+(\p{L}+)\s+(\d{4})"
    english = r"(\p{L}+)\s+\d+,?\s+(\d{4})\s+to\s+(\p{L}+)\s+\d+,?\s+(\d{4})"
    stamped = r"DATE DU RELEV[ÉE].*?(\d{2})\s+(\d{2})\s+(\d{2})"
    any_year = file(r"(\d{4})")
    years = {
        "desjardins_pdf": F.coalesce(pick(r"\b((?:19|20)\d{2})\b"), any_year), "rbc_pdf": F.coalesce(pick(french, 4), any_year), "desjardins_cc_pdf": F.coalesce(pick(filled_in, 3), any_year),
        "rbc_visa_pdf": F.coalesce(file(r"(\d{4})\.\d{2}"), pick(r"\d{2}\s+(?:JAN|F[ÉE]V|MAR|AVR|MAI|JUN|JUI|JUL|AO[ÛU]|SEP|OCT|NOV|D[ÉE]C)\s+(\d{4})"), any_year),
        "bdc_mc_pdf": F.coalesce(F.concat(F.lit("20"), pick(stamped, 1, "whole")), file(r"(\d{4})-\d{2}-\d{2}")),
        "td_visa_pdf": F.coalesce(pick(french, 4, "whole"), pick(english, 4, "whole"), file(r"\w{3}_\d+-(\d{4})")),
        "desj_visa_perso_pdf": F.coalesce(pick(filled_in, 3, "whole"), file(r"\w+-(\d{4})\.pdf")),
    }
    months = {
        "desjardins_cc_pdf": number(pick(filled_in, 2)), "rbc_visa_pdf": number(file(r"\d{4}\.(\d{2})")),
        "bdc_mc_pdf": number(F.coalesce(pick(stamped, 2, "whole"), file(r"\d{4}-(\d{2})-\d{2}"))),
        "desj_visa_perso_pdf": F.coalesce(number(pick(filled_in, 2, "whole")), exprs.month_number(file(r"(\w+)-\d{4}\.pdf"))),
    }
    return docs.select(
        "doc_id", "format", "file_name", F.coalesce(number(_by_layout(lambda n, s: years[n])), _by_layout(lambda n, s: s.year)).alias("year"), _by_layout(lambda n, s: months.get(n)).alias("month"),
        F.when(F.col("format") == "rbc_pdf", number(pick(french, 2))).alias("first_year"), F.when(F.col("format") == "rbc_pdf", exprs.month_number(pick(french, 1))).alias("first_month"),
        F.coalesce(pick(r"(\d{4}\s+\d{2}\*+\s+\*+\s+\d{4})"), pick(r"(\d{4}\s+\d{6}\s+\d{6})", 1, "whole")).alias("card"),
        F.coalesce(F.concat(pick(r"compte:\s*(\d+)\s+[\d-]+"), pick(r"compte:\s*\d+\s+([\d-]+)", 1)), exprs.normalize_account(pick(r"Folio\s+(\d+)"))).alias("account"),
    )


def header_bounds(rows: DataFrame) -> DataFrame:
    """Of rows of words with their format: by page that has a header, the column limits it gives.

    One layout's limits are half-way between the left edges of its amount headers.  The other's lie in the
    gaps between a group's right edge and the next group's left edge, and a ``($)`` belongs to the group that
    ends where it starts.
    """
    first = lambda found, key: F.max(F.when(found, F.col(key)))
    page = ["doc_id", "page"]
    best = lambda df, least: df.where(F.col("n") >= least).withColumn("_n", F.row_number().over(Window.partitionBy(*page).orderBy(F.desc("n"), "row"))).where("_n = 1")
    text = F.trim("text")
    lines = rows.where((F.col("format") == "desjardins_pdf") & text.isin(*HEADER)).groupBy(*page, "row")
    lines = best(lines.agg(F.count_distinct(text).alias("n"), *[first(text == k, "x0").alias(v) for k, v in HEADER.items()]), 3)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    one = lines.where("retrait_x is not null and solde_x is not null").select(
        *page, zero("code_x").alias("code_x"), zero("desc_x").alias("desc_x"), zero("frais_x").alias("frais_x"),
        F.when(zero("depot_x") > 0, (F.col("retrait_x") + F.col("depot_x")) / 2).otherwise(F.col("retrait_x") + 50).alias("first_limit"),
        F.when(F.col("solde_x") > 0, (zero("depot_x") + F.col("solde_x")) / 2).otherwise(zero("depot_x") + 40).alias("second_limit"), F.lit(None).cast("double").alias("debit_x"),
    )

    lower = F.lower(text)
    marks = rows.where((F.col("format") == "rbc_pdf") & lower.isin("date", "description", "solde", "($)", *DEBIT_WORDS, *CREDIT_WORDS)).withColumn("_t", lower)
    is_debit, is_credit, dollar = F.col("_t").isin(DEBIT_WORDS), F.col("_t").isin(CREDIT_WORDS), F.col("_t") == "($)"
    dollars = F.collect_list(F.when(dollar, F.struct("x0", "x1")))
    least = lambda found, key: F.min(F.when(found, F.col(key)))
    lines = best(
        marks.groupBy(*page, "row").agg(
            F.count("*").alias("n"), first(is_debit, "x1").alias("d1"), least(is_credit, "x0").alias("c0"), first(is_credit, "x1").alias("c1"), least(F.col("_t") == "solde", "x0").alias("b0"),
            least(F.col("_t") == "date", "x0").alias("t0"), least(F.col("_t") == "description", "x0").alias("desc_x"), dollars.alias("_d"),
        ), 5,
    )
    edge = lambda c, default: F.coalesce(F.col(c), F.lit(float(default)))
    d1, c0, c1, b0 = edge("d1", 0), edge("c0", 999), edge("c1", 0), edge("b0", 999)
    over = lambda start, keep: F.aggregate(F.filter("_d", keep), start, lambda a, d: F.greatest(a, d["x1"]))
    debit_right = over(d1, lambda d: d["x1"] < c0)
    credit_right = over(c1, lambda d: (d["x1"] >= c0) & (d["x0"] < b0))
    two = lines.select(
        *page, F.lit(None).cast("double").alias("code_x"), edge("desc_x", 90).alias("desc_x"), F.lit(None).cast("double").alias("frais_x"),
        ((debit_right + c0) / 2).alias("first_limit"), ((credit_right + b0) / 2).alias("second_limit"), (debit_right - 80).alias("debit_x"),
    )
    return one.unionByName(two)


def token_flags(x0: Column, text: Column, format: Column, bounds: dict[str, Column]) -> dict[str, Column]:
    """is_date, is_code, is_description and is_amount of a word; a word of an overlapping zone may be two of them.

    ``bounds`` has the columns code_x, desc_x, frais_x and debit_x of the layouts that are read by their headers.
    """
    b, none = bounds, F.lit(False)
    amount_left, short = b["frais_x"] - 10, F.length(text) <= 4

    def flags(name: str, spec: Layout) -> dict[str, Column]:
        if name == "desjardins_pdf":
            money = text.rlike(spec.amount) & (x0 > amount_left)
            date = ~money & (x0 < b["code_x"] - 5)
            code = ~money & ~date & (x0 < b["code_x"] + 25) & short
            said = ~money & ~date & ~code & (x0 < amount_left)
        elif name == "rbc_pdf":
            left = b["debit_x"] - 10
            money, date, code = (x0 >= left) & text.rlike(spec.amount), x0 < b["desc_x"] - 5, none
            said = (x0 >= b["desc_x"] - 5) & (x0 < left)
        else:
            low, high = spec.description
            money, date, code = (x0 > spec.amount_x) & text.rlike(spec.amount), x0 < spec.date_x, none
            said = (x0 > low) & (x0 < high) & (~text.rlike(spec.not_described) if spec.not_described else F.lit(True))
        return {"is_date": date, "is_code": code, "is_description": said, "is_amount": money}

    cases = {name: flags(name, spec) for name, spec in LAYOUTS.items()}
    return {k: F.coalesce(_by_layout(lambda n, s, k=k: cases[n][k], format), none) for k in ("is_date", "is_code", "is_description", "is_amount")}


def _date_parts() -> dict[str, Column]:
    """Day and month as written: with a month's name behind or before the day, or as two numbers."""
    part = lambda p, k: F.nullif(F.regexp_extract("date_text", p, k), F.lit(""))
    named, turned = r"^(\d{1,2})\s+(\p{L}+)", r"^(\p{L}{3,})\s+(\d{1,2})"
    number = lambda k: F.when(F.size("digits") >= 2, F.get("digits", F.lit(k))).try_cast("int")
    return {
        "_day1": part(named, 1).try_cast("int"), "_month1": exprs.month_number(part(named, 2)), "_day2": part(turned, 2).try_cast("int"), "_month2": exprs.month_number(part(turned, 1)),
        "_first": number(0), "_second": number(1),
    }


def _day_and_month(which: str) -> Column:
    """day or month of a row, by the way its layout writes dates."""
    first, second = ("_first", "_second") if which == "day" else ("_second", "_first")
    either = F.when(F.col("_month1").isNotNull(), F.col(f"_{which}1")).otherwise(F.col(f"_{which}2"))
    ways = {"named": F.col(f"_{which}1"), "either": either, "day_month": F.col(first), "month_day": F.col(second)}
    return _by_layout(lambda n, s: ways[s.dates])


def _year_of(month: Column) -> Column:
    """The year of a row's month: periods over two years, and months after the statement's, which are of the year before."""
    over = (F.col("first_year") != F.col("year")) & (month >= F.col("first_month"))
    before = F.coalesce(month > F.col("month"), F.lit(False))
    plain = F.when(before, F.col("year") - 1).otherwise(F.col("year"))
    ways = {"rbc_pdf": F.when(F.coalesce(over, F.lit(False)), F.col("first_year")).otherwise(F.col("year")), "rbc_visa_pdf": F.when(month > 6, plain).otherwise(F.col("year"))}
    return _by_layout(lambda n, s: ways.get(n, plain if s.dates in ("day_month", "month_day") else F.col("year")))


def transactions(words: DataFrame, cardholders: list[str] | None = None) -> DataFrame:
    """doc_id, page, row, format, date, code, description, debit, credit, balance, card and account of each transaction.

    Documents of no known layout, pages before a document's first header (where the layout needs one) and
    rows that a layout's list passes over give nothing.  Rows that name one of ``cardholders`` are passed
    over in the card layouts.  An empty table gives an empty one; null texts are no words.
    """
    words = words.where("text is not null and trim(text) <> ''")
    docs = documents(words)
    known = docs.where(F.col("format").isin(*LAYOUTS))
    of = words.select("doc_id", "page", "word_seq", F.trim("text").alias("text"), "x0", "x1", "top").join(known, "doc_id")
    widest = _by_layout(lambda n, s: s.widest)
    of = of.where(widest.isNull() | (F.col("x0") < widest))
    rows = L.rows_by_anchor(of, _by_layout(lambda n, s: float(s.tolerance)))
    pages = rows.select("doc_id", "page").distinct()
    bounds = L.carry_bounds(pages, header_bounds(rows))
    rows = rows.join(bounds, ["doc_id", "page"], "left")
    x = {c: F.col(c) for c in _X}
    rows = rows.withColumns(token_flags(F.col("x0"), F.col("text"), F.col("format"), x))
    rows = rows.withColumn("col", L.amount_column(F.col("x0"), F.col("x1"), [(x["first_limit"], "debit"), (x["second_limit"], "credit"), (None, "balance")]))
    rows = rows.where(~F.col("format").isin(*_BY_HEADER) | x["first_limit"].isNotNull())

    word = F.struct("x0", "word_seq", "text", "is_date", "is_code", "is_description", "is_amount", "col")
    meta = ["format", "year", "month", "first_year", "first_month", "card", "account"]
    lines = rows.groupBy("doc_id", "page", "row", *meta).agg(F.array_sort(F.collect_list(word)).alias("w"), F.min_by("top", "word_seq").alias("top"))
    texts = lambda keep: F.transform(F.filter("w", keep), lambda v: v["text"])
    said = lambda flag: F.array_join(texts(lambda v: v[flag]), " ")
    money = lambda col: texts(lambda v: v["is_amount"] & (v["col"] == col))
    lines = lines.select(
        "doc_id", "page", "row", "top", *meta, F.array_join(F.transform("w", lambda v: v["text"]), " ").alias("full"), said("is_date").alias("date_text"), said("is_code").alias("code"),
        said("is_description").alias("description"), said("is_amount").alias("amount_text"), texts(lambda v: v["is_date"] & v["text"].rlike(r"^\d{2}$")).alias("digits"),
        money("debit").alias("debits"), money("credit").alias("credits"), money("balance").alias("balances"),
    )
    # Each step's columns are written before the next uses them, or the plan would repeat them in every branch.
    lines = materialize(lines, "page-lines")

    upper = F.upper("full")
    raw = {"rbc_pdf": F.col("full"), "desjardins_pdf": F.upper("description")}
    has_any = lambda where, marks: F.exists(F.array(*[F.lit(t) for t in marks]), lambda t: F.contains(where, t))
    listed = _by_layout(lambda n, s: has_any(raw.get(n, upper), s.skips))
    shaped = _by_layout(lambda n, s: F.col("full").rlike(s.skip_pattern) if s.skip_pattern else F.lit(False))
    skipped = listed | shaped
    if cardholders:
        skipped = skipped | (has_any(upper, [c.upper() for c in cardholders]) & F.col("format").isin("desjardins_cc_pdf", "desj_visa_perso_pdf"))
    bank = F.col("format") == "desjardins_pdf"
    enter = bank & F.contains(upper, F.lit("EOP")) & (F.contains(upper, F.lit("EPARGNE")) | F.contains(upper, F.lit("OPERATIONS")))
    leave = bank & upper.rlike(r"COMPTE D'EPARGNE ET DE PLACEMENT|SOMMAIRE DES FRAIS|^PRET\b|PRET PERSONNEL|PRET HYPOTHE")
    # Column layouts: words of a column are summed, or the joined fragments are one amount; card layouts: the sign tells.
    amounts = lambda c: F.transform(c, lambda t: F.abs(exprs.parse_amount(t)))
    total = lambda c: F.when(F.size(c) > 0, F.aggregate(amounts(c), F.lit(0).cast("decimal(28,2)"), lambda a, v: (a + F.coalesce(v, F.lit(0))).cast("decimal(28,2)")).cast(exprs.MONEY))
    spelled = lambda c: exprs.parse_amount(F.array_join(c, " "), "french")
    lines = lines.select(
        "doc_id", "page", "row", "top", *meta, "code", "description", skipped.alias("skipped"), enter.alias("enter"), leave.alias("leave"), *[c.alias(k) for k, c in _date_parts().items()],
        *[exprs.parse_amount(F.col("amount_text"), style).alias(f"_{style}") for style in ("credit", "french", "english", "auto")],
        *[F.when(bank, total(c)).otherwise(F.abs(spelled(c))).alias(f"_{c}") for c in ("debits", "credits")],
        F.when(bank & (F.size("balances") > 0), exprs.parse_amount(F.element_at("balances", -1))).otherwise(spelled("balances")).alias("_balances"),
    )
    lines = lines.withColumn("leave", F.col("leave") & ~F.col("enter")).withColumns({"day": _day_and_month("day"), "month_of_row": _day_and_month("month")})
    lines = materialize(lines, "page-rows")

    in_document = Window.partitionBy("doc_id").orderBy("page", "top", "row").rowsBetween(Window.unboundedPreceding, 0)
    own = exprs.date_of(_year_of(F.col("month_of_row")), F.col("month_of_row"), F.col("day"))
    lines = lines.withColumns(
        {
            "_own": F.when(~F.col("leave") & (bank | ~F.col("skipped")), own),
            "_run": F.sum(F.col("leave").cast("int")).over(in_document),
            "_inside": F.last(F.when(F.col("leave"), 0).when(F.col("enter"), 1), ignorenulls=True).over(in_document),
        }
    )
    in_page = Window.partitionBy("doc_id", "page", "_run").orderBy("top", "row").rowsBetween(Window.unboundedPreceding, 0)
    carried = _by_layout(lambda n, s: s.dates in ("named", "either"))
    lines = lines.withColumn("date", F.when(carried, F.last("_own", ignorenulls=True).over(in_page)).otherwise(F.col("_own")))
    lines = lines.where(~F.col("skipped") & ~F.col("enter") & ~F.col("leave") & (~bank | (F.col("_inside") == 1)) & F.col("date").isNotNull())

    signed = _by_layout(lambda n, s: None if n in _BY_HEADER else F.col(f"_{s.style}"))
    by_header = F.col("format").isin(*_BY_HEADER)
    lines = lines.withColumn("_signed", signed).withColumns(
        {
            "debit": F.when(by_header, F.col("_debits")).when(F.col("_signed") >= 0, F.col("_signed")),
            "credit": F.when(by_header, F.col("_credits")).when(F.col("_signed") < 0, -F.col("_signed")),
            "balance": F.when(by_header, F.col("_balances")),
        }
    )
    moved, told = F.col("debit").isNotNull() | F.col("credit").isNotNull(), F.col("description") != ""
    real = {"desjardins_pdf": moved, "rbc_pdf": (exprs.has_amount(F.col("debit")) | exprs.has_amount(F.col("credit"))) & told}
    kept = lines.where(_by_layout(lambda n, s: real.get(n, moved & told)))
    return kept.select("doc_id", "page", "row", "format", "date", F.nullif("code", F.lit("")).alias("code"), "description", "debit", "credit", "balance", "card", "account")
