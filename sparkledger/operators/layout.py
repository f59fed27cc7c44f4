"""Rows, columns and sections from positioned words (doc_id, page, word_seq, text, x0, x1, top)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

PAGE = ["doc_id", "page"]


def rows_by_gap(words: DataFrame, tolerance: float) -> DataFrame:
    """Adds row: words whose tops follow each other within ``tolerance`` share one."""
    down = Window.partitionBy(*PAGE).orderBy("top", "word_seq")
    gap = F.col("top") - F.lag("top").over(down)
    new = F.when(gap.isNull() | (gap > tolerance), 1).otherwise(0)
    return words.withColumn("_new", new).withColumn("row", F.sum("_new").over(down.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def rows_by_anchor(words: DataFrame, tolerance: float | Column) -> DataFrame:
    """Adds row: a word joins the first row of its page whose first word is within ``tolerance``, else it opens one.

    The tolerance may be a column that is the same for all words of a page.

    A page's words are folded in reading order inside one expression; a page bounds what is gathered.
    """
    word = F.struct("word_seq", "top")
    limit = F.max(tolerance if isinstance(tolerance, Column) else F.lit(float(tolerance))).alias("_tolerance")
    tops = words.groupBy(*PAGE).agg(F.array_sort(F.collect_list(word)).alias("_words"), limit)

    def place(state: Column, w: Column) -> Column:
        anchors = state["anchors"]
        near = F.filter(F.sequence(F.lit(1), F.size(anchors)), lambda i: F.abs(F.element_at(anchors, i) - w["top"]) <= F.col("_tolerance"))
        known = F.when(F.size(anchors) > 0, F.get(near, F.lit(0)))
        row = F.coalesce(known, F.size(anchors) + 1)
        grown = F.when(known.isNull(), F.array_append(anchors, w["top"])).otherwise(anchors)
        return F.struct(grown.alias("anchors"), F.array_append(state["placed"], F.struct(w["word_seq"].alias("word_seq"), row.cast("int").alias("row"))).alias("placed"))

    start = F.struct(F.array().cast("array<double>").alias("anchors"), F.array().cast("array<struct<word_seq: bigint, row: int>>").alias("placed"))
    placed = tops.select(*PAGE, F.explode(F.aggregate("_words", start, place, lambda s: s["placed"])).alias("_p")).select(*PAGE, "_p.word_seq", "_p.row")
    return words.join(placed, [*PAGE, "word_seq"])


def row_texts(rows: DataFrame) -> DataFrame:
    """A row's words in order of x, joined by spaces, with its first word's number and top."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "word_seq", "text"))), lambda w: w["text"]), " ")
    return rows.groupBy(*PAGE, "row").agg(text.alias("text"), F.min("word_seq").alias("word_seq"), F.min("top").alias("top"), F.count("*").alias("n_words"))


def header_columns(rows: DataFrame, keywords: list[str], least: int, needed: list[str]) -> DataFrame:
    """By page the row with most distinct keywords, if it has ``least`` of them and all that are needed: the x0 of each keyword."""
    words = rows.where(F.col("text").isin(keywords))
    found = words.groupBy(*PAGE, "row").agg(F.count_distinct("text").alias("n"), *[F.max(F.when(F.col("text") == k, F.col("x0"))).alias(k) for k in keywords])
    for k in needed:
        found = found.where(F.col(k).isNotNull())
    best = F.row_number().over(Window.partitionBy(*PAGE).orderBy(F.desc("n"), "row"))
    return found.where(F.col("n") >= least).withColumn("_n", best).where("_n = 1").drop("_n")


def carry_bounds(pages: DataFrame, bounds: DataFrame) -> DataFrame:
    """Each page with the bounds of the last page that had a header; pages before the first have none."""
    last = Window.partitionBy("doc_id").orderBy("page").rowsBetween(Window.unboundedPreceding, 0)
    names = [c for c in bounds.columns if c not in (*PAGE, "row", "n")]
    joined = pages.select(*PAGE).distinct().join(bounds.withColumn("_b", F.struct(*names)).select(*PAGE, "_b"), PAGE, "left")
    return joined.withColumn("_b", F.last("_b", ignorenulls=True).over(last)).select(*PAGE, "_b.*")


def amount_column(x0: Column, x1: Column, bounds: list[tuple[Column, str]]) -> Column:
    """The first column whose right bound lies beyond a word's middle; the last has no bound."""
    middle, found = (x0 + x1) / 2, None
    for limit, name in bounds[:-1]:
        found = F.when(middle < limit, name) if found is None else found.when(middle < limit, name)
    return found.otherwise(bounds[-1][1])


def token_role(profile: str, x0: Column, text: Column, bounds: dict[str, Column] | None = None) -> Column:
    """date, code, amount, description or other, by a layout's x limits.

    The two account layouts have none of their own: they need ``bounds`` with the limits of their headers.
    """
    from sparkledger.operators.pages import token_flags

    limits = {c: F.lit(None).cast("double") for c in ("code_x", "desc_x", "frais_x", "debit_x")} | (bounds or {})
    flags = token_flags(x0, text, F.lit(profile), limits)
    found = F.when(flags["is_date"], "date").when(flags["is_code"], "code").when(flags["is_amount"], "amount")
    return found.when(flags["is_description"], "description").otherwise("other")


def carry_sections(rows: DataFrame, enter: Column, leave: Column) -> DataFrame:
    """Adds in_section: the last marker at or before a row of its document, over pages, was one that enters."""
    order = Window.partitionBy("doc_id").orderBy("page", "row").rowsBetween(Window.unboundedPreceding, 0)
    marker = F.when(leave, 0).when(enter, 1)
    return rows.withColumn("_m", marker).withColumn("in_section", F.coalesce(F.last("_m", ignorenulls=True).over(order) == 1, F.lit(False))).drop("_m")


def carry_dates(rows: DataFrame, date: str) -> DataFrame:
    """A row without a date has the one before it on its page."""
    order = Window.partitionBy(*PAGE).orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(date, F.last(date, ignorenulls=True).over(order))


def statement_date(day: Column, month: Column, year: Column, statement_month: Column) -> Column:
    """Months after the statement's belong to the year before."""
    from sparkledger.functions.exprs import date_of

    return date_of(F.when(month > statement_month, year - 1).otherwise(year), month, day)


def metadata(pages: DataFrame) -> DataFrame:
    """From first-page texts (doc_id, text): year, masked card, account and branch, null where not found."""
    pick = lambda p: F.nullif(F.regexp_extract("text", p, 1), F.lit(""))
    return pages.select("doc_id", pick("\\b((?:19|20)\\d{2})\\b").alias("year"), pick("((?:\\d{4}|[X*]{4})(?: [\\dX*]{2,4}){2,3})").alias("card"), pick("(?i)(?:folio|compte)\\D{0,5}(\\d{5,7})").alias("account"), pick("(?i)(?:caisse|succursale)\\D{0,5}(\\d{3,5})").alias("branch"))


#: Where a card statement's first page names the holder (x0 and top, both ends excluded), and how.
HOLDER_X, HOLDER_TOP, HOLDER_WORD = (160, 250), (280, 310), "^[A-Z]{3,}$"


def holders(words: DataFrame) -> DataFrame:
    """doc_id and holder, the capital words in the holder's place on page 0 in order; documents without any have no row."""
    inside = lambda c, ends: (F.col(c) > ends[0]) & (F.col(c) < ends[1])
    said = words.where((F.col("page") == 0) & inside("x0", HOLDER_X) & inside("top", HOLDER_TOP) & F.trim("text").rlike(HOLDER_WORD))
    named = F.array_sort(F.collect_list(F.struct("word_seq", F.trim("text").alias("t"))))
    return said.groupBy("doc_id").agg(F.array_join(F.transform(named, lambda w: w["t"]), " ").alias("holder"))


def detect_pdf_format(pages: DataFrame) -> DataFrame:
    """From first-page texts (doc_id, text): the layout; the first rule that fits decides."""
    up = F.upper("text")
    format = (
        F.when(up.contains("AEROPLAN") & up.contains("TD"), "td_visa_pdf").when(up.contains("BDC") | (up.contains("SOLUTIONS") & up.contains("MASTERCARD")), "bdc_mc_pdf")
        .when((up.contains("RBC") | up.contains("BANQUE ROYALE")) & up.contains("VISA"), "rbc_visa_pdf").when(up.contains("RBC") | up.contains("BANQUE ROYALE"), "rbc_pdf")
        .when(F.substring(up, 1, 600).contains("AFFAIRES") & F.substring(up, 1, 600).contains("MARGE"), "desjardins_cc_pdf")
        .when(up.contains("BONIDOLLARS") | up.contains("4530 92"), "desj_visa_perso_pdf").when(up.contains("DESJARDINS") | up.contains("CAISSE"), "desjardins_pdf").otherwise("unknown")
    )
    return pages.select("doc_id", format.alias("format"))


def merge_amounts(words: DataFrame, style: str = "plain", join: bool = False) -> DataFrame:
    """By row and column (col) of amount words: their sum, or the amount that the joined fragments spell."""
    from sparkledger.functions.exprs import parse_amount

    if not join:
        return words.groupBy(*PAGE, "row", "col").agg(F.sum(parse_amount(F.col("text"), style)).alias("amount"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "text"))), lambda w: w["text"]), "")
    return words.groupBy(*PAGE, "row", "col").agg(text.alias("_t")).select(*PAGE, "row", "col", parse_amount(F.col("_t"), style).alias("amount"))


def known_documents(pages: DataFrame) -> DataFrame:
    """Of first-page texts (doc_id, text) the documents of a known layout, with it."""
    return detect_pdf_format(pages).where("format <> 'unknown'")
