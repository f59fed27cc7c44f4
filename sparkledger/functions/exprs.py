"""Scalar expressions over amounts, dates, accounts, paths and texts. All return columns and stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

BLANK = "[\\s\\u00A0]"
MONEY = "decimal(18,2)"
#: Month names by their first letters, longest first where one begins another.
MONTHS = {
    "janv": 1, "jan": 1, "fév": 2, "fev": 2, "feb": 2, "mars": 3, "mar": 3, "avr": 4, "apr": 4, "mai": 5, "may": 5,
    "juin": 6, "jun": 6, "juil": 7, "jui": 7, "jul": 7, "août": 8, "aout": 8, "aoû": 8, "aou": 8, "aug": 8,
    "sep": 9, "oct": 10, "nov": 11, "déc": 12, "dec": 12,
}


def _number(text: Column) -> Column:
    return F.when(text.rlike("^[+-]?(\\d+(\\.\\d*)?|\\.\\d+)$"), text.try_cast(MONEY))


def parse_float(text: Column) -> Column:
    """A plain decimal; spaces and no-break spaces go, anything else unparsable is null."""
    return _number(F.regexp_replace(text, BLANK, ""))


def parse_french_float(text: Column) -> Column:
    """A decimal with a comma; quotes and blanks go."""
    return _number(F.replace(F.regexp_replace(text, '[\\s\\u00A0"]', ""), F.lit(","), F.lit(".")))


def parse_amount(text: Column, style: str = "plain") -> Column:
    """An amount in a statement's style.

    plain: blanks part thousands, a trailing minus is negative.  french: parentheses are negative, $
    goes, comma decimals.  credit: a CR suffix is negative.  english: commas part thousands, trailing
    minus negative.  auto: french or english by which mark comes last.
    """
    bare = F.regexp_replace(text, '[\\s\\u00A0$"]', "")
    if style == "credit":
        credit = F.upper(bare).endswith("CR")
        value = parse_amount(F.regexp_replace(bare, "(?i)CR$", ""), "auto")
        return F.when(credit, -value).otherwise(value)
    minus = bare.endswith("-") | bare.startswith("-") | (bare.startswith("(") & bare.endswith(")"))
    digits = F.regexp_replace(bare, "[-()]", "")
    if style == "french":
        digits = F.replace(digits, F.lit(","), F.lit("."))
    elif style == "english":
        digits = F.replace(digits, F.lit(","), F.lit(""))
    elif style == "auto":
        comma = F.instr(F.reverse(digits), ",")
        dot = F.instr(F.reverse(digits), ".")
        french = (comma > 0) & ((dot == 0) | (comma < dot)) & (comma <= 3)
        digits = F.when(french, F.replace(F.replace(digits, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).otherwise(F.replace(digits, F.lit(","), F.lit("")))
    value = _number(digits)
    return F.when(minus, -value).otherwise(value)


def month_number(name: Column) -> Column:
    """1 to 12 by the longest known beginning of a French or English month name; else null."""
    lower, found = F.lower(F.trim(name)), None
    for prefix in sorted(MONTHS, key=len, reverse=True):
        found = F.when(lower.startswith(prefix), MONTHS[prefix]) if found is None else found.when(lower.startswith(prefix), MONTHS[prefix])
    return found


def date_of(year: Column, month: Column, day: Column) -> Column:
    """A date, or null where there is none such."""
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    return F.concat(pad(year, 4), F.lit("-"), pad(month, 2), F.lit("-"), pad(day, 2)).try_cast("date")


def normalize_date(text: Column) -> Column:
    """ISO dates, dates with slashes, and day, month name, year; null where none fits."""
    bare = F.trim(text)
    words = "^(\\d{1,2})\\s+(\\p{L}+)\\.?,?\\s+(\\d{4})$"
    part = lambda k: F.regexp_extract(bare, words, k)
    named = F.when(bare.rlike(words), date_of(part(3), month_number(part(2)), part(1)))
    iso = F.when(bare.rlike("^\\d{4}-\\d{2}-\\d{2}$"), bare.try_cast("date"))
    slashed = F.when(bare.rlike("^\\d{4}/\\d{2}/\\d{2}$"), F.replace(bare, F.lit("/"), F.lit("-")).try_cast("date"))
    return F.coalesce(iso, slashed, named)


def month_of(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def normalize_account(account: Column) -> Column:
    """Accounts of five and six digits are padded to seven; others only trimmed."""
    bare = F.trim(account)
    return F.when(F.length(bare) == 5, F.concat(F.lit("00"), bare)).when(F.length(bare) == 6, F.concat(F.lit("0"), bare)).otherwise(bare)


def has_amount(amount: Column) -> Column:
    """Whether an amount is there and not zero."""
    return F.coalesce(amount, F.lit(0)) != 0


def last_path_parts(path: Column, n: int = 3) -> Column:
    parts = F.split(path, "/")
    return F.lower(F.array_join(F.slice(parts, F.greatest(F.size(parts) - (n - 1), F.lit(1)), n), "/"))


def entity_from_path(relative: Column) -> Column:
    """entities/<name>/… gives the name, anything else is global."""
    parts = F.split(relative, "/")
    return F.when((F.get(parts, F.lit(0)) == "entities") & (F.size(parts) > 2), F.get(parts, F.lit(1))).otherwise(F.lit("global"))


def keyword_label(text: Column, keywords: dict[str, list[str]], default: str) -> Column:
    """The first label one of whose keywords the lower-case text has."""
    lower, found = F.lower(text), None
    for label, words in keywords.items():
        hit = F.lit(False)
        for word in words:
            hit = hit | lower.contains(word)
        found = F.when(hit, label) if found is None else found.when(hit, label)
    return found.otherwise(default)


def date_on_document(name: Column) -> Column:
    """A date in a file name: a full one, else a year and month at its first day; else null."""
    full = F.nullif(F.regexp_extract(name, "(\\d{4}-\\d{2}-\\d{2})", 1), F.lit(""))
    month = "(\\d{4})[._-](\\d{2})\\b"
    part = F.when(name.rlike(month), F.concat(F.regexp_extract(name, month, 1), F.lit("-"), F.regexp_extract(name, month, 2), F.lit("-01")))
    return F.coalesce(full, part)


def is_placeholder(value: Column) -> Column:
    """Blank, an angle-bracket template, or the template month."""
    bare = F.trim(F.coalesce(value, F.lit("")))
    return (bare == "") | bare.rlike("^<[^>]+>$") | bare.contains("YYYY-MM")


def transaction_id(*columns: str) -> Column:
    """A hash of a row's own values, the same wherever and whenever it is computed; nulls count as empty."""
    return F.sha2(F.concat_ws("\u001f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), 256)


def with_ids(df, columns: list[str], name: str = "txn_id", order: str | None = None):
    """Adds an id: a hash of a row's own values and of how often they have come before, so true repeats differ.

    A null and an empty text differ.  Repeats are numbered in order of ``order``, or arbitrarily; the ids of a
    set of rows are the same either way.
    """
    from pyspark.sql import Window

    told = [F.when(F.col(c).isNull(), F.lit("\u0000")).otherwise(F.concat(F.lit("="), F.col(c).cast("string"))) for c in columns]
    rows = df.withColumn("_values", F.sha2(F.concat_ws("\u001f", *told), 256))
    nth = F.row_number().over(Window.partitionBy("_values").orderBy(order or F.lit(0)))
    return rows.withColumn(name, F.sha2(F.concat_ws("\u001f", "_values", nth.cast("string")), 256)).drop("_values")


def entity_by_rules(path: Column, rules: list[tuple[str, str]]) -> Column:
    """The entity of the first rule (pattern, entity) that the last three parts of a path fit; else null."""
    parts, found = last_path_parts(path), None
    for pattern, entity in rules:
        hit = parts.rlike("(?iU)" + pattern)
        found = F.when(hit, entity) if found is None else found.when(hit, entity)
    return F.lit(None).cast("string") if found is None else found


def similarity(a: Column, b: Column) -> Column:
    """One less the edit distance over the longer length; two empty texts are equal."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / longest)


def cross_check(file_name: Column, format: Column) -> Column:
    """A warning if a file is named for another bank than its content shows; else null."""
    lower, named = F.lower(file_name), None
    for bank in ("desjardins", "rbc", "amex"):
        named = F.when(lower.contains(bank), bank) if named is None else named.when(lower.contains(bank), bank)
    found = F.get(F.split(format, "_"), F.lit(0))
    return F.when(named.isNotNull() & (named != found), F.concat(F.lit("named for "), named, F.lit(" but holds "), found))


#: Marks of legal interpretation; each is looked for in the lower-case text between blanks.
LEGAL_MARKS = [" s.", " bia ", " loi ", " itc", " ita ", "art.", "paragraph", "subparagraph", "statutory interpretation", "jurisprudence"]


def has_legal_wording(text: Column) -> Column:
    padded = F.concat(F.lit(" "), F.lower(F.coalesce(text, F.lit(""))), F.lit(" "))
    found = F.lit(False)
    for mark in LEGAL_MARKS:
        found = found | padded.contains(mark)
    return found
