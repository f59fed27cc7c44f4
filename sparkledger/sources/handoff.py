"""The sheets that one program hands to the next: their columns, writing them, and reading them back with types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkledger.functions import exprs

MONEY = exprs.MONEY
#: Columns of the sheets, in their order.
TRANSFERS = "date date, amount decimal(18,2), source_entity string, source_account string, destination_entity string, destination_account string, transfer_type string, matched boolean, description string, file string"
MASTER = "date date, entity string, account string, description string, debit decimal(18,2), credit decimal(18,2), balance decimal(18,2), category string, category_label string, source_type string, file string"
OWNER = "date date, amount decimal(18,2), from string, to string, type string, description string, file string"
MATRIX = "month string, from string, to string, amount decimal(18,2)"
CARDS = "date string, card string, description string, amount decimal(18,2), class string, category string, label string, business_amount decimal(18,2), status string, note string, month string"
REGISTRY = "source_id string, path string, sha256 string, size_bytes long, first_seen string, last_verified string, entity string, domain string, document_type string, obtained_from string, date_on_document string"
_MARK = "﻿"


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _shaped(df: DataFrame, schema: str) -> DataFrame:
    """The sheet's columns in order and type; those that ``df`` lacks are null."""
    fields = [field.split(" ", 1) for field in schema.split(", ")]
    return df.select(*[(F.col(f"`{name}`") if name in df.columns else F.lit(None)).cast(kind).alias(name) for name, kind in fields])


def transfers_sheet(legs: DataFrame) -> DataFrame:
    """All legs, in order of date."""
    return _shaped(legs, TRANSFERS).orderBy("date")


def master_sheet(ledger: DataFrame) -> DataFrame:
    """All rows by entity and date; amounts of zero are left blank, balances of zero are not."""
    blank = lambda c: F.when(F.col(c) != 0, F.col(c))
    return _shaped(ledger.withColumns({"debit": blank("debit"), "credit": blank("credit")}), MASTER).orderBy("entity", "date")


def owner_sheet(repaid: DataFrame, advanced: DataFrame, type_of: Column) -> DataFrame:
    """Legs of one owner, both sets with their duplicates, with a type, in order of date."""
    rows = repaid.unionByName(advanced, allowMissingColumns=True)
    return _shaped(rows.withColumns({"from": F.col("source_entity"), "to": F.col("destination_entity"), "type": type_of}), OWNER).orderBy("date")


def matrix_sheet(matrix: DataFrame) -> DataFrame:
    """month, from, to and amount (month, src, dst, amount), rounded to cents; only what is above zero."""
    rows = matrix.select("month", F.col("src").alias("from"), F.col("dst").alias("to"), F.round("amount", 2).alias("amount"))
    return _shaped(rows.where("amount > 0"), MATRIX).orderBy("month", "from", "to")


def card_sheet(cards: DataFrame) -> DataFrame:
    return _shaped(cards, CARDS)


def write(sheet: DataFrame, path: str) -> None:
    """A sheet as CSV with a header, nulls blank; files follow the sheet's order."""
    sheet.write.option("header", True).option("quoteAll", True).option("nullValue", None).option("emptyValue", "").option("escape", '"')\
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    # All as text first: a blank is a null of any type, and what cannot be read is one too.
    names = _names(schema)
    text = spark.read.schema(", ".join(f"`{n}` string" for n in names)).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    kinds = dict(field.split(" ", 1) for field in schema.split(", "))
    value = lambda n: F.nullif(F.col(f"`{n}`"), F.lit(""))
    return text.select(*[(value(n) if kinds[n] == "string" else value(n).try_cast(kinds[n])).alias(n) for n in names])


def load_transfers(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, TRANSFERS)


def load_transactions(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, MASTER)


def load_cards(spark: SparkSession, path: str) -> DataFrame:
    """The card master: description, amount (its absolute value), card, date, month and bad_amount.

    A byte-order mark goes, a comma is a decimal point, a month that is not given is the date's.  An amount
    that cannot be read is null and flagged, not zero.
    """
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    rows = rows.toDF(*[c.strip().lstrip(_MARK).strip('"').lower() for c in rows.columns])
    text = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
    raw = F.coalesce(F.trim(text("montant")), F.lit("0" if "montant" not in rows.columns else ""))
    amount = F.abs(exprs.parse_french_float(raw))
    month = F.coalesce(F.nullif(text("mois"), F.lit("")), F.substring(text("date"), 1, 7))
    return rows.select(F.coalesce(text("description"), F.lit("")).alias("description"), amount.alias("amount"), text("carte").alias("card"), text("date").alias("date"), month.alias("month"), amount.isNull().alias("bad_amount"))


#: Documents of an object that are put in one file.
OBJECT_ROWS = 10_000


def write_registry(registry: DataFrame, path: str, kind: str = "json") -> None:
    """The registry as JSON lines, a document each; as JSON objects keyed by path (kind ``object``), or as CSV with a header.

    An object's documents without a path are left out.  Up to OBJECT_ROWS documents make one object in one file, more are
    dealt by path to a file of their own each, so that no object outgrows a task.
    """
    rows = _shaped(registry, REGISTRY)
    if kind == "csv":
        rows.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    elif kind == "object":
        rows = rows.where("path is not null")
        parts = max(1, -(-rows.count() // OBJECT_ROWS))
        entry = F.to_json(F.create_map("path", F.struct(*[n for n in _names(REGISTRY) if n != "path"])))
        inner = rows.select(F.pmod(F.xxhash64("path"), F.lit(parts)).alias("part"), F.substring(entry, F.lit(2), F.length(entry) - 2).alias("e"))
        whole = F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list("e")), ",\n"), F.lit("}"))
        inner.groupBy("part").agg(whole.alias("value")).write.partitionBy("part").text(path)
    else:
        rows.write.json(path)


def load_registry(spark: SparkSession, path: str, kind: str = "json") -> DataFrame:
    """A registry from JSON lines, from JSON objects keyed by path, one a file (kind ``object``), or from CSV.

    A JSON entry without a source_id has ``PATH:`` and its path; a CSV row without one is left out.  An object
    that is no JSON gives no rows.
    """
    names = _names(REGISTRY)
    if kind == "csv":
        rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
        rows = rows.select(*[(F.trim(F.coalesce(F.col(c), F.lit(""))) if c in rows.columns else F.lit("")).alias(c) for c in names])
        return _shaped(rows.where("source_id <> ''").withColumn("size_bytes", F.col("size_bytes").try_cast("long")), REGISTRY)
    if kind == "object":
        entry = "struct<" + ", ".join(f"{n}: {'long' if n == 'size_bytes' else 'string'}" for n in names if n != "path") + ">"
        whole = spark.read.text(path, wholetext=True).select(F.from_json("value", f"map<string, {entry}>").alias("m"))
        rows = whole.select(F.explode("m").alias("path", "_e")).select("path", "_e.*")
    else:
        rows = spark.read.schema(REGISTRY).json(path)
    own = F.coalesce(F.nullif(F.trim("source_id"), F.lit("")), F.concat(F.lit("PATH:"), F.col("path")))
    return _shaped(rows.withColumn("source_id", own), REGISTRY)
