"""Statement files: discovery, decoding, records, format detection and the scans of each layout.

A record is one entry of a CSV file by RFC 4180: quotes hold commas, quotes and line ends.  Files are read as
lines in parts that Spark cuts by bytes, so a file may be larger than a task.  Whether a line begins within
quotes follows from the number of quotes before it, which is added up by part and then along the parts of
a file.  Scans and warnings share the parsed records, and columns are found by the header's names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sparkledger.functions import exprs
from sparkledger.plans.shared import materialize

DESJARDINS = ["succursale", "compte", "type_rec", "date", "seq", "description", "extra", "debit", "credit", "c9", "c10", "c11", "c12", "balance"]
RBC = ["Date", "Description", "Debit", "Credit", "Balance"]
#: Patterns of the header names of card exports, lower case, by the column they fill.
AMEX = {
    "date": "^date$", "processed": "traitement|processing", "description": "^description$", "amount": "^(montant|amount)$",
    "merchant": "marchand|merchant", "reference": "^r[ée]f[ée]rence",
}
#: Headers of so many files are sent to all tasks; those of more meet the rows of each file in so many parts.
FILES, SALTS = 20_000, 16
OUT = ["file_path", "row_num", "date", "date_raw", "description", "debit", "credit", "balance"]


def discover(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """path, file_name, parent and size of files below ``root``; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    parts = F.split("path", "/")
    return files.select("path", F.element_at(parts, -1).alias("file_name"), F.element_at(parts, -2).alias("parent"), F.col("length").alias("size_bytes"))


def decoded(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """path and text: UTF-8 where it is valid, without its mark, else Latin-1, with a flag."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    good = F.is_valid_utf8(F.col("content").cast("string"))
    text = F.when(good, F.col("content").cast("string")).otherwise(F.decode("content", "ISO-8859-1"))
    return files.select("path", F.regexp_replace(text, "^\\uFEFF", "").alias("text"), good.alias("is_utf8"))


def detect_format(files: DataFrame) -> DataFrame:
    """path, format and confidence from the text alone: card header, bank header, else a score over the first ten lines."""
    lines = F.split(F.regexp_replace("text", "^\\s+|\\s+$", ""), "\\r?\\n")
    first = F.trim(F.get(lines, F.lit(0)))
    lines = F.filter(lines, lambda line: F.trim(line) != "")

    def score(line: Column) -> Column:
        cells = F.transform(F.split(line, ","), lambda c: F.trim(F.replace(c, F.lit('"'), F.lit(""))))
        cell = lambda k: F.coalesce(F.get(cells, F.lit(k)), F.lit(""))
        wide = F.when(F.size(cells) >= 14, 2).otherwise(0)
        kind = F.when(cell(2).isin("EOP", "VIS", "MCA", "MCR"), 3).otherwise(0)
        dated = F.when(cell(3).rlike("^\\d{4}/\\d{2}/\\d{2}"), 2).otherwise(0)
        return F.when(F.trim(line) == "", 0).otherwise(wide + kind + dated)

    total = F.aggregate(F.transform(F.slice(lines, 1, 10), score), F.lit(0), lambda a, b: a + b)
    named = lambda format, confidence: F.struct(F.lit(format).alias("format"), F.lit(confidence).alias("confidence"))
    found = (
        F.when(first.contains("Date de traitement") | first.contains("Montant des dépenses"), named("amex_csv", "high"))
        .when(first.contains("Processing Date") & first.contains("Amount"), named("amex_csv", "medium"))
        .when(first.startswith("Date") & first.contains("Description") & first.contains("Balance"), named("rbc_csv", "high"))
        .when(total >= 5, named("desjardins_csv", "high")).when(total >= 3, named("desjardins_csv", "medium")).otherwise(named("unknown", "low"))
    )
    return files.select("path", found.alias("_f")).select("path", "_f.*")


def cells(line: Column) -> Column:
    """The cells of a record: quotes around a cell go and doubled ones within are one; what follows a closing quote stays."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r',("[^"]*+(?:""[^"]*+)*+"[^,]*+|[^,]*+)'), F.lit(1))
    inner = lambda c: F.concat(F.replace(F.regexp_extract(c, r'^"([^"]*+(?:""[^"]*+)*+)"', 1), F.lit('""'), F.lit('"')), F.regexp_extract(c, r'^"[^"]*+(?:""[^"]*+)*+"([^,]*+)$', 1))
    return F.transform(raw, lambda c: F.when(c.rlike(r'^"[^"]*+(?:""[^"]*+)*+"'), inner(c)).otherwise(c))


def records(files: DataFrame) -> DataFrame:
    """Records of decoded texts (path, text): file_path, row_num from 0, cells and the first record's cells as header; blank lines are none.

    One file's records are split inside the task that has its text; ``read_records`` reads files of any size.
    """
    lines = F.filter(F.regexp_extract_all("text", F.lit(r'((?:[^"\n]++|"[^"]*+(?:""[^"]*+)*+"?)++)'), F.lit(1)), lambda x: F.trim(F.replace(x, F.lit("\r"), F.lit(""))) != "")
    rows = files.select(F.col("path").alias("file_path"), lines.alias("_l")).select("file_path", cells(_whole(F.get("_l", F.lit(0)))).alias("header"), F.posexplode("_l").alias("row_num", "_line"))
    return rows.select("file_path", "row_num", cells(_whole(F.col("_line"))).alias("cells"), "header")


def _whole(line: Column) -> Column:
    return F.regexp_replace(line, "\\r$", "")


def read_records(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """Records of all files below ``root``, of any size: as ``records``, with the record's line and is_utf8.

    Each file is read in as many tasks as its size needs.  Files that are not UTF-8 as a whole are read as Latin-1; a
    mark at the start goes.  A quote that is never closed makes what is left of its file one record.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).option("lineSep", "\n")
    value = F.col("value")
    lines = reader.text(root).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("part"), F.monotonically_increasing_id().alias("n"), value.cast("binary").alias("raw"),
        (F.octet_length(value) - F.octet_length(F.replace(value, F.lit('"'), F.lit("")))).alias("quotes"), F.is_valid_utf8(value).alias("valid"),
    )
    lines = materialize(lines, "lines")
    before = Window.partitionBy("file_path").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = lines.groupBy("file_path", "part").agg(F.sum("quotes").alias("q"), F.bool_and("valid").alias("v"))
    whole = Window.partitionBy("file_path")
    parts = parts.select("file_path", "part", F.coalesce(F.sum("q").over(before), F.lit(0)).alias("q_before"), F.bool_and("v").over(whole).alias("is_utf8"), F.min("part").over(whole).alias("first"))
    # Within a part lines follow each other by number; what is open at its start is known from the parts before.
    along = Window.partitionBy("file_path", "part").orderBy("n")
    ahead = along.rowsBetween(Window.unboundedPreceding, -1)
    text = F.when(F.col("is_utf8"), F.col("raw").cast("string")).otherwise(F.decode("raw", "ISO-8859-1"))
    rows = lines.join(parts, ["file_path", "part"])
    rows = rows.withColumn("inside", (F.col("q_before") + F.coalesce(F.sum("quotes").over(ahead), F.lit(0))) % 2 == 1)
    head = (F.col("part") == F.col("first")) & (F.row_number().over(along) == 1)
    rows = rows.withColumn("text", F.when(head, F.regexp_replace(text, "^\\uFEFF", "")).otherwise(text))
    rows = rows.withColumn("starts", ~F.col("inside") & (F.trim(F.replace("text", F.lit("\r"), F.lit(""))) != "")).where("inside or starts")
    rows = rows.withColumn("nth", F.sum(F.col("starts").cast("long")).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    rows = materialize(rows.select("file_path", "part", "n", "text", "is_utf8", "nth", "starts", ((F.col("quotes") % 2 == 1) | F.col("inside")).alias("long")), "record-lines")
    begun = rows.groupBy("file_path", "part").agg(F.sum(F.col("starts").cast("long")).alias("s"))
    begun = begun.select("file_path", "part", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("s_before"))
    rows = rows.join(begun, ["file_path", "part"]).withColumn("row_num", (F.col("s_before") + F.col("nth") - 1).cast("int"))
    # Only records of several lines are brought together.
    joined = rows.where("long").groupBy("file_path", "row_num", "is_utf8").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "n", "text"))), lambda r: r["text"]), "\n").alias("line"))
    found = rows.where("not long").select("file_path", "row_num", "is_utf8", F.col("text").alias("line")).unionByName(joined)
    found = materialize(found.select("file_path", "row_num", "is_utf8", _whole(F.col("line")).alias("line")).withColumn("cells", cells(F.col("line"))), "records")
    heads = found.where("row_num = 0").select("file_path", F.col("cells").alias("header"))
    if heads.limit(FILES + 1).count() <= FILES:
        return found.join(F.broadcast(heads), "file_path")
    salted = heads.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return found.withColumn("_s", F.pmod("row_num", F.lit(SALTS))).join(salted, ["file_path", "_s"]).drop("_s")


def heads(found: DataFrame, lines: int = 12) -> DataFrame:
    """path and text of the first records of each file, for ``detect_format``."""
    first = found.where(F.col("row_num") < lines).groupBy(F.col("file_path").alias("path"))
    return first.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_num", "line"))), lambda r: r["line"]), "\n").alias("text"))


def _parsed(files: DataFrame) -> DataFrame:
    return files if "cells" in files.columns else records(files)


def _named(name: str) -> Column:
    """The cell of the last header column of this name; null without one, or if a record ends before it."""
    at = F.array_position(F.reverse(F.transform("header", lambda h: F.trim(h))), name)
    return F.when(at > 0, F.get("cells", (F.size("header") - at).cast("int")))


def desjardins(files: DataFrame) -> DataFrame:
    """Account statements without a header: only EOP records of all columns; branch and account are the file's first."""
    full = _parsed(files).where(F.size("cells") >= len(DESJARDINS))
    rows = full.select("file_path", "row_num", *[F.get("cells", F.lit(k)).alias(c) for k, c in enumerate(DESJARDINS)])
    first = rows.groupBy("file_path").agg(*[F.min_by(F.nullif(F.trim(c), F.lit("")), F.when(F.trim(c) != "", F.col("row_num"))).alias(n) for c, n in (("compte", "account_raw"), ("succursale", "branch"))])
    out = rows.where(F.trim("type_rec") == "EOP").select("file_path", "row_num", exprs.normalize_date(F.col("date")).alias("date"), F.col("date").alias("date_raw"), F.trim("description").alias("description"), *[exprs.parse_float(F.col(c)).alias(c) for c in ("debit", "credit", "balance")], F.trim("seq").alias("seq"))
    if first.limit(FILES + 1).count() <= FILES:
        return out.join(F.broadcast(first), "file_path", "left")
    salted = first.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return out.withColumn("_s", F.pmod("row_num", F.lit(SALTS))).join(salted, ["file_path", "_s"], "left").drop("_s")


def rbc(files: DataFrame) -> DataFrame:
    """Account statements whose header names the columns, in any order; columns that are missing are null, and balances may be blank."""
    rows = _parsed(files).where("row_num > 0").select("file_path", "row_num", *[_named(c).alias(c) for c in RBC])
    return rows.select("file_path", "row_num", exprs.normalize_date(F.col("Date")).alias("date"), F.col("Date").alias("date_raw"), F.coalesce(F.trim("Description"), F.lit("")).alias("description"), *[exprs.parse_float(F.col(c)).alias(c.lower()) for c in ("Debit", "Credit", "Balance")])


def amex(files: DataFrame) -> DataFrame:
    """Card exports, French or English, by header: positive amounts are debits; rows without amount and description go."""

    def field(logical: str) -> Column:
        at = F.array_position(F.transform("header", lambda h: F.lower(F.trim(h)).rlike(AMEX[logical])), True)
        return F.trim(F.when(at > 0, F.get("cells", (at - 1).cast("int"))))

    body = _parsed(files).where("row_num > 0")
    amount = exprs.parse_french_float(field("amount"))
    out = body.select("file_path", "row_num", exprs.normalize_date(field("date")).alias("date"), field("date").alias("date_raw"), field("description").alias("description"), amount.alias("_a"), field("merchant").alias("merchant"), field("reference").alias("reference"))
    kept = out.where(F.col("_a").isNotNull() | (F.coalesce("description", F.lit("")) != ""))
    zero = F.lit(None).cast(exprs.MONEY)
    return kept.select(*[c for c in out.columns if c != "_a"], F.when(F.col("_a") > 0, F.col("_a")).alias("debit"), F.when(F.col("_a") < 0, -F.col("_a")).alias("credit"), zero.alias("balance"))


def file_warnings(texts: DataFrame, formats: DataFrame) -> DataFrame:
    """path and warning, a row for each: of texts (path, text) or records (``read_records``) and formats (path, format, confidence).

    Bank records with too few columns, header columns that are missing, formats that are unknown or not sure,
    files named for another bank, and, where is_utf8 says so, texts that are not UTF-8.
    """
    found = _parsed(texts)
    short = (F.size("cells") < len(DESJARDINS)) & F.exists("cells", lambda c: F.trim(c) != "")
    counted = found.groupBy(F.col("file_path").alias("path")).agg(F.count_if(short).alias("short"), F.first("header").alias("header"))
    counted = formats.select("path", "format", "confidence").join(counted, "path", "left")
    if "is_utf8" in texts.columns:
        key = "path" if "path" in texts.columns else "file_path"
        counted = counted.join(texts.groupBy(F.col(key).alias("path")).agg(F.bool_and("is_utf8").alias("is_utf8")), "path", "left")
    else:
        counted = counted.withColumn("is_utf8", F.lit(True))
    header = F.transform(F.coalesce("header", F.array().cast("array<string>")), lambda c: F.trim(c))
    lacking = F.array_except(F.array(*[F.lit(c) for c in RBC]), header)
    unnamed = F.array_compact(F.array(*[F.when(~F.exists(header, lambda h: F.lower(h).rlike(AMEX[c])), F.lit(c)) for c in ("date", "amount")]))
    of = lambda format: F.col("format") == format
    said = F.array_compact(
        F.array(
            F.when(of("desjardins_csv") & (F.col("short") > 0), F.concat(F.col("short").cast("string"), F.lit(" rows with too few columns"))),
            F.when(of("rbc_csv") & (F.size(lacking) > 0), F.concat(F.lit("missing columns: "), F.array_join(lacking, ", "))),
            F.when(of("amex_csv") & (F.size(unnamed) > 0), F.concat(F.lit("missing columns: "), F.array_join(unnamed, ", "))),
            F.when(of("unknown"), F.lit("unknown format")), F.when(~of("unknown") & (F.col("confidence") != "high"), F.concat(F.lit("format of "), F.col("confidence"), F.lit(" confidence"))),
            F.when(~F.col("is_utf8"), F.lit("not UTF-8, read as Latin-1")),
            exprs.cross_check(F.element_at(F.split("path", "/"), -1), F.col("format")),
        )
    )
    return counted.select("path", F.explode(said).alias("warning"))


def with_missing(files: DataFrame, expected: DataFrame) -> DataFrame:
    """The file reports, and one of format ``missing`` for each expected path (path) that has none."""
    absent = expected.select("path").distinct().join(files.select("path"), "path", "left_anti")
    return files.unionByName(absent.withColumns({"format": F.lit("missing"), "confidence": F.lit("low"), "warning": F.lit("no such file")}), allowMissingColumns=True)


def read_statements(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """All statement files below ``root``: files (path, format, confidence, is_utf8, warning) and transactions.

    Files that no format fits stay in the first with format unknown and have no transactions.  All warnings
    are those of ``file_warnings``; files that should be there are added by ``with_missing``.
    """
    found = read_records(spark, root)
    there = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(root).select(F.col("_metadata.file_path").alias("_key"), "path")
    texts = there.join(heads(found).withColumnRenamed("path", "_key"), "_key", "left").withColumn("text", F.coalesce("text", F.lit("")))
    utf8 = found.groupBy(F.col("file_path").alias("_key")).agg(F.bool_and("is_utf8").alias("is_utf8"))
    formats = texts.select("_key", "path").join(detect_format(texts), "path").join(utf8, "_key", "left")
    files = materialize(formats.select("_key", "path", "format", "confidence", F.coalesce("is_utf8", F.lit(True)).alias("is_utf8")), "files")
    files = files.withColumn("warning", exprs.cross_check(F.element_at(F.split("path", "/"), -1), F.col("format")))

    def of(format: str) -> DataFrame:
        return found.join(files.where(F.col("format") == format).select(F.col("_key").alias("file_path")), "file_path", "left_semi")

    parts = [scan(of(format)).withColumn("format", F.lit(format)) for format, scan in (("desjardins_csv", desjardins), ("rbc_csv", rbc), ("amex_csv", amex))]
    return files.drop("_key"), reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_decisions(spark: SparkSession, path: str) -> DataFrame:
    """A JSON-lines decision log; broken lines stay, with their text in _corrupt."""
    fields = ["ts", "entity", "field", "value", "basis", "source_id", "source", "source_locator", "confidence_status", "session", "corrects"]
    schema = ", ".join(f"{f} string" for f in fields) + ", _corrupt string"
    return spark.read.schema(schema).option("columnNameOfCorruptRecord", "_corrupt").json(path)


def write_ledger(ledger: DataFrame, path: str) -> None:
    """The ledger by entity, each file in order of date."""
    # By ranges, so that a hot entity's dates lie in several tasks.
    ledger.repartitionByRange("entity", "date").sortWithinPartitions("entity", "date").write.partitionBy("entity").parquet(path)


def write_csv(df: DataFrame, path: str, *order: str) -> None:
    """A report as CSV in the given order."""
    df.orderBy(*order).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
