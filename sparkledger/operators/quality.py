"""Rules over deliverables. Each gives rows of (deliverable, row_id, rule, severity, detail)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sparkledger.functions import exprs

#: Vocabularies, columns and modes from lax to strict.
CONFIDENCE = ["CONFIRMED", "INFERRED", "NEEDS_REVIEW", "BLOCKED"]
FORBIDDEN = ["VERIFY", "TBD", "MAYBE", "LOOK INTO"]
RESOLUTION = ["OPEN", "RESOLVED", "SUPERSEDED", ""]
MODES = ["template", "package", "strict", "handoff"]
REQUIRED_FILES = ["employee-claims.csv", "das-tax-schedule.csv", "creditor-schedule.csv", "personal-debt-schedule.csv", "exception-log.csv", "source-registry.csv", "decisions.jsonl"]
AMOUNTS = {"employee-claims.csv": "amount", "das-tax-schedule.csv": "balance_owed", "creditor-schedule.csv": "amount", "personal-debt-schedule.csv": "amount"}
ROW_COLUMNS = ["confidence_status", "source_id", "source", "source_locator"]
EXCEPTION_COLUMNS = ["id", "priority", "entity", "domain", "description", "discovered_date", "amount", "confidence_status", "resolution_status", "source_id", "source", "source_locator"]
DECISION_FIELDS = ["ts", "entity", "field", "value", "basis", "source_id", "source", "source_locator", "confidence_status", "session"]


def _found(df: DataFrame, deliverable: str | Column, rule: str, when: Column, detail: Column, severity: str = "error") -> DataFrame:
    return df.where(when).select(F.lit(deliverable).alias("deliverable"), F.col("id").cast("string").alias("row_id"), F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), detail.cast("string").alias("detail"))


def _blank(name: str) -> Column:
    return F.trim(F.coalesce(F.col(name).cast("string"), F.lit(""))) == ""


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def schedule_violations(df: DataFrame, deliverable: str | Column, mode: str = "package", registry: DataFrame | None = None, entities: DataFrame | None = None, amount: str = "amount") -> DataFrame:
    """All rules of a schedule in a mode; a stricter mode has the rules of those before it.

    BLOCKED rows may lack their sources.  The entity is looked at only if the schedule has one.
    """
    level, status = MODES.index(mode), F.upper(F.trim(F.coalesce("confidence_status", F.lit(""))))
    rules = []
    if level >= 1:
        rules += [
            _found(df, deliverable, "status_empty", status == "", F.lit("")),
            _found(df, deliverable, "status_forbidden", status.isin(FORBIDDEN), status),
            _found(df, deliverable, "status_unknown", ~status.isin(CONFIDENCE + FORBIDDEN + [""]), status),
        ]
        if "entity" in df.columns:
            rules.append(_found(df, deliverable, "placeholder_entity", exprs.is_placeholder(F.col("entity")), F.col("entity")))
        has = F.col(amount).isNotNull() & (status != "BLOCKED")
        rules += [_found(df, deliverable, f"missing_{c}", has & _blank(c), F.lit(c)) for c in ROW_COLUMNS[1:]]
    if level >= 1 and registry is not None:
        cited = df.where((status == "CONFIRMED") & ~_blank("source_id") & ~F.col("source_id").startswith("user_confirmation"))
        rules.append(_found(cited.join(registry.select("source_id").distinct(), "source_id", "left_anti"), deliverable, "source_not_registered", F.lit(True), F.col("source_id")))
    if level >= 2 and entities is not None and "entity" in df.columns:
        own = df.where(~F.col("entity").isin("global", "cross-entity") & ~exprs.is_placeholder(F.col("entity")))
        rules.append(_found(own.join(entities.select("entity").distinct(), "entity", "left_anti"), deliverable, "entity_unknown", F.lit(True), F.col("entity")))
    if level >= 3:
        rules.append(_found(df, deliverable, "inferred_at_handoff", status == "INFERRED", status))
    if not rules:
        return _found(df, deliverable, "none", F.lit(False), F.lit(""))
    return reduce(DataFrame.unionByName, rules)


def package_violations(records: DataFrame, mode: str = "package", registry: DataFrame | None = None, entities: DataFrame | None = None) -> DataFrame:
    """Columns and rows of all schedules of a package, from parsed records (file_path, row_num from 0, cells, header).

    Files are told apart by name; those of other names are passed over.  A file whose header lacks a required column
    has a violation for each such column and is judged no further.  Columns are found by name, wherever they stand; a
    row is named by its file and its place, the header being 1.  A cell that a short row lacks is empty, of columns
    with one name the last counts, and without a column for it the entity is empty, which a placeholder is too.
    """
    name = F.element_at(F.split("file_path", "/"), -1)
    amount = F.create_map(*[F.lit(x) for item in AMOUNTS.items() for x in item])[name]
    rows = records.withColumn("_amount", amount).where("_amount is not null")
    rows = rows.withColumn("_lacking", F.array_except(F.array_append(F.array(*[F.lit(c) for c in ROW_COLUMNS]), F.col("_amount")), "header"))
    lacking = rows.where("row_num = 0").select("file_path", F.explode("_lacking").alias("column"))
    columns = lacking.select(F.col("file_path").alias("deliverable"), F.lit("").alias("row_id"), F.lit("missing_column").alias("rule"), F.lit("error").alias("severity"), F.col("column").alias("detail"))
    if mode == "template":
        return columns
    cell = lambda c: F.when(F.array_contains("header", c), F.get("cells", F.size("header") - F.array_position(F.reverse("header"), c).cast("int")))
    named = [*ROW_COLUMNS, "entity"]
    judged = rows.where((F.col("row_num") > 0) & (F.size("_lacking") == 0)).select(
        "file_path", F.concat(name, F.lit(":row="), (F.col("row_num") + 1).cast("string")).alias("id"), F.nullif(F.trim(cell(F.col("_amount"))), F.lit("")).alias("amount"), *[cell(F.lit(c)).alias(c) for c in named]
    )
    return columns.unionByName(schedule_violations(judged, F.col("file_path"), mode, registry, entities))


def exception_violations(df: DataFrame, deliverable: str = "exception-log.csv") -> DataFrame:
    """Both vocabularies of an exception log, and statuses in the wrong column."""
    confidence = F.upper(F.trim(F.coalesce("confidence_status", F.lit(""))))
    resolution = F.upper(F.trim(F.coalesce("resolution_status", F.lit(""))))
    swapped = confidence.isin([r for r in RESOLUTION if r]) | resolution.isin(CONFIDENCE)
    return reduce(DataFrame.unionByName, [
        _found(df, deliverable, "statuses_swapped", swapped, F.concat_ws("/", confidence, resolution)),
        _found(df, deliverable, "status_unknown", ~swapped & ~confidence.isin(CONFIDENCE), confidence),
        _found(df, deliverable, "resolution_unknown", ~swapped & ~resolution.isin(RESOLUTION), resolution),
    ])


def decision_violations(df: DataFrame, strict: bool = False, deliverable: str = "decisions.jsonl") -> DataFrame:
    """Lines (id) that are no JSON, lack fields, have an unknown status or, if ``strict``, a basis that interprets the law."""
    present = [c for c in DECISION_FIELDS if c in df.columns]
    lacking = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) if c in present else F.lit(c) for c in DECISION_FIELDS]))
    broken = F.col("_corrupt").isNotNull() if "_corrupt" in df.columns else F.lit(False)
    rules = [
        _found(df, deliverable, "not_json", broken, F.lit("")),
        _found(df, deliverable, "missing_fields", ~broken & (F.size(lacking) > 0), F.array_join(lacking, ",")),
        _found(df, deliverable, "status_unknown", ~broken & F.col("confidence_status").isNotNull() & ~F.col("confidence_status").isin(CONFIDENCE), F.col("confidence_status")),
    ]
    if strict:
        rules.append(_found(df, deliverable, "legal_wording", ~broken & exprs.has_legal_wording(F.col("basis")), F.col("basis")))
    return reduce(DataFrame.unionByName, rules)


def hash_violations(registry: DataFrame, files: DataFrame) -> DataFrame:
    """Registered documents that are missing or whose hash is another than registered."""
    both = registry.select("source_id", "path", "sha256").join(files.select("path", F.col("sha256").alias("_now")), "path", "left")
    rule = F.when(F.col("_now").isNull(), "file_missing").when(F.col("_now") != F.col("sha256"), "hash_mismatch")
    return both.withColumn("rule", rule).where("rule is not null").select(F.lit("source-registry.csv").alias("deliverable"), F.col("source_id").alias("row_id"), "rule", F.lit("error").alias("severity"), F.col("path").alias("detail"))


def missing_sections(texts: DataFrame, markers: list[str], key: str, text: str = "text") -> DataFrame:
    """A row for each marker that a document lacks."""
    listed = texts.select(F.col(key), F.explode(F.array(*[F.when(~F.contains(F.coalesce(text, F.lit("")), F.lit(m)), F.lit(m)) for m in markers])).alias("marker"))
    return listed.where("marker is not null")


def missing_files(files: DataFrame) -> DataFrame:
    """Required deliverables that are not among ``files`` (path), templates and legacy folders aside."""
    spark = files.sparkSession
    expected = spark.createDataFrame([(f,) for f in REQUIRED_FILES], "name string")
    have = files.where(~F.col("path").contains("/templates/") & ~F.col("path").contains("/legacy/")).select(F.element_at(F.split("path", "/"), -1).alias("name")).distinct()
    return expected.join(have, "name", "left_anti")


def verdict(violations: DataFrame) -> DataFrame:
    """0 without violations, 2 with a hash mismatch, else 1; and their number: one row."""
    out = violations.agg(F.count("*").alias("n"), F.coalesce(F.max(F.when(F.col("rule") == "hash_mismatch", 1)), F.lit(0)).alias("_hash"))
    return out.select(F.when(F.col("_hash") == 1, 2).when(F.col("n") > 0, 1).otherwise(0).alias("verdict"), "n")


def stale(df: DataFrame, updated: str, as_of: str, days: int = 7) -> DataFrame:
    return df.where(F.datediff(F.lit(as_of).cast("date"), F.col(updated)) > days)


def confirmed_totals(df: DataFrame, amount: str = "amount") -> DataFrame:
    """By entity: confirmed sum and numbers of confirmed, open and blocked rows."""
    status = F.col("confidence_status")
    return df.groupBy("entity").agg(
        F.coalesce(F.sum(F.when(status == "CONFIRMED", F.col(amount))), F.lit(0)).alias("confirmed"), F.count_if(status == "CONFIRMED").alias("n_confirmed"),
        F.count_if(status.isin("INFERRED", "NEEDS_REVIEW")).alias("n_open"), F.count_if(status == "BLOCKED").alias("n_blocked"),
    )


def blocked(df: DataFrame) -> DataFrame:
    """What is to be fetched next."""
    return df.where("confidence_status = 'BLOCKED'")


def wrong_month(df: DataFrame) -> DataFrame:
    """Rows whose month is not the one their file is named for."""
    named = F.nullif(F.regexp_extract("file_name", "(\\d{4}-\\d{2})", 1), F.lit(""))
    return df.where(named.isNotNull() & (named != exprs.month_of(F.col("date"))))


def column_violations(df: DataFrame, deliverable: str, required: list[str]) -> DataFrame:
    """A violation for each required column that a deliverable lacks."""
    lacking = missing_columns(df, required)
    rows = df.sparkSession.createDataFrame([(c,) for c in lacking], "column string")
    return rows.select(F.lit(deliverable).alias("deliverable"), F.lit("").alias("row_id"), F.lit("missing_column").alias("rule"), F.lit("error").alias("severity"), F.col("column").alias("detail"))


#: The part of a briefing that a row's status puts it in.
SECTIONS = {"CONFIRMED": "confirmed", "INFERRED": "inferred", "NEEDS_REVIEW": "to review", "BLOCKED": "blocked"}


def briefing_sections(df: DataFrame) -> DataFrame:
    """Rows with the section their status puts them in; a status of no section is left out."""
    status = F.upper(F.trim("confidence_status"))
    section = F.create_map(*[F.lit(x) for item in SECTIONS.items() for x in item])[status]
    return df.withColumn("section", section).where("section is not null")
