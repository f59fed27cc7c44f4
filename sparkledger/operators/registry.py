"""The registry of source documents: merging scans, alerts and ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from sparkledger.functions import exprs
from sparkledger.plans.shared import materialize

#: Domains by words in a document's path, in their order.
DOMAINS = {
    "bank": ["bank-statement", "bank_statement", "releve", "desjardins", "rbc", "amex", "bank-statements"],
    "cc": ["credit-card", "cc_perso", "cc-perso", "mastercard", "visa", "cc_"],
    "payroll": ["payroll", "paie", "nethris", "cgi", "agendrix", "employee", "tips"],
    "tax": ["tax-account", "tax_account", "rp-federal", "rs-quebec", "tvq", "co-17", "co17", "t2", "cnesst", "rl-1", "gst", "hst"],
    "creditor": ["creditor", "supplier-invoice", "invoice"],
    "intercompany": ["intercompany", "interco"],
}
#: Types of documents by words in a document's path, in their order.
DOCUMENT_TYPES = {
    "etat_compte_RP": ["rp_etat", "rp-etat", "etat_compte_rp"],
    "etat_compte_RS": ["rs_etat", "rs-etat", "etat_compte_rs"],
    "etat_compte_TVQ": ["tvq_etat", "tvq-etat"],
    "etat_compte_GST": ["gst_etat", "gst-etat", "hst_etat"],
    "cnesst_cotisation": ["cnesst"],
    "t2_assessment": ["t2_assessment", "t2-assessment"],
    "co17_assessment": ["co17_assessment", "co-17"],
    "bank_statement_pdf": ["bank-statement", "bank_statement"],
    "cc_statement_pdf": ["cc-statement", "cc_statement", "visa", "mastercard", "amex"],
    "xlsx_reconciliation": ["reconciliation"],
    "supplier_invoice_pdf": ["invoice", "facture"],
}
#: Kinds of documents that are registered, and folders that are not.
EXTENSIONS = ["pdf", "csv", "xlsx", "xlsm", "tsv"]
EXCLUDED = ["output/", "__pycache__", "/templates/", "/legacy/"]


def _numbered(rows: DataFrame, order: str, name: str) -> DataFrame:
    """Adds _n, a row's place in its ``_label`` by ``order``, from 1.

    Rows are dealt by ranges, and each range counts on from those before it, so a label may lie in many tasks.
    """
    ranged = materialize(rows.repartitionByRange("_label", order).withColumn("_range", F.spark_partition_id()), name)
    earlier = Window.partitionBy("_label").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = ranged.groupBy("_label", "_range").agg(F.count("*").alias("_rows")).select("_label", "_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_label", "_range").orderBy(order))
    return ranged.withColumn("_place", place).join(before, ["_label", "_range"]).withColumn("_n", F.col("_before") + F.col("_place")).drop("_before", "_place", "_range")


def next_ids(new: DataFrame, used: DataFrame) -> DataFrame:
    """Gives each row of ``new`` (path, domain) the lowest source_id of its domain that ``used`` (source_id) does not have, in order of paths.

    Free numbers run up to the used ones plus the new rows, so they always suffice.
    """
    label = F.upper(F.coalesce(F.nullif(F.col("domain"), F.lit("")), F.lit("other")))
    wanted = _numbered(new.select("path", "domain", label.alias("_label")), "path", "registry-wanted")
    part = lambda k: F.regexp_extract("source_id", "^SRC-(.+)-(\\d+)$", k)
    taken = used.select(part(1).alias("_label"), F.nullif(part(2), F.lit("")).try_cast("long").alias("_number")).where("_number is not null").distinct()
    taken = _numbered(taken, "_number", "registry-taken")
    counts = wanted.groupBy("_label").agg(F.count("*").alias("_new"))
    beyond = taken.join(counts, "_label").select("_label", (F.col("_new") + F.col("_n")).alias("_number"))
    every = wanted.select("_label", F.col("_n").alias("_number")).unionByName(beyond)
    free = _numbered(every.join(taken.select("_label", "_number"), ["_label", "_number"], "left_anti"), "_number", "registry-free")
    number = F.col("_number").cast("string")
    made = F.concat(F.lit("SRC-"), F.col("_label"), F.lit("-"), F.when(F.length(number) < 3, F.lpad(number, 3, "0")).otherwise(number))
    return wanted.join(free, ["_label", "_n"]).select("path", "domain", made.alias("source_id"))


def merge(old: DataFrame, new: DataFrame, as_of: str) -> DataFrame:
    """Old and new scans in one registry: path, source_id, sha256, first_seen, status.

    A known path keeps its id and first_seen.  A path that is gone stays as removed, so its id is never
    given again.
    """
    fresh = new.join(old.select("path"), "path", "left_anti").select("path", "domain")
    made = next_ids(fresh, old).select("path", F.col("source_id").alias("_made"))
    a = old.select("path", "source_id", F.col("sha256").alias("_old"), "first_seen", F.lit(True).alias("_was"))
    b = new.select("path", F.col("sha256").alias("_new"), F.lit(True).alias("_is"))
    both = a.join(b, "path", "full_outer").join(made, "path", "left")
    status = F.when(F.col("_is").isNull(), "removed").when(F.col("_was").isNull(), "added").when(F.col("_old") != F.col("_new"), "changed").otherwise("same")
    return both.select("path", F.coalesce("source_id", "_made").alias("source_id"), F.coalesce("_new", "_old").alias("sha256"), F.coalesce("first_seen", F.lit(as_of).cast("date")).alias("first_seen"), status.alias("status"))


def alerts(old: DataFrame, new: DataFrame) -> DataFrame:
    """hash_changed and removed documents: path, alert."""
    changed = old.join(new.select("path", F.col("sha256").alias("_new")), "path").where("sha256 <> _new").select("path", F.lit("hash_changed").alias("alert"))
    return changed.unionByName(old.join(new.select("path"), "path", "left_anti").select("path", F.lit("removed").alias("alert")))


def scan_documents(files: DataFrame, root: str) -> DataFrame:
    """Of binary files (path, length, content) below ``root``: relative path, hash, size, domain, entity and date."""
    relative = F.regexp_replace("path", "^.*" + "\\Q" + root.rstrip("/") + "/\\E", "")
    name = F.element_at(F.split(F.col("relative"), "/"), -1)
    skipped = F.lit(False)
    for part in EXCLUDED:
        skipped = skipped | F.concat(F.lit("/"), F.col("relative")).contains(part)
    kept = files.withColumn("relative", relative).where(F.lower(name).rlike("\\.(" + "|".join(EXTENSIONS) + ")$") & ~skipped)
    return kept.select(
        F.col("relative").alias("path"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("size_bytes"), exprs.keyword_label(F.col("relative"), DOMAINS, "other").alias("domain"),
        exprs.keyword_label(F.col("relative"), DOCUMENT_TYPES, "").alias("document_type"), exprs.entity_from_path(F.col("relative")).alias("entity"), exprs.date_on_document(name).alias("date_on_document"),
    )
