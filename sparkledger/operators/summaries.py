"""Summaries of ledgers: by entity, category, month, card and pattern."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkledger.functions import exprs


def _sum(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


def entity_summary(ledger: DataFrame) -> DataFrame:
    """By entity: sums, net, rows, files, first and last date, accounts."""
    out = ledger.groupBy("entity").agg(
        _sum("debit").alias("debit"), _sum("credit").alias("credit"), F.count("*").alias("n"), F.count_distinct("file_name").alias("n_files"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.array_join(F.array_sort(F.collect_set("account")), ", ").alias("accounts"),
    )
    return out.withColumn("net", F.col("credit") - F.col("debit"))


def opening_closing(ledger: DataFrame, key: str) -> DataFrame:
    """By account: balances of the first and last row that have one, by (date, balance), and the balance before the first."""
    has = F.col("balance").isNotNull()
    net = F.coalesce(F.col("credit"), F.lit(0)) - F.coalesce(F.col("debit"), F.lit(0))
    row = F.struct("date", "balance", net.alias("net"))
    out = ledger.where(has).groupBy(key).agg(F.min(row).alias("a"), F.max(row).alias("b"))
    return out.select(key, F.col("a.balance").alias("opening"), F.col("b.balance").alias("closing"), (F.col("a.balance") - F.col("a.net")).alias("opening_before"))


def by_category(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("entity", "category").agg(F.count("*").alias("n"), _sum("debit").alias("debit"), _sum("credit").alias("credit"))


def grand_total(ledger: DataFrame) -> DataFrame:
    """A row for each entity and one, named TOTAL, for all."""
    out = ledger.rollup("entity").agg(F.grouping("entity").alias("_all"), F.count("*").alias("n"), _sum("debit").alias("debit"), _sum("credit").alias("credit"))
    return out.select(F.when(F.col("_all") == 1, "TOTAL").otherwise(F.col("entity")).alias("entity"), "n", "debit", "credit")


def categorization_rate(ledger: DataFrame) -> DataFrame:
    known = F.count_if(F.col("category") != "uncategorized")
    return ledger.agg(F.count("*").alias("n"), known.alias("n_known"), F.round(known / F.count("*"), 6).alias("rate"))


def uncategorized_patterns(ledger: DataFrame, most: int = 30, width: int = 40) -> DataFrame:
    """The report of the ``most`` beginnings of unknown descriptions that move most money."""
    rows = ledger.where("category = 'uncategorized'").groupBy(F.substring(F.coalesce("description", F.lit("")), 1, width).alias("pattern"))
    out = rows.agg(F.count("*").alias("n"), _sum("debit").alias("debit"), _sum("credit").alias("credit"))
    return out.orderBy((F.col("debit") + F.col("credit")).desc(), "pattern").limit(most)


def duplicate_groups(df: DataFrame, key: list[str]) -> DataFrame:
    """Groups of rows with equal keys, nulls equal among themselves; rows are only flagged."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def owner_split(ledger: DataFrame, key: str) -> DataFrame:
    """By ``key``: repayments to and advances from the owner, both together, and the advances' share."""
    repaid = F.coalesce(F.sum(F.when(F.col("debit").isNotNull(), F.col("debit"))), F.lit(0))
    advanced = F.coalesce(F.sum(F.when(F.col("credit").isNotNull(), F.col("credit"))), F.lit(0))
    out = ledger.groupBy(key).agg(repaid.alias("repaid"), advanced.alias("advanced"))
    total = F.col("repaid") + F.col("advanced")
    return out.withColumn("total", total).withColumn("share", F.round(F.try_divide(F.col("advanced"), total), 6))


def recipients(transfers: DataFrame) -> DataFrame:
    return transfers.groupBy("counterparty").agg(F.sum("amount").alias("cents"), F.count("*").alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def class_summary(cards: DataFrame) -> DataFrame:
    """By class: rows, total, business part, pending part and percentage of everything."""
    out = cards.groupBy("class").agg(
        F.count("*").alias("n"), F.sum("cents").alias("cents"), F.coalesce(F.sum("business_cents"), F.lit(0)).alias("business"),
        F.coalesce(F.sum(F.when(F.col("business_cents").isNull(), F.col("cents"))), F.lit(0)).alias("pending"),
    )
    whole = F.sum("cents").over(Window.partitionBy(F.lit(0)))  # over a row for each class
    return out.withColumn("percent", F.round(F.try_divide(100.0 * F.col("cents"), whole), 4))


def by_card(cards: DataFrame) -> DataFrame:
    """Card and class sums with a subtotal, class ALL, for each card."""
    out = cards.rollup("card", "class").agg(F.grouping_id().alias("_g"), F.count("*").alias("n"), F.sum("cents").alias("cents"))
    return out.where("_g < 3").select("card", F.when(F.col("_g") == 1, "ALL").otherwise(F.col("class")).alias("class"), "n", "cents")


def review_queue(cards: DataFrame) -> DataFrame:
    return cards.where("class = 'VERIFY'").orderBy(F.desc("cents"), "l_orderkey", "l_linenumber")


def match_stats(pairs: DataFrame, outs: DataFrame, ins: DataFrame, each: Column | None = None) -> DataFrame:
    """Pairs, legs of each side, what stays unmatched and the rate of matched outgoing legs: one row. A row of ``pairs`` stands for ``each`` of them."""
    n = lambda df, name: df.agg(F.count("*").alias(name))
    found = n(pairs, "n_pairs") if each is None else pairs.agg(F.coalesce(F.sum(each), F.lit(0)).alias("n_pairs"))
    row = found.crossJoin(n(outs, "n_out")).crossJoin(n(ins, "n_in"))
    return row.withColumns({"unmatched_out": F.col("n_out") - F.col("n_pairs"), "unmatched_in": F.col("n_in") - F.col("n_pairs"), "rate": F.round(F.try_divide(F.col("n_pairs"), F.col("n_out")), 6)})


def control_totals(ledger: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Rows and sums by file; against ``stored`` totals only the files that differ, from either side."""
    now = ledger.groupBy("file_name").agg(F.count("*").alias("n"), _sum("debit").alias("debit"), _sum("credit").alias("credit"))
    if stored is None:
        return now
    old = stored.select("file_name", *[F.col(c).alias(f"old_{c}") for c in ("n", "debit", "credit")])
    same = (F.col("n") == F.col("old_n")) & (F.col("debit") == F.col("old_debit")) & (F.col("credit") == F.col("old_credit"))
    return now.join(old, "file_name", "full_outer").where(~F.coalesce(same, F.lit(False)))


def review_summary(queue: DataFrame) -> DataFrame:
    """Count and sum over all, by month and by status."""
    out = queue.groupingSets([[], [F.col("month")], [F.col("status")]], "month", "status").agg(F.count("*").alias("n"), F.sum("cents").alias("cents"))
    return out.select(F.coalesce("month", F.lit("ALL")).alias("month"), F.coalesce("status", F.lit("ALL")).alias("status"), "n", "cents")


def bursts(entries: DataFrame, key: str, entered: str, about: str, hours: int = 1, months: int = 3) -> DataFrame:
    """Entries made within ``hours`` of others that are about ``months`` months or more: back-dated in one go.

    Adds n_months.  Entries without a time of entry are in no burst; a null key is a key.  Time is cut into buckets of ``hours``: an
    entry's frame holds its own bucket whole and parts of its two neighbours, of which the first and last entry about each
    month decide.  So no key is gathered, and what a row meets grows with months, not with rows.
    """
    width = 3600 * hours
    rows = entries.withColumn("_s", F.unix_timestamp(entered)).where("_s is not null").withColumn("_b", F.floor(F.col("_s") / F.lit(width)))
    by_month = rows.where(F.col(about).isNotNull()).groupBy(F.col(key).alias("_k"), F.col("_b").alias("_at"), exprs.month_of(F.col(about)).alias("month"))
    edges = by_month.agg(F.min("_s").alias("first"), F.max("_s").alias("last"))
    beside = edges.select("_k", F.explode(F.sequence(F.col("_at") - 1, F.col("_at") + 1)).alias("_at"), F.struct("month", "first", "last").alias("e"))
    frames = beside.groupBy("_k", "_at").agg(F.collect_list("e").alias("_e"))
    joined = rows.join(frames, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_b") == F.col("_at")))
    near = F.filter("_e", lambda e: (e["last"] >= F.col("_s") - width) & (e["first"] <= F.col("_s") + width))
    out = joined.withColumn("n_months", F.size(F.array_distinct(F.transform(near, lambda e: e["month"]))))
    return out.where(F.col("n_months") >= months).drop("_s", "_b", "_k", "_at", "_e")


def anomalies(duplicates: DataFrame, mismatches: DataFrame, unknown_files: DataFrame | None = None) -> DataFrame:
    """One feed (type, file_name, detail, n) of duplicate groups (file_name, n), entity mismatches (file_name, hint, entity) and files without a format."""
    feed = duplicates.groupBy("file_name").agg(F.sum("n").alias("n")).select(F.lit("duplicates").alias("type"), "file_name", F.lit("").alias("detail"), "n")
    wrong = mismatches.groupBy("file_name", F.concat(F.col("hint"), F.lit(" is "), F.col("entity")).alias("detail")).agg(F.count("*").alias("n"))
    feed = feed.unionByName(wrong.select(F.lit("entity_mismatch").alias("type"), "file_name", "detail", "n"))
    if unknown_files is not None:
        feed = feed.unionByName(unknown_files.select(F.lit("unknown_format").alias("type"), "file_name", F.lit("").alias("detail"), F.lit(1).cast("long").alias("n")))
    return feed


def override_entity(rows: DataFrame, accounts: DataFrame) -> DataFrame:
    """Adds entity and mismatch: the account's entity (accounts: account, entity) wins over the path's hint."""
    known = accounts.select("account", F.col("entity").alias("_known"))
    joined = rows.join(known, "account", "left")
    return joined.withColumns({"entity": F.coalesce("_known", "hint"), "mismatch": F.coalesce(F.col("_known") != F.col("hint"), F.lit(False))}).drop("_known")


def category_report(ledger: DataFrame) -> DataFrame:
    """Each entity's categories by money spent, with their place."""
    out = by_category(ledger)
    place = F.row_number().over(Window.partitionBy("entity").orderBy(F.desc("debit"), "category"))
    return out.withColumn("place", place).orderBy("entity", "place")


def recipient_report(transfers: DataFrame, most: int | None = None) -> DataFrame:
    """Recipients by money moved, all or the first ``most``."""
    out = recipients(transfers).orderBy(F.desc("cents"), "counterparty")
    return out.limit(most) if most else out


def largest(legs: DataFrame, most: int = 30) -> DataFrame:
    """The report of the ``most`` largest legs (id, date, cents)."""
    return legs.orderBy(F.desc("cents"), "date", "id").limit(most)


def attach_reports(summary: DataFrame, files: DataFrame) -> DataFrame:
    """A summary by entity with the warnings and failed files of the file reports (entity_hint, file_name, warnings, ok) that are named for it.

    What is attached is the number of each and their sorted names, a name once.
    """
    said = files.groupBy(F.col("entity_hint").alias("entity")).agg(
        F.count("*").alias("n_reports"), F.coalesce(F.sum(F.size("warnings")), F.lit(0)).alias("n_warnings"), F.array_sort(F.collect_set(F.when(~F.col("ok"), F.col("file_name")))).alias("failed")
    )
    return summary.join(said, "entity", "left").withColumns({"n_reports": F.coalesce("n_reports", F.lit(0)), "n_warnings": F.coalesce("n_warnings", F.lit(0)), "failed": F.coalesce("failed", F.array().cast("array<string>"))})
