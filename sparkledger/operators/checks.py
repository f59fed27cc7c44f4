"""Balance and file checks. A check's ``passed`` is null where it could not be made."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def _net() -> Column:
    return F.coalesce(F.col("credit"), F.lit(0)) - F.coalesce(F.col("debit"), F.lit(0))


#: Rows of an account that may share a window.
HOT = 2_000_000


def running_balance(df: DataFrame, key: str, order: list[str], tolerance: float, need_first: bool = True) -> DataFrame:
    """Adds expected and diff: the balance each row should have, going on from the last balance before it.

    After a row with a balance the sum starts anew from it, so one break is reported once.  With
    ``need_first`` an account whose first row has no balance is not checked; without, checks start at
    its first balance.  Up to ``HOT`` rows of an account share a window.  If one has more, rows are summed within each value
    of the first column of ``order`` (a day), and only the days of an account follow each other in one window.
    """
    most = df.groupBy(key).agg(F.count("*").alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0
    if most <= HOT:
        whole = Window.partitionBy(key).orderBy(*order)
        ahead = whole.rowsBetween(Window.unboundedPreceding, -1)
        out = df.withColumns({"_cum": F.sum(_net()).over(whole.rowsBetween(Window.unboundedPreceding, 0)), "_first": F.first(F.col("balance").isNotNull()).over(whole.rowsBetween(Window.unboundedPreceding, 0))})
        expected = F.last(F.col("balance") - F.col("_cum"), ignorenulls=True).over(ahead) + F.col("_cum")
        out = out.withColumn("expected", expected).withColumn("expected", F.when(F.col("_first"), F.col("expected")) if need_first else F.col("expected"))
        return out.withColumn("diff", F.col("balance") - F.col("expected")).withColumn("mismatch", F.abs("diff") > tolerance).drop("_cum", "_first")
    day = order[0]
    within = Window.partitionBy(key, day).orderBy(*order)
    so_far, before = within.rowsBetween(Window.unboundedPreceding, 0), within.rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("_cum", F.sum(_net()).over(so_far)).withColumn("_rest", F.col("balance") - F.col("_cum"))
    rows = rows.withColumn("_before", F.last("_rest", ignorenulls=True).over(before))
    place = F.struct(*order)
    days = rows.groupBy(key, day).agg(
        F.sum(_net()).alias("_total"), F.max_by("_rest", F.when(F.col("_rest").isNotNull(), place)).alias("_last"), F.min_by(F.col("balance").isNotNull(), place).alias("_has")
    )
    over = Window.partitionBy(key).orderBy(day)
    earlier = over.rowsBetween(Window.unboundedPreceding, -1)
    days = days.withColumn("_prefix", F.coalesce(F.sum("_total").over(earlier), F.lit(0)))
    days = days.withColumn("_anchor", F.last(F.col("_last") - F.col("_prefix"), ignorenulls=True).over(earlier))
    days = days.withColumn("_first", F.first("_has").over(over.rowsBetween(Window.unboundedPreceding, 0)))
    days = days.select(F.col(key).alias("_k"), F.col(day).alias("_day"), "_prefix", "_anchor", "_first")
    out = rows.join(days, rows[key].eqNullSafe(days["_k"]) & rows[day].eqNullSafe(days["_day"]))
    expected = F.coalesce(F.col("_before"), F.col("_anchor") + F.col("_prefix")) + F.col("_cum")
    out = out.withColumn("expected", F.when(F.col("_first"), expected) if need_first else expected)
    out = out.withColumn("diff", F.col("balance") - F.col("expected")).withColumn("mismatch", F.abs("diff") > tolerance)
    return out.drop("_cum", "_rest", "_before", "_k", "_day", "_prefix", "_anchor", "_first")


def balance_check(checked: DataFrame, key: str) -> DataFrame:
    """By account: rows checked, rows off, the sum of what they are off by, and whether the check passed."""
    bad = F.when(F.col("mismatch"), F.abs("diff"))
    out = checked.groupBy(key).agg(F.count("diff").alias("n_checked"), F.count(bad).alias("n_bad"), F.coalesce(F.sum(bad), F.lit(0)).alias("amount_bad"))
    return out.withColumn("passed", F.when(F.col("n_checked") > 0, F.col("n_bad") == 0))


def mismatches(checked: DataFrame, key: str, order: list[str], most: int = 10) -> DataFrame:
    """By account its first mismatches, ``most`` of them: a report for people."""
    rows = checked.where("mismatch").withColumn("nth", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return rows.where(F.col("nth") <= most)


def pairwise_balance(df: DataFrame, key: str, order: list[str], tolerance: float, most_percent: int = 5) -> DataFrame:
    """By account: neighbouring rows that both have a balance, how many do not follow, and whether they are few enough."""
    # The row before is one of the same day, or else the last of the day before; only days share a window by account.
    day = order[0]
    inside = Window.partitionBy(key, day).orderBy(*order)
    rows = df.withColumns({"_nth": F.row_number().over(inside), "_within": F.lag("balance").over(inside)})
    days = rows.groupBy(key, day).agg(F.max_by("balance", F.struct(*order)).alias("_end"))
    days = days.withColumn("_eve", F.lag("_end").over(Window.partitionBy(key).orderBy(day))).select(F.col(key).alias("_k"), F.col(day).alias("_day"), "_eve")
    rows = rows.join(days, rows[key].eqNullSafe(days["_k"]) & rows[day].eqNullSafe(days["_day"])).drop("_k", "_day")
    previous = F.when(F.col("_nth") == 1, F.col("_eve")).otherwise(F.col("_within"))
    rows = rows.withColumn("_diff", F.col("balance") - (previous + _net()))
    out = rows.groupBy(key).agg(F.count("_diff").alias("n_pairs"), F.count(F.when(F.abs("_diff") > tolerance, 1)).alias("n_bad"))
    return out.withColumn("passed", F.when(F.col("n_pairs") > 0, F.col("n_bad") * 100 < most_percent * F.col("n_pairs")))


def file_checks(df: DataFrame, key: str, date: str = "date", date_raw: str | None = None) -> DataFrame:
    """By file: rows, rows without an amount, rows whose date could not be read, first and last date."""
    unread = F.col(date).isNull() & (F.col(date_raw).isNotNull() if date_raw else F.lit(True))
    neither = (F.coalesce(F.col("debit"), F.lit(0)) == 0) & (F.coalesce(F.col("credit"), F.lit(0)) == 0)
    return df.groupBy(key).agg(
        F.count("*").alias("n_rows"), F.count_if(neither).alias("n_no_amount"), F.count_if(unread).alias("n_bad_date"), F.min(date).alias("period_start"), F.max(date).alias("period_end")
    )


def sequence_duplicates(df: DataFrame, key: str, sequence: str) -> DataFrame:
    """By file: how many rows repeat a sequence number; blanks do not count."""
    number = F.nullif(F.trim(F.col(sequence).cast("string")), F.lit(""))
    return df.groupBy(key).agg((F.count(number) - F.count_distinct(number)).alias("n_repeated"))


def excluded_types(df: DataFrame, key: str, record_type: str, kept: str = "EOP") -> DataFrame:
    """By file: the other record types that were left out."""
    other = F.when(F.trim(record_type) != kept, F.trim(record_type))
    return df.groupBy(key).agg(F.array_sort(F.collect_set(other)).alias("excluded")).where(F.size("excluded") > 0)


def examples(df: DataFrame, key: str, problem: Column, example: Column, most: int = 5) -> DataFrame:
    """By file: how many rows have the problem, and its first examples, ``most`` of them: a report for people."""
    rows = df.where(problem).withColumn("_e", example.cast("string"))
    nth = F.row_number().over(Window.partitionBy(key).orderBy("_e"))
    first = rows.select(key, "_e").distinct().withColumn("_n", nth).where(F.col("_n") <= most)
    first = first.groupBy(key).agg(F.array_sort(F.collect_list("_e")).alias("examples"))
    return rows.groupBy(key).agg(F.count("*").alias("n")).join(first, key)
