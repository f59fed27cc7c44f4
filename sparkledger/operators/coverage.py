"""Which account months have statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def covered_months(files: DataFrame, source_type: str = "csv") -> DataFrame:
    return files.where(F.col("source_type") == source_type).select("account", "month").distinct()


def prune_covered(files: DataFrame) -> DataFrame:
    """Files of the secondary type that are not needed: all their account months are covered by the primary type."""
    have = covered_months(files).withColumn("_has", F.lit(True))
    second = files.where("source_type <> 'csv'").select("file_name", "account", "month").distinct()
    judged = second.join(have, ["account", "month"], "left").groupBy("file_name").agg(F.every(F.coalesce("_has", F.lit(False))).alias("covered"), F.count("*").alias("n_months"))
    return judged.where("covered").select("file_name", "n_months")


def month_gaps(files: DataFrame) -> DataFrame:
    """Months between an account's first and last that no file covers."""
    first = F.to_date(F.concat(F.min("month"), F.lit("-01")))
    last = F.to_date(F.concat(F.max("month"), F.lit("-01")))
    every = files.groupBy("account").agg(F.sequence(first, last, F.expr("interval 1 month")).alias("months"))
    every = every.select("account", F.explode("months").alias("_m")).select("account", F.date_format("_m", "yyyy-MM").alias("month"))
    return every.join(files.select("account", "month").distinct(), ["account", "month"], "left_anti")


def extraction_variance(left: DataFrame, right: DataFrame) -> DataFrame:
    """Account months whose totals differ between two extractions of the same statements."""
    total = lambda df, name: df.groupBy("account", "month").agg(F.sum(F.coalesce(F.col("credit"), F.lit(0)) - F.coalesce(F.col("debit"), F.lit(0))).alias(name))
    both = total(left, "left_net").join(total(right, "right_net"), ["account", "month"])
    return both.withColumn("variance", F.col("left_net") - F.col("right_net"))
