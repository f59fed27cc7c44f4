"""The decision log: corrections, what holds now, and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def standing(log: DataFrame) -> DataFrame:
    """Decisions that no later one of the same entity and field corrects."""
    corrections = log.where("corrects is not null").select("entity", "field", F.col("corrects").alias("ts")).distinct()
    return log.join(corrections, ["entity", "field", "ts"], "left_anti")


def effective(log: DataFrame) -> DataFrame:
    """The last standing decision of each entity and field: entity, field, ts, value."""
    row = F.max(F.struct("ts", "value")).alias("_r")
    return standing(log).groupBy("entity", "field").agg(row).select("entity", "field", "_r.ts", "_r.value")


def tail(log: DataFrame, most: int = 10) -> DataFrame:
    """The report of the last ``most`` decisions."""
    return log.orderBy(F.desc("ts")).limit(most)


def audit_sample(log: DataFrame, seed: int, most: int = 3) -> DataFrame:
    """A few decisions to look at again, the same for the same seed."""
    return log.orderBy(F.xxhash64(F.lit(seed), F.col("ts"))).limit(most)
