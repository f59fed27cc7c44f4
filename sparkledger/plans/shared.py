"""Writing intermediate tables where every executor can read them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` below ``spark.checkpoint.dir`` (below the warehouse where that is unset) and reads it back."""
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
