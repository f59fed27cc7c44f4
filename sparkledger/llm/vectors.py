"""Reading vectors: one row per id, in double precision, with what cannot be compared set apart."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Vectors that centres are fitted on, at most.
SAMPLE = 65_536


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, d (number of components) and x (doubles, little-endian) of the vectors that take part.

    Rows that share an id are one vector, the smallest of their arrays.  Null ids, null, empty or zero
    vectors, and null or non-finite components take no part.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = ~F.exists("v", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))) & F.exists("v", lambda e: e != 0)
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(F.coalesce(fine, F.lit(False)))
    rows = rows.groupBy("id").agg(F.min("v").alias("v"))

    def tasks(batches):
        for batch in batches:
            column = batch.column(1)
            bounds = column.offsets.to_numpy().astype(np.int64)
            flat = column.flatten().to_numpy(zero_copy_only=False).astype("<f8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(bounds).astype(np.int32)), packed(flat, bounds - bounds[0])], names=["id", "d", "x"])

    return rows.mapInArrow(tasks, "id long, d int, x binary")


def lengths(rows: DataFrame) -> dict[int, int]:
    """How many vectors there are of each number of components: a row for each number."""
    return {r["d"]: r["count"] for r in rows.groupBy("d").count().collect()}


def packed(matrix: np.ndarray, bounds: np.ndarray | None = None) -> pa.Array:
    """Rows of raw bytes, of a matrix or of a flat array with bounds."""
    from sparkledger.llm.common import binary_array

    if bounds is None:
        bounds = np.arange(len(matrix) + 1) * (matrix.shape[1] if matrix.ndim == 2 else 0)
    return binary_array(np.ascontiguousarray(matrix).ravel(), bounds)


def matrix(column, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in column), kind).reshape(-1, width)


def sample(rows: DataFrame, dimension: int, n: int, size: int = SAMPLE) -> np.ndarray:
    """At most ``size`` of ``n`` vectors of one length, those with the smallest hashes of their ids.

    A first sieve by hash leaves about twice as many over all tasks, so no task sends many to the driver.
    """
    share = min(1.0, (2 * size + 1000) / max(n, 1))
    some = rows.withColumn("h", F.xxhash64("id")).where(F.pmod("h", F.lit(1 << 20)) <= int(share * (1 << 20)))
    return matrix(some.orderBy("h", "id").limit(size).select("x").toArrow()["x"], "<f8", dimension)
