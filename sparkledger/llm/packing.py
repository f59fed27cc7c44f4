"""Packing by power-of-two decomposition.

Each document's ids are cut into pieces whose lengths are powers of two: as many of the full sequence
length as fit, then one piece for each set bit of what is left, long pieces first.  Pieces of equal
length form a bucket, and every piece is a sequence of its own, so no sequence crosses documents and,
all lengths being powers of two, none needs padding.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sparkledger.llm import common, wordbpe


def cut(sizes: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, start and length of each piece of documents with ``sizes`` ids, in order."""
    full, rest = sizes // longest, sizes % longest
    bits = 1 << np.arange(int(longest).bit_length() - 2, -1, -1, dtype=np.int64)
    counts = full + ((rest[:, None] & bits) > 0).sum(1)
    doc = np.repeat(np.arange(len(sizes)), counts)
    first = np.cumsum(counts) - counts
    nth = np.arange(len(doc)) - first[doc]
    length = np.full(len(doc), longest, np.int64)
    tail = nth >= full[doc]
    row, bit = np.nonzero(rest[:, None] & bits)
    length[tail] = bits[bit]
    before = np.cumsum(length) - length
    return doc, before - before[np.minimum(first, len(doc) - 1)][doc] if len(doc) else before, length


def pack(docs: DataFrame, tokenizer: str, longest: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, bucket, sequence_id, offset.

    ``longest`` must be a power of two.  A null text is empty; as every document gets ``end_id``, each
    has one piece at least.  Null and repeated doc_ids are packed row by row.  Other columns are ignored.
    Sequence ids are unique longs that sort by bucket.
    """
    if longest < 1 or longest & (longest - 1) or longest > 1 << 31:
        raise ValueError("the sequence length must be a power of two, 2**31 at most")

    def tasks(batches):
        common.begin("words")
        for batch in batches:
            for part in common.slices(batch, 1, wordbpe.SLICE):
                ids, bounds = wordbpe.encode_column(part.column(1), tokenizer, end_id)
                sizes = np.diff(bounds)
                doc, start, length = cut(sizes, longest)
                ends = np.concatenate(([0], np.cumsum(length)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(doc)), pa.array(start), pa.array(length), common.binary_array(ids, ends), pa.array(sizes[doc])],
                    names=["doc_id", "start", "length", "ids", "doc_tokens"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = rows.mapInArrow(tasks, "doc_id long, start long, length long, ids binary, doc_tokens long")
    bucket = F.log2("length").cast("int")
    # The bucket takes five bits above 2**25 partitions of 2**33 rows.
    sequence = F.shiftleft(F.col("bucket").cast("long"), 58).bitwiseOR(F.monotonically_increasing_id())
    return pieces.withColumn("bucket", bucket).withColumn("sequence_id", sequence).withColumn("offset", F.lit(0).cast("long"))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """The sequences as Parquet, one folder per length."""
    pieces.select("bucket", "sequence_id", "doc_id", "start", "length", "ids").write.partitionBy("bucket").parquet(path)


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")
