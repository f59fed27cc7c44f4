"""Token files in Simple-8b word-aligned coding.

Ids are packed into 64-bit words.  The top four bits of a word select how many ids it holds and how wide
each is; selector 0 is the escape, one id of up to 60 bits by itself.  Blocks of 256 ids start at a word
of their own and their word offsets are stored, so any block can be decoded alone and all blocks of a
group are decoded together with vector operations.

A file is a run of groups of documents.  A group is a header of six unsigned 64-bit numbers (magic,
documents, ids, blocks, words, number of the first id in the file) followed by the documents' ids (long),
a byte for each that tells nulls, their numbers of tokens, the blocks' word offsets and the words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkledger.llm import common, wordbpe

BLOCK = 256
MAGIC = 0x31424B4F54_533853
#: Ids in a word and bits of each, by selector; selector 0 is the escape.
COUNTS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
WIDTHS = 60 // COUNTS


def _choices(widths: np.ndarray) -> np.ndarray:
    """For each position of each block the selector that takes most ids from there; past its end a block has width 0."""
    rows, size = widths.shape
    padded = np.zeros((rows, size + 64), np.uint8)
    padded[:, :size] = widths
    best = np.zeros((rows, size), np.uint8)
    high, reach = padded, 1
    for k in range(1, len(COUNTS)):
        n = int(COUNTS[k])
        shift = n - reach  # the maximum over n ids is that over the first `reach` and the last `reach` of them
        wider = high.copy()
        np.maximum(high[:, : high.shape[1] - shift], high[:, shift:], out=wider[:, : high.shape[1] - shift])
        high, reach = wider, n
        best[high[:, :size] <= WIDTHS[k]] = k
    return best


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits of each value; from 31 bits on 60, which only the escape holds."""
    widths = _LENGTHS[values & values.dtype.type(0xFFFF)]
    high = np.flatnonzero(values >> values.dtype.type(16))
    if len(high):
        top = values[high] >> values.dtype.type(16)
        widths[high] = np.where(top < 1 << 14, _LENGTHS[np.minimum(top, 0xFFFF)] + 16, 60)
    return widths


_LENGTHS = np.frexp(np.arange(1 << 16))[1].astype(np.uint8)


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words, and the word offset of each block with the number of words at the end."""
    most = int(ids.max()) if len(ids) else 0
    if most >= 1 << 60:
        raise ValueError("ids have 60 bits at most")
    blocks = -(-len(ids) // BLOCK)
    # Each block has 64 zeros behind it, so a word's ids can be read past its end.
    grid = np.zeros((blocks, BLOCK + 64), np.uint32 if most < 1 << 32 else np.uint64)
    whole = len(ids) // BLOCK
    grid[:whole, :BLOCK] = ids[: whole * BLOCK].reshape(whole, BLOCK)
    sizes = np.full(blocks, BLOCK)
    if whole < blocks:
        sizes[-1] = len(ids) - whole * BLOCK
        grid[-1, : sizes[-1]] = ids[whole * BLOCK :]
    best = _choices(_bit_lengths(np.ascontiguousarray(grid[:, :BLOCK]).ravel()).reshape(blocks, BLOCK))
    # All blocks advance together; the k-th step gives each block its k-th word.
    at, live, taken, steps = np.zeros(blocks, np.int64), np.arange(blocks), [], np.zeros(blocks, np.int64)
    flat_best = best.ravel()
    while len(live):
        here = at[live]
        chosen = flat_best[live * BLOCK + here]
        taken.append((live, here, chosen))
        here = here + COUNTS[chosen]
        at[live] = here
        steps[live] += 1
        live = live[here < sizes[live]]
    offsets = np.zeros(blocks + 1, np.uint32)
    offsets[1:] = np.cumsum(steps)
    if not taken:
        return np.empty(0, np.uint64), offsets
    row, pos, sel = (np.concatenate(x) for x in zip(*taken))
    nth = np.repeat(np.arange(len(taken)), [len(x[0]) for x in taken])
    words, target, flat_grid = np.empty(len(row), np.uint64), offsets[row] + nth, grid.ravel()
    for k in np.unique(sel):
        mine, n, width = np.flatnonzero(sel == k), int(COUNTS[k]), int(WIDTHS[k])
        base = row[mine] * (BLOCK + 64) + pos[mine]
        packed = np.full(len(mine), int(k) << 60, np.uint64)
        for j in range(n):
            packed |= flat_grid[base + j].astype(np.uint64) << np.uint64(j * width)
        words[target[mine]] = packed
    return words, offsets


def decode(words: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    """All ids of the blocks, as unsigned 64-bit numbers."""
    blocks = len(offsets) - 1
    out = np.zeros(blocks * BLOCK + 64, np.uint64)
    sel = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[sel]
    before = np.cumsum(counts) - counts
    per_block = np.diff(offsets.astype(np.int64))
    block = np.repeat(np.arange(blocks), per_block)
    first = before[np.minimum(offsets[:-1].astype(np.int64), max(len(words) - 1, 0))] if len(words) else before
    pos = before - first[block]
    for k in np.unique(sel):
        mine, n, width = np.flatnonzero(sel == k), int(COUNTS[k]), int(WIDTHS[k])
        mask = np.uint64((1 << width) - 1)
        held = (words[mine][:, None] >> (np.arange(n, dtype=np.uint64) * np.uint64(width))) & mask
        inside = pos[mine][:, None] + np.arange(n)
        target = (block[mine] * BLOCK)[:, None] + inside
        if (keep := inside < BLOCK).all():
            out[target] = held
        else:
            out[target[keep]] = held[keep]
    return out[:size]


def _group(keys: np.ndarray, nulls: np.ndarray, ids: np.ndarray, sizes: np.ndarray, first: int) -> bytes:
    words, offsets = encode(ids)
    head = np.array([MAGIC, len(keys), len(ids), len(offsets) - 1, len(words), first], "<u8")
    return b"".join(x.tobytes() for x in (head, keys.astype("<i8"), nulls.astype("u1"), sizes.astype("<u4"), offsets.astype("<u4"), words.astype("<u8")))


def read_groups(stream):
    """doc_ids, their null flags, sizes, number of the first id and ids of each group of a file."""
    while head := stream.read(48):
        magic, docs, size, blocks, count, first = (int(x) for x in np.frombuffer(head, "<u8"))
        if magic != MAGIC:
            raise ValueError("this is no token file")
        take = lambda kind, n: np.frombuffer(stream.read(n * np.dtype(kind).itemsize), kind)
        keys, nulls, sizes = take("<i8", docs), take("u1", docs).astype(bool), take("<u4", docs).astype(np.int64)
        offsets, words = take("<u4", blocks + 1), take("<u8", count)
        yield keys, nulls, sizes, first, decode(words, offsets, size)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the ids of all texts, in ascending doc_id order over the files, and returns the files.

    Each file has one range of doc_ids; the result has, by file, path, part, n_docs and n_tokens.  A null
    text is empty, each document has at least ``end_id``, null doc_ids come first, and rows that share a
    doc_id follow each other in the order of their texts.  Files are written under a task's own name and renamed when
    whole, so a task that runs again replaces its file.
    """
    from pyarrow import fs

    def tasks(batches):
        common.begin("words")
        part = TaskContext.get().partitionId()
        store, root = fs.FileSystem.from_uri(path)
        name, docs_seen, seen, out = f"{root}/part-{part:06d}.s8b", 0, 0, None
        attempt = f"{root}/_{part:06d}-{TaskContext.get().taskAttemptId()}"
        for batch in batches:
            for rows in common.slices(batch, 1, wordbpe.SLICE):
                ids, bounds = wordbpe.encode_column(rows.column(1), tokenizer, end_id)
                if out is None:
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(attempt)
                keys = rows.column(0)
                out.write(_group(pc.fill_null(keys, 0).to_numpy(), keys.is_null().to_numpy(zero_copy_only=False), ids, np.diff(bounds), seen))
                docs_seen, seen = docs_seen + len(keys), seen + len(ids)
        if out is not None:
            out.close()
            store.move(attempt, name)
            yield pa.RecordBatch.from_pydict({"path": [f"{path}/part-{part:06d}.s8b"], "part": [part], "n_docs": [docs_seen], "n_tokens": [seen]})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    width = common.shuffle_width(docs.sparkSession)
    ordered = rows.repartitionByRange(width, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    return ordered.mapInArrow(tasks, "path string, part long, n_docs long, n_tokens long")


def read(spark: SparkSession, files: DataFrame) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens and ids (little-endian unsigned 32-bit)."""
    from pyspark.sql import Window

    # One row per file: as few as there are partitions.
    based = files.withColumn("base", F.coalesce(F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))

    def tasks(batches):
        from pyarrow import fs

        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, name = fs.FileSystem.from_uri(path)
                with store.open_input_stream(name, buffer_size=1 << 20) as stream:
                    for keys, nulls, sizes, first, ids in read_groups(stream):
                        ends = np.concatenate(([0], np.cumsum(sizes)))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keys, mask=nulls), pa.array(base + first + ends[:-1]), pa.array(sizes), common.binary_array(ids.astype("<u4"), ends)],
                            names=["doc_id", "start", "n_tokens", "ids"],
                        )

    spread = based.select("path", "base").repartition(common.shuffle_width(spark), "path")
    return spread.mapInArrow(tasks, "doc_id long, start long, n_tokens long, ids binary")


def digest(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
