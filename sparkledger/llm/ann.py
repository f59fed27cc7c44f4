"""Approximate nearest neighbours by randomly rotated one-bit codes.

A vector's difference from a centre is padded to a number of bits, rotated at random and kept as its signs,
packed in 64-bit words, with its length and how well the signs represent it.  Every vector is coded once,
into a table.  A query is rotated likewise and cut to ``PLANES`` bits a component, so its inner product with
a code is a sum of bit counts of words; that gives an unbiased estimate of the inner product of the vectors,
with a bound that holds but for ``DEVIATIONS`` standard errors.  Vectors whose upper bound reaches the k-th
best exact product so far are ranked again on the original vectors.

Codes and their vectors are dealt once into parts of bounded size; only queries visit every part.  A few parts
come first, and the k-th best products found there are the floors with which queries visit the others.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sparkledger.llm import common, vectors as V

#: Bits of a code for each component, and at least; bits of a query's component; standard errors; vectors ranked before any bound.
BITS_EACH, LEAST_BITS, PLANES, DEVIATIONS, FIRST = 2, 128, 4, 3.5, 64
#: Bytes of original vectors in a part, and vectors that a query meets at once.
PART_BYTES, BLOCK = 4 << 20, 8192
#: One part in so many comes first.
PILOT = 8


def rotation(dimension: int, bits: int, seed: int = 7) -> np.ndarray:
    """``dimension`` orthonormal rows of a random rotation of ``bits`` dimensions."""
    square, upper = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, bits)))
    return (square * np.sign(np.diag(upper)))[:dimension]


def in_order(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed from the first component to the last."""
    total = np.zeros(len(x))
    for k in range(x.shape[1]):
        total += x[:, k] * y[:, k]
    return total


class Codes:
    """Codes of vectors: words of signs, lengths of the differences, and how alike signs and differences are."""

    def __init__(self, words: np.ndarray, length: np.ndarray, alike: np.ndarray):
        self.words, self.length, self.alike = words, length, alike
        self.bits = words.shape[1] * 64
        self.columns = [np.ascontiguousarray(words[:, w]) for w in range(words.shape[1])]
        self.ones = sum(np.bitwise_count(c).astype(np.int32) for c in self.columns)
        self.scale = length / alike
        self.spread = self.scale**2 * np.maximum(1 - alike**2, 0) / (self.bits - 1)

    @classmethod
    def of(cls, x: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> "Codes":
        rest = x - centre
        length, turned = np.linalg.norm(rest, axis=1), rest @ turn
        with np.errstate(invalid="ignore", divide="ignore"):
            alike = np.where(length > 0, np.abs(turned).sum(1) / np.sqrt(turn.shape[1]) / length, 1.0)
        return cls(np.packbits(turned > 0, axis=1, bitorder="little").view("<u8"), length, alike)

    def estimate(self, query: "Query", low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Of a run of the vectors: their estimated inner products with the query and the error bounds."""
        count = np.zeros(high - low, np.int32)
        for w, column in enumerate(self.columns):
            column = column[low:high]
            for b in range(PLANES):
                count += np.bitwise_count(column & query.planes[b, w]).astype(np.int32) << b
        along = 2 * (query.low * self.ones[low:high] + query.step * count) - query.total
        guess = along * self.scale[low:high] / np.sqrt(self.bits) + query.base
        return guess, DEVIATIONS * np.sqrt(query.size**2 * self.spread[low:high] + (self.scale[low:high] * query.lost) ** 2 / self.bits) + 1e-9


class Query:
    """A rotated query, its components cut to ``PLANES`` bits in words like the codes', with what the cut loses."""

    def __init__(self, q: np.ndarray, centre: np.ndarray, turn: np.ndarray):
        turned = q @ turn
        self.low = turned.min()
        self.step = max((turned.max() - self.low) / (2**PLANES - 1), 1e-300)
        cut = np.rint((turned - self.low) / self.step).astype(np.uint8)
        near = self.low + self.step * cut
        self.lost, self.total = np.linalg.norm(turned - near), near.sum()
        self.size, self.base = np.linalg.norm(q), q @ centre
        self.planes = np.stack([np.packbits((cut >> b) & 1, bitorder="little").view("<u8") for b in range(PLANES)])


class Part:
    """The vectors of one part with their codes; queries are asked one after the other."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, codes: Codes, centre: np.ndarray, turn: np.ndarray, k: int):
        self.ids, self.x, self.codes, self.centre, self.turn, self.k = ids, x, codes, centre, turn, k

    def ask(self, query_id: int, q: np.ndarray, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact products of the query's k best vectors that reach the floor; block after block the floor rises."""
        query, k = Query(q, self.centre, self.turn), self.k
        best_ids, best = np.empty(0, np.int64), np.empty(0)
        for low in range(0, len(self.ids), BLOCK):
            high = min(low + BLOCK, len(self.ids))
            guess, bound = self.codes.estimate(query, low, high)
            guess[self.ids[low:high] == query_id] = -np.inf
            if len(best) < k and floor == -np.inf:
                first = min(FIRST, high - low)
                likely = np.argpartition(-guess, first - 1)[:first]
                likely = likely[guess[likely] > -np.inf]
                exact = self.x[low + likely] @ q
                if len(likely) >= k:
                    floor = np.partition(exact, len(likely) - k)[len(likely) - k] - 1e-9
            near = low + np.flatnonzero((guess + bound >= floor) & (guess > -np.inf))
            if not len(near):
                continue
            exact = in_order(self.x[near], np.broadcast_to(q, (len(near), len(q))))
            best_ids, best = np.concatenate((best_ids, self.ids[near])), np.concatenate((best, exact))
            if len(best) > k:
                keep = best >= np.partition(best, len(best) - k)[len(best) - k]
                best_ids, best = best_ids[keep], best[keep]
                floor = max(floor, best.min())  # equal products stay, for the order of ids
        order = np.lexsort((best_ids, -best))[:k]
        return best_ids[order], best[order]


def search(table: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score: for each vector of ``queries`` its k nearest in ``table``.

    Nearness is the inner product, ties go to the smaller vec_id, and a vector is not its own neighbour.
    What ``vectors.usable`` sets apart takes no part on either side, a query only meets vectors of its own
    length, and rows that share an id are one vector.
    """
    rows = common.materialize(V.usable(table, id_col, vector_col), "vectors")
    asked = common.materialize(V.usable(queries, id_col, vector_col), "queries")
    here, there = V.lengths(rows), V.lengths(asked)
    found = [_search(rows.where(F.col("d") == d), asked.where(F.col("d") == d), d, here[d], k) for d in sorted(here.keys() & there.keys())]
    if not found:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def coded(rows: DataFrame, centre: np.ndarray, turn: np.ndarray, parts: int) -> DataFrame:
    """The code table: id, x, words, length, alike and part of each vector (id, x)."""

    def tasks(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                piece = batch.slice(at, 4096)
                codes = Codes.of(V.matrix(piece.column(1), "<f8", len(centre)), centre, turn)
                yield pa.RecordBatch.from_arrays([*piece.columns, V.packed(codes.words), pa.array(codes.length), pa.array(codes.alike)], names=["id", "x", "words", "length", "alike"])

    table = rows.select("id", "x").mapInArrow(tasks, "id long, x binary, words binary, length double, alike double")
    return common.materialize(table.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")), "codes")


def _search(rows: DataFrame, asked: DataFrame, dimension: int, n: int, k: int) -> DataFrame:
    """Of vectors of one length: query_id, vec_id and score of each part's best for each query."""
    centre = V.sample(rows, dimension, n, 8192).mean(0)
    bits = -(-max(LEAST_BITS, BITS_EACH * dimension) // 64) * 64
    turn = rotation(dimension, bits)
    parts = -(-n // max(1024, PART_BYTES // (8 * dimension)))
    table = coded(rows, centre, turn, parts)
    first = -(-parts // PILOT)
    found = common.materialize(_asked(table.where(F.col("part") < first), asked.withColumn("floor", F.lit(float("-inf"))), 0, first, centre, turn, k), "first-neighbours")
    if first == parts:
        return found
    nth = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score")))
    floors = found.withColumn("nth", nth).where(F.col("nth") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
    asked = common.materialize(asked.join(floors, "id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf")))), "floors")
    return found.unionByName(_asked(table.where(F.col("part") >= first), asked, first, parts, centre, turn, k))


def _asked(table: DataFrame, asked: DataFrame, low: int, high: int, centre: np.ndarray, turn: np.ndarray, k: int) -> DataFrame:
    """All queries (id, x, floor) put to the parts from ``low`` up to ``high``: each part is read, then queries stream past it."""
    width, bits = len(centre), turn.shape[1]

    def tasks(batches):
        held, now, part = [], None, None
        for batch in batches:
            number, asks = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.concatenate(([True], (number[1:] != number[:-1]) | (asks[1:] != asks[:-1])))) if len(number) else []
            for a, b in zip(cuts, [*cuts[1:], len(number)]):
                piece = batch.slice(a, b - a)
                if number[a] != now:
                    held, now, part = [], number[a], None
                if not asks[a]:
                    held.append((piece.column(2).to_numpy(), V.matrix(piece.column(3), "<f8", width), V.matrix(piece.column(4), "<u8", bits // 64), piece.column(5).to_numpy(), piece.column(6).to_numpy()))
                    continue
                if part is None and held:
                    ids, x, words, length, alike = (np.concatenate(c) for c in zip(*held))
                    part, held = Part(ids, x, Codes(words, length, alike), centre, turn, k), []
                if part is None:
                    continue
                query_ids, q, floors = piece.column(2).to_numpy(), V.matrix(piece.column(3), "<f8", width), piece.column(7).to_numpy()
                found = [part.ask(*one) for one in zip(query_ids.tolist(), q, floors.tolist())]
                sizes = [len(ids) for ids, _ in found]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(query_ids, sizes)), pa.array(np.concatenate([ids for ids, _ in found])), pa.array(np.concatenate([s for _, s in found]))], names=["query_id", "vec_id", "score"])

    none = lambda kind: F.lit(None).cast(kind)
    left = table.select("part", F.lit(False).alias("asks"), "id", "x", "words", "length", "alike", none("double").alias("floor"))
    every = F.explode(F.sequence(F.lit(low), F.lit(high - 1))).alias("part")
    right = asked.select(every, F.lit(True).alias("asks"), "id", "x", none("binary").alias("words"), none("double").alias("length"), none("double").alias("alike"), "floor")
    # A task holds one part at a time, however many it is dealt.
    dealt = left.unionByName(right).repartition(max(1, high - low), "part").sortWithinPartitions("part", "asks")
    return dealt.mapInArrow(tasks, "query_id long, vec_id long, score double")
