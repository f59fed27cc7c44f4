"""Near-duplicate vectors through spherical k-means cells.

Equal vectors are one class.  Centres are fitted on a bounded sample.  A class belongs to each cell whose
centre is at most a margin less alike than its best one; the margin is measured: pairs just at the threshold
are made around sampled vectors that gave no centre, and it is so wide that all but ``MISSED`` of them share a cell.  Cells are
cut into blocks and each pair of blocks of a cell is one group: it multiplies the blocks, confirms likely
pairs in double precision, and hands on how many partners each class has and a spanning forest of the links,
so what leaves a group grows with its vectors and not with its pairs.  A pair that meets in several cells
counts in the first of them.  Vectors of different lengths are compared with those of their own length only.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sparkledger.llm import common, vectors as V
from sparkledger.llm.components import components

#: Classes in a cell on average, until there are ``MOST_CELLS``, which the sample bounds (eight vectors a centre); vectors in a block.
CELL, MOST_CELLS, BLOCK = 512, 8192, 2048
#: Share of pairs at the threshold that may share no cell, and pairs it is measured on.
MISSED, PROBES = 0.0005, 8192


def spherical_kmeans(points: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """Unit centres of unit points; the first points in order are the first centres."""
    centres = points[:k].copy()
    for _ in range(rounds):
        nearest = np.concatenate([(points[i : i + 8192] @ centres.T).argmax(1) for i in range(0, len(points), 8192)])
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        norms = np.linalg.norm(sums, axis=1)
        full = norms > 0
        centres[full] = sums[full] / norms[full, None]
    return centres


def _unit(x: np.ndarray) -> np.ndarray:
    """Scaled by the largest component first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of n nodes the smallest node that the links a-b reach."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def fitted(points: np.ndarray, k: int, least: float) -> tuple[np.ndarray, float]:
    """Centres of all points but a quarter, ``PROBES`` at most, and the margin that the pairs around those others need."""
    aside = min(PROBES, len(points) // 4)
    fit = points[: len(points) - aside]
    centres = spherical_kmeans(fit, min(k, len(fit)))
    return centres, margin(points[len(fit) :] if aside else points, centres, least)


def margin(points: np.ndarray, centres: np.ndarray, least: float) -> float:
    """How much less alike than the best a centre may be, so that nearly all pairs with a cosine of ``least`` share one.

    ``points`` should have given neither seeds nor means of the centres: such points are closer to them than others.  A pair's need is the least, over centres, of the larger of its two shortfalls.
    """
    if len(centres) < 2 or points.shape[1] < 2:
        return 2.0
    some = points[:PROBES]
    some = np.tile(some, (-(-PROBES // len(some)), 1))[:PROBES]
    aside = np.random.default_rng(11).standard_normal(some.shape)
    aside -= np.einsum("ij,ij->i", aside, some)[:, None] * some
    other = least * some + np.sqrt(max(0.0, 1 - least * least)) * aside / np.linalg.norm(aside, axis=1, keepdims=True)
    needs = []
    for low in range(0, PROBES, 512):
        a, b = some[low : low + 512] @ centres.T, other[low : low + 512] @ centres.T
        needs.append(np.maximum(a.max(1, keepdims=True) - a, b.max(1, keepdims=True) - b).min(1))
    return float(np.quantile(np.concatenate(needs), 1 - MISSED)) + 1e-9


def near_vectors(table: DataFrame, least: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per row of ``table``: vec_id, n_links, component_id (smallest linked vec_id) and kept.

    Links are pairs with a cosine of ``least`` or more.  What ``vectors.usable`` sets apart links with
    nothing; a null vec_id has no component and is kept.  Rows that share a vec_id fare alike.
    """
    rows = common.materialize(V.usable(table, id_col, vector_col), "vectors")
    # Counted in each task before the shuffle, so a vector that many rows share weighs little.
    classes = common.materialize(rows.groupBy("d", "x").agg(F.min("id").alias("id"), F.count("*").alias("size")), "class-vectors")
    sizes = classes.select(F.col("id").alias("class"), "size")
    found = [_linked(classes.where(F.col("d") == d), d, n, least) for d, n in sorted(V.lengths(classes).items())]
    links = reduce(DataFrame.unionByName, found) if found else None
    own = sizes.select(F.col("class").alias("id"), (F.col("size") - 1).alias("own"))
    if links is None:
        known = own.select("id", F.col("own").alias("n_links"), F.lit(None).cast("long").alias("component"))
    else:
        links = common.materialize(links, "vector-links")
        degrees = links.groupBy("id").agg(F.sum("n").alias("n"))
        groups = components(links.select(F.col("id").alias("a"), F.col("root").alias("b")))
        known = own.join(degrees, "id", "left").join(groups, "id", "left").select("id", (F.col("own") + F.coalesce("n", F.lit(0))).alias("n_links"), "component")
    # A class of one is its own row; only members of larger ones are joined by their vectors.
    several = classes.where("size > 1").select("d", "x", F.col("id").alias("class"))
    member = rows.join(several, ["d", "x"], "left").select("id", F.coalesce("class", "id").alias("class"))
    known = member.join(known.withColumnRenamed("id", "class"), "class").select(F.col("id").alias("vec_id"), "n_links", F.coalesce("component", "class").alias("component"))
    out = table.select(F.col(id_col).cast("long").alias("vec_id")).join(known, "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


def _linked(classes: DataFrame, dimension: int, n: int, least: float) -> DataFrame:
    """Of classes of one length (id, x, size): id, the smallest id it reaches in a group, and the vectors it links with there."""
    k = int(min(max(1, n // CELL), MOST_CELLS))
    centres, beside = fitted(_unit(V.sample(classes, dimension, n)), k, least)

    def assign(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                unit = _unit(V.matrix(part.column(1), "<f8", dimension))
                alike = unit @ centres.T
                near = alike >= alike.max(1, keepdims=True) - beside
                bounds = np.concatenate(([0], np.cumsum(near.sum(1))))
                yield pa.RecordBatch.from_arrays([part.column(0), V.packed(unit), part.column(2), common.list_array(np.nonzero(near)[1], bounds, pa.int32())], names=["id", "x", "size", "cells"])

    assigned = common.materialize(classes.select("id", "x", "size").mapInArrow(assign, "id long, x binary, size long, cells array<int>"), "cells")
    in_cells = assigned.withColumn("cell", F.explode("cells"))
    # As many rows as there are cells, which MOST_CELLS bounds.
    blocks = in_cells.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n_blocks"))
    placed = in_cells.join(F.broadcast(blocks), "cell").withColumn("block", F.pmod(F.xxhash64("id"), F.col("n_blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    placed = placed.select("cell", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", "x", "size", "cells")

    def compare(group: pa.Table) -> pa.Table:
        cell, i, j = (group[c][0].as_py() for c in ("cell", "i", "j"))
        block, ids, size, unit = group["block"].to_numpy(), group["id"].to_numpy(), group["size"].to_numpy(), V.matrix(group["x"], "<f8", dimension)
        cells = group["cells"].to_pylist()
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        coarse = unit.astype(np.float32)
        found = []
        for at in range(0, len(left), 1024):
            rows_of = left[at : at + 1024]
            a, b = np.nonzero(coarse[rows_of] @ coarse[right].T >= least - 1e-3)
            a, b = rows_of[a], right[b]
            once = a < b if i == j else np.ones(len(a), bool)
            a, b = a[once], b[once]
            for low in range(0, len(a), 200_000):
                x, y = a[low : low + 200_000], b[low : low + 200_000]
                near = np.einsum("ij,ij->i", unit[x], unit[y]) >= least
                found.append((x[near], y[near]))
        a, b = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, int), np.empty(0, int))
        # The first cell of both sides; vectors with the same list, the usual case, need no look.
        lists: dict[tuple, int] = {}
        kind = np.array([lists.setdefault(tuple(c), len(lists)) for c in cells])
        names = [set(c) for c in lists]
        pairs, inverse = np.unique(kind[a] * len(names) + kind[b], return_inverse=True)
        first = np.array([min(names[p // len(names)] & names[p % len(names)]) == cell for p in pairs.tolist()], bool)
        if len(a):
            a, b = a[first[inverse]], b[first[inverse]]
        degree = np.zeros(len(ids), np.int64)
        np.add.at(degree, a, size[b])
        np.add.at(degree, b, size[a])
        order = np.argsort(ids)  # roots are smallest ids
        rank = np.empty(len(ids), np.int64)
        rank[order] = np.arange(len(ids))
        root = order[_forest(rank[a], rank[b], len(ids))][rank]
        linked = np.flatnonzero(degree)
        return pa.table({"id": pa.array(ids[linked]), "root": pa.array(ids[root[linked]]), "n": pa.array(degree[linked])})

    return placed.groupBy("cell", "i", "j").applyInArrow(compare, "id long, root long, n long")
