"""Near-duplicate texts through an LSH forest over MinHash signatures.

A text's set is its distinct shingles of consecutive words.  Texts with equal sets form a class and only
the class's smallest doc_id goes on.  Each tree of the forest sorts the classes by a run of their minima;
a region is what shares the tree's first ``LEAST_DEPTH`` minima, and a class meets its ``REACH`` next ones
in that order.  So a small region is compared in full at the least depth, and within a larger one a class
first meets those with which it shares the longest prefixes.  Pairs are sifted by all minima, then
confirmed on the full sets: first each class's most alike partner, then the pairs that still lie in
different groups.  What is then left of a larger region, its pairs from different groups, is compared in
full too: its rows are dealt into blocks of bounded size, and each pair of blocks counts all its
intersections at once.  No pair that shares a region goes unmet.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sparkledger.llm import common
from sparkledger.llm.components import components

TREES, DEPTH, LEAST_DEPTH, REACH = 12, 6, 3, 10
#: A pair is confirmed in full if its estimate is at most this far below the threshold: more than five standard errors.
MARGIN = 0.25
_MINIMA = TREES * DEPTH
#: A block of a crowded region: about so many shingles, and so many that each row counts for besides its own.
BLOCK, ROW = 1 << 20, 800


def _sets(text: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, sorted, in a row, and bounds for each text."""
    data, offsets = common.text_bytes(text)
    data = common.lower_ascii(data)
    starts, ends, bounds = common.word_spans(data, offsets, common.BLANK_SEPARATED)
    words, counts, row = common.word_hashes(data, starts, ends), np.diff(bounds), common.row_of(bounds)
    place = np.arange(len(words)) - bounds[row]
    hashes = common.window_hashes(words, size, 3)
    whole = (place + size <= counts[row])[: len(hashes)]
    found, owner = hashes[whole], row[: len(hashes)][whole]
    # Texts of fewer words are one shingle: their whole sequence, hashed apart from full shingles by its length.
    for n in range(1, size):
        few = np.flatnonzero(counts == n)
        if len(few):
            shorter = common.window_hashes(words, n, 3 + n * 1000)[bounds[few]]
            found, owner = np.concatenate((found, shorter)), np.concatenate((owner, few))
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    new = np.concatenate(([True], (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])))[: len(found)]
    found, owner = found[new], owner[new]
    return found, np.searchsorted(owner, np.arange(len(text) + 1))


def _odd_numbers(n: int) -> np.ndarray:
    return common.mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)


def minima(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The smallest of each of ``_MINIMA`` hashes over each set, 32 bits each; empty sets get zeros."""
    out = np.zeros((len(bounds) - 1, _MINIMA), np.uint32)
    full = np.flatnonzero(np.diff(bounds) > 0)
    if len(full):
        heads = bounds[:-1][full]
        for k, factor in enumerate(_odd_numbers(_MINIMA)):
            hashed = values * factor
            hashed >>= np.uint64(32)
            out[full, k] = np.minimum.reduceat(hashed.astype(np.uint32), heads)
    return out


def signatures(rows: DataFrame, size: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, a 128-bit hash of the set (h1, h2) and the minima of (doc_id, text, text_hash) rows."""

    def tasks(batches):
        common.begin("minhash")
        for batch in batches:
            for part in common.slices(batch, 1):
                values, bounds = _sets(part.column(1), size)
                sizes = np.diff(bounds)
                h1, h2 = np.zeros(len(sizes), np.uint64), np.zeros(len(sizes), np.uint64)
                full = np.flatnonzero(sizes > 0)
                if len(full):
                    mixed = common.mix(values + np.uint64(0x632BE59BD9B4E019))
                    h1[full], h2[full] = np.add.reduceat(mixed, bounds[:-1][full]), np.bitwise_xor.reduceat(common.mix(mixed), bounds[:-1][full])
                found = minima(values, bounds).ravel()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), common.binary_array(found, np.arange(len(sizes) + 1) * _MINIMA), part.column(2)],
                    names=["doc_id", "n_shingles", "h1", "h2", "minima", "text_hash"],
                )

    return rows.mapInArrow(tasks, "doc_id long, n_shingles long, h1 long, h2 long, minima binary, text_hash long")


def _matrix(column: pa.Array, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in column), kind).reshape(-1, width)


def _trees(batches):
    """A row for each tree of each class: its sort prefix and a sketch, the low byte of every minimum."""
    common.begin("minhash")
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            found, n = _matrix(part.column(1), "<u4", _MINIMA), part.num_rows
            sketch = common.binary_array(np.tile(found.astype(np.uint8), (TREES, 1)).ravel(), np.arange(n * TREES + 1) * _MINIMA)
            prefix = np.ascontiguousarray(found.reshape(n, TREES, DEPTH).transpose(1, 0, 2)).astype(">u4").ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(TREES, dtype=np.int32), n)), common.binary_array(prefix, np.arange(n * TREES + 1) * DEPTH), pa.concat_arrays([part.column(0)] * TREES), sketch],
                names=["tree", "prefix", "id", "sketch"],
            )


def _neighbours(least: float):
    """Over rows sorted by tree and prefix: pairs within reach that share a region and look alike, the rows at both ends,
    and, without a sketch, the rows of regions that go beyond the reach."""

    def tasks(batches):
        held, first = None, True
        for batch in batches:
            for at in range(0, batch.num_rows, 20000):
                part = batch.slice(at, 20000)
                now = (part.column(0).to_numpy(), _matrix(part.column(1), ">u4", DEPTH), part.column(2).to_numpy(), _matrix(part.column(3), "u1", _MINIMA))
                rows = now if held is None else tuple(np.concatenate(x) for x in zip(held, now))
                skip = 0 if held is None else len(held[0])
                tree, prefix, ids, sketch = rows
                for j in range(1, REACH + 1):
                    low = max(skip - j, 0)  # pairs among held rows are done
                    a, b = np.arange(low, len(ids) - j), np.arange(low + j, len(ids))
                    same = (tree[a] == tree[b]) & (prefix[a, :LEAST_DEPTH] == prefix[b, :LEAST_DEPTH]).all(1) & (ids[a] != ids[b])
                    a, b = a[same], b[same]
                    alike = (sketch[a] == sketch[b]).mean(1)
                    keep = alike >= least
                    a, b, alike = a[keep], b[keep], alike[keep]
                    yield _found(np.minimum(ids[a], ids[b]), np.maximum(ids[a], ids[b]), alike)
                a = np.arange(max(len(ids) - REACH, 0))  # rows with another of their region REACH behind them: so have all between
                long = a[(tree[a] == tree[a + REACH]) & (prefix[a, :LEAST_DEPTH] == prefix[a + REACH, :LEAST_DEPTH]).all(1)]
                inside = np.zeros(len(ids) + 1, np.int64)
                np.add.at(inside, long, 1)
                np.add.at(inside, long + REACH + 1, -1) if len(long) else None
                inside = np.cumsum(inside)[:-1] > 0
                yield _crowd(tree[inside], prefix[inside, :LEAST_DEPTH], ids[inside])
                if first:
                    yield _ends(*(x[:REACH] for x in rows))
                    first = False
                held = tuple(x[-REACH:] for x in rows)
        if held is not None:
            yield _ends(*held)

    return tasks


_NEIGHBOURS = "a long, b long, alike double, tree int, prefix binary, id long, sketch binary"


def _found(a, b, alike) -> pa.RecordBatch:
    n = len(a)
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(alike), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())], names=["a", "b", "alike", "tree", "prefix", "id", "sketch"])


def _ends(tree, prefix, ids, sketch) -> pa.RecordBatch:
    n = len(ids)
    return pa.RecordBatch.from_arrays(
        [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.float64()), pa.array(tree.astype(np.int32)), common.binary_array(prefix.astype(">u4").ravel(), np.arange(n + 1) * DEPTH), pa.array(ids), common.binary_array(sketch.ravel(), np.arange(n + 1) * _MINIMA)],
        names=["a", "b", "alike", "tree", "prefix", "id", "sketch"],
    )


def _crowd(tree, prefix, ids) -> pa.RecordBatch:
    n = len(ids)
    return pa.RecordBatch.from_arrays(
        [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.float64()), pa.array(tree.astype(np.int32)), common.binary_array(prefix.astype(">u4").ravel(), np.arange(n + 1) * LEAST_DEPTH), pa.array(ids), pa.nulls(n, pa.binary())],
        names=["a", "b", "alike", "tree", "prefix", "id", "sketch"],
    )


def _intersections(x: np.ndarray, x_row: np.ndarray, n: int, y: np.ndarray, y_row: np.ndarray, m: int) -> np.ndarray:
    """How many values each of ``n`` sets shares with each of ``m``; sets are (value, row) entries."""
    shared = np.zeros((n, m), np.float32)  # exact up to 2**24
    both = np.intersect1d(x, y)
    if not len(both):
        return shared

    def entries(values, row):
        at = np.minimum(np.searchsorted(both, values), len(both) - 1)
        mine = both[at] == values
        order = np.argsort(at[mine], kind="stable")
        return at[mine][order], row[mine][order]

    (x_at, x_row), (y_at, y_row) = entries(x, x_row), entries(y, y_row)
    x_low, y_low = np.searchsorted(x_at, np.arange(len(both) + 1)), np.searchsorted(y_at, np.arange(len(both) + 1))
    x_times, y_times = np.diff(x_low), np.diff(y_low)
    times = x_times * y_times
    common_ones = times * 100 > n * m
    place = np.cumsum(common_ones) - 1
    for low in range(0, int(common_ones.sum()), 2048):  # frequent values as products of 0/1 matrices
        sides = []
        for at, row, k in ((x_at, x_row, n), (y_at, y_row, m)):
            mine = common_ones[at] & (place[at] >= low) & (place[at] < low + 2048)
            side = np.zeros((k, 2048), np.float32)
            side[row[mine], place[at[mine]] - low] = 1
            sides.append(side)
        shared += sides[0] @ sides[1].T
    rare = np.flatnonzero(~common_ones)  # the others pair by pair
    block = np.cumsum(times[rare]) >> 22
    for part in np.split(rare, np.flatnonzero(np.diff(block)) + 1):
        each = times[part]
        which = np.repeat(np.arange(len(part)), each)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(each) - each, each)
        across = y_times[part][which]
        pairs = x_row[x_low[part][which] + nth // across] * m + y_row[y_low[part][which] + nth % across]
        shared += np.bincount(pairs, minlength=n * m).reshape(n, m)
    return shared


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As few links as join what the links (a, b) join."""
    names, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b, of = ends[: len(a)], ends[len(a) :], np.arange(len(names))
    while True:
        now = of.copy()
        least = np.minimum(of[a], of[b])
        for side in (a, b):
            np.minimum.at(now, side, least)
            np.minimum.at(now, of[side], least)
        now = now[now]
        if (now == of).all():
            apart = np.flatnonzero(of != np.arange(len(names)))
            return names[of[apart]], names[apart]
        of = now


def _compare(percent: int):
    """Two blocks, or one with itself, of rows with their group and set: links between groups, as few as join them."""

    def table(rows: pa.Table) -> pa.Table:
        second, group = rows["second"].to_numpy(), rows["group"].to_numpy()
        sets = rows["shingles"].combine_chunks()
        sides = []
        for k in (False, True):
            mine = np.flatnonzero(second == k)
            if not len(mine):  # a block with itself
                sides.append(sides[0] if sides else None)
                continue
            found = [np.frombuffer(sets[i].as_buffer(), np.uint64) for i in mine.tolist()]
            sizes = np.array([len(v) for v in found])
            sides.append((np.concatenate(found), np.repeat(np.arange(len(mine)), sizes), sizes, group[mine]))
        if sides[0] is None:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        (x, x_row, x_size, x_group), (y, y_row, y_size, y_group) = sides
        shared = _intersections(x, x_row, len(x_size), y, y_row, len(y_size)).astype(np.int64)
        a, b = np.nonzero((100 * shared >= percent * (x_size[:, None] + y_size[None, :] - shared)) & (x_group[:, None] != y_group[None, :]))
        a, b = _forest(x_group[a], y_group[b])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return table


def _crowded(crowd: DataFrame, percent: int, sets) -> DataFrame:
    """Links (a, b) between groups from crowded regions: rows (tree, prefix, id, group, n); ``sets`` gives the sets of ids.

    Pairs of one group need no comparison.  A group too large for a block has blocks of its own, which do not
    meet each other; smaller groups are dealt whole.
    """
    region = ["tree", "prefix"]
    weight = F.col("n") + ROW
    groups = crowd.groupBy(*region, "group").agg(F.sum(weight).alias("w"), F.count("*").alias("n"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("mark"))
    large = F.col("w") > BLOCK
    regions = groups.groupBy(*region).agg(F.count("*").alias("groups"), F.sum("n").alias("n"), F.sum("mark").alias("mark"), F.sum(F.when(~large, F.col("w"))).alias("rest")).where("groups > 1")
    # Trees in which a region holds the same rows need it once.
    regions = regions.groupBy("n", "mark").agg(F.min_by(F.struct(*region, "rest"), F.struct(*region)).alias("r")).select("r.*")
    blocks_of = lambda w: F.greatest(F.ceil(w / BLOCK), F.lit(1)).cast("int")
    groups = groups.join(regions, region).withColumns({"own": F.when(large, F.col("group")), "many": blocks_of(F.when(large, F.col("w")).otherwise(F.coalesce("rest", F.lit(0))))})
    groups = common.materialize(groups.select(*region, "group", "own", "many"), "crowd-groups")
    rows = crowd.hint("merge").join(groups, [*region, "group"])
    salt = F.when(F.col("own").isNull(), F.xxhash64("group")).otherwise(F.xxhash64("id"))
    rows = common.materialize(rows.select(*region, "own", F.pmod(salt, F.col("many")).cast("int").alias("block"), "id", "group"), "crowd-rows")

    blocks = groups.groupBy(*region, "own").agg(F.max("many").alias("many")).select(*region, "own", F.explode(F.sequence(F.lit(0), F.col("many") - 1)).alias("block"))
    place = F.struct(F.coalesce("own", F.lit(-1)).alias("own"), F.col("own").isNotNull().alias("large"), "block")
    blocks = blocks.select(*region, place.alias("at"))
    pairs = blocks.withColumnRenamed("at", "x").join(blocks.withColumnRenamed("at", "y"), region)
    pairs = pairs.where("x <= y and not (x.large and y.large and x.own = y.own)")
    pairs = common.materialize(pairs, "crowd-pairs")
    meets = pairs.select(*region, F.col("x").alias("at"), "x", "y", F.lit(False).alias("second")).unionByName(pairs.where("x <> y").select(*region, F.col("y").alias("at"), "x", "y", F.lit(True).alias("second")))
    full = common.materialize(sets(rows.select(F.col("id").alias("doc_id")).distinct()), "crowd-sets")
    dealt = rows.select(*region, place.alias("at"), "id", "group").hint("merge").join(meets, [*region, "at"]).hint("merge").join(full, "id")
    links = dealt.groupBy(*region, "x", "y").applyInArrow(_compare(percent), "a long, b long")
    return links.distinct()


def _confirm(percent: int):
    """Pairs with both sets: those with 100 * intersection >= percent * union."""

    def tasks(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                shared = 0 if min(len(x), len(y)) * 100 < percent * max(len(x), len(y)) else len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])

    return tasks


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest linked doc_id), kept and text_hash.

    Words are lower-cased in A-Z and parted by space and the characters 9 to 13; a set is the distinct
    runs of ``size`` words, or the whole sequence if there are fewer.  Texts are linked if 100 times the
    size of their sets' intersection is at least ``percent`` times that of the union.  Null and empty
    texts link with nothing, and so do rows with a null doc_id (component_id null, kept).  Rows that
    share a doc_id are judged each by its own text, told apart by ``text_hash``, Spark's xxhash64 of it.  Other
    columns are ignored.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = common.materialize(signatures(source.withColumn("text_hash", F.xxhash64("text")), size), "signatures")
    able = rows.where("n_shingles > 0 and doc_id is not null")
    # The first of equal sets stands for them all; their minima are the same.
    classes = able.groupBy("h1", "h2", "n_shingles").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"), F.first("minima").alias("minima"))
    classes = common.materialize(classes.select("h1", "h2", "n_shingles", F.col("first.doc_id").alias("id"), "first", "minima"), "classes")
    # Where rows with different sets share a doc_id, a set of theirs is named by its hashes instead.
    shared = common.materialize(classes.groupBy("id").count().where("count > 1").select("id", F.lit(True).alias("_shared")), "shared-ids")
    several = not shared.isEmpty()
    if several:
        classes = classes.join(shared, "id", "left").withColumn("id", F.when(F.col("_shared"), F.xxhash64("h1", "h2", "n_shingles")).otherwise(F.col("id"))).drop("_shared")
        classes = common.materialize(classes, "classes")

    trees = classes.select("id", "minima").mapInArrow(_trees, "tree int, prefix binary, id long, sketch binary")
    ordered = trees.repartitionByRange(common.shuffle_width(spark), "tree", "prefix", "id").sortWithinPartitions("tree", "prefix", "id")
    least = percent / 100 - MARGIN
    met = common.materialize(ordered.mapInArrow(_neighbours(least), _NEIGHBOURS), "neighbours")
    # Where a partition ends its order goes on in the next: as many rows as there are partitions, times the reach.
    seams = met.where("a is null and sketch is not null").select("tree", "prefix", "id", "sketch").repartition(1).sortWithinPartitions("tree", "prefix", "id")
    across = common.materialize(seams.mapInArrow(_neighbours(least), _NEIGHBOURS), "seams")
    pairs = met.where("a is not null").select("a", "b", "alike").unionByName(across.where("a is not null").select("a", "b", "alike"))
    pairs = common.materialize(pairs.distinct(), "pairs")

    nodes = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()

    def sets(batches):
        common.begin("minhash")
        for batch in batches:
            for part in common.slices(batch, 1):
                values, bounds = _sets(part.column(1), size)
                yield pa.RecordBatch.from_arrays([part.column(0), common.binary_array(values, bounds)], names=["id", "shingles"])

    def sets_of(ids: DataFrame) -> DataFrame:
        # A set is made from the text that stands for it, which doc_id alone does not tell.
        wanted = ids.select(F.col("doc_id").alias("id")).hint("merge").join(classes.select("id", "first"), "id").select("id", F.col("first.doc_id").alias("doc_id"), F.col("first.text_hash").alias("text_hash"))
        found = source.withColumn("text_hash", F.xxhash64("text")).join(wanted.hint("merge"), ["doc_id", "text_hash"])
        return found.select("id", "text").mapInArrow(sets, "id long, shingles binary")

    full = common.materialize(sets_of(nodes), "sets")

    def confirm(chosen: DataFrame) -> DataFrame:
        # Merge joins at every size: what is small now is not at scale, and a hot side can be split.
        both = chosen.hint("merge").join(full.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a").hint("merge").join(full.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
        return both.select("a", "b", "x", "y").mapInArrow(_confirm(percent), "a long, b long")

    either = pairs.select("a", "b", "alike").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "alike"))
    best = either.groupBy("a").agg(F.max_by("b", F.struct("alike", -F.col("b"))).alias("b"))
    best = best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    group = components(confirm(best))
    named = lambda side: group.select(F.col("id").alias(side), F.col("component").alias(f"of_{side}"))
    apart = pairs.select("a", "b").join(named("a"), "a", "left").join(named("b"), "b", "left")
    apart = apart.withColumns({"of_a": F.coalesce("of_a", "a"), "of_b": F.coalesce("of_b", "b")}).where("of_a <> of_b")
    late = confirm(common.materialize(apart.join(best, ["a", "b"], "left_anti").select("a", "b"), "apart"))
    late = late.join(named("a"), "a", "left").join(named("b"), "b", "left").select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))

    def renamed(group: DataFrame, links: DataFrame) -> DataFrame:
        # Groups that merged later pass the name on to all their members, and to a group's first itself.
        merged = components(links).select(F.col("id").alias("component"), F.col("component").alias("merged"))
        names = group.join(merged, "component", "left").select("id", F.coalesce("merged", "component").alias("component"))
        names = names.unionByName(merged.select(F.col("component").alias("id"), F.col("merged").alias("component")))
        return common.materialize(names.groupBy("id").agg(F.min("component").alias("component")), "groups")

    group = renamed(group, late)
    beyond = lambda df: df.where("a is null and sketch is null").select("tree", "prefix", "id")
    crowd = beyond(met).unionByName(beyond(across)).distinct()
    sizes = classes.groupBy("id").agg(F.max("n_shingles").alias("n"))
    crowd = crowd.hint("merge").join(group, "id", "left").hint("merge").join(sizes, "id").select("tree", "prefix", "id", F.coalesce("component", "id").alias("group"), "n")
    named = renamed(group, _crowded(common.materialize(crowd, "crowd"), percent, sets_of))

    held = classes.join(named, "id", "left").select("h1", "h2", "n_shingles", F.coalesce("component", "id").alias("_component"), F.col("first.doc_id").alias("_first"))
    if several:
        held = common.materialize(held, "held")
        names = held.groupBy("_component").agg(F.min("_first").alias("_least"))
        held = held.join(names, "_component").select("h1", "h2", "n_shingles", F.col("_least").alias("_component"))
    out = rows.select("doc_id", "n_shingles", "h1", "h2", "text_hash").join(held, ["h1", "h2", "n_shingles"], "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("_component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"), "text_hash")
