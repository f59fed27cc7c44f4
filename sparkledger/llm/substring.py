"""Removing passages that repeat, found through difference-cover anchors.

A window is ``window`` consecutive words.  A residue set D modulo p is a difference cover: for any two
positions some shift k < p brings both onto residues in D.  So two equal windows share an anchor, a
shorter run of ``window - p + 1`` words, that starts at a covered position in both documents.  The steps:

1. each task hashes the anchors at covered positions of its documents and sends each distinct hash once
   to a bucket of hash values, so a hash that a third of all documents share weighs one entry a task;
2. each bucket tells the groups of documents which of their anchors occur again;
3. a group extends those anchors to the windows around them, keeps its own first of equal ones, and
   sends these windows' hashes with their places to buckets, where the first of all is found;
4. each group removes the words that later windows cover.

A group is a hash-chosen set of documents.  The numbers of groups and buckets follow the bytes of all texts, so
a task's share has the same size however large the corpus is, and rows between the steps are packed arrays.
Hashes have 64 bits.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from sparkledger.llm import common

#: Difference covers by modulus.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 6, 8, 18), 31: (0, 1, 3, 8, 12, 18)}
#: Bytes of text that a task works on, about; groups and buckets for each task.
TASK_BYTES, EACH = 3 << 20, 2
#: Anchors that a task gathers before it sends them on.
HELD = 2_000_000


def cover_for(window: int) -> tuple[int, tuple[int, ...]]:
    """The largest modulus that leaves anchors more than a third of the window's words, with its residues."""
    modulus = max(p for p in COVERS if p == 1 or 3 * (window - p + 1) > window)
    return modulus, COVERS[modulus]


class _Words:
    """Words of a batch of texts: bounds by text, hashes, and hashes of all runs of ``window`` words with a mask."""

    def __init__(self, text: pa.Array):
        data, offsets = common.text_bytes(text)
        starts, ends, self.bounds = common.word_spans(data, offsets, common.BLANK_SEPARATED)
        self.hashes = common.word_hashes(data, starts, ends)
        self.counts = np.diff(self.bounds)
        self.row = common.row_of(self.bounds)
        self.place = np.arange(len(self.hashes)) - self.bounds[self.row]

    def runs(self, size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the runs that begin at each word (as far as there are enough), and whether they stay in one text."""
        found = common.window_hashes(self.hashes, size, seed)
        return found, (self.place + size <= self.counts[self.row])[: len(found)]


def _blobs(names: dict[str, np.ndarray], key: np.ndarray):
    """Rows sorted by key, as one binary per key for each array: keys, and the binaries by name."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    cuts = np.concatenate((np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))), [len(key)])) if len(key) else np.zeros(1, np.int64)
    return key[cuts[:-1]], {name: common.binary_array(values[order], cuts) for name, values in names.items()}


def _joined(column, kind) -> np.ndarray:
    parts = [np.frombuffer(x.as_buffer(), kind) for x in column if x.is_valid]
    return np.concatenate(parts) if parts else np.empty(0, kind)


def _sizes(column, width: int) -> np.ndarray:
    return (pc.fill_null(pc.binary_length(column), 0).to_numpy() // width).astype(np.int64)


def mark_repeats(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text", keep_cols: tuple[str, ...] = (), as_text: str = "words") -> DataFrame:
    """One row per row of ``docs``: its id, the columns in ``keep_cols``, n_words, n_removed and kept_text.

    A word goes if a window of ``window`` words covers it whose words, as they are, also start earlier:
    in a smaller doc_id, or in the same document further ahead.  Null texts have no words and a null
    doc_id comes before all others.  Rows with the same doc_id and place are not earlier than each other,
    so repeated rows fare alike.  ``as_text`` "words" joins kept words by one space; "spans" leaves texts
    without removals as they are and otherwise cuts each removed run with the blanks behind it.
    """
    size = docs.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0
    width = max(1, -(-size // TASK_BYTES))
    groups = buckets = EACH * width
    modulus, cover = cover_for(window)
    anchor = window - modulus + 1
    covered = np.isin(np.arange(modulus), cover)
    lowest = -(2**63)

    source = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"), *[F.col(c) for c in keep_cols])
    source = source.withColumn("_group", F.pmod(F.xxhash64("_id", "_text"), F.lit(groups)).cast("int"))
    dealt = source.repartition(width, "_group")

    sent_columns = ["kind", "bucket", "group", "hashes", "groups"]

    def anchors(batches):
        """Entries for buckets (kind 0: hashes and the group of each, or -1) and, for hashes that the task itself met again, for groups (kind 1)."""
        common.begin("substring")
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush():
            hashes, groups_of = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order = np.argsort(hashes, kind="stable")
            hashes, groups_of = hashes[order], groups_of[order]
            new = np.concatenate(([True], hashes[1:] != hashes[:-1]))
            again = np.zeros(len(hashes), bool)
            again[1:] |= ~new[1:]
            again[:-1] |= ~new[1:]
            # What occurs once here goes to its bucket with its group; what occurs again goes once, without one.
            group, sent = np.where(again, -1, groups_of)[new].astype(np.int32), hashes[new]
            bucket = ((sent >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(group, kind="stable")  # equal groups lie together and compress well
            keys, packed = _blobs({"hashes": sent[order], "groups": group[order]}, bucket[order])
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(keys), np.int32)), pa.array(keys.astype(np.int32)), pa.nulls(len(keys), pa.int32()), packed["hashes"], packed["groups"]], names=sent_columns)
            mine, owner = hashes[again], groups_of[again]
            order = np.lexsort((mine, owner))
            mine, owner = mine[order], owner[order]
            once = np.concatenate(([True], (mine[1:] != mine[:-1]) | (owner[1:] != owner[:-1])))[: len(mine)]
            keys, packed = _blobs({"hashes": mine[once]}, owner[once])
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(keys), np.int32)), pa.array((keys % buckets).astype(np.int32)), pa.array(keys.astype(np.int32)), packed["hashes"], pa.nulls(len(keys), pa.binary())], names=sent_columns)

        for batch in batches:
            for part in common.slices(batch, 1):
                words = _Words(part.column(1))
                found, whole = words.runs(anchor, 1)
                at = np.flatnonzero(whole & covered[(words.place % modulus)[: len(found)]])
                held.append((found[at], part.column(0).to_numpy()[words.row[at]]))
            if sum(len(x[0]) for x in held) > HELD:
                yield from flush()
        if any(len(x[0]) for x in held):
            yield from flush()

    def recurring(table: pa.Table) -> pa.Table:
        """Of a bucket: by group, the hashes of its anchors that occur again anywhere. What tasks know already passes through."""
        passed = table.filter(pc.equal(table["kind"], 1)).select(["group", "hashes"])
        table = table.filter(pc.equal(table["kind"], 0))
        hashes, group = _joined(table["hashes"], np.uint64), _joined(table["groups"], np.int32)
        values, counts = np.unique(hashes, return_counts=True)
        many = np.union1d(values[counts > 1], hashes[group < 0])
        mine = (group >= 0) & common.member(hashes, many)
        keys, packed = _blobs({"hashes": hashes[mine]}, group[mine].astype(np.int64))
        return pa.concat_tables([pa.table({"group": pa.array(keys.astype(np.int32)), "hashes": packed["hashes"]}), passed], promote_options="permissive")

    def windows(left: pa.Table, right: pa.Table) -> pa.Table:
        """Of a group of documents: for buckets, the hash and first place of each window that may occur elsewhere."""
        none = pa.table({"bucket": pa.array([], pa.int32()), "group": pa.array([], pa.int32()), "hashes": pa.array([], pa.binary()), "ids": pa.array([], pa.binary()), "starts": pa.array([], pa.binary())})
        if not left.num_rows or not right.num_rows:
            return none
        group = left["_group"][0].as_py()
        again = np.unique(_joined(right["hashes"], np.uint64))
        words = _Words(left["_text"].combine_chunks())
        found, whole = words.runs(anchor, 1)
        hit = np.zeros(len(words.hashes) + modulus + 1, np.int32)
        at = np.flatnonzero(whole & covered[(words.place % modulus)[: len(found)]])
        hit[at] = common.member(found[at], again)
        ahead = np.concatenate(([0], np.cumsum(hit)))
        found, whole = words.runs(window, 2)
        at = np.flatnonzero(whole & (ahead[modulus : modulus + len(found)] > ahead[: len(found)]))
        ids = pc.fill_null(left["_id"].combine_chunks(), lowest).to_numpy()[words.row[at]]
        hashes, starts = found[at], words.place[at]
        order = np.lexsort((starts, ids, hashes))
        hashes, ids, starts = hashes[order], ids[order], starts[order]
        first = np.concatenate(([True], hashes[1:] != hashes[:-1]))[: len(hashes)]
        hashes, ids, starts = hashes[first], ids[first], starts[first]
        order = np.lexsort((starts, ids, (hashes >> np.uint64(40)) % np.uint64(buckets)))  # neighbours in a text lie together and compress well
        hashes, ids, starts = hashes[order], ids[order], starts[order]
        keys, packed = _blobs({"hashes": hashes, "ids": ids, "starts": starts.astype(np.uint32)}, ((hashes >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64))
        return pa.table({"bucket": pa.array(keys.astype(np.int32)), "group": pa.array(np.full(len(keys), group, np.int32)), **packed})

    def later(table: pa.Table) -> pa.Table:
        """Of a bucket: by group, the hashes of its windows that start earlier in another group."""
        hashes, ids, starts = _joined(table["hashes"], np.uint64), _joined(table["ids"], np.int64), _joined(table["starts"], np.uint32)
        group = np.repeat(table["group"].to_numpy(), _sizes(table["hashes"].combine_chunks(), 8))
        order = np.lexsort((starts, ids, hashes))
        hashes, ids, starts, group = hashes[order], ids[order], starts[order], group[order]
        head = np.maximum.accumulate(np.where(np.concatenate(([True], hashes[1:] != hashes[:-1]))[: len(hashes)], np.arange(len(hashes)), 0))
        gone = (ids != ids[head]) | (starts != starts[head])
        keys, packed = _blobs({"hashes": hashes[gone]}, group[gone].astype(np.int64))
        return pa.table({"group": pa.array(keys.astype(np.int32)), "hashes": packed["hashes"]})

    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        """The group's documents without the words that later windows cover."""
        text = left["_text"].combine_chunks()
        words = _Words(text)
        found, whole = words.runs(window, 2)
        at = np.flatnonzero(whole)
        hashes, starts = found[at], words.place[at]
        ids = pc.fill_null(left["_id"].combine_chunks(), lowest).to_numpy()[words.row[at]]
        gone = common.member(hashes, np.unique(_joined(right["hashes"], np.uint64)) if right.num_rows else np.empty(0, np.uint64))
        order = np.argsort(hashes, kind="stable")
        same = np.concatenate(([False], hashes[order][1:] == hashes[order][:-1]))[: len(order)]
        near = same.copy()
        near[:-1] |= same[1:]
        order = order[near]  # only windows that occur twice in the group need an order of places
        order = order[np.lexsort((starts[order], ids[order], hashes[order]))]
        head = np.maximum.accumulate(np.where(np.concatenate(([True], hashes[order][1:] != hashes[order][:-1]))[: len(order)], np.arange(len(order)), 0))
        gone[order[(ids[order] != ids[order][head]) | (starts[order] != starts[order][head])]] = True
        edges = np.zeros(len(words.hashes) + 1, np.int64)
        edges[at[gone]] += 1
        edges[at[gone] + window] -= 1
        removed = np.cumsum(edges)[:-1] > 0
        totals = np.concatenate(([0], np.cumsum(removed)))
        n_removed = totals[words.bounds[1:]] - totals[words.bounds[:-1]]
        kept = []
        for k, raw in enumerate(text):
            raw, mine = (raw.as_py() or "").encode(), removed[words.bounds[k] : words.bounds[k + 1]]
            if as_text == "words":
                kept.append(b" ".join(compress(raw.split(), (~mine).tolist()) if n_removed[k] else raw.split()).decode())
            else:
                kept.append(_without(raw, mine).decode() if n_removed[k] else text[k].as_py())
        return pa.table({"_id": left["_id"], **{c: left[c] for c in keep_cols}, "n_words": pa.array(words.counts), "n_removed": pa.array(n_removed), "kept_text": pa.array(kept, pa.string())})

    sent = source.select("_group", "_text").mapInArrow(anchors, "kind int, bucket int, group int, hashes binary, groups binary")
    candidates = sent.repartition(width, "bucket").groupBy("bucket").applyInArrow(recurring, "group int, hashes binary")
    candidates = candidates.repartition(width, "group")
    places = dealt.groupBy("_group").cogroup(candidates.groupBy("group")).applyInArrow(windows, "bucket int, group int, hashes binary, ids binary, starts binary")
    lost = places.repartition(width, "bucket").groupBy("bucket").applyInArrow(later, "group int, hashes binary").repartition(width, "group")
    kinds = dict(source.dtypes)
    schema = ", ".join(["_id long", *[f"`{c}` {kinds[c]}" for c in keep_cols], "n_words long, n_removed long, kept_text string"])
    return dealt.groupBy("_group").cogroup(lost.groupBy("group")).applyInArrow(remove, schema).withColumnRenamed("_id", id_col)


def _without(raw: bytes, removed: np.ndarray) -> bytes:
    """The text without the removed words and the blanks behind each."""
    data = np.frombuffer(raw, np.uint8)
    starts, _, _ = common.word_spans(data, np.array([0, len(data)]), common.BLANK_SEPARATED)
    after = np.concatenate((starts[1:], [len(data)]))
    edges = np.zeros(len(data) + 1, np.int64)
    edges[starts[removed]] += 1
    edges[after[removed]] -= 1
    return data[np.cumsum(edges)[:-1] == 0].tobytes()


def digest(marked: DataFrame) -> DataFrame:
    return marked.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
