"""Removing bytes of long repeated strings, by a distributed merge sort of suffixes that knows common prefixes.

A string of ``window`` bytes that occurs twice holds, in both places, the same anchor: the smallest of the
hashed short strings that begin in its first ``span`` bytes.  So only suffixes at anchors are sorted, one in
about span / 2 bytes, with the bytes before an anchor beside them.  An anchor stands for the windows that
chose it, by their distance d to it: W(d) begins d bytes ahead.  The steps:

1. tasks send, for each anchor, a hash of the core that all its windows share and one of all bytes that they
   cover.  What has a core that occurs once takes no further part, and of equal ones two are sent on.  A core
   with very many different surroundings is dealt anew: its windows in ranges of fewer distances, which share
   longer cores, down to single windows;
2. each group of documents sorts its suffixes, cuts them at the splitters of a sample, and sends each range as
   one front-coded run: the length of the prefix shared with the suffix before, then the rest;
3. a range merges its runs with a loser tree that carries common prefixes and compares only what lies behind
   them.  Window W(d) of two suffixes is equal if they share ``window`` - d bytes, which the merged order tells by
   its common prefixes, and the d bytes before them, which an order of those tells likewise;
4. the windows that occur again go back to the groups that hold them, which remove the bytes they cover.

Hashes of 64 bits decide who takes part and where answers belong; that windows are equal is decided on bytes.
"""

from __future__ import annotations

import math
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from sparkledger.llm import common

#: Bytes of an anchor's string at most; bytes whose anchors are worked on at once.
ANCHOR, PIECE = 24, 1 << 19
#: Distances in a range, after all of them: what too common cores are dealt into.
FINER = (16, 1)
#: Different surroundings of a core, in what a task holds at once and in all, from which it is dealt into finer ranges.
LOCAL, CROWD = 64, 20_000
#: Anchors that a task holds at once; anchors in a bucket; text whose suffixes make a range; ranges at most; samples for each.
HELD, BUCKET, RANGE_BYTES, MOST_RANGES, SAMPLES = 1 << 20, 1 << 18, 16 << 20, 50_000, 8
_BASE = 0x9E3779B97F4A7C15
_CODES = common.mix(np.arange(301, 557, dtype=np.uint64) * np.uint64(_BASE))
PAIRS = "bucket int, cores binary, contexts binary, groups binary, flags binary"


def span_of(window: int) -> int:
    return max(1, window * 16 // 25)


def widths_of(window: int) -> list[int]:
    """Distances in a range, level by level."""
    return [span_of(window), *(w for w in FINER if w < span_of(window))]


class Piece:
    """Anchors that lie in ``[start, end)`` of ``data``, each with all windows that chose it, and hashes of its strings.

    An anchor's windows are not parted between pieces, so its hashes are the same wherever a task cuts its bytes.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, start: int, end: int, window: int):
        span = span_of(window)
        low, high = max(0, start - span + 1), min(end, len(data) - window + 1)  # where those windows begin
        self.window, self.low = window, low
        part = data[low : min(high + window, len(data))]
        size = min(ANCHOR, window - span + 1)
        self.sums = np.empty(len(part) + 1, np.uint64)
        self.sums[0] = 0
        np.cumsum(_CODES[part] * common._power(_BASE, len(part)), dtype=np.uint64, out=self.sums[1:])
        self.inverse = common._power(pow(_BASE, -1, 2**64), len(part) + 1)
        n = high - low
        values = np.full(-(-(n + span) // span) * span, ~np.uint64(0))
        m = min(len(part) - size + 1, len(values))
        if m > 0:
            prints = common.mix((self.sums[size : size + m] - self.sums[:m]) * self.inverse[:m])
            values[:m] = (prints >> np.uint64(24) << np.uint64(24)) | np.arange(m, dtype=np.uint64)
        # The smallest of ``span`` values from each start on: of a block's end and the next one's beginning.
        blocks = values.reshape(-1, span)
        ahead = np.minimum.accumulate(blocks, 1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
        nearest = (np.minimum(behind[:n], ahead[span - 1 : span - 1 + n]) & np.uint64(0xFFFFFF)).astype(np.int64)
        edges = np.zeros(n + 1, np.int32)
        first, last = offsets[:-1], offsets[1:] - window + 1
        fits = (last > first) & (last > low) & (first < high)
        np.add.at(edges, np.maximum(first[fits], low) - low, 1)
        np.add.at(edges, np.minimum(last[fits], high) - low, -1)
        whole = np.flatnonzero(np.cumsum(edges[:-1]) > 0)
        at = nearest[whole]
        new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (whole[1:] != whole[:-1] + 1)))[: len(at)])
        tail = np.concatenate((new[1:], [len(at)]))[: len(new)] - 1
        mine = (at[new] >= start - low) & (at[new] < end - low)
        new, tail = new[mine], tail[mine]
        self.anchor = at[new]
        self.near, self.far = self.anchor - whole[tail], self.anchor - whole[new]  # smallest and largest distance

    def hashed(self, start: np.ndarray, end: np.ndarray, seed: np.ndarray) -> np.ndarray:
        return common.mix((self.sums[end] - self.sums[start]) * self.inverse[start] + common.mix(seed.astype(np.uint64) * np.uint64(_BASE)))

    def items(self, widths: list[int], heavy: list[np.ndarray]) -> list[dict[str, np.ndarray]]:
        """By level the ranges of distances that are not dealt into finer ones; ``heavy`` has the cores that are, by level.

        An item has an anchor, distances near to far, base (the range's first distance) and hashes of core and context.
        """
        found, anchor, near, far = [], self.anchor, self.near, self.far
        for level, width in enumerate(widths):
            base = near // width * width
            core = self.hashed(anchor - base, anchor - base + self.window - width + 1, base + (level << 20))
            crowded = common.member(core, heavy[level]) if level < len(heavy) else np.zeros(len(core), bool)
            mine = ~crowded
            a, d, e, b = anchor[mine], near[mine], far[mine], base[mine]
            context = self.hashed(a - e, a - d + self.window, (((b << 10) + d << 10) + e << 3) + level)
            found.append({"anchor": a, "near": d, "far": e, "base": b, "core": core[mine], "context": context})
            if level + 1 == len(widths) or not crowded.any():
                break
            # The crowded ones in ranges of the next width.
            finer, a, d, e = widths[level + 1], anchor[crowded], near[crowded], far[crowded]
            each = e // finer - d // finer + 1
            anchor, low, high = np.repeat(a, each), np.repeat(d, each), np.repeat(e, each)
            step = (low // finer + np.arange(len(low)) - np.repeat(np.cumsum(each) - each, each)) * finer
            near, far = np.maximum(low, step), np.minimum(high, step + finer - 1)
        return found


def pieces(data: np.ndarray, offsets: np.ndarray, window: int):
    size = len(data) - window + span_of(window) if len(data) >= window else 0
    for start in range(0, size, PIECE):
        yield Piece(data, offsets, start, min(start + PIECE, size), window)


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """How many first bytes two strings share, of which ``known`` are known to be."""
    n = min(len(a), len(b))
    while known < n:
        end = min(known + 48, n)
        x, y = a[known:end], b[known:end]
        if x != y:
            return end - ((int.from_bytes(x) ^ int.from_bytes(y)).bit_length() + 7) // 8
        known = end
    return n


class Run:
    """A sorted run of strings, front-coded, with each one's context: distances, the bytes before it and its hashes."""

    @staticmethod
    def coded(strings: list[bytes], befores: list[bytes], near: list[int], contexts: list[int], buckets: list[int]) -> bytes:
        shared = [0, *(common_prefix(a, b) for a, b in zip(strings, strings[1:]))]
        rests = [s[k:] for s, k in zip(strings, shared)]
        numbers = np.array([shared, [len(r) for r in rests], [len(b) for b in befores], near], np.uint16)
        return b"".join((len(strings).to_bytes(4, "little"), numbers.tobytes(), np.array(contexts, np.uint64).tobytes(), np.array(buckets, np.int32).tobytes(), *rests, *befores))

    def __init__(self, blob: bytes):
        n = int.from_bytes(blob[:4], "little")
        self.shared, self.sizes, self.befores, self.near = np.frombuffer(blob, np.uint16, 4 * n, 4).reshape(4, n).tolist()
        self.contexts = np.frombuffer(blob, np.uint64, n, 4 + 8 * n).tolist()
        self.buckets = np.frombuffer(blob, np.int32, n, 4 + 16 * n).tolist()
        self.blob, self.at, self.k = blob, 4 + 20 * n, -1
        self.before_at = self.at + sum(self.sizes)
        self.text = b""

    def step(self) -> int | None:
        """Goes to the next string: how much of it is as in the one before, or None at the end."""
        self.k += 1
        if self.k == len(self.shared):
            return None
        same, end = self.shared[self.k], self.at + self.sizes[self.k]
        self.text = self.text[:same] + self.blob[self.at : end]
        self.at = end
        return same

    def entry(self) -> tuple[bytes, int, int, int]:
        """Bytes before, smallest distance, context and bucket of the present string."""
        before = self.blob[self.before_at : self.before_at + self.befores[self.k]]
        self.before_at += self.befores[self.k]
        return before, self.near[self.k], self.contexts[self.k], self.buckets[self.k]


def merged(runs: list[Run]):
    """All strings of the runs in order: each with how long a prefix it shares with the one before it, and its entry.

    A tree of losers: each inner node keeps the run that lost there and the prefix which that run's string shares with
    the winner.  Of two strings the one that shares more with the last string put out is smaller; only if both share
    equally much are bytes compared, from there on.
    """
    leaves = 1 << max(0, (len(runs) - 1).bit_length())
    shares: list[int | None] = [runs[k].step() if k < len(runs) else None for k in range(leaves)]
    losers = [0] * leaves

    def play(a: int, b: int) -> tuple[int, int]:
        x, y = shares[a], shares[b]
        if y is None or x is not None and x > y:
            return a, b
        if x is None or y > x:
            return b, a
        s, t = runs[a].text, runs[b].text
        k = common_prefix(s, t, x)
        if k == len(s) or k < len(t) and s[k] < t[k]:
            shares[b] = k
            return a, b
        shares[a] = k
        return b, a

    winners = [*[0] * leaves, *range(leaves)]
    for node in range(leaves - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    winner = winners[1]
    while shares[winner] is not None:
        run = runs[winner]
        yield shares[winner], run.text, run.entry()
        shares[winner] = run.step()
        node = (winner + leaves) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2


def repeated(shared: np.ndarray, befores: list[bytes], near: np.ndarray, window: int, width: int) -> np.ndarray:
    """For sorted suffixes, with the prefixes neighbours share and the bytes before each: by suffix and distance, whether that window is there twice."""
    n = len(shared)
    far = np.array([len(b) for b in befores], np.int64)
    kind = np.cumsum(shared < window - width + 1)
    turned = [b[::-1] for b in befores]
    order = np.array(sorted(range(n), key=lambda k: (kind[k], turned[k])), np.int64)
    alike = np.array([0, *(common_prefix(turned[a], turned[b]) if kind[a] == kind[b] else -1 for a, b in zip(order.tolist(), order[1:].tolist()))], np.int64)
    apart = np.concatenate(([True], kind[order][1:] != kind[order][:-1]))[:n]
    out = np.zeros((n, width), bool)
    behind = np.empty(n, np.int64)
    for d in range(width):
        mine = np.flatnonzero((near <= d) & (d <= far))
        if len(mine) < 2:
            continue
        behind[order] = np.cumsum(apart | (alike < d))
        key = np.cumsum(shared < window - d)[mine] * (n + 1) + behind[mine]
        sort = np.argsort(key, kind="stable")
        same = key[sort][1:] == key[sort][:-1]
        twice = np.zeros(len(mine), bool)
        twice[sort[1:]] |= same
        twice[sort[:-1]] |= same
        out[mine[twice], d] = True
    return out


def _grouped(key: np.ndarray, **values: np.ndarray):
    """Each key with its part of the arrays, as bytes."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    cuts = [*np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))[: len(key)]).tolist(), len(key)]
    values = {k: v[order] for k, v in values.items()}
    return [(int(key[a]), {k: v[a:b].tobytes() for k, v in values.items()}) for a, b in zip(cuts, cuts[1:])]


def _joined(column, kind) -> np.ndarray:
    return np.concatenate([np.empty(0, kind), *(np.frombuffer(x.as_buffer(), kind) for x in column if x.is_valid)])


def _pairs(found: list[dict[str, np.ndarray]], groups: list[np.ndarray], buckets: int, finest: bool) -> list[tuple]:
    """Rows for buckets: each different pair of core and context of a group, flag 1 if it is there again, 2 if the core has too many contexts."""
    core, context, group = np.concatenate([x["core"] for x in found]), np.concatenate([x["context"] for x in found]), np.concatenate(groups)
    order = np.lexsort((group, context, core))
    core, context, group = core[order], context[order], group[order]
    new = np.concatenate(([True], (core[1:] != core[:-1]) | (context[1:] != context[:-1]) | (group[1:] != group[:-1])))[: len(core)]
    flags = np.diff(np.flatnonzero(new), append=len(core)) > 1
    core, context, group, flags = core[new], context[new], group[new], flags.astype(np.uint8)
    if not finest and len(core):
        head = np.concatenate(([True], core[1:] != core[:-1]))
        different = head | np.concatenate(([True], context[1:] != context[:-1]))
        which = np.cumsum(head) - 1
        crowded = (np.bincount(which, different) > LOCAL)[which]
        again = crowded & ~(head | np.concatenate(([True], group[1:] != group[:-1])))
        context[crowded], flags[crowded] = 0, 2
        core, context, group, flags = core[~again], context[~again], group[~again], flags[~again]
    return _grouped(((core >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64), cores=core, contexts=context, groups=group.astype(np.int32), flags=flags)


def mark_repeats(docs: DataFrame, window: int = 400, id_col: str = "doc_id", text_col: str = "text", keep_cols: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: its id, the columns in ``keep_cols``, n_bytes, n_removed, n_spans and kept, the bytes that stay.

    A byte of a text's UTF-8 goes if it lies in a string of ``window`` bytes that also begins anywhere else, in this text or
    another; n_spans counts the maximal runs that go.  Null texts are empty, texts of fewer bytes stay whole, rows that repeat
    each other lose all such strings, and an empty table gives none.  A cut may part a character, so kept is binary.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0
    widths, span = widths_of(window), span_of(window)
    groups = max(1, math.ceil(total / common.group_bytes(total)))
    anchors = max(1, 2 * total // (span + 1))
    buckets, ranges = max(1, math.ceil(anchors / BUCKET)), max(1, min(MOST_RANGES, math.ceil(total / RANGE_BYTES)))
    width, bucket_width = common.width_of(spark, groups), common.width_of(spark, buckets)
    sampled = np.uint64(min(2**64 - 1, int(2**64 * SAMPLES * ranges / anchors)))
    core_size = window - span + 1
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *[F.col(c) for c in keep_cols])
    source = source.withColumn("_group", F.pmod(F.xxhash64("_id", "_text"), F.lit(groups)).cast("int"))
    dealt = source.repartition(width, "_group")

    def pair_batch(rows) -> pa.RecordBatch:
        names = ("cores", "contexts", "groups", "flags")
        return pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()), *(pa.array([v[c] for _, v in rows], pa.binary()) for c in names)], names=["bucket", *names])

    def first_pairs(batches):
        """Pairs of all anchors, and in bucket -1 a sample of their suffixes' first bytes."""
        common.begin("suffixes")
        found, owner, held, sample = [], [], 0, set()

        def flush():
            return pair_batch(_pairs(found, owner, buckets, len(widths) == 1))

        for batch in batches:
            for part in common.slices(batch, 1):
                data, offsets = common.text_bytes(part.column(1))
                group = part.column(0).to_numpy()
                for piece in pieces(data, offsets, window):
                    mine = piece.items(widths[:1], [])[0]
                    found.append(mine)
                    owner.append(group[np.searchsorted(offsets, mine["anchor"] + piece.low, side="right") - 1])
                    held += len(mine["anchor"])
                    for at in (mine["anchor"][mine["core"] <= sampled] + piece.low).tolist():
                        sample.add(data[at : at + core_size].tobytes())
                    if held > HELD:
                        yield flush()
                        found, owner, held = [], [], 0
        if held:
            yield flush()
        if sample:
            yield pair_batch([(-1, {"cores": s, "contexts": b"", "groups": b"", "flags": b""}) for s in sample])

    def text_of(left: pa.Table):
        data, offsets = common.text_bytes(left["_text"].combine_chunks())
        return data, offsets, left["_group"][0].as_py()

    def heavy_of(right: pa.Table, levels: int) -> list[np.ndarray]:
        rows = right.filter(pc.equal(right["kind"], 1))
        return [np.sort(_joined(rows.filter(pc.equal(rows["level"], k))["hashes"], np.uint64)) for k in range(levels)]

    def finer_pairs(level: int):
        def work(left: pa.Table, right: pa.Table) -> pa.Table:
            rows, found = [], []
            if left.num_rows and right.num_rows:
                data, offsets, group = text_of(left)
                heavy = heavy_of(right, level)
                for piece in pieces(data, offsets, window):
                    found += piece.items(widths[: level + 1], heavy)[level : level + 1]
                if found:
                    rows = _pairs(found, [np.full(len(x["core"]), group) for x in found], buckets, level + 1 == len(widths))
            return pa.Table.from_batches([pair_batch(rows)])

        return work

    def judge(level: int):
        def work(table: pa.Table) -> pa.Table:
            """Of a bucket: to each group which contexts it sends (kind 0) and which of its cores are dealt finer (kind 1)."""
            core, context, group, flags = _joined(table["cores"], np.uint64), _joined(table["contexts"], np.uint64), _joined(table["groups"], np.int32), _joined(table["flags"], np.uint8)
            order = np.lexsort((group, context, core))
            core, context, group, flags = core[order], context[order], group[order], flags[order]
            head = np.concatenate(([True], core[1:] != core[:-1]))[: len(core)]
            other = head | np.concatenate(([True], context[1:] != context[:-1]))[: len(core)]
            which = np.cumsum(head) - 1
            crowd = (np.bincount(which, other) > (CROWD if level + 1 < len(widths) else len(core))) | (np.bincount(which, flags == 2) > 0)
            again = np.bincount(which, 1 + (flags == 1)) > 1
            place = np.arange(len(core))
            nth = place - np.maximum.accumulate(np.where(other, place, 0))  # of equal contexts the first two do
            sent, dealt_finer = (again & ~crowd)[which] & (nth < 2), crowd[which]
            rows = [(g, 0, v["x"]) for g, v in _grouped(group[sent], x=context[sent])] + [(g, 1, v["x"]) for g, v in _grouped(group[dealt_finer], x=core[dealt_finer])]
            return pa.table({"group": pa.array([g for g, _, _ in rows], pa.int32()), "kind": pa.array([k for _, k, _ in rows], pa.int32()), "level": pa.array([level] * len(rows), pa.int32()), "hashes": pa.array([h for _, _, h in rows], pa.binary())})

        return work

    # Step 1, level by level while some cores are crowded.
    pairs, verdicts, cuts = [], [], []
    for level in range(len(widths)):
        if level == 0:
            made = source.select("_group", "_text").mapInArrow(first_pairs, PAIRS)
        else:
            crowded = verdicts[0].where("kind = 1")
            for v in verdicts[1:]:
                crowded = crowded.unionByName(v.where("kind = 1"))
            if verdicts[-1].where("kind = 1").isEmpty():
                break
            made = dealt.groupBy("_group").cogroup(crowded.repartition(width, "group").groupBy("group")).applyInArrow(finer_pairs(level), PAIRS)
        table = common.materialize(made, "suffix-pairs")
        pairs.append(table.where("bucket >= 0"))
        if level == 0:
            cuts = _splitters([bytes(r["cores"]) for r in table.where("bucket < 0").select("cores").collect()], ranges)
        told = pairs[-1].repartition(bucket_width, "bucket").groupBy("bucket").applyInArrow(judge(level), "group int, kind int, level int, hashes binary")
        verdicts.append(common.materialize(told, "suffix-verdicts"))
    verdict, pair = verdicts[0], pairs[0]
    for v, p in zip(verdicts[1:], pairs[1:]):
        verdict, pair = verdict.unionByName(v), pair.unionByName(p)
    levels = len(verdicts)
    verdict = verdict.repartition(width, "group")

    def runs(left: pa.Table, right: pa.Table) -> pa.Table:
        """Of a group: its suffixes that take part, for each level, base and range one front-coded run."""
        common.begin("suffixes")
        rows = []
        if left.num_rows and right.num_rows:
            data, offsets, _ = text_of(left)
            raw, heavy = data.tobytes(), heavy_of(right, levels)
            sends = right.filter(pc.equal(right["kind"], 0))
            wanted = np.unique(_joined(sends["hashes"], np.uint64))
            chosen: dict[tuple[int, int, int], list] = {}
            seen: dict[int, int] = {}
            for piece in pieces(data, offsets, window) if len(wanted) else ():
                for level, x in enumerate(piece.items(widths[:levels], heavy)):
                    mine = np.flatnonzero(common.member(x["context"], wanted))
                    where = ((x["core"][mine] >> np.uint64(33)) % np.uint64(buckets)).tolist()
                    for a, d, e, base, context, bucket in zip(*(x[c][mine].tolist() for c in ("anchor", "near", "far", "base", "context")), where):
                        seen[context] = seen.get(context, 0) + 1
                        if seen[context] > 2:
                            continue
                        start = a + piece.low - base
                        text = raw[start : start + window - (d - base)]
                        part = bisect_right(cuts, text[:core_size])
                        chosen.setdefault((level, base, part), []).append((text, raw[start - (e - base) : start], d - base, context, bucket))
            for (level, base, part), mine in chosen.items():
                mine.sort(key=lambda x: x[0])
                rows.append((level, base, part, Run.coded(*map(list, zip(*mine)))))
        return pa.table({**{c: pa.array([r[k] for r in rows], pa.int32()) for k, c in enumerate(("level", "base", "part"))}, "run": pa.array([r[3] for r in rows], pa.binary())})

    def merge(table: pa.Table) -> pa.Table:
        """Of a range: the contexts that hold windows which occur again, with a bit for each distance."""
        common.begin("suffixes")
        size = widths[table["level"][0].as_py()]
        shared, befores, near, contexts, where = [], [], [], [], []
        for same, _, (before, low, context, bucket) in merged([Run(x.as_py()) for x in table["run"]]):
            shared.append(same)
            befores.append(before)
            near.append(low)
            contexts.append(context)
            where.append(bucket)
        found = repeated(np.array(shared, np.int64), befores, np.array(near, np.int64), window, size)
        context, bucket = np.array(contexts, np.uint64), np.array(where, np.int64)
        _, first = np.unique(context, return_index=True)
        hit = first[found[first].any(1)]
        bits = np.zeros((len(hit), -(-span // 8)), np.uint8)
        few = np.packbits(found[hit], axis=1)
        bits[:, : few.shape[1]] = few
        rows = _grouped(bucket[hit], contexts=context[hit], bits=bits)
        return pa.table({"bucket": pa.array([b for b, _ in rows], pa.int32()), **{c: pa.array([v[c] for _, v in rows], pa.binary()) for c in ("contexts", "bits")}})

    bytes_each = -(-span // 8)

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        """Of a bucket: to each group the repeated windows of its contexts."""
        rows = []
        if left.num_rows and right.num_rows:
            context, bits = _joined(left["contexts"], np.uint64), _joined(left["bits"], np.uint8).reshape(-1, bytes_each)
            order = np.argsort(context)
            context, bits = context[order], bits[order]
            mine, group = _joined(right["contexts"], np.uint64), _joined(right["groups"], np.int32)
            held = common.member(mine, context)
            both = np.unique(np.stack((group[held].astype(np.int64), mine[held].view(np.int64)), 1), axis=0)
            own = both[:, 1].astype(np.int64).view(np.uint64) if len(both) else np.empty(0, np.uint64)
            rows = _grouped(both[:, 0], contexts=own, bits=bits[np.searchsorted(context, own)])
        return pa.table({"group": pa.array([g for g, _ in rows], pa.int32()), "kind": pa.array([2] * len(rows), pa.int32()), "level": pa.array([0] * len(rows), pa.int32()), "hashes": pa.array([v["contexts"] for _, v in rows], pa.binary()), "bits": pa.array([v["bits"] for _, v in rows], pa.binary())})

    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        """The group's texts without the bytes of repeated windows."""
        common.begin("suffixes")
        data, offsets = common.text_bytes(left["_text"].combine_chunks()) if left.num_rows else (np.empty(0, np.uint8), np.zeros(1, np.int64))
        hit = np.zeros(len(data), bool)
        told = right.filter(pc.equal(right["kind"], 2))
        if told.num_rows:
            context, bits = _joined(told["hashes"], np.uint64), _joined(told["bits"], np.uint8).reshape(-1, bytes_each)
            order = np.argsort(context)
            context, bits, heavy = context[order], bits[order], heavy_of(right, levels)
            for piece in pieces(data, offsets, window):
                for x in piece.items(widths[:levels], heavy):
                    mine = np.flatnonzero(common.member(x["context"], context))
                    for low in range(0, len(mine), 8192):
                        some = mine[low : low + 8192]
                        item, d = np.nonzero(np.unpackbits(bits[np.searchsorted(context, x["context"][some])], axis=1))
                        hit[(x["anchor"][some] - x["base"][some])[item] + piece.low - d] = True
        gone = np.zeros(len(data), bool)
        for low in range(0, len(data), PIECE):  # a byte goes if a repeated window begins at most window - 1 bytes ahead of it
            first = max(0, low - window + 1)
            upto = np.concatenate((np.zeros(window, np.int32), np.cumsum(hit[first : low + PIECE], dtype=np.int32)))
            size = min(PIECE, len(data) - low)
            at = np.arange(low - first, low - first + size)
            gone[low : low + size] = upto[at + window] > upto[at]
        head = gone.copy()
        head[1:] &= ~gone[:-1]
        starts = offsets[:-1][offsets[:-1] < offsets[1:]]
        head[starts] = gone[starts]
        ahead = np.searchsorted(np.flatnonzero(gone), offsets)  # how many go before each text
        spans = np.diff(np.searchsorted(np.flatnonzero(head), offsets))
        return pa.table({
            "_id": left["_id"], **{c: left[c] for c in keep_cols}, "n_bytes": pa.array(np.diff(offsets)), "n_removed": pa.array(np.diff(ahead)), "n_spans": pa.array(spans),
            "kept": common.binary_array(data[~gone], offsets - ahead),
        })

    cut = dealt.groupBy("_group").cogroup(verdict.groupBy("group")).applyInArrow(runs, "level int, base int, part int, run binary")
    bits = cut.repartition(common.width_of(spark, ranges), "level", "base", "part").groupBy("level", "base", "part").applyInArrow(merge, "bucket int, contexts binary, bits binary")
    told = bits.repartition(bucket_width, "bucket").groupBy("bucket").cogroup(pair.repartition(bucket_width, "bucket").groupBy("bucket")).applyInArrow(answer, "group int, kind int, level int, hashes binary, bits binary")
    known = told.unionByName(verdict.where("kind = 1").withColumn("bits", F.lit(None).cast("binary"))).repartition(width, "group")
    kinds = dict(source.dtypes)
    schema = ", ".join([f"_id {kinds['_id']}", *[f"`{c}` {kinds[c]}" for c in keep_cols], "n_bytes long, n_removed long, n_spans long, kept binary"])
    return dealt.groupBy("_group").cogroup(known.groupBy("group")).applyInArrow(remove, schema).withColumnRenamed("_id", id_col)


def _splitters(sample: list[bytes], ranges: int) -> list[bytes]:
    """Strings that part the sample into about equal ranges, each cut behind the byte that tells it from the sample before."""
    sample = sorted(set(sample))
    places = sorted({k * len(sample) // ranges for k in range(1, ranges)} - {0})
    return [sample[k][: common_prefix(sample[k - 1], sample[k]) + 1] for k in places]


def digest(marked: DataFrame) -> DataFrame:
    return marked.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
