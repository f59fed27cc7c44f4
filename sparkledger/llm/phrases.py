"""Phrases whose words occur together more often than apart, by Rabin-Karp fingerprints.

Texts are dealt into groups of bounded size.  A group hashes each n-gram from prefix polynomials over the
hashes of its words.  The steps:

1. each group sorts shortened fingerprints with their counts, cuts them by ranges and sends each range, as
   differences, to its shard together with the group's number, the pointer back to where they occur;
2. a shard adds up and tells the groups which of theirs are frequent in all; what is rare anywhere ends here;
3. a group takes the n-grams behind those, counts them by two full fingerprints from polynomials at different
   points, verifies every occurrence of one against the text of its first, and sends counts to the shards;
4. a shard adds up exactly, and points to one group that holds each frequent phrase;
5. that group alone writes the phrase out as text.

Two different phrases of one group that agree in both fingerprints end the job with an error; those of different
groups would have to agree in the shortened one and 48 bits of the second one, together 77 bits at 1 GB and more beyond.

Scores are exact decimals over the table of frequent phrases.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from sparkledger.llm import common

#: What ends a piece, and what parts words within one.
BREAKS, BLANKS = (*b".,;:!?", *range(0x0A, 0x0E)), (0x20, 0x09)
_WORDS, _UNBROKEN = common.byte_table([*BREAKS, *BLANKS]), common.byte_table(BREAKS)
#: Most words of a phrase; shortened fingerprints in a shard, about.
LONGEST, SHARD = 3, 4 << 20
#: A table of frequent phrases of so many rows is sent to all tasks; a larger one is joined by shuffles.
BROADCAST_ROWS = 200_000
#: Words whose bytes are compared at once.
COMPARED = 1 << 19
#: Parts of a language whose best phrases are found apart.
PARTS = 64
#: Where the second polynomial is taken.
SECOND = 0xC2B2AE3D27D4EB4F


def packed(values: np.ndarray) -> bytes:
    """Sorted integers as differences of one, two or four bytes, of which the largest adds and goes on."""
    steps = np.diff(values, prepend=np.uint64(0)).astype(np.uint64)
    mean = int(values[-1]) // len(values) if len(values) else 0
    kind = np.uint8 if mean < 350 else np.uint16 if mean < 16384 else np.uint32
    most = np.iinfo(kind).max
    more = (steps // np.uint64(most)).astype(np.int64)
    out = np.full(len(steps) + int(more.sum()), most, kind)
    out[np.cumsum(more + 1) - 1] = (steps % np.uint64(most)).astype(kind)
    return bytes([out.itemsize]) + out.tobytes()


def unpacked(blob) -> np.ndarray:
    data = memoryview(blob)
    kind = {1: np.uint8, 2: np.uint16, 4: np.uint32}[data[0]]
    steps = np.frombuffer(data, kind, offset=1)
    return np.cumsum(steps, dtype=np.uint64)[steps != np.iinfo(kind).max]


def small_counts(counts: np.ndarray) -> bytes:
    """Counts of a byte each, and those of 255 and more behind them."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype(np.int64).tobytes()


def counts_of(blob, n: int) -> np.ndarray:
    out = np.frombuffer(blob, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(blob, np.int64, offset=n)
    return out


def _six_bytes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes()


def _of_six_bytes(blob) -> np.ndarray:
    """Values without their lowest 16 bits."""
    parts = np.frombuffer(blob, np.uint8).reshape(-1, 6)
    return np.concatenate((np.zeros((len(parts), 2), np.uint8), parts), 1).view(np.uint64).ravel()


def _both(codes: np.ndarray, others: np.ndarray) -> np.ndarray:
    """One number for a shortened and a second fingerprint."""
    return common.mix(codes + np.uint64(1)) ^ (others >> np.uint64(16) << np.uint64(16))


class Grams:
    """Words of a group of texts and the n-grams that lie within pieces."""

    def __init__(self, text: pa.Array, lang: pa.Array):
        data, offsets = common.text_bytes(text)
        self.data = common.lower_ascii(data)
        self.starts, self.ends, self.bounds = common.word_spans(self.data, offsets, _WORDS)
        self.row = common.row_of(self.bounds)
        breaks = np.flatnonzero(~_UNBROKEN[self.data])
        self.piece = np.searchsorted(breaks, self.starts)
        self.hashes = common.word_hashes(self.data, self.starts, self.ends)
        names = lang.dictionary_encode()
        self.langs, self.lang = names.dictionary.to_pylist(), names.indices.to_numpy(zero_copy_only=False)
        raw, places = common.text_bytes(names.dictionary)
        self.seeds = common.word_hashes(raw, places[:-1], places[1:])

    def second(self) -> np.ndarray:
        """Other hashes of the words."""
        return common.word_hashes(self.data, self.starts, self.ends, SECOND)

    def prints(self, size: int, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Where n-grams of ``size`` words begin, by word, and their fingerprints, which differ by language too."""
        hashes = self.hashes if hashes is None else hashes
        last = len(self.hashes) - size + 1
        if last <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        at = np.flatnonzero((self.row[:last] == self.row[size - 1 :]) & (self.piece[:last] == self.piece[size - 1 :]))
        return at, common.mix(common.window_hashes(hashes, size, 50 + size)[at] ^ self.seeds[self.lang[self.row[at]]])

    def word_ids(self) -> np.ndarray:
        """A number for each word, equal for equal words: by hash, each word compared with the first of its hash."""
        _, first, ids = np.unique(self.hashes, return_index=True, return_inverse=True)
        like = first[ids]
        same = self.ends - self.starts == self.ends[like] - self.starts[like]
        for low in range(0, len(ids) if same.all() else 0, COMPARED):
            a, b = self.starts[low : low + COMPARED], self.starts[like[low : low + COMPARED]]
            sizes = self.ends[low : low + COMPARED] - a
            inside = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            if not np.array_equal(self.data[np.repeat(a, sizes) + inside], self.data[np.repeat(b, sizes) + inside]):
                same[:] = False
                break
        if not same.all():  # two words share a hash: numbered by their bytes instead
            known: dict[bytes, int] = {}
            raw = self.data.tobytes()
            ids = np.array([known.setdefault(raw[s:e], len(known)) for s, e in zip(self.starts.tolist(), self.ends.tolist())], np.int64)
        return ids

    def counted(self, size: int, wanted, second: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the n-grams whose fingerprints are wanted, by different one: both fingerprints, the first place, and how often it occurs."""
        at, prints = self.prints(size)
        mine = wanted(prints)
        at, prints, others = at[mine], prints[mine], self.prints(size, second)[1][mine]
        order = np.lexsort((at, others, prints))
        at, prints, others = at[order], prints[order], others[order]
        first = np.flatnonzero(np.concatenate(([True], (prints[1:] != prints[:-1]) | (others[1:] != others[:-1])))[: len(at)])
        counts = np.diff(first, append=len(at))
        like = np.repeat(at[first], counts)
        if not all(np.array_equal(ids[at + k], ids[like + k]) for k in range(size)) or not np.array_equal(self.lang[self.row[at]], self.lang[self.row[like]]):
            raise ValueError("two phrases agree in both fingerprints; change SECOND")
        return prints[first], others[first], at[first], counts


def _by_shard(codes: np.ndarray, shards: int, span: int) -> list[tuple[int, int, int]]:
    """Shards with their parts of sorted codes."""
    marks = [int(c) for c in np.searchsorted(codes, np.arange(1, shards, dtype=np.uint64) * np.uint64(span))]
    return [(s, a, b) for s, (a, b) in enumerate(zip([0, *marks], [*marks, len(codes)])) if b > a]


def frequent_phrases(docs: DataFrame, least: int = 10, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, phrase, size, f of every run of one to three words within a piece that occurs ``least`` times or more in its language.

    Rows of size 0 and no phrase hold numbers of words of a language, to be added up.  A-Z are lower-cased, texts are
    cut at ``[.,;:!?\\x0A-\\x0D]`` and those pieces into words at blanks and tabs.  Null texts are empty, a null language is
    ``und``; repeated rows count each time.
    """
    spark = docs.sparkSession
    source = docs.select(F.coalesce(text_col, F.lit("")).alias("_text"), F.coalesce(lang_col, F.lit("und")).alias("_lang"), F.col(id_col).alias("_id"))
    total = source.agg(F.sum(F.octet_length("_text")).alias("n")).first()["n"] or 0
    groups = max(1, math.ceil(total / common.group_bytes(total, 400)))
    width = common.width_of(spark, groups)
    # Fingerprints are cut to so many bits that there are more values than n-grams: few rare ones then seem frequent.
    bits = min(64, max(24, total.bit_length() - 1))
    shards = max(1, math.ceil(total / 2.5 / SHARD))
    cut, span = np.uint64(64 - bits), -(-(1 << bits) // shards)
    dealt = source.select("_text", "_lang", F.pmod(F.xxhash64("_id", "_text"), F.lit(groups)).cast("int").alias("_group")).repartition(width, "_group")

    def sift(table: pa.Table) -> pa.Table:
        """Of a group: for each shard its shortened fingerprints and their counts, up to ``least``."""
        common.begin("phrases")
        grams = Grams(table["_text"].combine_chunks(), table["_lang"].combine_chunks())
        codes = np.concatenate([grams.prints(size)[1] >> cut for size in range(1, LONGEST + 1)])
        codes.sort()
        first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1]))[: len(codes)])
        counts = np.minimum(np.diff(first, append=len(codes)), least).astype(np.uint8 if least < 256 else np.uint32)
        codes = codes[first]
        rows = _by_shard(codes, shards, span)
        return pa.table({
            "shard": pa.array([s for s, _, _ in rows], pa.int32()), "group": pa.array([table["_group"][0].as_py()] * len(rows), pa.int32()),
            "codes": pa.array([packed(codes[a:b] - np.uint64(s * span)) for s, a, b in rows], pa.binary()), "counts": pa.array([counts[a:b].tobytes() for _, a, b in rows], pa.binary()),
        })

    def frequent(table: pa.Table) -> pa.Table:
        """Of a shard: by group, which of its fingerprints reach ``least`` over all groups."""
        codes = [unpacked(x.as_buffer()) for x in table["codes"]]
        counts = [np.frombuffer(x.as_buffer(), np.uint8 if least < 256 else np.uint32) for x in table["counts"]]
        values, which = np.unique(np.concatenate(codes), return_inverse=True)
        often = np.bincount(which, np.concatenate(counts), len(values)) >= least
        out, low = [], 0
        for group, mine in zip(table["group"].to_pylist(), codes):
            kept = mine[often[which[low : low + len(mine)]]]
            low += len(mine)
            if len(kept):
                out.append((group, packed(kept)))
        shard = [table["shard"][0].as_py()] * len(out)
        return pa.table({"group": pa.array([g for g, _ in out], pa.int32()), "shard": pa.array(shard, pa.int32()), "codes": pa.array([c for _, c in out], pa.binary())})

    def tally(left: pa.Table, right: pa.Table) -> pa.Table:
        """Of a group: the exact counts of its n-grams whose shortened fingerprints are frequent, for the shards."""
        common.begin("phrases")
        rows, codes = [], np.empty(0, np.uint64)
        if left.num_rows and right.num_rows:
            grams = Grams(left["_text"].combine_chunks(), left["_lang"].combine_chunks())
            wanted = np.sort(np.concatenate([unpacked(x.as_buffer()) + np.uint64(s * span) for s, x in zip(right["shard"].to_pylist(), right["codes"])]))
            ids, second = grams.word_ids(), grams.second()
            found = [grams.counted(size, lambda prints: common.member(prints >> cut, wanted), second, ids) for size in range(1, LONGEST + 1)]
            codes, others, counts = (np.concatenate([f[k] for f in found]) for k in (0, 1, 3))
            codes >>= cut
            order = np.lexsort((others, codes))
            codes, others, counts = codes[order], others[order], counts[order]
            rows = _by_shard(codes, shards, span)
        return pa.table({
            "shard": pa.array([s for s, _, _ in rows], pa.int32()), "group": pa.array([left["_group"][0].as_py()] * len(rows), pa.int32()), "codes": pa.array([packed(codes[a:b] - np.uint64(s * span)) for s, a, b in rows], pa.binary()),
            "others": pa.array([_six_bytes(others[a:b]) for _, a, b in rows], pa.binary()), "counts": pa.array([small_counts(counts[a:b]) for _, a, b in rows], pa.binary()),
        })

    def settle(table: pa.Table) -> pa.Table:
        """Of a shard: the phrases that are frequent, each pointed at the first group that holds it, with its count."""
        base = np.uint64(table["shard"][0].as_py() * span)
        codes, others = [unpacked(x.as_buffer()) for x in table["codes"]], np.concatenate([_of_six_bytes(x.as_buffer()) for x in table["others"]])
        sizes = [len(x) for x in codes]
        counts, group = np.concatenate([counts_of(x.as_buffer(), n) for x, n in zip(table["counts"], sizes)]), np.repeat(table["group"].to_numpy(), sizes)
        codes = np.concatenate(codes) + base
        order = np.lexsort((group, others, codes))
        codes, others, counts, group = codes[order], others[order], counts[order], group[order]
        first = np.flatnonzero(np.concatenate(([True], (codes[1:] != codes[:-1]) | (others[1:] != others[:-1])))[: len(codes)])
        sums = np.add.reduceat(counts, first)
        often = sums >= least
        keys, group, sums = _both(codes, others)[first][often], group[first][often], sums[often]
        order = np.lexsort((keys, group))
        keys, group, sums = keys[order], group[order], sums[order]
        cuts = [*np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))[: len(group)]).tolist(), len(group)]
        parts = list(zip(cuts, cuts[1:]))
        return pa.table({"group": pa.array([int(group[a]) for a, _ in parts], pa.int32()), "keys": pa.array([keys[a:b].tobytes() for a, b in parts], pa.binary()), "sums": pa.array([sums[a:b].tobytes() for a, b in parts], pa.binary())})

    def write_out(left: pa.Table, right: pa.Table) -> pa.Table:
        """Of a group: its languages' numbers of words, and the phrases that it was asked for as text with their counts in all."""
        common.begin("phrases")
        langs, phrases, sizes, counts = [], [], [], []
        if left.num_rows:
            grams = Grams(left["_text"].combine_chunks(), left["_lang"].combine_chunks())
            words = np.bincount(grams.lang[grams.row], minlength=len(grams.langs))
            langs, phrases, sizes, counts = list(grams.langs), [None] * len(words), [0] * len(words), words.tolist()
            if right.num_rows:
                asked, sums = (np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in right[c]]) for c, kind in (("keys", np.uint64), ("sums", np.int64)))
                order = np.argsort(asked)
                asked, sums = asked[order], sums[order]
                second, raw = grams.second(), grams.data.tobytes()
                for size in range(1, LONGEST + 1):
                    at, prints = grams.prints(size)
                    keys = _both(prints >> cut, grams.prints(size, second)[1])
                    mine = common.member(keys, asked)
                    keys, first = np.unique(keys[mine], return_index=True)
                    at = at[mine][first]
                    spans = [[raw[a:b] for a, b in zip(grams.starts[at + k].tolist(), grams.ends[at + k].tolist())] for k in range(size)]
                    phrases += [b" ".join(x).decode() for x in zip(*spans)]
                    langs += [grams.langs[x] for x in grams.lang[grams.row[at]].tolist()]
                    sizes += [size] * len(at)
                    counts += sums[np.searchsorted(asked, keys)].tolist()
        return pa.table({"lang": pa.array(langs, pa.string()), "phrase": pa.array(phrases, pa.string()), "size": pa.array(sizes, pa.int32()), "f": pa.array(counts, pa.int64())})

    by_shard = lambda df: df.repartition(common.width_of(spark, shards), "shard").groupBy("shard")
    texts = dealt.groupBy("_group")
    told = by_shard(texts.applyInArrow(sift, "shard int, group int, codes binary, counts binary")).applyInArrow(frequent, "group int, shard int, codes binary")
    exact = texts.cogroup(told.repartition(width, "group").groupBy("group")).applyInArrow(tally, "shard int, group int, codes binary, others binary, counts binary")
    asked = by_shard(exact).applyInArrow(settle, "group int, keys binary, sums binary")
    return texts.cogroup(asked.repartition(width, "group").groupBy("group")).applyInArrow(write_out, "lang string, phrase string, size int, f long")


def collocations(docs: DataFrame, least: int = 10, inside: int = 50, most: int = 2000, **columns: str) -> DataFrame:
    """The ``most`` best phrases of two or three words by language: lang, rank, phrase, a, l, r, n, score.

    A phrase that occurs a times and is cut in two that occur l and r times has score floor(1000000 * a * a / (l * r)); of
    its cuts the lowest score counts, then the one that comes first.  A phrase goes if one of three words holds it
    and occurs at least ``inside`` % as often.  Order is by score and a, largest first, then by phrase.  Languages without
    a frequent phrase have no row; an empty table gives none.
    """
    table = common.materialize(frequent_phrases(docs, least, **columns), "phrases")
    words = table.where("size = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    known = table.where("size > 0")
    few = known.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    small = (lambda df: F.broadcast(df)) if few else (lambda df: df)
    # Longer phrases first tell the pairs that they hold how often they occur.
    w = F.split("phrase", " ")
    join = lambda *ks: F.concat_ws(" ", *[w[k] for k in ks])
    longer = known.where("size = 3").select("lang", F.explode(F.array_distinct(F.array(join(0, 1), join(1, 2)))).alias("phrase"), "f")
    longer = longer.groupBy("lang", "phrase").agg(F.max("f").alias("_f"))
    alone = known.where("size >= 2").join(small(longer), ["lang", "phrase"], "left").where(F.col("_f").isNull() | (100 * F.col("_f") < inside * F.col("f")))
    cut = lambda k, left, right: F.struct(F.lit(k).alias("k"), left.alias("left"), right.alias("right"))
    cuts = F.when(F.col("size") == 2, F.array(cut(1, w[0], w[1]))).otherwise(F.array(cut(1, w[0], join(1, 2)), cut(2, join(0, 1), w[2])))
    parts = alone.select("lang", "phrase", F.col("f").alias("a"), F.explode(cuts).alias("c")).select("lang", "phrase", "a", "c.*")
    one = known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    two = known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    parts = parts.join(small(one), ["lang", "left"]).join(small(two), ["lang", "right"])
    whole = {c: F.col(c).cast("decimal(38,0)") for c in "alr"}
    exact = parts.withColumns({f"_{c}": v for c, v in whole.items()}).withColumn("score", F.expr("(CAST(1000000 AS DECIMAL(38,0)) * _a * _a) div (_l * _r)"))
    best = exact.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("b")).select("lang", "phrase", "a", "b.score", "b.l", "b.r")
    # First within parts of a language, so that no task sorts more than ``PARTS`` times ``most`` of one.
    rank = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), F.desc("a"), "phrase"))
    parted = best.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    parted = parted.withColumn("rank", rank("lang", "_part")).where(F.col("rank") <= most)
    first = parted.withColumn("rank", rank("lang")).where(F.col("rank") <= most)
    return first.join(words, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", F.col("score").cast("long"))
