"""A quality classifier: interpolated modified Kneser-Ney n-grams over the bytes of texts, and quantiles by language.

n-grams are of ``ORDER`` unfolded bytes, so their number grows with the corpus.  Each slice of the texts
(``ROWS`` rows of a file) lists its distinct n-grams once; sums over all slices are the counts.  Discounts,
context totals, lower orders and interpolated probabilities come from shuffle joins of count tables that
Spark shards by n-gram or context: a context has at most 256 n-grams, so none of these keys is hot.  A last
join brings each slice the scores of its own n-grams, with which it sums up its texts.

Trusted texts are parted in halves by their ids, with counts of their own side by side.  Every text is scored by
the model of the half that its id is not in, so no text is scored by a model that has seen it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkledger.llm import common

ORDER = 5
#: Rows of a file that share a table of scores.
ROWS = 8192
#: Trusted ids up to this size are sent to all tasks; more are joined by a shuffle.
BROADCAST_BYTES = 32 << 20
#: Bytes of text a task counts or scores at once.
SLICE = 2 << 20
_BOUNDARY = 10
#: How much further out than the sample's quantiles the limits are, over the root of its size.
UNSURE = 3.0
#: A score takes 16 bits: up to 16 bits a byte in parts of 1/2048, beyond in parts of 1/128.  That ends at 272, which five orders
#: with contexts of up to 2**52 counts cannot reach.
PARTS_OF_BIT, FINE, COARSE_PARTS = 2048, 16, 128
#: Files that hold a slice's scores, at most.
DEALT = 4
_CODE, _CLASS = 8 * ORDER, 60


def gram_codes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each byte the n-gram that ends there, as a number; texts begin behind line ends."""
    s = data.astype(np.int64)
    padded = np.concatenate((np.full(ORDER - 1, _BOUNDARY, np.int64), s))
    codes = np.zeros(len(s), np.int64)
    for k in range(ORDER):
        codes <<= 8
        codes |= padded[k : k + len(s)]
    full = offsets[:-1] < offsets[1:]
    starts, limits = offsets[:-1][full], offsets[1:][full]
    for ahead in range(ORDER - 1):  # the first bytes of each text look back into the text before: compute them anew
        at = starts[starts + ahead < limits] + ahead
        code = np.zeros(len(at), np.int64)
        for k in range(ORDER):
            back = ORDER - 1 - k
            code = (code << 8) | (s[at - back] if back <= ahead else _BOUNDARY)
        codes[at] = code
    return codes


def _keys(part: pa.RecordBatch, langs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of each text, under the number of its language, and each text's offsets among them."""
    data, offsets = common.text_bytes(part.column(part.schema.get_field_index("_text")))
    if not len(data):
        return np.empty(0, np.int64), offsets
    lang = pc.index_in(part.column(part.schema.get_field_index("_lang")), langs).to_numpy().astype(np.int64)
    return gram_codes(data, offsets) | np.repeat(lang << _CODE, np.diff(offsets)), offsets


def _by_slice(batch: pa.RecordBatch):
    """Runs of rows of one slice, of about ``SLICE`` bytes: (slice, rows)."""
    for part in common.slices(batch, batch.schema.get_field_index("_text"), SLICE):
        of = part.column(part.schema.get_field_index("_slice")).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield int(of[a]), part.slice(a, b - a)


def slice_grams(texts: DataFrame, langs: list[str]) -> DataFrame:
    """slice, g, c0, c1 of (_slice, _lang, _text, _class) rows: the distinct n-grams of each slice, and how often each
    half's trusted texts (class 1 and 2) hold them.  A slice may be listed in parts."""
    names = pa.array(langs, pa.string())

    def merged(held):
        keys, counts = np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        return keys[heads], np.add.reduceat(counts, heads)

    def flush(at, held):
        keys, counts = merged(held)
        kind, (grams, place) = keys >> _CLASS, np.unique(keys & ((1 << _CLASS) - 1), return_inverse=True)
        seen = np.zeros((2, len(grams)), np.int64)
        for half in (0, 1):
            mine = kind == half + 1
            seen[half, place[mine]] = counts[mine]
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(grams), at)), pa.array(grams), pa.array(seen[0]), pa.array(seen[1])], names=["slice", "g", "c0", "c1"])

    def tasks(batches):
        common.begin("quality")
        now, held = None, []
        for batch in batches:
            for at, part in _by_slice(batch):
                if at != now and held:
                    yield flush(now, held)
                    held = []
                now = at
                keys, offsets = _keys(part, names)
                if len(keys):
                    kinds = part.column(part.schema.get_field_index("_class")).to_numpy().astype(np.int64)
                    held.append(np.unique(keys | np.repeat(kinds << _CLASS, np.diff(offsets)), return_counts=True))
                    if len(held) == 8:
                        held = [merged(held)]
        if held:
            yield flush(now, held)
        held = []
        common.release()  # JVM tasks come next, beside this idle worker

    return texts.select("_slice", "_lang", "_text", "_class").mapInArrow(tasks, "slice long, g long, c0 long, c1 long")


def _lang(k: int) -> Column:
    return F.shiftright("g", 8 * k).cast("int")


def count_orders(grams: DataFrame) -> dict[int, DataFrame]:
    """By order: g, c0, c1.  Lower orders count the distinct n-grams that end in theirs, as Kneser-Ney asks; what no trusted text holds counts 0."""
    counts = {ORDER: common.materialize(grams.groupBy("g").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1")), "gram-counts")}
    for k in range(ORDER - 1, 0, -1):
        seen = [F.count(F.when(F.col(c) > 0, 1)).alias(c) for c in ("c0", "c1")]
        counts[k] = common.materialize(counts[k + 1].groupBy(_suffix(k + 1).alias("g")).agg(*seen), "gram-counts")
    return counts


def _suffix(k: int) -> Column:
    """The n-gram of the next lower order that one of order ``k`` ends in."""
    return F.shiftleft(F.shiftright("g", 8 * k), 8 * (k - 1)).bitwiseOR(F.col("g").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1).cast("long")))


def discounts(counts: dict[int, DataFrame]) -> dict[int, list[tuple]]:
    """By order, for each language: its number, three discounts of each half, and whether each half has any text."""
    kinds = [F.count(F.when(F.col(c) == n, 1) if n else F.when(F.col(c) > 0, 1)).alias(f"{c}_{n}") for c in ("c0", "c1") for n in range(5)]
    every = None
    for k, table in counts.items():
        part = table.groupBy(_lang(k).alias("l")).agg(*kinds).withColumn("k", F.lit(k))
        every = part if every is None else every.unionByName(part)
    out: dict[int, list[tuple]] = {k: [] for k in counts}
    for r in every.collect():  # a row for each language and order
        values = []
        for c in ("c0", "c1"):
            n = [r[f"{c}_{i}"] for i in range(5)]
            y = n[1] / (n[1] + 2 * n[2]) if n[1] + n[2] else 0.5
            # A discount that the counts of counts do not give is half its count.
            values += [max(0.05, min(i - 0.05, i - (i + 1) * y * n[i + 1] / n[i] if n[i] else i / 2)) for i in (1, 2, 3)]
        out[r["k"]].append((r["l"], *values, r["c0_0"] > 0, r["c1_0"] > 0))
    return out


def scores(counts: dict[int, DataFrame], less: dict[int, list[tuple]]) -> DataFrame:
    """g, p0, p1: the interpolated probability of each n-gram of the highest order by each half's model."""
    spark = counts[ORDER].sparkSession
    schema = "l int, d01 double, d02 double, d03 double, d11 double, d12 double, d13 double"
    lower = None
    for k in range(1, ORDER + 1):
        table = F.broadcast(spark.createDataFrame([r[:7] for r in less[k]], schema))  # a row for each language
        taken = lambda i: F.when(F.col(f"c{i}") == 0, 0.0).when(F.col(f"c{i}") == 1, F.col(f"d{i}1")).when(F.col(f"c{i}") == 2, F.col(f"d{i}2")).otherwise(F.col(f"d{i}3"))
        known = counts[k].withColumn("l", _lang(k)).join(table, "l").select("g", F.shiftright("g", 8).alias("h"), "c0", "c1", taken(0).alias("t0"), taken(1).alias("t1"))
        contexts = known.groupBy("h").agg(*[F.sum(c).alias(f"all_{c}") for c in ("c0", "c1", "t0", "t1")])
        joined = known.join(contexts, "h")
        if lower is None:
            joined = joined.withColumns({"q0": F.lit(1 / 256), "q1": F.lit(1 / 256)})
        else:
            joined = joined.withColumn("suffix", _suffix(k)).join(lower.select(F.col("g").alias("suffix"), F.col("p0").alias("q0"), F.col("p1").alias("q1")), "suffix")
        # A new context has all its weight in the lower order.
        p = lambda i: F.when(F.col(f"all_c{i}") > 0, (F.col(f"c{i}") - F.col(f"t{i}") + F.col(f"all_t{i}") * F.col(f"q{i}")) / F.col(f"all_c{i}")).otherwise(F.col(f"q{i}"))
        lower = joined.select("g", p(0).alias("p0"), p(1).alias("p1"))
    return lower


def answer(grams: DataFrame, found: DataFrame, path: str, folders: int) -> None:
    """Writes each slice's n-grams with their scores by both models in one number, a folder for each slice or few."""
    def bits(p: str):
        score = -F.log2(p)
        return F.when(score < FINE, F.least(F.round(score * PARTS_OF_BIT), F.lit(FINE * PARTS_OF_BIT - 1))).otherwise(FINE * PARTS_OF_BIT + F.round((score - FINE) * COARSE_PARTS)).cast("int")

    packed = found.select("g", F.shiftleft(bits("p0"), 16).bitwiseOR(bits("p1")).alias("bits"))
    rows = grams.select("slice", "g").join(packed, "g").withColumn("folder", (F.col("slice") % folders).cast("int"))
    # A folder's rows are dealt to several tasks, so that those whose hashes fall together do not make one task long.
    rows.repartition(folders, "folder", F.col("g") % DEALT).sortWithinPartitions("folder", "slice", "g").write.option("compression", "zstd").partitionBy("folder").parquet(path)


def _score(codes: np.ndarray) -> np.ndarray:
    """Bits a byte of scores as ``answer`` wrote them."""
    above = codes.astype(np.int64) - FINE * PARTS_OF_BIT
    return np.where(above < 0, codes / PARTS_OF_BIT, FINE + above / COARSE_PARTS)


class _Scores:
    """A slice's n-grams and their scores: a table by hash, and what found its place taken apart."""

    def __init__(self, grams: np.ndarray, bits: np.ndarray):
        self.shift = np.uint64(64 - max(8, int(4 * len(grams)).bit_length()))
        at = self._place(grams)
        self.grams, self.bits = np.full(1 << (64 - int(self.shift)), -1, np.int64), np.zeros(1 << (64 - int(self.shift)), np.uint32)
        self.grams[at], self.bits[at] = grams, bits
        apart = self.grams[at] != grams
        self.more, self.more_bits = grams[apart], bits[apart]  # sorted, as the n-grams are

    def _place(self, grams: np.ndarray) -> np.ndarray:
        return ((grams.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def of(self, grams: np.ndarray) -> np.ndarray:
        at = self._place(grams)
        out = self.bits[at]
        other = np.flatnonzero(self.grams[at] != grams)
        if len(other):
            k = np.minimum(np.searchsorted(self.more, grams[other]), len(self.more) - 1)
            if not len(self.more) or (self.more[k] != grams[other]).any():
                raise ValueError("a text holds n-grams that its slice had not when they were counted")
            out[other] = self.more_bits[k]
        return out


_held: dict[tuple[str, int], _Scores] = {}
common.caches["quality"] = _held.clear


def _scores_of(path: str, at: int, folders: int) -> _Scores:
    """The scores of a slice, from the shared folder; a worker holds those of one."""
    from pyarrow import dataset, fs

    if (path, at) not in _held:
        _held.clear()
        store, root = fs.FileSystem.from_uri(path)
        rows = dataset.dataset(f"{root}/folder={at % folders}", filesystem=store, format="parquet").to_table(columns=["g", "bits"], filter=pc.field("slice") == at)
        grams, bits = rows["g"].to_numpy(), rows["bits"].to_numpy().view(np.uint32)
        order = np.argsort(grams, kind="stable")  # a slice that was listed in parts has n-grams twice
        _held[path, at] = _Scores(grams[order], bits[order])
    return _held[path, at]


def _scored(rows: DataFrame, path: str, folders: int, langs: list[str], known: set[str], columns: list[str]) -> DataFrame:
    """The given columns with bits per byte (null without text or a model of the language) and bytes."""
    kinds = dict(rows.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in columns] + ["_bits double", "_bytes long"])
    names = pa.array(langs, pa.string())

    def tasks(batches):
        common.begin("quality")
        for batch in batches:
            for at, part in _by_slice(batch):
                keys, offsets = _keys(part, names)
                sizes = np.diff(offsets)
                bits = np.full(len(sizes), np.nan)
                able = np.array([x in known for x in part.column(part.schema.get_field_index("_lang")).to_pylist()], bool) & (sizes > 0)
                if able.any():
                    both = _scores_of(path, at, folders).of(keys)
                    half = part.column(part.schema.get_field_index("_half")).to_numpy()
                    for k in np.flatnonzero(able).tolist():  # each text by the other half's model
                        mine = both[offsets[k] : offsets[k + 1]]
                        bits[k] = _score(mine >> 16 if half[k] else mine & 0xFFFF).mean(dtype=np.float64)
                arrays = [part.column(part.schema.get_field_index(c)) for c in columns]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(bits, mask=np.isnan(bits)), pa.array(sizes)], names=[*columns, "_bits", "_bytes"])
        _held.clear()
        common.release()

    return rows.select(*dict.fromkeys(["_slice", "_lang", "_text", "_half", *columns])).mapInArrow(tasks, schema)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """doc_ids with quality 1 and without a toxic label, once each; a null label is no trust."""
    return labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select(F.col("doc_id").cast("long").alias("_id")).distinct()


def _in_slices(docs: DataFrame, columns: list[Column]) -> DataFrame:
    """The columns and ``_slice``, from the row's place in its file; rows that are not read from Parquet files are written first."""
    place = F.xxhash64("_metadata.file_path", F.floor(F.col("_metadata.row_index") / ROWS)).bitwiseAND(F.lit((1 << 62) - 1))
    if "_metadata" not in docs.columns:
        try:
            return docs.select(*columns, place.alias("_slice"))
        except AnalysisException:
            pass
    written = common.materialize(docs.select(*columns), "texts")
    return written.select("*", place.alias("_slice"))


def classify(docs: DataFrame, labels: DataFrame, low: float = 0.002, high: float = 0.995, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", keep_cols: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: its id, ``keep_cols``, language, perplexity, thresholds (low_limit, high_limit) and accepted.

    Perplexity is two to the bits per byte, by the model of the trusted texts of the language in the half that the
    text's id is not in.  A text is accepted if its perplexity lies between the quantiles ``low`` and ``high`` of
    its language's trusted texts, all of them held out.  The limits lie further from the median by ``UNSURE``
    parts in the root of the number of texts, in bits, so that the ends of a small sample do not pass for
    those of all good text.  A null language is one of its own; a language without trusted text in both
    halves has no perplexity and no limits; its texts are accepted.  Null and empty texts are not.  Rows that
    share an id and a text fare alike; a null id is in a half, and not trusted.
    """
    spark: SparkSession = docs.sparkSession
    columns = [F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"), F.coalesce(lang_col, F.lit("")).alias("_lang"), *[F.col(c) for c in keep_cols if c != text_col]]
    ids = common.materialize(trusted_ids(labels), "trusted").withColumn("_trusted", F.lit(True))
    few = ids.count() * 16 <= BROADCAST_BYTES
    half = F.pmod(F.xxhash64("_id"), F.lit(2)).cast("int")
    named = _in_slices(docs, columns).withColumn("_half", half)
    langs = sorted(r["_lang"] for r in named.select("_lang").distinct().collect())
    if len(langs) >= 1 << (_CLASS - _CODE):
        raise ValueError("more languages than an n-gram's number has room for")
    marked = named.join(F.broadcast(ids) if few else ids, "_id", "left").withColumn("_class", F.when(F.col("_trusted"), F.col("_half") + 1).otherwise(0))

    grams = common.materialize(slice_grams(marked, langs), "slice-grams")
    counts = count_orders(grams)
    less = discounts(counts)
    known = {langs[r[0]] for r in less[1] if r[7] and r[8]}
    folders = max(grams.select("slice").distinct().count(), 1)
    path = common.shared_dir(spark, "slice-scores")
    answer(grams, scores(counts, less), path, folders)

    at = lambda q: F.percentile_approx("_bits", q, 20000)
    held_out = _scored(marked.where("_trusted"), path, folders, langs, known, ["_lang"])
    quantiles = held_out.groupBy("_lang").agg(F.array(at(low), at(0.5), at(high)).alias("q"), F.count("_bits").alias("n")).where("n > 0").collect()
    limits = {}
    for r in quantiles:
        (a, middle, b), unsure = r["q"], UNSURE / r["n"] ** 0.5
        limits[r["_lang"]] = (2 ** (a - unsure * (middle - a)), 2 ** (b + unsure * (b - middle)))

    scored = _scored(named, path, folders, langs, known, ["_id", "_lang", *["_text" if c == text_col else c for c in keep_cols]])
    # A row for each language that has trusted text.
    table = spark.createDataFrame([(k, *v) for k, v in sorted(limits.items())], "_lang string, low_limit double, high_limit double")
    out = scored.join(F.broadcast(table), "_lang", "left").withColumn("perplexity", F.pow(F.lit(2.0), "_bits"))
    fits = F.col("perplexity").between(F.col("low_limit"), F.col("high_limit"))
    accepted = F.when(F.col("_bytes") == 0, False).otherwise(F.coalesce(fits, F.lit(True)))
    return out.select(F.col("_id").alias(id_col), *[F.col("_text").alias(c) if c == text_col else F.col(c) for c in keep_cols], F.col("_lang").alias("model_lang"), "perplexity", "low_limit", "high_limit", accepted.alias("accepted"))
