"""SentencePiece encoding and decoding through a table of distinct marked words.

No piece of the models used here has a white-space marker behind another character, so pieces cannot
cross into a following marked word, and a text's ids are those of its marked words in a row.  A marked
word is a run of spaces with what follows it up to the next space.

Texts are read in slices.  A slice gives its distinct marked words, the commonest first, and, for its texts
in a row, each word's number among them.  Its words are dealt by hash into packets; one task has the packets of
one hash from all slices and segments each distinct word once.  The ids go back to the slices, where the numbers
put them in their positions.  Numbers ride along with the packets, so one scan feeds one line of two exchanges.
Texts themselves are not shuffled, and packets and numbers are compressed.  A text that holds the marker
character itself is one word, whole.
"""

from __future__ import annotations

import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from sparkledger.llm import common
from sparkledger.llm.wordbpe import gather

MARKER = "▁"
#: Bytes of text in a slice; a longer text is a slice of its own.
SLICE_BYTES = 8 << 20
#: Ids that are turned into Python numbers at once; a text with more is decoded alone.
DECODED = 1 << 19
#: Words a task remembers before it starts anew, and the bytes of the longest; they bound memory only.
REMEMBERED, LONGEST = 1_000_000, 256
_models: dict[str, "MarkedWords"] = {}
common.caches["pieces"] = _models.clear


class MarkedWords:
    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        # Chunking holds only for models that keep blanks, mark the start, and never put a marker inside a piece.
        inside = any(MARKER in self.model.id_to_piece(i).lstrip(MARKER) for i in range(self.model.get_piece_size()))
        self.chunked = not inside and self.model.decode(self.model.encode("a  b ")) == "a  b " and self.model.encode("b c") == self.model.encode("b") + self.model.encode("c")
        self.blank = array("i", [self.model.piece_to_id(MARKER)]).tobytes()

    def split(self, text: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The marked words of some texts, the numbers of each text's words in a row, and bounds for each text.

        The last word of a text that ends with a single space is empty.
        """
        text = pc.fill_null(text, "")
        whole = pc.and_(pc.match_substring(text, MARKER) if self.chunked else True, pc.greater(pc.binary_length(text), 0)).to_numpy(zero_copy_only=False)
        whole_texts = text.filter(pa.array(whole)).to_pylist()
        data, offsets = common.text_bytes(pc.if_else(pa.array(whole), "", text))
        space = data == 0x20
        cut = space.copy()
        cut[1:] &= ~space[:-1]
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]
        cut[heads] = False
        cuts = np.flatnonzero(cut)
        # The chunk behind a last single space starts where its text ends and has no bytes; it sorts before the next text's first.
        starts = np.sort(np.concatenate((cuts + 1, heads)))
        counts = np.diff(np.searchsorted(cuts, offsets)) + (offsets[:-1] < offsets[1:])
        bounds = np.concatenate((starts, [len(data)])).astype(np.int32)
        chunks = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
        coded = chunks.dictionary_encode()
        # A chunk may end with the space that parts it from the next.
        words = [c[:-1] if c.endswith(" ") and c.strip(" ") else c for c in coded.dictionary.to_pylist()]
        rows = np.concatenate(([0], np.cumsum(counts)))
        numbers = np.insert(coded.indices.to_numpy().astype(np.int64), rows[:-1][whole], len(words) + np.arange(len(whole_texts)))
        return words + whole_texts, numbers, rows + np.concatenate(([0], np.cumsum(whole)))

    def segment(self, words: list[str]) -> list[bytes]:
        """Each word's ids as 32-bit numbers."""
        found = self.model.encode(words, num_threads=1) if words else []
        return [array("i", ids).tobytes() if word else self.blank for word, ids in zip(words, found)]

    def encode_column(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, with bounds for each text; a null is an empty text."""
        words, numbers, rows = self.split(text)
        ids, ends = gather(*_joined(pa.array(self.segment(words), pa.binary())), numbers)
        return ids, ends[rows]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The text of each run of ids, a bounded number of ids at a time."""
        texts, low = [], 0
        while low < len(bounds) - 1:
            high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + DECODED, side="right")) - 1)
            every, ends = ids[bounds[low] : bounds[high]].tolist(), (bounds[low : high + 1] - bounds[low]).tolist()
            texts += self.model.decode([every[a:b] for a, b in zip(ends[:-1], ends[1:])])
            low = high
        return texts


def _joined(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of an array of words' ids in a row, with bounds for each word."""
    if not len(ids):
        return np.empty(0, np.int32), np.zeros(1, np.int64)
    _, offsets, data = ids.buffers()
    bounds = np.frombuffer(offsets, np.int32)[ids.offset : ids.offset + len(ids) + 1].astype(np.int64) // 4
    values = np.frombuffer(data, np.int32)[bounds[0] : bounds[-1]] if data is not None and bounds[-1] > bounds[0] else np.empty(0, np.int32)
    return values, bounds - bounds[0]


def marked_words(path: str) -> MarkedWords:
    if path not in _models:
        _models[path] = MarkedWords(path)
    return _models[path]


def pack(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32, compressed: their count, a byte each with the number itself or its length, and by length the bits that are left."""
    numbers = numbers.astype(np.uint32)
    length = np.frexp(numbers.astype(np.float64))[1] - 1
    parts = [np.array([len(numbers)], "<u4").view(np.uint8), np.where(length < 7, numbers, length + 121).astype(np.uint8)]
    for k in range(7, 32):
        rest = numbers[length == k] - np.uint32(1 << k)
        parts += [((rest >> np.uint32(shift)) & np.uint32(255)).astype(np.uint8) for shift in range(0, k, 8)]
    return zstandard.compress(np.concatenate(parts).tobytes(), 3)


def unpack(packed: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(packed), np.uint8)
    n = int(raw[:4].view("<u4")[0])
    first, at = raw[4 : 4 + n], 4 + n
    numbers = first.astype(np.uint32)
    for k in np.unique(first[first >= 128]).astype(int) - 121:
        chosen = np.flatnonzero(first == k + 121)
        value = np.full(len(chosen), 1 << k, np.uint32)
        for shift in range(0, k, 8):
            value += raw[at : at + len(chosen)].astype(np.uint32) << np.uint32(shift)
            at += len(chosen)
        numbers[chosen] = value
    return numbers


#: A row is a slice's texts (bucket -1) or a packet of its words.
ROWS = "slice long, bucket int, doc_ids array<long>, values array<binary>"
_NAMES = ["slice", "bucket", "doc_ids", "values"]


def _row(slice: int, bucket: int, values: list[bytes], doc_ids: pa.Array | None = None) -> pa.RecordBatch:
    ids = pa.array([None], pa.list_(pa.int64())) if doc_ids is None else pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], pa.int32()), doc_ids)
    return pa.RecordBatch.from_arrays([pa.array([slice], pa.int64()), pa.array([bucket], pa.int32()), ids, pa.array([values], pa.list_(pa.binary()))], names=_NAMES)


def word_lists(docs: DataFrame, model: str, buckets: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each slice a row of its texts, bucket -1, and a packet for each bucket that has words of it.

    The row of texts has three packed lists: how many words each text has, the numbers of these words, and the
    bucket of each distinct word.  A packet has the lengths and the bytes of its words in order of their numbers.
    """

    def tasks(batches):
        common.begin("pieces")
        table, slice = marked_words(model), TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in common.slices(batch, 1, SLICE_BYTES):
                words, numbers, rows = table.split(part.column(1))
                common_first = np.argsort(-np.bincount(numbers, minlength=len(words)), kind="stable")
                rank = np.empty(len(words), np.int64)
                rank[common_first] = np.arange(len(words))
                listed = pa.array(words, pa.large_string()).take(pa.array(common_first))
                dealt = np.array([zlib.crc32(w.encode()) % buckets for w in listed.to_pylist()], np.int64)
                yield _row(slice, -1, [pack(np.diff(rows)), pack(rank[numbers]), pack(dealt)], part.column(0))
                data, offsets = common.text_bytes(listed.take(pa.array(np.argsort(dealt, kind="stable"))))
                lengths, bounds = np.diff(offsets), np.concatenate(([0], np.cumsum(np.bincount(dealt, minlength=buckets))))
                for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
                    if a < b:
                        yield _row(slice, k, [pack(lengths[a:b]), zstandard.compress(data[offsets[a] : offsets[b]].tobytes(), 3)])
                slice += 1

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tasks, ROWS)


def segmented(lists: DataFrame, model: str, buckets: int) -> DataFrame:
    """The rows of ``word_lists``, packets with the number of ids of each word and the ids; a distinct word is segmented once."""

    def tasks(batches):
        common.begin("pieces")
        table, known = marked_words(model), {}
        for batch in batches:
            packets = pc.greater_equal(batch.column(1), 0)
            yield batch.filter(pc.invert(packets))
            chosen = batch.filter(packets)
            for slice, bucket, (lengths, raw) in zip(chosen.column(0).to_pylist(), chosen.column(1).to_pylist(), chosen.column(3).to_pylist()):
                ends = np.concatenate(([0], np.cumsum(unpack(lengths), dtype=np.int64))).tolist()
                raw = zstandard.decompress(raw)
                words = [raw[a:b] for a, b in zip(ends[:-1], ends[1:])]
                new = [w for w in words if w not in known]
                found = dict(zip(new, table.segment([w.decode() for w in new])))
                ids = [found[w] if w in found else known[w] for w in words]
                if len(known) > REMEMBERED:
                    known.clear()
                known.update((w, i) for w, i in found.items() if len(w) <= LONGEST)
                sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
                yield _row(slice, bucket, [pack(sizes), pack(np.frombuffer(b"".join(ids), np.int32))])

    # Rows of texts are spread by their slices.
    place = F.when(F.col("bucket") >= 0, F.col("bucket").cast("long")).otherwise(-1 - F.col("slice"))
    return lists.withColumn("_p", place).repartition(buckets, "_p").drop("_p").mapInArrow(tasks, ROWS)


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = True, buckets: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (array of int) and, unless ``decode`` is off, decoded.

    A null text is empty and has no ids.  Null and repeated doc_ids are kept as they are; other columns
    are ignored.  There are as many ``buckets`` of words as shuffle partitions, if not given; a word that
    stands in every slice is once in a packet of each.
    """
    buckets = buckets or common.shuffle_width(docs.sparkSession)

    def join(rows: pa.Table) -> pa.Table:
        common.begin("pieces")
        of = rows.column("bucket").to_numpy()
        order = np.argsort(of)
        (doc_ids, (counts, numbers, dealt)), packets = (rows.column(name)[int(order[0])] for name in ("doc_ids", "values")), [rows.column("values")[int(k)].as_py() for k in order[1:]]
        counts, numbers, dealt = (unpack(x.as_py()) for x in (counts, numbers, dealt))
        sizes, ids = (np.concatenate([np.empty(0, np.uint32), *[unpack(p[k]) for p in packets]]) for k in (0, 1))
        # Packets in order of their buckets have the words in this order.
        place = np.empty(len(dealt), np.int64)
        place[np.argsort(dealt, kind="stable")] = np.arange(len(dealt))
        found, ends = gather(ids.astype(np.int32), np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))), place[numbers])
        bounds = ends[np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))]
        columns = [doc_ids.values, common.list_array(found, bounds, pa.int32())]
        if decode:
            columns.append(pa.array(marked_words(model).decode(found, bounds), pa.string()))
        return pa.Table.from_arrays(columns, names=["doc_id", "ids", "decoded"][: len(columns)])

    lists = word_lists(docs, model, buckets, id_col, text_col)
    return segmented(lists, model, buckets).groupBy("slice").applyInArrow(join, "doc_id long, ids array<int>" + ", decoded string" * decode)


def digest(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, and the SHA-256 of the comma-joined ids and of the decoded text."""
    joined = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
