"""Tokenizing columns of text with a `tokenizers` file, one distinct chunk at a time.

Where a tokenizer drops white space, a text's ids are those of its blank-separated chunks in a row; that is
probed for each file, and texts are encoded whole if it does not hold.  Each Arrow batch is
dictionary-encoded by chunk.  Chunks of plain letters with trailing punctuation are cut in two, and each
distinct lower-cased part is looked up in the worker's table of parts; parts that it has not met yet go
straight to the BPE model.  Other chunks go through the whole library call.  Ids are gathered by position.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from sparkledger.llm import common

#: Parts a worker remembers; beyond it the memory is emptied. It bounds memory only, never results.
REMEMBERED = 400_000
#: Bytes of text encoded at once.
SLICE = 4 << 20
_PLAIN = r"^(?P<a>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<b>[!-&(-/:-@\[-`{-~]*)$"
_tables: dict[str, "ChunkTable"] = {}
common.caches["words"] = _tables.clear


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves, others from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, extra = {}, 256
    for byte in range(256):
        letters[byte] = chr(byte if byte in printable else extra)
        extra += byte not in printable
    return letters


class _Store:
    """Texts with their ids, as flat arrays; a text's code is its place."""

    def __init__(self):
        self.texts, self.values, self.bounds = pa.array([], pa.string()), np.empty(0, np.uint32), np.zeros(1, np.int64)

    def codes(self, wanted: pa.Array, encode: Callable[[list[str]], list]) -> np.ndarray:
        """The code of each of the distinct texts; those not met yet are encoded and added."""
        codes = pc.fill_null(pc.index_in(wanted, value_set=self.texts), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(codes < 0)
        if len(new):
            fresh = wanted.take(pa.array(new))
            found = encode(fresh.to_pylist())
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter((i for ids in found for i in ids), np.uint32, int(sizes.sum()))
            codes[new] = len(self.texts) + np.arange(len(new))
            self.texts = pa.concat_arrays([self.texts, fresh])
            self.values = np.concatenate((self.values, flat))
            self.bounds = np.concatenate((self.bounds, self.bounds[-1] + np.cumsum(sizes)))
        return codes

    def forget(self):
        """Before the next batch: lets go of all if they are many or long."""
        if len(self.texts) > REMEMBERED or self.texts.nbytes > REMEMBERED * 32:
            self.__init__()


class ChunkTable:
    """What a worker knows of one tokenizer file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters, self.store = self.tokenizer.model, _byte_letters(), _Store()
        self.chunked = self._drops_blanks()
        self.direct = self.chunked and self._splits_plainly()

    def _one(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _drops_blanks(self) -> bool:
        """Whether white space only parts chunks: checked on probes with this file."""
        blanks = [" ", "\t", "\n", "\v", "\f", "\r", "  ", " \n\t "]
        parts = ["a", "Be.", "x-1", "é", "<|", "'s", "42"]
        apart = {p: self._one(p) for p in parts}
        return all(self._one(s) == [] for s in blanks) and all(self._one(s + p + s + q + s) == apart[p] + apart[q] for s in blanks for p in parts for q in parts)

    def _splits_plainly(self) -> bool:
        """Whether letters and punctuation may go to the model by themselves: checked on probes with this file."""
        if self.tokenizer.normalizer is None or self.tokenizer.pre_tokenizer is None:
            return False
        for probe in ("Straßes.", "the", "Ébène,,", "a-", "QUE!!", "onthat###", "z<|"):
            core = probe.rstrip("!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")
            tail = probe[len(core) :]
            if [i for ids in self._parts([core.lower(), tail][: 1 + bool(tail)]) for i in ids] != self._one(probe):
                return False
        return True

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _parts(self, parts: list[str]) -> list[list[int]]:
        """Ids of lower-cased runs of letters and of runs of punctuation, by the model itself."""
        tokenize, letters = self.model.tokenize, self.letters
        return [[t.id for t in tokenize(p if p.isascii() else p.encode().decode("latin-1").translate(letters))] for p in parts]

    def ids(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all distinct chunks in a row, and bounds for each chunk."""
        self.store.forget()
        first = np.full(len(distinct), -1, np.int64)
        second = first.copy()
        odd = np.arange(len(distinct))
        if self.direct:
            parts = pc.extract_regex(distinct, pattern=_PLAIN)
            plain = parts.is_valid().to_numpy(zero_copy_only=False)
            at, odd = np.flatnonzero(plain), np.flatnonzero(~plain)
            chosen = parts.take(pa.array(at))
            cores, tails = pc.utf8_lower(chosen.field("a")).dictionary_encode(), chosen.field("b").dictionary_encode()
            first[at] = self.store.codes(cores.dictionary, self._parts)[cores.indices.to_numpy()]
            ends = self.store.codes(tails.dictionary, lambda new: [self._parts([t])[0] if t else [] for t in new])
            second[at] = ends[tails.indices.to_numpy()]
        values, bounds = self.store.values, self.store.bounds
        if len(odd):  # they follow the store for this call only
            found = self.whole(distinct.take(pa.array(odd)).to_pylist())
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            first[odd] = len(bounds) - 1 + np.arange(len(odd))
            values = np.concatenate((values, np.fromiter((i for ids in found for i in ids), np.uint32, int(sizes.sum()))))
            bounds = np.concatenate((bounds, bounds[-1] + np.cumsum(sizes)))
        empty = len(bounds) - 1
        bounds = np.concatenate((bounds, bounds[-1:]))
        codes = np.stack((first, np.where(second < 0, empty, second)), 1).ravel()
        ids, ends = gather(values, bounds, codes)
        return ids, ends[::2]


def chunk_table(path: str) -> ChunkTable:
    """The worker's table for a tokenizer file."""
    if path not in _tables:
        _tables[path] = ChunkTable(path)
    return _tables[path]


def gather(values: np.ndarray, bounds: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``values`` that ``codes`` name, in a row, and the number of values up to each code."""
    sizes = np.diff(bounds)[codes]
    ends = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(sizes, out=ends[1:])
    at = np.arange(ends[-1]) + np.repeat(bounds[:-1][codes] - ends[:-1], sizes)
    return values[at], ends


def encode_column(text: pa.Array, path: str, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each text (a null is empty) in a row, with ``end_id`` after each if given, and bounds for each text."""
    table, text = chunk_table(path), pc.fill_null(text, "")
    if table.chunked:
        chunks = pc.ascii_split_whitespace(text)
        coded = chunks.flatten().dictionary_encode()
        rows = chunks.offsets.to_numpy().astype(np.int64)
        ids, ends = gather(*table.ids(coded.dictionary), coded.indices.to_numpy())
        limits = ends[rows - rows[0]]
    else:
        found = table.whole(text.to_pylist())
        limits = np.concatenate(([0], np.cumsum(np.fromiter(map(len, found), np.int64, len(found))))).astype(np.int64)
        ids = np.fromiter((i for x in found for i in x), np.uint32, int(limits[-1]))
    if end_id is None:
        return ids, limits
    shifted = limits + np.arange(len(limits))
    out = np.empty(shifted[-1], np.uint32)
    mask = np.ones(len(out), bool)
    mask[shifted[1:] - 1] = False
    out[mask], out[~mask] = ids, end_id
    return out, shifted
