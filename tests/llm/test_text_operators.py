"""Operators on texts against brute force, with nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from sparkledger.llm import common, licenses, minhash, packing, pieces, substring, token_store, wordbpe

WORD, PIECE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, ids string, length string, _id string, kept string"
ODD = ["", " ", "a ", " a", "a  b  ", None, "it's a don't x's", "Á é ẛ̣ ß ẞ İ ı", "foo\x1cbar\x85baz\xa0qux z", "<|endoftext|> a<|startoftext|>b", "１２３ 123", "\t\n a\r\n", "日本語 テスト", "😀 x", "Σίσυφος ΣΣ", "a▁b c▁ ▁d", "x" * 9000, "\x00 \x00a"]


def documents(spark, texts, ids=None):
    rows = [(k, t, "x", "x", "x", "x") for k, t in zip(ids if ids is not None else range(len(texts)), texts)]
    return spark.createDataFrame(rows, SCHEMA)


def prose(n, seed, vocabulary=40):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORD)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab  \n\té'A.,▁1<s>|#Éß&", max_size=25), st.text(max_size=12)), max_size=8))
def test_chunk_tables_equal_the_libraries(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    column = pa.array(texts, pa.string())
    ids, bounds = wordbpe.encode_column(column, WORD)
    whole = wordbpe.chunk_table(WORD).tokenizer
    assert isinstance(whole, Tokenizer)
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
    model = pieces.marked_words(PIECE)
    assert isinstance(model.model, sentencepiece.SentencePieceProcessor)
    ids, bounds = model.encode_column(column)
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [model.model.encode(t or "") for t in texts]


def test_packing_covers_each_id_once(spark, tokenizer):
    texts = [*ODD, prose(5000, 1)]
    rows = packing.pack(documents(spark, texts), WORD).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    for k, text in enumerate(texts):
        own = sorted((r for r in rows if r.doc_id == k), key=lambda r: r.start)
        ids = np.frombuffer(b"".join(r.ids for r in own), "<u4").tolist()
        assert ids == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        assert [r.start for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))]
        assert all(r.length & (r.length - 1) == 0 and r.length <= 2048 and r.offset == 0 and r.doc_tokens == len(ids) for r in own)
        assert sum(r.length < 2048 for r in own) <= 11
    assert packing.digest(packing.pack(documents(spark, ["a b"]), WORD)).first().ids_crc32 is not None
    assert packing.pack(documents(spark, []), WORD).count() == 0
    with pytest.raises(ValueError):
        packing.pack(documents(spark, []), WORD, longest=100)
    wide = packing.pack(documents(spark, [prose(120_000, 8)]), WORD, longest=1 << 20).collect()
    assert len({r.sequence_id for r in wide}) == len(wide) and all(r.sequence_id >= 0 for r in wide) and max(r.length for r in wide) >= 1 << 17


def test_tokenizers_that_keep_blanks(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    rows = packing.pack(documents(spark, ODD), path).collect()
    for k, text in enumerate(ODD):
        own = b"".join(r.ids for r in sorted((r for r in rows if r.doc_id == k), key=lambda r: r.start))
        assert np.frombuffer(own, "<u4").tolist() == [*whole.encode(text or "", add_special_tokens=False).ids, 1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 70000), st.integers(0, 2**60 - 1)), max_size=700))
def test_simple8b_round_trip(values):
    ids = np.array(values, np.uint64)
    words, offsets = token_store.encode(ids)
    assert token_store.decode(words, offsets, len(ids)).tolist() == values
    assert len(offsets) == -(-len(values) // token_store.BLOCK) + 1 and offsets[-1] == len(words)
    for block in range(len(offsets) - 1):  # a block alone
        part = token_store.decode(words[offsets[block] : offsets[block + 1]], np.array([0, offsets[block + 1] - offsets[block]]), min(256, len(ids) - block * 256))
        assert part.tolist() == values[block * 256 : block * 256 + 256]


def test_simple8b_holds_small_ids_densely():
    words, _ = token_store.encode(np.ones(6000, np.uint64))
    assert len(words) <= 6000 / 50
    with pytest.raises(ValueError):
        token_store.encode(np.array([1 << 60], np.uint64))


def test_token_files(spark, tokenizer):
    texts = [*ODD, prose(3000, 2), "same", "same"]
    ids = [None, *random.Random(3).sample(range(-50, 200), len(texts) - 3), 77777, 77777]
    files = token_store.write(documents(spark, texts, ids), common.shared_dir(spark, "t"), WORD)
    got = sorted(token_store.read(spark, common.materialize(files, "f")).collect(), key=lambda r: r.start)
    order = sorted(zip(ids, texts), key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    start = 0
    for row, (key, text) in zip(got, order, strict=True):
        expected = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        assert (row.doc_id, row.start, row.n_tokens) == (key, start, len(expected))
        assert np.frombuffer(row.ids, "<u4").tolist() == expected and zlib.crc32(row.ids) == zlib.crc32(np.array(expected, "<u4").tobytes())
        start += len(expected)
    empty = token_store.write(documents(spark, []), common.shared_dir(spark, "t"), WORD)
    assert token_store.read(spark, common.materialize(empty, "f")).count() == 0


def test_piece_codes(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    texts = [*ODD, prose(2000, 4), "twice", "twice"]
    rows = {r.doc_id: r for r in pieces.digest(pieces.encode(documents(spark, texts), PIECE)).collect()}
    for k, text in enumerate(texts):
        ids = model.encode(text or "")
        assert rows[k].n_tokens == len(ids)
        assert rows[k].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[k].decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()
    assert pieces.encode(documents(spark, []), PIECE).count() == 0
    assert pieces.encode(documents(spark, [None, "", None]), PIECE, decode=False).collect() == [(0, []), (1, []), (2, [])]


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1))))
def test_packed_numbers_come_back(numbers):
    assert pieces.unpack(pieces.pack(np.array(numbers, np.int64))).tolist() == numbers


def test_each_distinct_marked_word_is_segmented_once(spark, monkeypatch):
    """Slices of a few bytes: their words go to buckets and ids come back to their positions, with and without room to remember words."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    monkeypatch.setattr(pieces, "SLICE_BYTES", 40)
    texts = [*ODD, *["the  hot the word "] * 300, *[prose(k, k) for k in range(60)], " ".join(f"u{k}" for k in range(70_000))]
    ids = [None, *[k // 2 for k in range(1, len(texts))]]
    docs = documents(spark, texts, ids).repartition(5)
    lists = common.materialize(pieces.word_lists(docs, PIECE, 3), "t")
    rows = pieces.segmented(lists, PIECE, 3).collect()
    packets = [r for r in rows if r.bucket >= 0]
    assert len(rows) == lists.count() and {r.bucket for r in rows} == {-1, 0, 1, 2}
    # As many words have ids as are listed; the wide slice has all of its own.
    sizes = [len(pieces.unpack(r["values"][0])) for r in packets]
    assert sum(sizes) == sum(len(pieces.unpack(r["values"][2])) for r in rows if r.bucket < 0) and max(sizes) > 20_000
    expected = sorted(((k, model.encode(t or ""), model.decode(model.encode(t or ""))) for k, t in zip(ids, texts)), key=str)
    for remembered, buckets in ((1_000_000, None), (10, 1)):
        monkeypatch.setattr(pieces, "REMEMBERED", remembered)
        got = sorted(((r.doc_id, list(r.ids), r.decoded) for r in pieces.encode(docs, PIECE, buckets=buckets).collect()), key=str)
        assert got == expected


def removed_by_hand(docs, window):
    """First places of all windows, then coverage; docs are (id, text)."""
    first, found = {}, {}
    for key, text in docs:
        words = (text or "").encode().split()
        for s in range(len(words) - window + 1):
            w = tuple(words[s : s + window])
            first[w] = min(first.get(w, (key, s)), (key, s))
    for n, (key, text) in enumerate(docs):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            if first[tuple(words[s : s + window])] < (key, s):
                gone[s : s + window] = [True] * window
        found[n] = (len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g).decode())
    return found


@pytest.mark.parametrize("window", [3, 8, 20, 50])
def test_repeated_passages(spark, monkeypatch, window):
    monkeypatch.setattr(substring, "TASK_BYTES", 3 << 20 if window == 8 else 4096)
    r = random.Random(window)
    passages = [prose(r.choice([window - 1, window, window + 5, 90]), 100 + k, 500) for k in range(5)]
    texts = [*ODD]
    for k in range(50):
        parts = [prose(r.randrange(40), 1000 + k, 3 if k % 9 == 0 else 400)]
        for _ in range(r.randrange(3)):
            parts += [r.choice(passages), prose(r.randrange(20), r.random(), 400)]
        texts.append(r.choice([" ", "\n", "  \t"]).join(parts))
    texts += texts[-5:]
    ids = r.sample(range(1000), len(texts))
    ids[-1], texts[-1] = ids[-2], texts[-2]  # a repeated row
    got = substring.mark_repeats(documents(spark, texts, ids), window, keep_cols=("text",)).collect()
    expected = {(ids[n], texts[n]): x for n, x in removed_by_hand(list(zip(ids, texts)), window).items()}
    assert len(got) == len(texts)
    for row in got:
        assert (row.n_words, row.n_removed, row.kept_text) == expected[row.doc_id, row.text]
    assert substring.mark_repeats(documents(spark, []), window).count() == 0


def test_spans_leave_other_texts_alone(spark):
    repeat = prose(30, 5, 1000)
    texts = [f"one  two\n{repeat}", f"start\n\n{repeat} end  of it", None, "plain   text"]
    rows = {r.doc_id: r.kept_text for r in substring.mark_repeats(documents(spark, texts), as_text="spans").collect()}
    assert rows == {0: texts[0], 1: "start\n\nend  of it", 2: None, 3: "plain   text"}


@pytest.mark.parametrize("modulus", list(substring.COVERS))
def test_difference_covers(modulus):
    cover = substring.COVERS[modulus]
    assert {(a - b) % modulus for a in cover for b in cover} == set(range(modulus))


def components_by_hand(sets, percent):
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, size, percent):
    r = random.Random(size)
    texts = [*ODD, "one two", "One TWO", "one two three", "a b c d e f"]
    for base in range(25):
        words = prose(r.choice([8, 60, 200]), 50 + base, 3000).split()
        for _ in range(r.choice([1, 2, 6, 40])):
            copy = list(words)
            for _ in range(r.choice([0, 1, 1, 2, 5])):
                copy[r.randrange(len(copy))] = f"z{r.random()}"
            texts.append(r.choice([str.upper, str])(" ".join(copy)))
    lower = [(t or "").encode().lower().split() for t in texts]
    sets = [{tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set()) for w in lower]
    expected = components_by_hand(sets, percent)
    got = {x.doc_id: x for x in minhash.near_duplicates(documents(spark, texts), size, percent).collect()}
    for k in range(len(texts)):
        assert (got[k].n_shingles, got[k].component_id, got[k].kept) == (len(sets[k]), expected[k], expected[k] == k), texts[k]


def test_near_duplicates_of_odd_tables(spark):
    assert minhash.near_duplicates(documents(spark, [])).count() == 0
    rows = minhash.near_duplicates(documents(spark, ["a b c d e f g", "a b c d e f g", "a b c d e f g", None], [None, 5, 5, 6])).collect()
    assert sorted((str(x.doc_id), str(x.component_id), x.kept) for x in rows) == [("5", "5", True), ("5", "5", True), ("6", "6", True), ("None", "None", True)]


def test_rows_that_share_an_id_are_judged_by_their_own_texts(spark):
    a, b = prose(100, 1, 3000).split(), prose(100, 2, 3000)
    near = " ".join([*a[:50], "other", *a[51:]])
    rows = minhash.near_duplicates(documents(spark, [near, " ".join(a), b], [2, 5, 5]), 3, 85).collect()
    assert sorted((x.doc_id, x.component_id, x.kept) for x in rows) == [(2, 2, True), (5, 2, False), (5, 5, True)]


@pytest.mark.parametrize("seed", range(3))
def test_random_texts_with_repeated_ids(spark, seed):
    r = random.Random(seed)
    texts, ids = [], []
    for base in range(15):
        words = prose(60, 300 + base + 50 * seed, 3000).split()
        for _ in range(r.choice([1, 2, 5])):
            copy = list(words)
            for _ in range(r.choice([0, 1, 2, 4])):
                copy[r.randrange(60)] = f"z{r.random()}"
            texts.append(" ".join(copy))
            ids.append(r.randrange(14))
    sets = [{tuple(w[i : i + 3]) for i in range(len(w) - 2)} for w in (t.split() for t in texts)]
    root = components_by_hand(sets, 85)
    least = {c: min(i for i, d in zip(ids, root) if d == c) for c in root}
    got = minhash.near_duplicates(documents(spark, texts, ids), 3, 85).collect()
    assert sorted((x.doc_id, x.n_shingles, x.component_id) for x in got) == sorted((i, len(s), least[c]) for i, s, c in zip(ids, sets, root))


def test_large_group_of_near_copies_is_one(spark):
    r = random.Random(9)
    words = prose(120, 1, 5000).split()
    texts = []
    for k in range(400):
        copy = list(words)
        for _ in range(2):
            copy[r.randrange(120)] = f"n{k}"
        texts.append(" ".join(copy))
    rows = minhash.near_duplicates(documents(spark, texts), 3, 85).collect()
    lower = [t.split() for t in texts]
    expected = components_by_hand([{tuple(w[i : i + 3]) for i in range(len(w) - 2)} for w in lower], 85)
    assert {x.doc_id: x.component_id for x in rows} == dict(enumerate(expected))


@pytest.mark.parametrize("block", [minhash.BLOCK, 60_000])
def test_links_in_a_family_just_below_the_threshold(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    common_part = prose(900, 3, 10**6).split()
    own = [[f"o{k}x{i}" for i in range(100)] for k in range(300)]
    for k in range(0, 60, 2):  # pairs that share 26 more words: 926 / 1074, the family 900 / 1100
        own[k + 1][:26] = own[k][:26]
    for k in range(60, 80):  # a group of its own that is close to itself
        own[k][:95] = own[60][:95]
    texts = [" ".join(common_part + x) for x in own]
    random.Random(4).shuffle(texts)
    expected = components_by_hand([set(t.split()) for t in texts], 85)
    assert len(set(expected)) == 300 - 30 - 19
    rows = minhash.near_duplicates(documents(spark, texts), 1, 85).collect()
    assert {x.doc_id: x.component_id for x in rows} == dict(enumerate(expected))


def phrases_by_hand(text):
    import re

    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)
    found = [(i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    return len(words), len(found), min((i for i, _ in found), default=None), max((i for i, _ in found), default=None), ",".join(sorted({x for _, x in found}))


def test_license_spans(spark):
    texts = [*ODD, "Released under the MIT License.", "x MIT-license y; GNU General\nPublic License and gnu general public", "CC BY cc by", "mitlicense MIT Licenses", "été MIT License été", "of the and to " * 50]
    texts += [f"before {t} after" for _, t in licenses.TEMPLATES]
    rows = {r.doc_id: r for r in licenses.scan(documents(spark, texts)).collect()}
    for k, text in enumerate(texts):
        r = rows[k]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == phrases_by_hand(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) or not r.base_labels
        assert 0 <= r.score <= 1
    for k, (label, _) in enumerate(licenses.TEMPLATES):
        r = rows[len(texts) - len(licenses.TEMPLATES) + k]
        assert label in r.labels.split(",") and r.score == 1.0
        assert any(s.label == label and s.first_word == 1 and s.last_word == r.n_words - 2 for s in r.spans)
    assert rows[len(ODD) + 5].labels == "" and licenses.scan(documents(spark, [])).count() == 0


def test_licenses_in_long_edited_and_mixed_texts(spark):
    full = {label: text for label, text in licenses.TEMPLATES if len(text) > 600}
    filler = prose(300, 7, 2000)
    mit, bsd = full["mit"].split(), full["bsd-3-clause"].split()
    edited = list(mit)
    for k in range(10, len(edited), 17):
        edited[k] = "changed"
    half = len(mit) // 2
    texts = [
        f"{filler} {full['zlib']} {filler}", f"{filler} {' '.join(edited)}", f"{' '.join(mit[:half])} {filler} {full['unlicense']} {filler} {' '.join(bsd)}",
        " ".join(bsd[: len(bsd) // 3]), "the software is " * 40 + filler, filler * 20, "own words one two three four five six seven eight nine ten",
    ]
    table = spark.createDataFrame([("own", texts[-1]), (None, "x"), ("y", None)], "label string, text string")
    rows = {r.doc_id: r for r in licenses.scan(documents(spark, texts), table).collect()}
    found = [set(filter(None, rows[k].labels.split(","))) for k in range(len(texts))]
    assert found[0] == {"zlib"} and rows[0].score == 1.0 and "mit" in found[1] and rows[1].score >= 0.8
    assert {"mit", "unlicense", "bsd-3-clause"} <= found[2] and found[3] & {"bsd", "bsd-3-clause"}
    assert found[4] == set() and found[5] == set() and found[6] == {"own"}
    span = next(s for s in rows[0].spans if s.label == "zlib")
    assert (span.first_word, span.last_word) == (300, 300 + len(licenses._hashes(full["zlib"])) - 1)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=12), min_size=1, max_size=4), st.lists(st.integers(0, 4), max_size=20))
def test_automaton_gives_longest_runs(lists, text):
    automaton = licenses.Automaton(lists)
    runs = {tuple(x[i:j]) for x in lists for i in range(len(x)) for j in range(i + 1, len(x) + 1)}
    longest = [max((n for n in range(1, e + 2) if tuple(text[e + 1 - n : e + 1]) in runs), default=0) for e in range(len(text))]
    expected = [(e, n) for e, n in enumerate(longest) if n >= licenses.LEAST_RUN and (e + 1 == len(text) or longest[e + 1] <= n)]
    found = automaton.matches(text)
    assert [(e, n) for e, n, _ in found] == expected
    for e, n, state in found:
        for number, place in automaton.ends[state].items():
            assert lists[number][place + 1 - n : place + 1] == text[e + 1 - n : e + 1]
