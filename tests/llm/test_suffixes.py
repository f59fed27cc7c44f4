"""Removal of repeated strings against brute force, with nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import random
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from sparkledger.llm import common, suffixes

SCHEMA = "doc_id long, text string, kept string, n_bytes string, _id string, _group string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


def by_hand(rows, window):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for (k, _), t in zip(rows, texts):
        gone = [False] * len(t)
        for i in range(len(t) - window + 1):
            if seen[t[i : i + window]] > 1:
                gone[i : i + window] = [True] * window
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((k, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, window):
    got = sorted(map(tuple, suffixes.digest(suffixes.mark_repeats(table(spark, rows), window)).collect()), key=str)
    assert got == by_hand(rows, window)


def rows_of(seed, texts, letters, longest, window):
    r = random.Random(seed)
    text = lambda n: "".join(r.choice(letters) for _ in range(n))
    passages = [text(r.randrange(window // 2, 3 * window)) for _ in range(6)]
    rows = []
    for k in range(texts):
        parts = [r.choice(passages) if r.random() < 0.4 else text(r.randrange(longest)) for _ in range(r.randrange(5))]
        rows.append((k % (texts - 3), "".join(parts)))
    rows += [(900, None), (901, ""), (None, text(2 * window)), (902, letters[0] * (4 * window)), (903, passages[0][: window - 1]), (904, "\x00" * window), (905, "\x00" * (window + 1))]
    return rows + rows[:4]


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(common, "group_bytes", lambda total: 4000)
    monkeypatch.setattr(suffixes, "PIECE", 997)
    monkeypatch.setattr(suffixes, "BUCKET", 40)
    monkeypatch.setattr(suffixes, "RANGE_BYTES", 3000)


@pytest.mark.parametrize("window, letters", [(40, "abcdefgh é"), (9, "ab"), (100, "ab\x00"), (1, "abcdefghijklmnop日")])
def test_removal_equals_brute_force(spark, small, window, letters):
    check(spark, rows_of(window, 40, letters, 4 * window, window), window)


@pytest.mark.parametrize("local, crowd", [(1, 1), (2, 5), (10**6, 3)])
def test_crowded_cores_are_dealt_into_finer_ranges(spark, small, monkeypatch, local, crowd):
    """Many texts that share a passage amid different surroundings, so that its cores have many contexts."""
    monkeypatch.setattr(suffixes, "LOCAL", local)
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    r = random.Random(8)
    text = lambda n: "".join(r.choice("abcdefghij ") for _ in range(n))
    passage = text(70)
    rows = [(k, text(r.randrange(60)) + passage[r.randrange(20) : 70 - r.randrange(15)] + text(r.randrange(60))) for k in range(60)]
    for window in (40, 50):
        check(spark, rows, window)


@pytest.mark.parametrize("window", [40, 100])
def test_windows_of_an_anchor_stay_together_at_ends_of_pieces(spark, small, monkeypatch, window):
    """Tasks that find anchors and groups that send suffixes cut their bytes into pieces at different places."""
    r = random.Random(window)
    text = lambda n: "".join(r.choice("abcdefghij ") for _ in range(n))
    passages = [text(window + k % 6) for k in range(60)]
    rows = [(k, text(r.randrange(2 * window)) + passages[k % 60] + text(r.randrange(2 * window))) for k in range(120)]
    data, offsets = common.text_bytes(pa.array([t for _, t in rows]))
    found = []
    for size in (10**6, 997, 3 * window):
        monkeypatch.setattr(suffixes, "PIECE", size)
        parts = [(piece.low, piece.items(suffixes.widths_of(window)[:1], [])[0]) for piece in suffixes.pieces(data, offsets, window)]
        found.append(sorted(x for low, i in parts for x in zip((i["anchor"] + low).tolist(), i["near"].tolist(), i["far"].tolist(), i["context"].tolist())))
    assert found[0] == found[1] == found[2]
    check(spark, rows, window)


def test_whole_size(spark):
    check(spark, rows_of(4, 12, "etaoinshrdlu ", 900, 400), 400)


def test_odd_tables(spark):
    assert suffixes.mark_repeats(table(spark, [])).collect() == []
    check(spark, [(1, None), (1, None), (2, "")], 400)
    rows = suffixes.mark_repeats(spark.createDataFrame([(1, "x" * 500, "en")], "doc_id long, text string, lang string"), keep_cols=("lang",)).collect()
    assert [tuple(x) for x in rows] == [(1, "en", 500, 500, 1, b"")]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.text(alphabet="ab", max_size=8).map(str.encode), min_size=1, max_size=12), min_size=1, max_size=9))
def test_loser_tree_merges_front_coded_runs(lists):
    runs = []
    for strings in lists:
        strings = sorted(strings)
        n = len(strings)
        runs.append(suffixes.Run(suffixes.Run.coded(strings, [s[:2] for s in strings], list(range(n)), [7] * n, [3] * n)))
    found = list(suffixes.merged(runs))
    texts = [t for _, t, _ in found]
    assert texts == sorted(s for strings in lists for s in strings)
    assert [x[0] for x in found] == [0, *(suffixes.common_prefix(a, b) for a, b in zip(texts, texts[1:]))]
    assert all(entry[0] == text[:2] for _, text, entry in found)


def test_known_prefixes_are_not_compared_again(monkeypatch):
    """Bytes compared while merging stay near the sum of what neighbours share, far below all strings' lengths times the tree's depth."""
    compared = [0]
    plain = suffixes.common_prefix

    def counting(a, b, known=0):
        found = plain(a, b, known)
        compared[0] += found - known + 1
        return found

    r = random.Random(2)
    strings = [b"p" * 300 + bytes(r.choice(b"ab") for _ in range(40)) for _ in range(400)]
    runs = [sorted(strings[k::16]) for k in range(16)]
    coded = [suffixes.Run(suffixes.Run.coded(x, [b""] * len(x), [0] * len(x), [0] * len(x), [0] * len(x))) for x in runs]
    monkeypatch.setattr(suffixes, "common_prefix", counting)
    assert [t for _, t, _ in suffixes.merged(coded)] == sorted(strings)
    assert compared[0] < 16 * 300 + 400 * 40
