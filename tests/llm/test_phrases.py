"""Phrases against brute force, with nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns and forced collisions."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from sparkledger.llm import common, phrases

SCHEMA = "doc_id long, text string, lang string, phrase string, n string, _text string, _group string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


def counted(rows):
    n, f = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    return n, f


def by_hand(rows, least, most):
    n, f = counted(rows)
    cands = {key: a for key, a in f.items() if len(key[1]) >= 2 and a >= least}
    out = []
    for (lang, words), a in cands.items():
        if len(words) == 2 and any(100 * b >= 50 * a for (m, long), b in cands.items() if m == lang and len(long) == 3 and words in (long[:2], long[1:])):
            continue
        score, _, l, r = min((1000000 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k, f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words)))
        out.append((lang, " ".join(words), a, l, r, n[lang], score))
    found = []
    for lang in {x[0] for x in out}:
        mine = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))[:most]
        found += [(lang, k + 1, *x[1:]) for k, x in enumerate(mine)]
    return sorted(found)


def rows_of(seed, texts=60):
    r = random.Random(seed)
    words = ["the", "New", "york", "city", "a", "é", "日本", "the.", "x,y", "\tb", "\n", "İ", "z" * 50]
    rows = [(k % 40, " ".join(r.choice(words) for _ in range(r.randrange(0, 60))), r.choice(["en", "fr", None])) for k in range(texts)]
    rows += [(1, None, "en"), (None, "", None), (None, "  \t. ,", "de"), (5, "new york city " * 300, "en"), (6, "w1 w2 " * 2000, None)]
    return rows + rows[:9]


@pytest.fixture
def small_groups(monkeypatch):
    monkeypatch.setattr(common, "group_bytes", lambda total, factor: 2000)
    monkeypatch.setattr(phrases, "SHARD", 3000)


@pytest.mark.parametrize("most", [2000, 7])
def test_phrases_equal_brute_force(spark, small_groups, most):
    rows = rows_of(1)
    got = sorted(map(tuple, phrases.collocations(table(spark, rows), most=most).collect()))
    assert got == by_hand(rows, 10, most) and len(got) >= 7


def test_joins_by_shuffle_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BROADCAST_ROWS", 0)
    rows = rows_of(2)
    assert sorted(map(tuple, phrases.collocations(table(spark, rows), least=4).collect())) == by_hand(rows, 4, 2000)


def test_empty_tables(spark):
    assert phrases.collocations(table(spark, [])).collect() == []
    assert phrases.collocations(table(spark, [(1, None, None), (2, "", "en")])).collect() == []


def _grams(rows):
    return phrases.Grams(pa.array([t or "" for _, t, _ in rows], pa.string()), pa.array([lang or "und" for _, _, lang in rows]))


def _counted(grams, second):
    raw, found = grams.data.tobytes(), Counter()
    for size in (1, 2, 3):
        _, _, at, n = grams.counted(size, lambda prints: np.ones(len(prints), bool), second, grams.word_ids())
        for i, c in zip(at.tolist(), n.tolist()):
            found[grams.langs[grams.lang[grams.row[i]]], tuple(raw[grams.starts[i + k] : grams.ends[i + k]].decode() for k in range(size))] += c
    return found


def test_collisions_are_found_in_the_text():
    """With first hashes of five bits nearly all words and n-grams collide, and counts are still exact; if both collide, the text tells."""
    rows = rows_of(3)
    grams = _grams(rows)
    second = grams.second()
    grams.hashes = grams.hashes & np.uint64(31)
    assert _counted(grams, second) == counted(rows)[1]
    with pytest.raises(ValueError):
        grams.hashes = grams.hashes & np.uint64(1)
        _counted(grams, second & np.uint64(1))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**40), max_size=50), st.sampled_from([1, 2**14, 2**18, 2**40]))
def test_packed_integers(values, scale):
    values = np.unique(np.array([v % (scale * 40) for v in values], np.uint64))
    assert np.array_equal(phrases.unpacked(phrases.packed(values)), values)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(1, 300), st.integers(1, 2**50)), max_size=30))
def test_small_counts(values):
    assert phrases.counts_of(phrases.small_counts(np.array(values, np.int64)), len(values)).tolist() == values
