"""Vectors, archives, the quality model, components and the pipeline."""

import hashlib
import math
import random
import struct
from collections import Counter

import numpy as np
import pytest

from sparkledger.llm import ann, common, quality_lm, queries, vector_dedup, warc
from sparkledger.llm.components import components

VECTORS = "vec_id long, embedding array<float>, label int, id string, x string, n_links string"


def vectors(spark, items):
    return spark.createDataFrame([(k, v, 0, "i", "x", "n") for k, v in items], VECTORS)


def clustered(n, d, seed):
    r = np.random.default_rng(seed)
    x = r.standard_normal((n, d))
    for k in range(n // 2, n):
        x[k] = x[r.integers(0, 40)] + r.standard_normal(d) * r.choice([0.0, 0.05, 0.2, 0.3])
    return x.astype(np.float32)


ODD = [(900001, None), (900002, [0.0] * 16), (900003, [float("nan")] * 16), (900004, [1.0, None] + [0.0] * 14), (900005, [float("inf")] * 16), (900006, [1.0, 2.0]), (None, [1.0] * 16), (900007, [])]


def test_near_vectors(spark):
    x = clustered(300, 16, 1)
    items = [(k * 3, v.tolist()) for k, v in enumerate(x)] + ODD + [(0, x[0].tolist())]
    got = vector_dedup.near_vectors(vectors(spark, items)).collect()
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    root = list(range(len(x)))
    for _ in range(len(x)):
        new = [min([root[k], *(root[j] for j in np.flatnonzero(links[k]))]) for k in range(len(x))]
        if new == root:
            break
        root = new
    by = {r.vec_id: r for r in got}
    assert len(got) == len(items)
    for k in range(len(x)):
        r = by[3 * k]
        assert (r.n_links, r.component_id, r.kept) == (links[k].sum(), 3 * root[k], root[k] == k)
    for key, _ in ODD:
        assert by[key].n_links == 0 and by[key].kept and by[key].component_id == key
    assert vector_dedup.near_vectors(vectors(spark, [])).count() == 0


def test_near_vectors_over_cells_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "CELL", 40)
    monkeypatch.setattr(vector_dedup, "BLOCK", 25)
    x = clustered(400, 16, 2)
    got = vector_dedup.near_vectors(vectors(spark, [(k, v.tolist()) for k, v in enumerate(x)])).collect()
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.9).sum(1) - 1
    found = np.array([r.n_links for r in sorted(got, key=lambda r: r.vec_id)])
    assert (found <= links).all() and found.sum() >= 0.98 * links.sum()


def test_near_vectors_of_several_lengths(spark):
    items = [(0, [1.0, 0.0]), (1, [2.0, 0.001]), (2, [0.0, 1.0]), (3, [1.0, 0.0, 0.0]), (4, [1.0, 0.1, 0.0]), (5, [1.0, 0.0]), (6, [1.0])]
    rows = {r.vec_id: (r.n_links, r.component_id) for r in vector_dedup.near_vectors(vectors(spark, items)).collect()}
    assert rows == {0: (2, 0), 1: (2, 0), 2: (0, 2), 3: (1, 3), 4: (1, 3), 5: (2, 0), 6: (0, 6)}


def shared_cells(unit, aside, k, r):
    """Share of pairs at the threshold around vectors that the fit has not seen which share a cell, and cells of a vector."""
    centres, beside = vector_dedup.fitted(unit, k, 0.9)
    t = r.standard_normal(aside.shape)
    t -= (t * aside).sum(1, keepdims=True) * aside
    b = 0.9 * aside + np.sqrt(1 - 0.81) * t / np.linalg.norm(t, axis=1, keepdims=True)
    near = lambda x: (s := x @ centres.T) >= s.max(1, keepdims=True) - beside
    a, b = near(aside), near(b)
    return (a & b).any(1).mean(), a.sum(1).mean()


@pytest.mark.parametrize("d", [2, 4, 8, 16, 64])
def test_pairs_at_the_threshold_share_a_cell(d):
    r = np.random.default_rng(d)
    unit = vector_dedup._unit(r.standard_normal((24_000, d)))
    assert shared_cells(unit[:20_000], unit[20_000:], 39, r)[0] >= 0.998


@pytest.mark.parametrize("clusters", [0, 400])
def test_pairs_share_a_cell_with_as_many_cells_as_probes(clusters):
    r = np.random.default_rng(clusters)
    x = r.standard_normal((65_536 + 1500, 64))
    if clusters:
        x = 0.1 * x + r.standard_normal((clusters, 64))[r.integers(0, clusters, len(x))]
    unit = vector_dedup._unit(x)
    share, cells = shared_cells(unit[:65_536], unit[65_536:], vector_dedup.MOST_CELLS, r)
    assert share >= 0.99, (share, cells)


@pytest.mark.parametrize("part_bytes", [16 << 20, 1])
def test_one_bit_search(spark, monkeypatch, part_bytes):
    monkeypatch.setattr(ann, "PART_BYTES", part_bytes)
    monkeypatch.setattr(ann, "BLOCK", 300)
    x = clustered(3000, 16, 3)
    x[7] = x[9]  # a tie
    table = vectors(spark, [(k, v.tolist()) for k, v in enumerate(x)] + ODD)
    got = ann.search(table, table.where("vec_id % 20 = 0")).collect()
    asked = range(0, len(x), 20)
    assert len(got) == 20 * len(asked)
    hit = 0
    for q in asked:
        score = ann.in_order(x.astype(float), np.tile(x[q].astype(float), (len(x), 1)))
        order = [k for k in sorted(range(len(x)), key=lambda k: (-score[k], k)) if k != q][:20]
        rows = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in rows] == list(range(1, 21))
        assert all(r.score == score[r.vec_id] for r in rows)
        hit += len(set(order) & {r.vec_id for r in rows})
    assert hit >= 0.99 * 20 * len(asked)


def test_search_of_small_and_empty_tables(spark):
    few = vectors(spark, [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (3, [1.0, 1.0])])
    rows = sorted(tuple(r) for r in ann.search(few, few.where("vec_id % 20 = 0")).collect())
    assert rows == [(0, 1, 3, 1.0), (0, 2, 20, 0.0), (20, 1, 3, 1.0), (20, 2, 0, 0.0)]
    none = vectors(spark, [])
    assert ann.search(none, none).count() == 0
    # Lengths are kept apart, whichever is the more common one.
    mixed = vectors(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [0.25, 0.0]), *[(k, [float(k), 1.0, 0.0]) for k in range(3, 9)], (20, [1.0, 2.0, 3.0])])
    rows = sorted(tuple(r) for r in ann.search(mixed, mixed.where("vec_id % 20 = 0"), 2).collect())
    assert rows == [(0, 1, 1, 0.5), (0, 2, 2, 0.25), (20, 1, 8, 10.0), (20, 2, 7, 9.0)]


@pytest.mark.parametrize("d", [5, 32, 200])
def test_estimates_keep_their_bounds(d):
    r = np.random.default_rng(5)
    x, q = r.standard_normal((2000, d)), r.standard_normal((20, d))
    x[3] = x.mean(0)
    centre, turn = x.mean(0), ann.rotation(d, 512)
    codes = ann.Codes.of(x, centre, turn)
    inside = []
    for one in q:
        guess, bound = codes.estimate(ann.Query(one, centre, turn), 0, 2000)
        inside.append(np.abs(guess - x @ one) <= bound)
    assert np.mean(inside) > 0.998


PAGES = "page_id long, url string, html string, digest string, path string, first_page string"


def test_archives(spark):
    long = "<p>été</p>" * 40
    rows = [(5, "u5", long), (3, "u3", long), (9, None, long), (1, "u1", "short"), (2, "u2", "short"), (4, "a\r\nb", None), (None, "n", long), (8, "e", ""), (7, "b", "é" * 50), (6, "b", "é" * 50), (10, "c", "x" * 99), (11, "c", "x" * 99), (12, "v", "y" * 300_000)]
    rows += [(100 + k, f"u{k}", f"<html><head><title>page {k}</title></head><body>{long}{k}</body></html>") for k in range(60)]
    copies = [(400 + k, "s", "<b>same sample</b>" * 20) for k in range(300)]  # the sample takes different records only
    table = spark.createDataFrame([(*r, "d", "p", "f") for r in rows], PAGES)
    assert len(warc.build_dictionary(spark.createDataFrame([(*r, "d", "p", "f") for r in copies], PAGES))) == 0
    archives = common.materialize(warc.write(table, common.shared_dir(spark, "w")), "a")
    got = sorted(warc.read(spark, archives).collect(), key=lambda r: (r.page_id is None, r.page_id))
    expected = {}
    for page, _, html in rows:
        payload = (html or "").encode()
        first = min(p for p, _, h in rows if h == html and p is not None) if page is not None else None
        again = page is not None and len(payload) >= 100 and first != page
        expected[page] = (len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response", first if again else None, None if again else payload.decode())
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.html) for r in got} == expected
    assert sum(r.n_records for r in archives.collect()) == len(rows)
    path = archives.first().path.removeprefix("file:")
    with open(path.replace("///", "/"), "rb") as f:
        magic, size = struct.unpack("<II", f.read(8))
        assert magic == warc.DICTIONARY_MAGIC and size > 0
    import re
    from glob import glob

    folder, ids, referred = path.rsplit("/", 1)[0].replace("///", "/"), {}, []
    for name in glob(f"{folder}/*.warc.zst"):
        with open(name, "rb") as f:
            records = [warc.parse_record(r) for r in warc._frames(f)]
        assert records[0][0]["warc-type"] == "warcinfo" and all(r[0]["warc-type"] != "warcinfo" for r in records[1:])
        for fields, block in records:
            assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", fields["warc-date"]) and re.fullmatch(r"<urn:uuid:[0-9a-f-]{36}>", fields["warc-record-id"])
            ids[fields["warc-record-id"]] = fields["warc-type"]
            if fields["warc-type"] == "revisit":
                assert fields["warc-refers-to-date"] == fields["warc-date"] and fields["warc-profile"].endswith("identical-payload-digest")
                referred.append((fields["warc-refers-to"], fields["warc-refers-to-target-uri"]))
            if fields["warc-type"] in ("response", "revisit"):
                assert fields["content-type"] == "application/http; msgtype=response" and block.startswith(b"HTTP/1.1 200 OK\r\n")
    assert len(ids) >= len(rows) and referred and all(ids[to] == "response" for to, _ in referred) and {"u3", "b"} == {uri for _, uri in referred}
    empty = common.materialize(warc.write(spark.createDataFrame([], PAGES), common.shared_dir(spark, "w")), "a")
    assert warc.read(spark, empty).count() == 0


def test_components(spark):
    r = random.Random(1)
    pairs = [(k, k + 1) for k in range(0, 60)] + [(100 + r.randrange(50), 100 + r.randrange(50)) for _ in range(30)] + [(500, k) for k in range(501, 560)] + [(7, 7), (None, 3), (1, 0)]
    got = dict(tuple(x) for x in components(spark.createDataFrame(pairs, "a long, b long")).collect())
    root = {x: x for p in pairs for x in p if x is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in root if find(x) != x}


def kneser_ney(texts):
    """p(byte | four before) as plain dictionaries."""
    order = quality_lm.ORDER
    grams = Counter()
    for text in texts:
        s = [10] * (order - 1) + list(text.encode())
        grams.update(tuple(s[i : i + order]) for i in range(len(s) - order + 1))
    counts = [grams]
    for _ in range(order - 1):
        counts.append(Counter(g[1:] for g in counts[-1]))
    levels = []
    for c in reversed(counts):
        n = Counter(c.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else 0.5
        raw = [(k - (k + 1) * y * n[k + 1] / n[k]) if n[k] else k / 2 for k in (1, 2, 3)]
        d = [max(0.05, min(k - 0.05, x)) for k, x in zip((1, 2, 3), raw)]
        total, left = Counter(), Counter()
        for g, v in c.items():
            total[g[:-1]] += v
            left[g[:-1]] += d[min(v, 3) - 1]
        levels.append((c, d, total, left))

    def p(g):
        below = 1 / 256 if len(g) == 1 else p(g[1:])
        c, d, total, left = levels[len(g) - 1]
        if g[:-1] not in total:
            return below
        v = c.get(g, 0)
        return (v - d[min(v, 3) - 1] if v else 0) / total[g[:-1]] + left[g[:-1]] / total[g[:-1]] * below

    return p


def bits_by_hand(p, text):
    s = [10] * (quality_lm.ORDER - 1) + list(text.encode())
    return -sum(math.log2(p(tuple(s[i : i + quality_lm.ORDER]))) for i in range(len(text.encode()))) / len(text.encode())


def test_quality_model(spark, monkeypatch, tmp_path):
    r = random.Random(2)
    syllables = ["ta", "ren", "mi", "so", "lu", "bér"]
    text = lambda n: " ".join("".join(r.choice(syllables) for _ in range(r.randrange(1, 4))) for _ in range(n)).capitalize() + "."
    good = [text(60) for _ in range(80)]
    junk = ["#$%@ !!" * 30, "QWXZ KJJJ" * 20]
    rows = [(k, t, "aa") for k, t in enumerate(good)] + [(100, junk[0], "aa"), (101, junk[1], "aa"), (102, "", "aa"), (103, None, "aa"), (104, "unknown tongue", "zz"), (105, good[0], None), (None, text(60), "aa"), (3, good[3], "aa"), (106, text(60) * 400, "aa")]
    docs = spark.createDataFrame([(*x, "c", "p", "m") for x in rows], "doc_id long, text string, lang string, accepted string, perplexity string, _metadata string")
    labels = spark.createDataFrame([(k, 1, None if k % 2 else 0) for k in range(60)] + [(60, 1, 1), (100, 0, 0), (None, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality_lm.classify(docs, labels, keep_cols=("text",)).collect()
    assert len(got) == len(rows)
    by = {x.doc_id: x for x in got}
    assert not by[100].accepted and not by[101].accepted and not by[102].accepted and not by[103].accepted
    assert by[104].accepted and by[104].perplexity is None and by[105].accepted and by[105].perplexity is None

    # Every text, trusted or not, is held against the model of the half that its id is not in.
    half = {x.id: x.h for x in spark.createDataFrame([(x[0],) for x in rows], "id long").selectExpr("id", "pmod(xxhash64(id), 2) AS h").collect()}
    keys = [*range(60), 3]  # the third text is there twice
    models = {h: kneser_ney([good[k] for k in keys if half[k] != h]) for h in (0, 1)}
    for key in (0, 1, 2, 70, 71, 100, 101, 106, None):
        assert abs(math.log2(by[key].perplexity) - bits_by_hand(models[half[key]], by[key].text)) < 0.001
    # Of 61 scores the quantiles are the ends.
    held = [bits_by_hand(models[half[k]], good[k]) for k in keys]
    middle, unsure = sorted(held)[30], quality_lm.UNSURE / 61**0.5
    low, high = min(held) - unsure * (middle - min(held)), max(held) + unsure * (max(held) - middle)
    assert abs(math.log2(by[0].low_limit) - low) < 0.002 and abs(math.log2(by[0].high_limit) - high) < 0.002
    for k in [*range(80), 106, None]:
        assert by[k].accepted == (by[k].low_limit <= by[k].perplexity <= by[k].high_limit)
    assert all(by[k].accepted for k in range(80))
    assert quality_lm.classify(docs.limit(0), labels).count() == 0
    assert quality_lm.classify(docs, labels.limit(0)).where("accepted").count() == len(rows) - 2

    # How rows fall into slices, files and pieces of work changes nothing.
    monkeypatch.setattr(quality_lm, "ROWS", 7)
    monkeypatch.setattr(quality_lm, "SLICE", 3000)
    docs.drop("_metadata").repartition(3).write.parquet(f"{tmp_path}/docs")
    again = quality_lm.classify(spark.read.parquet(f"{tmp_path}/docs"), labels, keep_cols=("text",)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_slice_scores():
    r = np.random.default_rng(3)
    grams = np.unique(r.integers(0, 1 << 45, 50_000))
    bits = r.integers(0, 1 << 32, len(grams)).astype(np.uint32)
    table = quality_lm._Scores(grams, bits)
    assert len(table.more) and (table.of(grams) == bits).all()
    twice = quality_lm._Scores(np.repeat(grams, 2), np.repeat(bits, 2))
    assert (twice.of(grams) == bits).all()
    with pytest.raises(ValueError):
        table.of(np.array([1 << 50]))


def test_several_languages(spark):
    rows = [(k, f"text of {'abcde'[k % 5] * 9} and more {k}", f"l{k % 5}") for k in range(50)] + [(99, "else", "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(50)], "doc_id long, quality int, toxic int")
    got = quality_lm.classify(docs, labels).collect()
    assert sorted(x.doc_id for x in got) == sorted(k for k, _, _ in rows)
    assert all((x.perplexity is None) == (x.doc_id == 99) for x in got)


SF = "/root/testdata/sf0.001"


def test_held_out_quality(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    seen = labels.where("doc_id % 2 = 0")
    held = quality_lm.classify(docs, seen).join(labels.where("doc_id % 2 = 1 and toxic = 0"), "doc_id")
    counts = {(r["quality"], r["accepted"]): r["count"] for r in held.groupBy("quality", "accepted").count().collect()}
    good, bad = counts.get((1, True), 0), counts.get((0, False), 0)
    assert good >= 0.95 * (good + counts.get((1, False), 0)) and bad >= 0.7 * (bad + counts.get((0, True), 0))


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_registered_queries(spark, name):
    assert queries.QUERIES[name](spark, SF).count() > 0


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_same_rows_as_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = con.execute(queries.ORACLES[name])
    columns = [c[0] for c in found.description]
    rows = queries.QUERIES[name](spark, SF).select(*columns).collect()
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, found.fetchall()))


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = common.materialize(stage(spark, docs, SF), f"test-stage-{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == corpus_pipeline.COLUMNS
            assert 0.5 * before.count() < docs.count() <= before.count()
    packed = docs.groupBy("doc_id").count().count()
    assert packed == before.select("doc_id").distinct().count()
    assert corpus_pipeline.run(spark, SF).count() == docs.count()


def test_pipeline_keeps_other_texts_of_a_shared_id(spark):
    import corpus_pipeline

    a, b = "one two three four five six seven eight nine ten", "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [(1, a, "en", "s", len(a)), (5, a, "en", "s", len(a)), (5, b, "en", "s", len(b)), (None, a, "en", "s", len(a)), (7, None, None, None, None), (8, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted(map(repr, map(tuple, corpus_pipeline.near_duplicates(spark, docs, SF).collect())))
    assert kept == sorted(map(repr, [rows[0], *rows[2:]]))


def test_pipeline_against_brute_force(spark):
    import corpus_pipeline
    from tests.llm.test_text_operators import WORD, components_by_hand, removed_by_hand
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    judged = common.materialize(corpus_pipeline.quality(spark, docs, SF), "test-judged").collect()
    # What the first stage kept is taken as it is (its model has tests of its own); the others are done by hand.
    lower = [(r.text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split() for r in judged]
    order = sorted(range(len(judged)), key=lambda k: judged[k].doc_id)
    sets = [{tuple(lower[k][i : i + 5]) for i in range(len(lower[k]) - 4)} or ({tuple(lower[k])} if lower[k] else set()) for k in order]
    root = components_by_hand(sets, 80)
    kept = [judged[k] for n, k in enumerate(order) if root[n] == n]
    cut = removed_by_hand([(r.doc_id, r.text) for r in kept], 20)
    whole = Tokenizer.from_file(WORD)
    expected = {}
    for n, r in enumerate(kept):
        n_words, n_removed, left = cut[n]
        if n_removed == 0 or n_removed < n_words:
            expected[r.doc_id] = len(whole.encode((r.text or "") if n_removed == 0 else left, add_special_tokens=False).ids) + 1
    got = {r.doc_id: r.doc_tokens for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == expected


def test_scores_of_very_unlikely_bytes_are_not_cut(spark, tmp_path):
    """A byte of 53 bits, or of 200, keeps them."""
    probabilities = [0.5, 2.0**-15.9999, 2.0**-16.3, 2.0**-53.25, 2.0**-200.5, 1.0]
    grams = spark.createDataFrame([(0, k) for k in range(6)], "slice int, g long")
    found = spark.createDataFrame([(k, p, 0.25) for k, p in enumerate(probabilities)], "g long, p0 double, p1 double")
    path = f"file://{tmp_path}/scores"
    quality_lm.answer(grams, found, path, 1)
    codes = quality_lm._scores_of(path, 0, 1).of(np.arange(6))
    assert np.allclose(quality_lm._score(codes >> 16), [1, 16, 16.3, 53.25, 200.5, 0], atol=0.005) and np.allclose(quality_lm._score(codes & 0xFFFF), 2)
