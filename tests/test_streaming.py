"""Keyed review state over restarts, files with outcomes, and frames over hot keys."""

import datetime as dt
import json
import os
import random
from collections import defaultdict

from sparkledger.operators import layout, matching, summaries
from sparkledger.sources import handoff
from sparkledger.streaming import incremental

T = lambda day, hour=0: dt.datetime(2024, 1, day, hour)


def test_review_goes_on_after_a_restart(spark, tmp_path):
    root = str(tmp_path)

    def put(n, items, answers):
        spark.createDataFrame(items, "key string, ts timestamp, cents long").coalesce(1).write.parquet(f"{root}/i/b={n}")
        spark.createDataFrame(answers, "key string, ts timestamp").coalesce(1).write.parquet(f"{root}/a/b={n}")

    def go():
        items = spark.readStream.schema("key string, ts timestamp, cents long").parquet(f"{root}/i/*")
        answers = spark.readStream.schema("key string, ts timestamp").parquet(f"{root}/a/*")
        return incremental.run_review(incremental.review_log(items, answers, 3), f"{root}/out", f"{root}/state")

    def status(log):
        return {r.key: (r.status, r.cents, r["at"]) for r in incremental.review_status(log).collect()}

    put(0, [("x", T(1), 5), ("x", T(1, 1), 6), ("y", T(2), 7), ("z", T(9), 1), (None, T(1), 1), ("n", None, 1), ("v", T(9), None)], [("y", T(4)), ("early", T(8)), (None, T(2))])
    first = {"x": ("EXPIRED", 5, T(4)), "y": ("RESOLVED", 7, T(4)), "z": ("OPEN", 1, T(9)), "v": ("OPEN", None, T(9))}
    assert status(go()) == first
    put(1, [("early", T(9, 1), 3), ("w", T(20), 4)], [("z", T(11)), ("z", T(10)), ("v", T(13))])
    assert status(go()) == first | {"z": ("RESOLVED", 1, T(10)), "v": ("EXPIRED", None, T(12)), "early": ("RESOLVED", 3, T(8)), "w": ("OPEN", 4, T(20))}
    log = go()  # nothing new
    assert log.where("status <> 'OPEN'").count() == 5 and log.where("status = 'OPEN'").count() == 6


def test_files_are_taken_once_and_again_after_mending(spark, tmp_path):
    root, store = tmp_path / "in", str(tmp_path / "store")
    root.mkdir()
    (root / "a.csv").write_text('id,v\n1,"10"\n2,20\n')
    (root / "b.csv").write_text("id,v\n3,ten\n4,40\n")
    (root / "c.csv").write_text("id,v\n")
    read = incremental.csv_rows("id long, v long")
    take = lambda: incremental.take_in(spark, str(root), store, read)
    said = lambda: {os.path.basename(r["_path"]): (r.outcome, r.n, r.n_broken, r.batch) for r in incremental.file_status(spark, store).collect()}
    rows = lambda: sorted((r.id, r.v) for r in incremental.taken(spark, store).collect())
    assert take() == 0 and said() == {"a.csv": ("parsed", 2, 0, 0), "b.csv": ("failed", 2, 1, 0), "c.csv": ("empty", 0, 0, 0)}
    assert rows() == [(1, 10), (2, 20)]
    assert take() is None
    (root / "b.csv").write_text("id,v\n3,30\n4,40\n5,50\n")
    assert take() == 1 and said()["b.csv"] == ("parsed", 3, 0, 1)
    assert rows() == [(1, 10), (2, 20), (3, 30), (4, 40), (5, 50)]
    (root / "a.csv").write_text("id,v\n1,11\n2,22\n9,99\n")
    take()
    os.remove(f"{store}/log/batch=2/_SUCCESS")  # as if the run had been cut short before its commit
    assert rows() == [(1, 10), (2, 20), (3, 30), (4, 40), (5, 50)]
    assert take() == 2 and rows() == [(1, 11), (2, 22), (3, 30), (4, 40), (5, 50), (9, 99)]


def test_a_file_that_breaks_later_gives_no_rows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    file, read = tmp_path / "in" / "a.csv", incremental.csv_rows("id long")
    for text in ("id\n1\n", "id\nx\ny\n"):
        file.write_text(text)
        incremental.take_in(spark, str(tmp_path / "in"), str(tmp_path / "s"), read)
    assert incremental.taken(spark, str(tmp_path / "s")).count() == 0
    assert [(r.outcome, r.n_broken) for r in incremental.file_status(spark, str(tmp_path / "s")).collect()] == [("failed", 2)]


def test_bursts_equal_brute_force(spark):
    rng, start = random.Random(5), dt.datetime(2024, 6, 1)
    rows = [("hot" if k % 3 else rng.choice(["a", None]), start + dt.timedelta(seconds=rng.randrange(6 * 86400)), dt.date(2023, 1 + rng.randrange(12), 5) if k % 11 else None, k) for k in range(1500)]
    rows += [("hot", start + dt.timedelta(seconds=s), dt.date(2022, m, 1), 2000 + s) for s, m in ((0, 1), (3600, 2), (7200, 3), (7201, 4))] + [("a", None, dt.date(2022, 1, 1), 9999)]
    df = spark.createDataFrame(rows, "tab string, entered timestamp, about date, id long")
    for hours, months in ((1, 3), (2, 8)):
        by_tab, expected = defaultdict(list), {}
        for tab, at, about, id in rows:
            by_tab[tab].append((at, about, id))
        for of in by_tab.values():
            for at, _, id in of:
                n = len({a.month + 12 * a.year for t, a, _ in of if at and t and a and abs((t - at).total_seconds()) <= 3600 * hours})
                if at and n >= months:
                    expected[id] = n
        got = {r.id: r.n_months for r in summaries.bursts(df, "tab", "entered", "about", hours, months).collect()}
        assert got == expected and expected
    assert summaries.bursts(df.limit(0), "tab", "entered", "about").collect() == []


def test_an_amount_that_all_cards_hold(spark):
    rng = random.Random(2)
    row = lambda k, who: (k, who, dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(40)), rng.choice([500, 500, 500, rng.randrange(480, 530)]))
    stmt, book = [row(k, f"c{k % 30}") for k in range(600)], [row(k, f"t{k % 4}") for k in range(100)]
    got = matching.fingerprint(spark.createDataFrame(stmt, "id long, card string, date date, cents long"), spark.createDataFrame(book, "id long, tab string, date date, cents long"))
    expected = {}
    for tab in ("t0", "t1", "t2", "t3"):
        first = sorted((r for r in book if r[1] == tab), key=lambda r: (r[2], r[0]))[:20]
        hits = {c: sum(any(s[1] == c and abs(s[3] - f[3]) <= 4 and abs((s[2] - f[2]).days) <= 5 for s in stmt) for f in first) for c in {s[1] for s in stmt}}
        card = min(hits, key=lambda c: (-hits[c], c))
        expected[tab] = (card, hits[card], 20)
    assert {r.tab: (r.card, r.n_matched, r.n_sample) for r in got.collect()} == expected


def test_holders_stand_in_their_place(spark):
    words = [(1, 0, 1, "ROE", 200.0, 290.0), (1, 0, 0, " JANE ", 170.0, 290.0), (1, 0, 2, "Card", 180.0, 290.0), (1, 0, 3, "JR", 180.0, 290.0), (1, 0, 4, "AWAY", 250.0, 290.0), (1, 1, 5, "NEXT", 200.0, 290.0), (2, 0, 6, None, 200.0, 290.0)]
    got = layout.holders(spark.createDataFrame(words, "doc_id long, page int, word_seq long, text string, x0 double, top double")).collect()
    assert [tuple(r) for r in got] == [(1, "JANE ROE")]


def test_a_registry_of_several_objects(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(handoff, "OBJECT_ROWS", 3)
    rows = [(f"S{k}" if k % 2 else None, f'a "{k}"\\é.csv' if k else None, k) for k in range(11)]
    df = spark.createDataFrame(rows, "source_id string, path string, size_bytes long")
    handoff.write_registry(df, str(tmp_path / "o"), "object")
    files = [p for p in (tmp_path / "o").rglob("*.txt")]
    assert len(files) > 1 and sum(len(json.loads(p.read_text())) for p in files) == 10
    got = sorted((r.source_id, r.path, r.size_bytes) for r in handoff.load_registry(spark, str(tmp_path / "o"), "object").collect())
    assert got == sorted((s or f"PATH:{p}", p, k) for s, p, k in rows if p)
    handoff.write_registry(df.limit(0), str(tmp_path / "e"), "object")
    assert handoff.load_registry(spark, str(tmp_path / "o"), "object").where("path = 'none'").count() == 0
