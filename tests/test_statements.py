"""Records of statement files: against the csv module, over parts of any size, and by header names."""

import csv
import io
import random

import pytest

from sparkledger.sources import statements


def texts_of(seed):
    r = random.Random(seed)
    cell = lambda: r.choice(["a", "", "x y", '"q,1"', '"two\nlines"', '"say ""hi"""', '""', '"a\n\n,b"', "é", "12.50", '"end"z'])
    return ["".join(",".join(cell() for _ in range(r.randrange(1, 6))) + r.choice(["\n", "\r\n", "\n\n", "\n \n"]) for _ in range(r.randrange(0, 12))) for _ in range(25)]


def by_csv(text):
    """What the csv module reads; records that are blank lines go."""
    rows = [[c for c in row] for row in csv.reader(io.StringIO(text, newline=""))]
    return [row for row in rows if row and not (len(row) == 1 and row[0].strip() == "")]


def test_records_equal_the_csv_module(spark):
    texts = texts_of(1) + [",a", "a,", ",", '"open, never closed\nx', "﻿x,y".replace("﻿", "")]
    got = {}
    for r in statements.records(spark.createDataFrame(list(enumerate(texts)), "path int, text string")).collect():
        got.setdefault(r.file_path, {})[r.row_num] = r.cells
        assert r.header is not None
    for k, text in enumerate(texts):
        mine = [got.get(k, {})[n] for n in range(len(got.get(k, {})))]
        if "never closed" not in text:
            assert [r for r in mine if not (len(r) == 1 and r[0].strip() == "")] == by_csv(text), text


@pytest.mark.parametrize("part", [40, 1 << 20])
def test_files_are_read_in_parts_of_any_size(spark, tmp_path, part):
    texts = {f"f {k}é.csv": t for k, t in enumerate(texts_of(2)[:8])}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    (tmp_path / "latin.csv").write_bytes('Date,é,"x\ny"\n1,ü,2'.encode("latin-1"))
    (tmp_path / "mark.csv").write_bytes(b"\xef\xbb\xbfDate,b\n1,2")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", part)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        rows = statements.read_records(spark, str(tmp_path)).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    from urllib.parse import unquote

    got = {}
    for r in rows:
        got.setdefault(unquote(r.file_path.split("/")[-1]), {})[r.row_num] = (r.cells, r.header, r.is_utf8)
    assert [got["latin.csv"][k] for k in range(2)] == [(["Date", "é", "x\ny"], ["Date", "é", "x\ny"], False), (["1", "ü", "2"], ["Date", "é", "x\ny"], False)]
    assert got["mark.csv"][0][0] == ["Date", "b"]
    for name, text in texts.items():
        mine = [got.get(name, {})[k][0] for k in range(len(got.get(name, {})))]
        assert [r for r in mine if not (len(r) == 1 and r[0].strip() == "")] == by_csv(text), (name, text)
        assert all(v[1] == mine[0] for v in got.get(name, {}).values())


def test_headers_of_many_files_meet_rows_in_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(statements, "FILES", 0)
    for k in range(3):
        (tmp_path / f"{k}.csv").write_text(f"Date,Description,Credit,Debit,Balance\n2024-01-0{k + 1},d{k},1.00,,5.00\n" * 1)
    files, rows = statements.read_statements(spark, str(tmp_path))
    assert sorted((str(r.date), r.description, float(r.credit), r.debit) for r in rows.collect()) == [(f"2024-01-0{k + 1}", f"d{k}", 1.0, None) for k in range(3)]
    assert files.count() == 3


def test_columns_by_name(spark):
    texts = ["Date,Description,Credit,Debit,Balance\n2024-01-01,in,5.00,,1", "Date,Description,Debit,Balance\n2024-01-01,out,2.00,9.00\n2024-01-02", "Date,Date de traitement,Montant,Description\n21 Jan 2025,,\"3,50\",x"]
    files = spark.createDataFrame([(str(k), t) for k, t in enumerate(texts)], "path string, text string")
    got = sorted((r.file_path, r.row_num, r.description, r.debit and float(r.debit), r.credit and float(r.credit), r.balance and float(r.balance)) for r in statements.rbc(files.where("path < 2")).collect())
    assert got == [("0", 1, "in", None, 5.0, 1.0), ("1", 1, "out", 2.0, None, 9.0), ("1", 2, "", None, None, None)]
    assert [(r.description, float(r.debit)) for r in statements.amex(files.where("path = 2")).collect()] == [("x", 3.5)]
    formats = spark.createDataFrame([("0", "rbc_csv", "high"), ("1", "rbc_csv", "high"), ("2", "amex_csv", "medium"), ("9", "unknown", "low")], "path string, format string, confidence string")
    said = sorted((r.path, r.warning) for r in statements.file_warnings(files, formats).collect())
    assert said == [("1", "missing columns: Credit"), ("2", "format of medium confidence"), ("9", "unknown format")]


def test_missing_files_are_reported(spark):
    files = spark.createDataFrame([("a.csv", "rbc_csv", "high", None)], "path string, format string, confidence string, warning string")
    expected = spark.createDataFrame([("a.csv",), ("b.csv",), ("b.csv",)], "path string")
    got = sorted(tuple(r) for r in statements.with_missing(files, expected).collect())
    assert got == [("a.csv", "rbc_csv", "high", None), ("b.csv", "missing", "low", "no such file")]
