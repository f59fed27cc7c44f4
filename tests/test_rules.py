"""Rules over distinct texts: each way of meeting the answers gives the same rows, and plans are those meant."""

import random

import pytest
from pyspark.sql import functions as F

from sparkledger.functions import rules
from sparkledger.sources import statements
from sparkledger.operators import quality


def table(spark, n, different):
    r = random.Random(n)
    some = ["Lightspeed Commerce Inc LS", "LOYER bureau", None, "", "BELL MOBILITE"] + [f"text {k}" for k in range(different)]
    rows = [(k, "LOYER bureau" if k % 2 else r.choice(some)) for k in range(n)]
    return spark.createDataFrame(rows, "id long, description string")


def judged(df):
    return sorted((x.id, x.category, x.category_label) for x in rules.categorize(df).collect())


@pytest.mark.parametrize("hot, repeats", [(1000, 0), (3, 0), (1, 0), (1000, 10**6)])
def test_all_ways_give_the_same(spark, monkeypatch, hot, repeats):
    df = table(spark, 400, 100)
    expected = judged(df)
    monkeypatch.setattr(rules, "TEXT_BYTES", -1)
    monkeypatch.setattr(rules, "HOT", hot)
    monkeypatch.setattr(rules, "REPEATS", repeats)
    assert judged(df) == expected and {c for _, c, _ in expected} > {"uncategorized"}


def plan_of(df, capsys):
    capsys.readouterr()
    rules.categorize(df).explain("formatted")
    return capsys.readouterr().out


def test_plans(spark, monkeypatch, capsys):
    df = table(spark, 400, 100)
    assert "SortMergeJoin" not in plan_of(df, capsys)
    monkeypatch.setattr(rules, "TEXT_BYTES", -1)
    monkeypatch.setattr(rules, "HOT", 3)
    found = plan_of(df, capsys)  # hot texts are broadcast, others meet by a shuffle, and no row is copied
    assert "SortMergeJoin" in found and "BroadcastHashJoin" in found and "LeftAnti" in found and "Generate" not in found
    monkeypatch.setattr(rules, "REPEATS", 10**6)
    assert "Join" not in plan_of(df, capsys)


def test_patterns_are_those_that_spark_can_run(spark):
    text = '[["(?P<a>x)", "c", "l"], ["x++y(?i)", "d", "l"], ["[", "e", "l"], ["a", "b"], ["ok", "f", "l"], [1, 2, 3]]'
    assert rules.rules_from_json(text) == [("x++y(?i)", "d", "l"), ("ok", "f", "l")]
    assert rules.rules_from_json("{") == rules.rules_from_json(None) == rules.rules_from_json('{"a": 1}') == []
    df = spark.createDataFrame([("zXXY",)], "description string")
    assert df.select(rules.first_match(F.col("description"), rules.rules_from_json(text))["category"]).first()[0] == "d"


def test_missing_columns_are_violations(spark):
    df = spark.createDataFrame([(1, "x")], "id int, entity string")
    got = sorted(tuple(r) for r in quality.column_violations(df, "claims.csv", ["id", "amount", "source"]).collect())
    assert got == [("claims.csv", "", "missing_column", "error", "amount"), ("claims.csv", "", "missing_column", "error", "source")]
    assert quality.column_violations(df, "claims.csv", ["id"]).collect() == []


def test_a_package_is_judged_by_columns_then_by_rows(spark):
    texts = spark.createDataFrame([
        ("a/creditor-schedule.csv", "source,amount,confidence_status,source_locator,source_id\nx,5,BLOCKED\n,7,CONFIRMED,p1,S1\n\n\"a,\n\"\"b\"\"\",8,odd,p,S1"),
        ("b/creditor-schedule.csv", "source,Amount,confidence_status,source_id\n,7,,,"), ("c/das-tax-schedule.csv", "confidence_status,source_id,source,source_locator,balance_owed"),
        ("c/notes.csv", "x\n1"), ("d/employee-claims.csv", "entity,amount,amount,source_id,source,source_locator,confidence_status\n<entity-slug>, ,1,,,,INFERRED"),
    ], "path string, text string")
    found = statements.records(texts)
    columns = [("b/creditor-schedule.csv", "", "missing_column", "amount"), ("b/creditor-schedule.csv", "", "missing_column", "source_locator")]
    rows = [
        *[("a/creditor-schedule.csv", f"creditor-schedule.csv:row={k}", "placeholder_entity", None) for k in (2, 3, 4)],
        *[("d/employee-claims.csv", "employee-claims.csv:row=2", f"missing_{c}", c) for c in ("source", "source_id", "source_locator")],
        ("a/creditor-schedule.csv", "creditor-schedule.csv:row=3", "missing_source", "source"), ("a/creditor-schedule.csv", "creditor-schedule.csv:row=4", "status_unknown", "ODD"),
        ("d/employee-claims.csv", "employee-claims.csv:row=2", "placeholder_entity", "<entity-slug>"),
    ]
    said = lambda **on: sorted((r.deliverable, r.row_id, r.rule, r.detail) for r in quality.package_violations(found, **on).collect())
    assert said(mode="template") == columns and said() == sorted(columns + rows)
    late = ("d/employee-claims.csv", "employee-claims.csv:row=2", "inferred_at_handoff", "INFERRED")
    registry = spark.createDataFrame([("S2",)], "source_id string")
    stray = ("a/creditor-schedule.csv", "creditor-schedule.csv:row=3", "source_not_registered", "S1")
    assert said(mode="handoff", registry=registry) == sorted([*columns, *rows, late, stray])
    assert quality.package_violations(found.where("false"), mode="handoff").count() == 0
