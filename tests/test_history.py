"""Dimension history: against a replay in Python, over crashes and repeats."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F, types as T

from starmill.operators.history import BEGAN, ENDED, IS_CURRENT, advance, interval_report, opened, row_mark, version_at
from starmill.operators.lookups import DEFAULT_BUDGET, BroadcastBudget
from starmill.operators.quality import QualityError
from starmill.operators.schema import SchemaDrift
from starmill.sinks.history import HistoryTable
from starmill.sinks.records import subfolders

SNAPSHOT = T.StructType().add("id", "string").add("city", "string").add("size", "integer")
DAYS = [date(2024, 1, 1) + timedelta(30 * i) for i in range(6)]


def snapshots():
    draw = random.Random(7)
    return [
        {f"m{i}": (draw.choice(["x", "y", None]), draw.choice([1, None])) for i in range(40) if draw.random() < 0.8} for _ in DAYS
    ]


def replay(states):
    """Versions as (id, city, size, began, ended)."""
    done, held = [], {}
    for day, state in zip(DAYS, states, strict=True):
        for key in list(held):
            if state.get(key) != held[key][0]:
                done.append((key, *held[key][0], held[key][1], day))
                del held[key]
        for key, value in state.items():
            held.setdefault(key, (value, day))
    return sorted([*done, *((k, *v, began, None) for k, (v, began) in held.items())], key=str)


def frame(spark, state):
    return spark.createDataFrame([(k, *v) for k, v in state.items()], SNAPSHOT)


def versions(df):
    return sorted((tuple(r) for r in df.select("id", "city", "size", BEGAN, ENDED).collect()), key=str)


@pytest.fixture
def table(tmp_path):
    return HistoryTable(f"{tmp_path}/history", "hst", SNAPSHOT, "id")


def test_snapshots_in_turn(spark, table):
    states = snapshots()
    assert table.read(spark).collect() == [] and table.current(spark).collect() == []
    for day, state in zip(DAYS, states, strict=True):
        lines = table.apply(frame(spark, state), day)
        assert not any(r["violations"] for r in lines)
    assert versions(table.read(spark)) == replay(states)
    assert sorted(map(tuple, table.current(spark).collect()), key=str) == sorted(((k, *v) for k, v in states[-1].items()), key=str)
    with pytest.raises(ValueError):
        table.apply(frame(spark, states[0]), DAYS[0])


def test_a_repeated_day_replaces_its_own_outcome(spark, table):
    states = snapshots()
    wrong = {k: ("wrong", 9) for k in states[1]}
    for day, state in ((DAYS[0], wrong), (DAYS[0], states[0]), (DAYS[1], wrong), (DAYS[1], {}), (DAYS[1], states[1])):
        table.apply(frame(spark, state), day)
    for day, state in zip(DAYS[2:], states[2:], strict=True):
        table.apply(frame(spark, state), day)
    assert versions(table.read(spark)) == replay(states)


def test_a_run_that_dies_changes_nothing(spark, table, monkeypatch):
    states = snapshots()
    table.apply(frame(spark, states[0]), DAYS[0])
    before = versions(table.read(spark))
    with monkeypatch.context() as patch:
        patch.setattr("starmill.sinks.records.Records.add", lambda *_: (_ for _ in ()).throw(OSError("died")))
        with pytest.raises(OSError):
            table.apply(frame(spark, states[1]), DAYS[1])
    assert versions(table.read(spark)) == before
    for bad in ([("a", "x", 1), ("a", "y", 1)], [(None, "x", 1)]):
        with pytest.raises(QualityError):
            table.apply(spark.createDataFrame(bad, SNAPSHOT), DAYS[1])
    with pytest.raises(SchemaDrift):
        table.apply(frame(spark, states[1]).drop("size"), DAYS[1])
    assert versions(table.read(spark)) == before


@pytest.mark.parametrize("keep", [0, 1])
def test_folders_that_no_record_needs_are_deleted(spark, table, monkeypatch, keep):
    states = snapshots()
    wrong = {k: ("wrong", 9) for k in states[1]}
    assert table.drop_superseded(spark, keep) == 0
    for day, state in ((DAYS[0], states[0]), (DAYS[1], states[1]), (DAYS[2], wrong), (DAYS[2], states[2])):
        table.apply(frame(spark, state), day)
    with monkeypatch.context() as patch:
        patch.setattr("starmill.sinks.records.Records.add", lambda *_: (_ for _ in ()).throw(OSError("died")))
        with pytest.raises(OSError):
            table.apply(frame(spark, states[3]), DAYS[3])
    before, folders = versions(table.read(spark)), lambda: [subfolders(spark, f"{table.root}/{p}") for p in ("current", "ended")]
    assert [len(f) for f in folders()] == [5, 4]
    # Needed: the last record's current rows and two sets of ended ones, and what its day started from.
    left = {0: [2, 2], 1: [3, 3]}[keep]
    assert table.drop_superseded(spark, keep) == 9 - sum(left) and [len(f) for f in folders()] == left
    assert table.drop_superseded(spark, keep) == 0 and versions(table.read(spark)) == before
    table.apply(frame(spark, states[2]), DAYS[2])  # starts from the day before, whose rows must still be there
    assert versions(table.read(spark)) == before


def test_broken_intervals_are_counted(spark):
    rows = [("a", DAYS[0], DAYS[2], False), ("a", DAYS[1], None, True), ("b", DAYS[1], DAYS[1], False), ("c", DAYS[0], None, False)]
    df = spark.createDataFrame(rows, f"id string, {BEGAN} date, {ENDED} date, {IS_CURRENT} boolean")
    assert {r.check_name: r.violations for r in interval_report(df, "t", "id").collect()} == {
        "intervals(empty)": 1, "intervals(overlap)": 1, "intervals(flag)": 1
    }


def test_marks_tell_null_from_text(spark):
    rows = [(None, "a"), ("null", "a"), ("", "a"), ("a", None), ("a", "a"), ("aa", "")]
    df = spark.createDataFrame(rows, "x string, y string").withColumn("m", row_mark(["x", "y"]))
    assert df.select("m").distinct().count() == len(rows)


def test_a_version_of_the_same_day_never_held(spark):
    current = opened(frame(spark, {"a": ("x", 1)}), "id", DAYS[0])
    ended, held = advance(current, frame(spark, {"a": ("y", 1)}), "id", DAYS[0])
    assert ended.collect() == [] and versions(held) == [("a", "y", 1, DAYS[0], None)]


@pytest.mark.parametrize("budget", [DEFAULT_BUDGET, BroadcastBudget(rows=0)])
def test_versions_at_a_time(spark, table, budget):
    states = snapshots()
    for day, state in zip(DAYS, states, strict=True):
        table.apply(frame(spark, state), day)
    facts = [(f"m{i % 45}" if i % 11 else None, DAYS[0] + timedelta(i % 190 - 5) if i % 13 else None) for i in range(900)]
    df = spark.createDataFrame(facts, "who string, day date")
    got = version_at(df, table.read(spark), {"id": F.col("who")}, F.col("day"), budget)
    assert got.columns == ["who", "day", "city", "size"]
    want = []
    for who, day in facts:
        nth = max((i for i, d in enumerate(DAYS) if day is not None and d <= day), default=None)
        want.append((who, day, *(states[nth].get(who, (None, None)) if nth is not None else (None, None))))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
