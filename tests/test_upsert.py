"""The upsert as a plan and on catalog tables."""

from uuid import uuid4

import pytest

import scoreloom.operators.upsert as upsert_module
from scoreloom.operators.upsert import DuplicateSourceKey, check_source, upsert, upsert_table
from scoreloom.sources.tables import table_provider

SCHEMA = "champion string, n int"
TARGET = [("A", 1), ("B", 2), (None, 9)]
SOURCE = [("B", 20), ("C", 30), (None, 90)]


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_replace_insert_keep(spark):
    result = upsert(frame(spark, TARGET), frame(spark, SOURCE))
    expected = [("A", 1), ("B", 20), ("C", 30), (None, 9), (None, 90)]
    assert rows_of(result) == sorted(expected, key=str)


def test_null_safe_replaces_the_null_row(spark):
    result = upsert(frame(spark, TARGET), frame(spark, SOURCE), null_safe=True)
    assert rows_of(result) == sorted([("A", 1), ("B", 20), ("C", 30), (None, 90)], key=str)


def test_idempotent_without_null_keys(spark):
    target, source = frame(spark, TARGET[:2]), frame(spark, SOURCE[:2])
    once = upsert(target, source)
    assert rows_of(upsert(once, source)) == rows_of(once)


def test_null_source_key_is_added_on_every_run(spark):
    source = frame(spark, SOURCE)
    twice = upsert(upsert(frame(spark, TARGET), source), source)
    assert [r[1] for r in rows_of(twice) if r[0] is None] == [9, 90, 90]


def test_column_order_of_the_source_does_not_matter(spark):
    source = frame(spark, [(5, "A")], "n int, champion string")
    assert rows_of(upsert(frame(spark, [("A", 1)]), source)) == [("A", 5)]


def test_key_of_two_columns(spark):
    schema = "puuid string, champion string, n int"
    target = frame(spark, [("p", "A", 1), ("p", "B", 2), (None, "A", 3)], schema)
    source = frame(spark, [("p", "B", 20), ("q", "A", 30), (None, "A", 40)], schema)
    result = upsert(target, source, key=["puuid", "champion"])
    expected = [("p", "A", 1), ("p", "B", 20), ("q", "A", 30), (None, "A", 3), (None, "A", 40)]
    assert rows_of(result) == sorted(expected, key=str)


def test_two_source_rows_for_one_target_row(spark):
    target = frame(spark, TARGET)
    with pytest.raises(DuplicateSourceKey):
        check_source(target, frame(spark, [("B", 1), ("B", 2)]), "champion")
    # Repeated keys that match nothing are simply inserted.
    check_source(target, frame(spark, [("N", 1), ("N", 2), (None, 1), (None, 2)]), "champion")
    with pytest.raises(DuplicateSourceKey):
        check_source(target, frame(spark, [(None, 1), (None, 2)]), "champion", null_safe=True)


def test_table_is_created_then_updated(spark):
    table = f"t_{uuid4().hex}"
    assert upsert_table(spark, table, frame(spark, TARGET[:2])) == 2
    assert upsert_table(spark, table, frame(spark, SOURCE[:2])) == 3
    assert rows_of(spark.table(table)) == [("A", 1), ("B", 20), ("C", 30)]
    # The source may be computed from the table itself.
    assert upsert_table(spark, table, spark.table(table).where("n > 5")) == 3
    assert rows_of(spark.table(table)) == [("A", 1), ("B", 20), ("C", 30)]


def test_no_nested_loop_join(spark, plan_of):
    for null_safe in (False, True):
        plan = plan_of(upsert(frame(spark, TARGET), frame(spark, SOURCE), null_safe=null_safe))
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_the_source_is_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    table = f"u_{uuid4().hex}"
    rows = spark.createDataFrame([(f"c{i}", i) for i in range(50)], "champion string, n int")
    source = rows.mapInPandas(count, rows.schema)
    for _ in range(2):
        seen.value = 0
        upsert_table(spark, table, source)
        assert seen.value == 50
    assert spark.table(table).count() == 50


def test_the_branch_follows_the_provider(spark, monkeypatch):
    table = f"u_{uuid4().hex}"
    rows = spark.createDataFrame([("a", 1)], "champion string, n int")
    upsert_table(spark, table, rows, fmt="orc")
    assert table_provider(spark, table) == "orc"
    done = []

    class Merge:
        def __getattr__(self, name):
            return lambda *args: done.append(name) or self

    monkeypatch.setattr(upsert_module, "table_provider", lambda *_: "delta")
    monkeypatch.setattr(upsert_module, "publish", lambda *_: Merge())
    assert upsert_table(spark, table, rows) is None
    assert done == ["alias", "mergeInto", "whenMatched", "updateAll", "whenNotMatched", "insertAll", "merge"]
