"""The bucketed slot table: batches, repeated batches, merges, broken jobs and pruned reads."""

from collections import defaultdict

import pytest

from codeloom.session import new_table_path
from codeloom.streaming.buckets import HEADS, SLOTS, SlotTable

LEVELS = ["c1", "c2"]
SCHEMA = "product_id long, c1 int, c2 int"


def batch_of(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def plain(batches):
    seen, free, out = set(), defaultdict(int), []
    for batch in batches:
        first = {}
        for row in sorted(r for r in batch if r[0] is not None):
            first.setdefault(row[0], row)
        for number, a, b in sorted(first.values()):
            if number not in seen:
                seen.add(number)
                out.append((number, a, b, free[a, b]))
                free[a, b] += 1
    return sorted(out)


def rows_of(table, before=None):
    return sorted(tuple(r) for r in table.read(before).collect())


def test_many_batches_with_merges(spark):
    batches = [[((i * 7 + n * 3) % 60, i % 3, n % 2) for i in range(8)] + [(None, 1, 1)] for n in range(7)]
    table = SlotTable(spark, new_table_path(spark, "slots"), LEVELS, buckets=4, fan=2)
    for number, rows in enumerate(batches):
        table.append(batch_of(spark, rows), number)
        assert rows_of(table) == plain(batches[: number + 1])
    assert table.runs(SLOTS) == [(0, 3), (4, 5), (6, 6)] and table.runs(HEADS) == table.runs(SLOTS)
    asked = spark.createDataFrame([(str(r[0]),) for r in batches[0][:3]] + [("x",), (None,)], "name string")
    found = sorted(tuple(r) for r in table.find(asked, "name").collect())
    assert found == [r for r in plain(batches) if r[0] in {b[0] for b in batches[0][:3]}]


@pytest.mark.parametrize("last", [2, 3])
def test_a_repeated_batch_changes_nothing(spark, last):
    batches = [[(n * 5 + i, i % 2, 0) for i in range(7)] for n in range(last + 1)]
    table = SlotTable(spark, new_table_path(spark, "slots"), LEVELS, buckets=4, fan=2)
    for number, rows in enumerate(batches):
        table.append(batch_of(spark, rows), number)
    want = rows_of(table)
    for _ in range(2):  # with the last batch merged (3) or not (2)
        table.append(batch_of(spark, batches[-1]), last)
        assert rows_of(table) == want == plain(batches)


def test_a_broken_run_is_not_seen(spark):
    table = SlotTable(spark, new_table_path(spark, "slots"), LEVELS, buckets=4, fan=2)
    table.append(batch_of(spark, [(1, 0, 0), (2, 0, 0)]), 0)
    table.append(batch_of(spark, [(3, 0, 0)]), 1)
    want = rows_of(table)
    for name in (SLOTS, HEADS):  # the merge broke: its files are there, its mark is not
        where, fs = table._fs(f"{table.path}/{name}/run=0-1/_SUCCESS")
        assert fs.delete(where, False)
    assert table.runs(SLOTS) == [(0, 0), (1, 1)] and rows_of(table) == want
    table.append(batch_of(spark, [(3, 0, 0), (4, 0, 0)]), 2)
    assert rows_of(table) == [(1, 0, 0, 0), (2, 0, 0, 1), (3, 0, 0, 2), (4, 0, 0, 3)]


def test_only_touched_buckets_are_read(spark, capsys):
    table = SlotTable(spark, new_table_path(spark, "slots"), LEVELS, buckets=64, fan=8)
    table.append(batch_of(spark, [(i, 0, 0) for i in range(500)]), 0)
    found = table.find(batch_of(spark, [(7, 0, 0)]))
    found.explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    assert [tuple(r) for r in found.collect()] == [(7, 0, 0, 7)]
    numbers = {r["bucket"] for r in table._read(SLOTS, table.runs(SLOTS), [3, 5]).collect()}
    assert numbers == {3, 5}


def test_empty_batches(spark):
    table = SlotTable(spark, new_table_path(spark, "slots"), LEVELS, buckets=4)
    assert table.read().collect() == []
    table.append(batch_of(spark, []), 0)
    table.append(batch_of(spark, [(1, 5, 5)]), 1)
    assert rows_of(table) == [(1, 5, 5, 0)]
