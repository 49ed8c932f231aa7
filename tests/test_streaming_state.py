"""Slots from streaming state: order of arrival, replays, published tables, hot tuples."""

from collections import defaultdict

import pytest

from codeloom.session import new_table_path
from codeloom.streaming import state

LEVELS = ["c1", "c2"]
SCHEMA = "product_id long, c1 int, c2 int"


@pytest.fixture
def rocksdb(spark):
    before = {state.PROVIDER: spark.conf.get(state.PROVIDER), "spark.sql.shuffle.partitions": spark.conf.get("spark.sql.shuffle.partitions")}
    spark.conf.set(state.PROVIDER, state.ROCKSDB)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


def run(spark, batches, published=None, most=state.SORTED_ROWS, arrivals=None, stop_after=None, out=None, checkpoint=None):
    arrivals, out, checkpoint = arrivals or new_table_path(spark, "in"), out or new_table_path(spark, "out"), checkpoint or new_table_path(spark, "ck")
    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(arrivals)
        source = spark.readStream.schema(SCHEMA).parquet(arrivals)
        slots = state.slots_by_state(source, LEVELS, published, buckets=8, most=most)
        writer = slots.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()
    rows = [tuple(r) for r in spark.read.parquet(out).select("product_id", *LEVELS, "dedup").collect()]
    return rows, (arrivals, out, checkpoint)


def plain(batches, published=()):
    seen = {row[0] for row in published}
    free = defaultdict(int)
    for _, a, b, slot in published:
        free[a, b] = max(free[a, b], slot + 1)
    out = []
    for batch in batches:
        first = {}
        for row in sorted(r for r in batch if r[0] is not None):
            first.setdefault(row[0], row)
        for number, a, b in sorted(first.values()):
            if number not in seen:
                seen.add(number)
                out.append((number, a, b, free[a, b]))
                free[a, b] += 1
    return out


ROWS = [(i * 37 % 101, i % 3, i % 2) for i in range(60)]


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1), (1, 2, 0)])
def test_three_orders_of_arrival(rocksdb, order):
    parts = [ROWS[:25] + [(None, 1, 1)], ROWS[20:45], ROWS[45:] + [(3, 9, 9), (3, 8, 8), (1000, 8, 8)]]
    batches = [parts[i] for i in order]
    got, _ = run(rocksdb, batches)
    assert sorted(got) == sorted(plain(batches))
    by_tuple = defaultdict(list)
    for _, a, b, slot in got:
        by_tuple[a, b].append(slot)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_tuple.values())


def test_replays_and_published_rows(rocksdb):
    published = [(500 + i, 1, 1, i) for i in range(4)] + [(ROWS[0][0], 0, 0, 7)]
    table = rocksdb.createDataFrame(published, SCHEMA + ", dedup int")
    batches = [ROWS[:20], ROWS[:20], ROWS[10:30] + [(501, 2, 2)]]
    got, places = run(rocksdb, batches, table)
    assert sorted(got) == sorted(plain(batches, published))
    # The whole stream once more, from its own start, gives the same table; a restart without new files adds nothing.
    again, _ = run(rocksdb, batches, table)
    assert sorted(again) == sorted(got)
    rocksdb.createDataFrame(ROWS[:5], SCHEMA).coalesce(1).write.mode("append").parquet(places[0])
    unchanged, _ = run(rocksdb, [ROWS[:5]], table, arrivals=places[0], out=places[1], checkpoint=places[2])
    assert sorted(unchanged) == sorted(got)


def test_a_tuple_larger_than_a_piece(rocksdb):
    rows = [(i, 1, 1) for i in range(300)]
    got, _ = run(rocksdb, [rows], most=50)
    assert sorted(r[0] for r in got) == list(range(300)) and sorted(r[3] for r in got) == list(range(300))


def test_other_state_stores_are_refused(spark):
    with pytest.raises(ValueError, match="providerClass"):
        state.slots_by_state(spark.createDataFrame([], SCHEMA), LEVELS)
