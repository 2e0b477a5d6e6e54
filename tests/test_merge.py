"""The merging sink: corrections, replays, stops between rows and ledger, and compaction."""

from callscore.session import scratch_path
from callscore.streaming.merge import MergingTable

SCHEMA = "k long, part string, value string, rev long"


def _table(spark):
    return MergingTable(spark, scratch_path(spark, "t-merge"), SCHEMA, ["k", "part"], "rev", buckets=4)


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _rows(table):
    return sorted((tuple(r) for r in table.read().collect()), key=str)


def test_corrections_replays_and_stops(spark):
    table = _table(spark)
    write = table.writer()
    assert _rows(table) == []
    first = _df(spark, [(1, "a", "old", 1), (1, "a", "older", 0), (2, None, "x", 1), (None, "n", "null key", 1)])
    second = _df(spark, [(1, "a", "new", 2), (2, None, "late but older", 0), (3, "c", "y", 1)])
    write(first, 0)
    assert _rows(table) == [(1, "a", "old", 1), (2, None, "x", 1), (None, "n", "null key", 1)]
    table.write_rows(second, 1)            # stopped before the ledger
    assert _rows(table) == [(1, "a", "old", 1), (2, None, "x", 1), (None, "n", "null key", 1)]
    write(second, 1)                       # the checkpoint replays the batch
    want = [(1, "a", "new", 2), (2, None, "x", 1), (3, "c", "y", 1), (None, "n", "null key", 1)]
    assert _rows(table) == want
    for batch, df in ((0, first), (1, second), (0, first)):
        write(df, batch)
        assert _rows(table) == want
    write(_df(spark, []), 2)
    assert _rows(table) == want


def test_compaction_switches_at_once(spark):
    table = _table(spark)
    table.compact()                        # nothing yet
    for b in range(3):
        table.writer()(_df(spark, [(k, "a", f"v{b}", b) for k in range(b, 6)]), b)
    want = _rows(table)
    before = table.read()
    table.compact()
    assert _rows(table) == want and table._version() == (2, [])
    assert sorted((tuple(r) for r in before.collect()), key=str) == want      # readers of the old version go on
    table.writer()(_df(spark, [(0, "a", "again", 9), (7, "b", "z", 0)]), 3)
    table.compact()
    assert _rows(table) == sorted([(0, "a", "again", 9), (7, "b", "z", 0), *[r for r in want if r[0] != 0]], key=str)
