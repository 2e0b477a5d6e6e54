"""The message log: order by key, offsets, starts, bounds and restarts."""

import json

from callscore.session import scratch_path
from callscore.sources import message_log as log
from callscore.streaming.runner import stream_settings

N = 3


def _append(spark, path, lo, hi):
    rows = [(f"k{i % 7}", f'"é\n{i}', i) for i in range(lo, hi)]
    log.append(spark.createDataFrame(rows, "key string, value string, i long").repartition(4), path, ["i"], N)


def _drain(spark, path, root, out, **options):
    """Run a query from the checkpoint until nothing is left; (batch sizes, rows)."""
    def write(df, batch):
        df.write.mode("overwrite").json(f"{root}/{out}/batch={batch}")
    with stream_settings(spark):
        q = log.stream(spark, path, N, **options).writeStream.option("checkpointLocation", f"{root}/ckpt-{out}").foreachBatch(write).start()
        q.processAllAvailable()
        yield
        q.processAllAvailable()
        sizes = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
        q.stop()
    yield sizes


def _rows(spark, root, out):
    return sorted((r["partition"], r["offset"], r["key"], r["value"]) for r in spark.read.json(f"{root}/{out}").collect())


def test_offsets_starts_and_restarts(spark):
    root = scratch_path(spark, "t-log")
    path = f"{root}/log"
    assert log.ends(path, N) == {"0": 0, "1": 0, "2": 0}
    _append(spark, path, 0, 50)
    before = log.ends(path, N)
    assert sum(before.values()) == 50

    late, early = _drain(spark, path, root, "late", max_messages=12), _drain(spark, path, root, "early", starting="earliest")
    next(late)
    _append(spark, path, 50, 80)
    sizes = next(late)
    assert sum(sizes) == 30 and max(sizes) <= 12
    next(early)
    assert sum(next(early)) == 80
    whole, suffix = _rows(spark, root, "early"), _rows(spark, root, "late")
    assert len(whole) == 80 and suffix == [r for r in whole if r[1] >= before[str(r[0])]]
    for p in range(N):
        own = [r for r in whole if r[0] == p]
        assert [r[1] for r in own] == list(range(len(own)))
        numbers = [int(r[3].split("\n")[1]) for r in own]
        assert numbers == sorted(numbers) and all(r[2] == f"k{i % 7}" for r, i in zip(own, numbers))
    assert len({(r[0], r[2]) for r in whole}) == 7      # a key is in one partition

    # stopped; more arrives; the checkpoint's offsets go on, whatever the start option says
    _append(spark, path, 80, 90)
    again = _drain(spark, path, root, "late")
    next(again)
    assert sum(next(again)) == 10
    assert len(_rows(spark, root, "late")) == 40


def test_a_segment_outside_the_index_does_not_count(spark):
    root = scratch_path(spark, "t-log2")
    _append(spark, root, 0, 10)
    fs, folder = log._open(root)
    fs.create_dir(f"{folder}/partition=0", recursive=True)
    log._write(fs, f"{folder}/partition=0/{99:020d}-x.jsonl", json.dumps(["k", "v"]).encode() + b"\n")      # an append that failed
    assert sum(log.ends(root, N).values()) == 10
    log.append(spark.createDataFrame([], "key string, value string, i long"), root, ["i"], N)
    assert sum(log.ends(root, N).values()) == 10
