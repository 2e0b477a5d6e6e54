"""Drive a file-stream query through ordered arrival waves.

All messages are written once, a folder for each wave. The query is restarted
from its checkpoint with ``trigger(availableNow)`` on one wave's folder more
each time, so every wave is one or more micro-batches and every restart exercises
checkpoint recovery (offsets, state store, sink log). All folders live in
the shared scratch root (``spark.checkpoint.dir``).
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# files of a micro-batch: what a trigger takes in at a time, however much has arrived
MAX_FILES = 64

# name -> state-store figures of the last wave of the last run (for reports)
LAST_STATE: dict[str, dict] = {}


def idempotent_batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` sink that overwrites the folder of its batch id, so a
    replayed micro-batch (after a failure) rewrites, never duplicates, its rows."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch_id={int(batch_id)}")
    return write


def console_sink(lines: DataFrame, checkpoint: str):
    """Print the ``line`` column of a stream to the driver console."""
    return (lines.select("line").writeStream.format("console").option("truncate", False)
            .option("checkpointLocation", checkpoint).start())


def run_waves(spark: SparkSession, messages: DataFrame, build: Callable[[DataFrame], DataFrame],
              output_schema: str, name: str, wave_col: str = "wave", value_col: str = "value",
              max_files_per_trigger: int | None = MAX_FILES, sink: str | Callable[[DataFrame, int], None] = "files",
              runs: int | None = None) -> DataFrame | None:
    """``messages`` has a wave number and a JSON text column; ``build`` turns the
    streaming text DataFrame into the output stream. Returns the sink contents.

    The query is restarted for every wave, or ``runs`` times in all: then each
    run takes a share of the waves at once, and the last wave is a run of its own.
    ``sink`` may be a function for ``foreachBatch``; what it wrote is its caller's."""
    with stream_settings(spark):
        return _run(spark, messages, build, output_schema, name, wave_col, value_col, max_files_per_trigger, sink, runs)


@contextmanager
def stream_settings(spark: SparkSession):
    """Session settings while stream queries run."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    # availableNow + processing-time state timeouts would otherwise keep
    # scheduling no-data batches forever; a drained run needs none
    # state partitions are fixed by the first run of a checkpoint: size them to
    # the cluster, not to whatever shuffle width the calling session uses
    settings = {"spark.sql.streaming.noDataMicroBatches.enabled": "false",
                "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
                "spark.sql.shuffle.partitions": str(max(1, spark.sparkContext.defaultParallelism))}
    prev = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in prev.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _stops(waves: int, runs: int | None) -> list[int]:
    """How many waves have arrived at each run."""
    if runs is None or runs >= waves:
        return list(range(1, waves + 1))
    return sorted({-(-(waves - 1) * k // (runs - 1)) for k in range(1, runs)} | {waves}) if runs > 1 else [waves]


def _run(spark, messages, build, output_schema, name, wave_col, value_col, max_files_per_trigger, sink, runs):
    LAST_STATE.pop(name, None)
    root = scratch_path(spark, name)
    inp, ckpt, out = f"{root}/input", f"{root}/checkpoint", f"{root}/output"
    # a wave is a few files for each core, however many partitions the messages come in: every micro-batch visits all states
    files = 2 * max(1, spark.sparkContext.defaultParallelism)
    (messages.select(F.col(wave_col).cast("long").alias("wave"), F.col(value_col).alias("value")).coalesce(files)
     .write.mode("overwrite").partitionBy("wave").text(inp))
    waves = [int(r[0]) for r in spark.read.text(inp).select("wave").distinct().orderBy("wave").collect()]  # wave ids only
    for k in _stops(len(waves), runs):
        reader = spark.readStream.format("text")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        stream = build(reader.load(f"{inp}/wave={{{','.join(map(str, waves[:k]))}}}"))
        writer = stream.writeStream.option("checkpointLocation", ckpt).outputMode("append") \
            .trigger(availableNow=True)
        if callable(sink):
            q = writer.foreachBatch(sink).start()
        elif sink == "foreachBatch":
            q = writer.foreachBatch(idempotent_batch_writer(out)).start()
        else:
            q = writer.format("parquet").option("path", out).start()
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
        obs = [p.get("observedMetrics") or {} for p in (q.recentProgress or [])]
        ops = [o for p in (q.recentProgress or []) for o in (p.get("stateOperators") or [])]
        if ops:
            last = ops[-len(q.recentProgress[-1].get("stateOperators") or [1]):]
            prev = LAST_STATE.get(name, {})
            LAST_STATE[name] = {"state_rows": sum(int(o.get("numRowsTotal", 0)) for o in last),
                                "state_bytes": sum(int(o.get("memoryUsedBytes", 0)) for o in last),
                                "rows_read": prev.get("rows_read", 0) + sum(_metric(m, "rows") for m in obs),
                                "quarantined": prev.get("quarantined", 0) + sum(_metric(m, "quarantined") for m in obs)}
    if callable(sink):
        return None
    if sink == "foreachBatch":
        return spark.read.schema(output_schema).option("basePath", out).parquet(f"{out}/batch_id=*") \
            if _exists(spark, out) else spark.createDataFrame([], output_schema)
    return spark.read.schema(output_schema).parquet(out)


def _metric(observed, field: str, name: str = "envelope") -> int:
    """One counter of an observed-metrics row (a Row per observation name)."""
    try:
        r = observed[name]
        return int(r[field] or 0)
    except (KeyError, TypeError, ValueError, IndexError):
        return 0


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
