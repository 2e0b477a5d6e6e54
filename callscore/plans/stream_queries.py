"""Registered streaming queries (T1-T6). Each writes its input messages as
ordered waves of files, drains the stream with restarts from the
checkpoint, and returns the sink. The DuckDB twin is the batch twin's."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import calls
from ..operators.calls import number_chunks
from ..sources import envelope as env
from ..sources import message_log
from ..streaming import calls as scalls
from ..streaming import segments as ssegs
from ..session import scratch_path
from ..streaming.merge import MergingTable
from ..streaming.runner import run_waves, stream_settings
from . import call_queries, segment_queries
from . import fixtures as fx

END_WAVE = 1 << 30
FRAME_WAVE = 25
RUNS = 3              # starts of the query over the waves of a chunk stream
JOINED = 2            # chunks of every call before the log is joined
LOG_PARTITIONS = 4
SHUFFLED = 3          # waves over which the disordered streams deal their input


def _call_stream(text_stream):
    return scalls.with_decisions(scalls.call_states(env.decode(text_stream)))


_OUT = scalls.OUTPUT_SCHEMA + ", bert_prob double, mfcc_prob double, spec_prob double, final_prob double, " \
                              "status string"


def _doubling(position):
    """Arrival wave of a position: each wave reaches twice as far as the one before."""
    return F.floor(F.log2(position + 1)).cast("long")


def _dealt(*cols):
    """A wave by hash: neighbours arrive in any order."""
    return F.pmod(F.xxhash64(*cols), F.lit(SHUFFLED))


def chunk_messages(spark, sf_dir, wave=None):
    """Chunks of every conversation, with their matrices, plus one end marker per call."""
    ch = fx.chunk_matrices(spark, sf_dir)
    message = env.chunk_message(F.col("call_id"), F.col("chunk_index"), F.col("transcript"), mfcc=F.col("mfcc"), spec=F.col("spectrogram"))
    msgs = ch.select((_doubling(F.col("chunk_index")) if wave is None else wave).alias("wave"), message.alias("value"))
    ends = ch.select("call_id").distinct().select(F.lit(END_WAVE).alias("wave"),
                                                  env.end_message(F.col("call_id")).alias("value"))
    return msgs.unionByName(ends)


def event_messages(spark, sf_dir):
    """The call_events stream as the producer emits it: blank chunks dropped,
    chunks numbered per call, end markers in time order; waves of days."""
    ev = fx.call_events(spark, sf_dir)
    ch = number_chunks(ev)
    day = _doubling(F.greatest(F.datediff(F.to_date("ts"), F.lit("2024-01-01")), F.lit(0)))
    msgs = ch.select(day.alias("wave"), env.chunk_message(F.col("call_id"), F.col("chunk_index"), F.col("transcript"),
                                                          F.col("ts")).alias("value"))
    ends = calls.end_markers(ev).select(day.alias("wave"), env.end_message(F.col("call_id"), F.col("ts")).alias("value"))
    return msgs.unionByName(ends)


def _by_row():
    """The call stream with ``row_kind``: a chunk's running row may become a quarantined one and back, both are its row."""
    of_chunk = F.col("kind").isin("running", "quarantined")
    return lambda s: _call_stream(s).withColumn("row_kind", F.when(of_chunk, "chunk").otherwise(F.col("kind")))


def merged_calls(spark, messages, name, runs=RUNS):
    """The stream's rows merged by (kind, call, chunk): corrections replace what they correct."""
    build = _by_row()
    schema = _OUT + ", row_kind string"
    table = MergingTable(spark, scratch_path(spark, f"{name}-table"), schema, ["row_kind", "call_id", "chunk_index"], "revision")
    run_waves(spark, messages, build, schema, name, sink=table.writer(), runs=runs)
    return table.read()


def _run_chunks(spark, sf_dir, name):
    return scalls.latest(run_waves(spark, chunk_messages(spark, sf_dir), _call_stream, _OUT, name, runs=RUNS))


def _run_events(spark, sf_dir, name):
    return scalls.latest(run_waves(spark, event_messages(spark, sf_dir), _call_stream, _OUT, name))


_SCORES = ["bert_prob", "mfcc_prob", "spec_prob", "final_prob", "status"]


def q_stream_running(spark, sf_dir):
    out = _run_chunks(spark, sf_dir, "stream_running").filter(F.col("kind") == "running")
    return out.select(F.col("call_id").cast("long").alias("call_id"), "chunk_index", "n_segments",
                      F.col("text").alias("running_text"), *_SCORES)


def q_stream_final(spark, sf_dir):
    out = _run_chunks(spark, sf_dir, "stream_final").filter(F.col("kind") == "final")
    return out.select(F.col("call_id").cast("long").alias("call_id"), "n_segments",
                      F.col("text").alias("full_text"), *_SCORES)


def q_stream_ended_calls(spark, sf_dir):
    out = _run_events(spark, sf_dir, "stream_ended_calls").filter(F.col("kind") == "final")
    return out.select("call_id", "n_segments", F.col("text").alias("full_text"), *_SCORES)


def q_stream_orphan_ends(spark, sf_dir):
    out = _run_events(spark, sf_dir, "stream_orphan_ends").filter(F.col("kind") == "orphan_end")
    return out.select("call_id")


def q_stream_final_disordered(spark, sf_dir):
    """Chunks arrive in any order over several restarts, some of them twice."""
    msgs = chunk_messages(spark, sf_dir, _dealt("call_id", "chunk_index"))
    again = (F.col("wave") < SHUFFLED) & (F.xxhash64("value") % 5 == 0)
    waves = F.when(again, F.array("wave", (F.col("wave") + 1) % SHUFFLED)).otherwise(F.array("wave"))
    out = run_waves(spark, msgs.select(F.explode(waves).alias("wave"), "value"), _call_stream, _OUT, "stream_final_disordered").filter(F.col("kind") == "final")
    return out.select(F.col("call_id").cast("long").alias("call_id"), "n_segments",
                      F.col("text").alias("full_text"), *_SCORES)


def _undelivered(call_id: str, chunk_index: str) -> str:
    """SQL: the chunks that never arrive, about one in twenty."""
    return f"({call_id} * 31 + {chunk_index} * 17) % 20 = 3"


def q_stream_progress(spark, sf_dir):
    """One chunk in twenty is lost, one in five comes a wave late, some come twice; the last row of every chunk
    that was delivered, merged by chunk over all restarts."""
    delivered = ~F.expr(_undelivered("call_id", "chunk_index"))
    late = ((F.col("call_id") * 7 + F.col("chunk_index") * 3) % 5 == 0).cast("long")
    msgs = chunk_messages(spark, sf_dir, F.when(delivered, _doubling(F.col("chunk_index")) + 3 * late))
    msgs = msgs.where("wave is not null and wave < %d" % END_WAVE)
    again = msgs.where(F.xxhash64("value") % 7 == 0).withColumn("wave", F.col("wave") + 1)
    out = merged_calls(spark, msgs.unionByName(again), "stream_progress").where(F.col("kind") == "running")
    return out.select(F.col("call_id").cast("long").alias("call_id"), "chunk_index", "n_segments", F.col("text").alias("running_text"), *_SCORES)


def q_stream_from_latest(spark, sf_dir):
    """A message log is joined at its latest message, after the first two chunks of every call; what comes later is
    scored from there, over a restart after which every third chunk comes late."""
    ch = chunk_messages(spark, sf_dir, F.col("chunk_index")).where(F.col("wave") < END_WAVE)
    msgs = ch.withColumn("key", F.get_json_object("value", "$.call_id"))
    late = F.col("wave") % 3 == 0
    out = joined_at_latest(spark, msgs, "stream_from_latest", [F.col("wave") < JOINED, (F.col("wave") >= JOINED) & ~late, (F.col("wave") >= JOINED) & late])
    out = out.where(F.col("kind") == "running")
    return out.select(F.col("call_id").cast("long").alias("call_id"), "chunk_index", "n_segments", F.col("text").alias("running_text"), *_SCORES)


def joined_at_latest(spark, messages, name, parts, partitions=LOG_PARTITIONS):
    """Append the first part to a log, join it at the latest message, and append the others one by one, each to a
    query that is started from the checkpoint; the rows merged by chunk."""
    root = scratch_path(spark, name)
    messages = messages.persist()
    build, schema = _by_row(), _OUT + ", row_kind string"
    table = MergingTable(spark, f"{root}/table", schema, ["row_kind", "call_id", "chunk_index"], "revision")
    try:
        message_log.append(messages.where(parts[0]), f"{root}/log", ["wave", "value"], partitions)
        with stream_settings(spark):
            for part in parts[1:]:
                stream = build(message_log.stream(spark, f"{root}/log", partitions))
                q = stream.writeStream.option("checkpointLocation", f"{root}/checkpoint").outputMode("append").foreachBatch(table.writer()).start()
                try:
                    q.processAllAvailable()      # the start is settled before more comes
                    message_log.append(messages.where(part), f"{root}/log", ["wave", "value"], partitions)
                    q.processAllAvailable()
                finally:
                    q.stop()
    finally:
        messages.unpersist()
    return table.read()


def _frame_messages(spark, sf_dir, wave):
    return fx.frames(spark, sf_dir).select(wave.alias("wave"), F.to_json(F.struct("clip_id", "frame_no", "is_voiced")).alias("value"))


def q_stream_segments(spark, sf_dir):
    msgs = _frame_messages(spark, sf_dir, _doubling(F.col("frame_no") / FRAME_WAVE))
    return run_waves(spark, msgs, ssegs.segment_stream, ssegs.SEGMENT_SCHEMA, "stream_segments")


def q_stream_segments_disordered(spark, sf_dir):
    """T5: frames arrive in any order over several restarts."""
    msgs = _frame_messages(spark, sf_dir, _dealt("clip_id", "frame_no"))
    return run_waves(spark, msgs, ssegs.segment_stream, ssegs.SEGMENT_SCHEMA, "stream_segments_disordered")


QUERIES = {
    "stream_running": q_stream_running,
    "stream_final": q_stream_final,
    "stream_ended_calls": q_stream_ended_calls,
    "stream_orphan_ends": q_stream_orphan_ends,
    "stream_segments": q_stream_segments,
    "stream_final_disordered": q_stream_final_disordered,
    "stream_segments_disordered": q_stream_segments_disordered,
    "stream_progress": q_stream_progress,
    "stream_from_latest": q_stream_from_latest,
}

_ENDED = call_queries.ORACLE["ended_calls"].replace("select e.call_id, e.event_id, f.n_segments",
                                                    "select e.call_id, f.n_segments", 1)
_ORPH = call_queries.ORACLE["orphan_ends"].replace("select e.call_id, e.event_id from call_events e",
                                                   "select e.call_id from call_events e", 1)

_DELIVERED = call_queries.ORACLE["call_running"].replace("from conversations\n", f"from conversations where not {_undelivered('conv_id', 'turn')}\n", 1)

_JOINED = call_queries.ORACLE["call_running"].replace("from conversations\n", f"from conversations where turn >= {JOINED}\n", 1)

ORACLE = {
    "stream_progress": _DELIVERED,
    "stream_from_latest": _JOINED,
    "stream_running": call_queries.ORACLE["call_running"],
    "stream_final": call_queries.ORACLE["call_final"],
    "stream_ended_calls": _ENDED,
    "stream_orphan_ends": _ORPH,
    "stream_segments": segment_queries.ORACLE["voice_segments"],
    "stream_final_disordered": call_queries.ORACLE["call_final"],
    "stream_segments_disordered": segment_queries.ORACLE["voice_segments"],
}
