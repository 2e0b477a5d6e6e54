"""Registered message-envelope queries (S2-S4, S11, F3-F5, X2, Q1) and twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import calls
from ..sources import envelope as env
from . import fixtures as fx
from .sqltext import strip_or_empty


def _numbered_with_ts(spark, sf_dir):
    ev = fx.call_events(spark, sf_dir)
    return ev, calls.number_chunks(ev)


def _timing():
    """Stage durations between the times at which a chunk's stages ended: its
    features ``value`` ms after its start, its transcript 2 * ``value`` ms later."""
    after = lambda t, ms: F.timestamp_micros(F.unix_micros(t) + (ms * 1000).cast("long"))
    started = F.col("ts").cast("timestamp")
    featured = after(started, F.col("value"))
    return env.timing_between(started, featured, after(featured, F.col("value") * 2))


def q_envelope_roundtrip(spark, sf_dir):
    ev, ch = _numbered_with_ts(spark, sf_dir)
    timing = _timing()
    payload = env.b64(F.encode("transcript", "UTF-8"))
    chunk_msgs = ch.select(env.chunk_message(F.col("call_id"), F.col("chunk_index"), F.col("transcript"),
                                             F.col("ts"), timing=timing, audio_b64=payload).alias("value"))
    end_msgs = calls.end_markers(ev).select(env.end_message(F.col("call_id"), F.col("ts")).alias("value"))
    d = env.decode(chunk_msgs.unionByName(end_msgs))
    return d.select("call_id", "kind", F.col("chunk_no").alias("chunk_index"), "event", "start_timestamp",
                    "timestamp", "transcript", F.col("timing")["total_ms"].alias("total_ms"),
                    F.decode(env.unb64("audio_b64"), "UTF-8").alias("payload"))


def q_producer_log_lines(spark, sf_dir):
    ev, ch = _numbered_with_ts(spark, sf_dir)
    timing = _timing()
    return ch.select("call_id", "chunk_index", env.producer_log("chunk_index", "transcript", timing).alias("line"))


def raw_messages(spark, sf_dir):
    """Delivered message text with a share of broken deliveries (offset = event_id)."""
    ev, ch = _numbered_with_ts(spark, sf_dir)
    k = F.col("event_id") % 50
    matrix = F.when(k == 4, "[[1,2],[3]]").when(k == 5, "[[1,2],[3,null]]").when(k == 6, "[[1,2],null]").otherwise("[[1,2],[3,4]]")
    index = F.when(k == 7, -1 - F.col("chunk_index")).otherwise(F.col("chunk_index"))
    chunk = F.concat(F.lit('{"call_id":"'), F.col("call_id"), F.lit('","chunk_index":'),
                     index.cast("string"), F.lit(',"event":"CHUNK","transcript":"'),
                     F.col("transcript"), F.lit('","mfcc":'), matrix, F.lit('}'))
    bad_idx = F.concat(F.lit('{"call_id":"'), F.col("call_id"), F.lit('","chunk_index":"x'),
                       F.col("chunk_index").cast("string"), F.lit('","event":"CHUNK","transcript":"'),
                       F.col("transcript"), F.lit('"}'))
    end = F.concat(F.lit('{"call_id":"'), F.col("call_id"), F.lit('","event":"CALL_END"}'))
    broken = (F.when(k == 0, F.col("props")).when(k == 1, F.concat(F.lit("not json "), F.col("props")))
               .when(k == 3, F.lit(None).cast("string")))
    c = ch.select(F.col("event_id").alias("msg_offset"),
                  F.when(k.isin(0, 1, 3), broken).when(k == 2, bad_idx).otherwise(chunk).alias("value"))
    e = calls.end_markers(ev).select(F.col("event_id").alias("msg_offset"),
                                     F.when(k.isin(0, 1, 3), broken).otherwise(end).alias("value"))
    return c.unionByName(e)


def q_quarantine(spark, sf_dir):
    d = env.decode(raw_messages(spark, sf_dir))
    return d.select("msg_offset", F.coalesce(env.quarantine_reason(), F.lit("ok")).alias("reason"))


QUERIES = {
    "envelope_roundtrip": q_envelope_roundtrip,
    "quarantine": q_quarantine,
    "producer_log_lines": q_producer_log_lines,
}

_ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%SZ')"
_NTS = ("nt", f"""select call_id, event_id, ts, value, props,
  row_number() over (partition by call_id order by ts, event_id) - 1 as chunk_index, transcript
  from call_events where event <> 'CALL_END' and length({strip_or_empty('transcript')}) > 0""")
_RAW = ("raw", """select event_id as msg_offset, case when event_id % 50 = 0 then props
  when event_id % 50 = 1 then 'not json ' || props when event_id % 50 = 3 then null
  when event_id % 50 = 2 then '{"call_id":"' || call_id || '","chunk_index":"x' || cast(chunk_index as varchar)
    || '","event":"CHUNK","transcript":"' || transcript || '"}'
  else '{"call_id":"' || call_id || '","chunk_index":' || cast(case when event_id % 50 = 7 then -1 - chunk_index else chunk_index end as varchar)
    || ',"event":"CHUNK","transcript":"' || transcript || '","mfcc":' || case event_id % 50 when 4 then '[[1,2],[3]]'
    when 5 then '[[1,2],[3,null]]' when 6 then '[[1,2],null]' else '[[1,2],[3,4]]' end || '}' end as value from nt
  union all select event_id, case when event_id % 50 = 0 then props when event_id % 50 = 1 then 'not json ' || props
  when event_id % 50 = 3 then null else '{"call_id":"' || call_id || '","event":"CALL_END"}' end
  from call_events where event = 'CALL_END'""")

_MS = "cast(round({}, 2) as varchar)"
# whole microseconds, as timestamps keep them
_FEATURE = "cast(trunc(value * 1000) as bigint) / 1000.0"
_TRANSCRIBE = "cast(trunc(value * 2 * 1000) as bigint) / 1000.0"
_TOTAL = "(cast(trunc(value * 1000) as bigint) + cast(trunc(value * 2 * 1000) as bigint)) / 1000.0"

ORACLE = {
    "producer_log_lines": fx.oracle(["call_events"], "select call_id, chunk_index, 'Chunk ' || cast(chunk_index as varchar)"
                                    " || ' : Transcript: ' || transcript || chr(10) || 'feature_ms=' || "
                                    + _MS.format(_FEATURE) + " || ' | transcribe_ms=' || " + _MS.format(_TRANSCRIBE)
                                    + " || ' | total_ms=' || " + _MS.format(_TOTAL) + " as line from nt", _NTS),
    "envelope_roundtrip": fx.oracle(["call_events"], f"""select call_id, 'chunk' as kind, cast(chunk_index as int) as chunk_index, 'CHUNK' as event,
  {_ISO} as start_timestamp, null::varchar as timestamp, transcript, round({_TOTAL}, 2) as total_ms,
  transcript as payload from nt
  union all select call_id, 'end', null::int, 'CALL_END', null::varchar, {_ISO}, null::varchar, null::double,
  null::varchar from call_events where event = 'CALL_END'""", _NTS),
    "quarantine": fx.oracle(["call_events"], """select msg_offset, case when j is null or json_extract_string(j, '$.call_id') is null
  then 'no_call_id' when coalesce(json_extract_string(j, '$.event'), '') <> 'CALL_END'
  and coalesce(try_cast(json_extract_string(j, '$.chunk_index') as integer), -1) < 0 then 'bad_index'
  when coalesce(json_extract_string(j, '$.event'), '') = 'CALL_END' or json_extract(j, '$.mfcc') is null then 'ok'
  when cast(json_extract(j, '$.mfcc') as varchar) like '%null%' then 'null_matrix'
  when len(list_distinct(list_transform(from_json(json_extract(j, '$.mfcc'), '["JSON"]'), lambda x: json_array_length(x)))) > 1
  then 'ragged_matrix' else 'ok' end as reason
  from (select msg_offset, case when json_valid(value) then value end as j from raw) x""", _NTS, _RAW),
}
