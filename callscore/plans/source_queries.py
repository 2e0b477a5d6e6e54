"""Registered queries of sources, sinks and small table helpers (S3, S6, S8,
S10, P8, P9, J5) and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import calls, splits
from ..session import scratch_path
from ..sources import envelope as env
from ..sources import tables
from ..streaming.runner import run_waves
from . import call_queries, stream_queries
from . import fixtures as fx
from .envelope_queries import _ISO, _NTS


def q_sink_frame(spark, sf_dir):
    """S3: key and value of every message as the keyed sink gets them."""
    ev = fx.call_events(spark, sf_dir)
    ch = calls.number_chunks(ev)
    chunks = ch.select("call_id", env.chunk_message(F.col("call_id"), F.col("chunk_index"), F.col("transcript"), F.col("ts")).alias("value"))
    ends = calls.end_markers(ev).select("call_id", env.end_message(F.col("call_id"), F.col("ts")).alias("value"))
    return env.kafka_sink_frame(chunks.unionByName(ends))


def q_fallback_source(spark, sf_dir):
    """The first source is not there, the second has the columns."""
    names = ("clip_id", "label_num", "bert_prob", "mfcc_prob", "spec_prob")
    scores = fx.scored(spark, sf_dir).drop("user_id").toDF("clip_id", "label_num", "bert_prob", "mfcc_prob", "spec_prob")
    path = tables.write_csv(scores, scratch_path(spark, "scores"))
    return tables.read_first(spark, f"{path}-first", path, names, tables.SCORE_SCHEMA, fmt="csv")


def q_stream_batch_sink(spark, sf_dir):
    """The call stream into the per-batch idempotent sink."""
    out = run_waves(spark, stream_queries.chunk_messages(spark, sf_dir), stream_queries._call_stream, stream_queries._OUT, "stream_batch_sink",
                    sink="foreachBatch").filter(F.col("kind") == "final")
    return out.select(F.col("call_id").cast("long").alias("call_id"), "n_segments", F.col("text").alias("full_text"), *stream_queries._SCORES)


def q_listed_files(spark, sf_dir):
    """The files of a written table, listed without reading them."""
    texts = fx.texts(spark, sf_dir)
    path = tables.write_parquet(texts.repartition("lang"), scratch_path(spark, "listed"), ["lang"])
    files = tables.file_listing(spark, path, "*.parquet")
    return files.groupBy(F.regexp_extract("path", "lang=([^/]*)", 1).alias("lang")).agg(
        F.count(F.lit(1)).alias("n_files"), F.min(F.col("length") > 0).alias("filled"))


def q_default_column(spark, sf_dir):
    """A constant where the column is missing, the column where it is not."""
    d = tables.require_columns(fx.texts(spark, sf_dir).select("doc_id", "lang"), ["doc_id", "lang"])
    return tables.with_default(tables.with_default(d, "split", "train"), "lang", "none")


def q_class_weight_join(spark, sf_dir):
    """The balanced class weight on every row."""
    d = fx.scored(spark, sf_dir).select("clip_id", "label_num")
    return splits.with_class_weight(d).select("clip_id", "label_num", F.round("weight", 9).alias("weight"))


QUERIES = {
    "sink_frame": q_sink_frame,
    "fallback_source": q_fallback_source,
    "stream_batch_sink": q_stream_batch_sink,
    "listed_files": q_listed_files,
    "default_column": q_default_column,
    "class_weight_join": q_class_weight_join,
}

ORACLE = {
    "sink_frame": fx.oracle(["call_events"], f"""select call_id as key, '{{"call_id":"' || call_id || '","chunk_index":' || cast(chunk_index as varchar)
  || ',"event":"CHUNK","start_timestamp":"' || {_ISO} || '","transcript":"' || transcript || '"}}' as value from nt
  union all select call_id, '{{"call_id":"' || call_id || '","event":"CALL_END","timestamp":"' || {_ISO} || '"}}'
  from call_events where event = 'CALL_END'""", _NTS),
    "fallback_source": fx.oracle(["scored"], """select clip_id, label_num, p1 as bert_prob, p2 as mfcc_prob, p3 as spec_prob from scored"""),
    "stream_batch_sink": call_queries.ORACLE["call_final"],
    "listed_files": """select coalesce(lang, '__HIVE_DEFAULT_PARTITION__') as lang, cast(1 as bigint) as n_files, true as filled
  from documents group by 1""",
    "default_column": "select doc_id, lang, 'train' as split from documents",
    "class_weight_join": fx.oracle(["scored"], """select clip_id, label_num, round(cast(count(*) over () as double)
  / ((select count(distinct label_num) from scored) * count(*) over (partition by label_num)), 9) as weight from scored"""),
}
