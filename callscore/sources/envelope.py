"""Message envelope: construction (S3, S4, X2), decoding with a quarantine
(S2, Q1), Kafka source/sink wrappers (S1, S3) and base64 payloads (S11).

No Kafka connector ships with the runtime used for tests, so the Kafka
wrappers are thin and the same envelope is exercised through file streams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import iso_utc

# ---- fixed values: message fields ----
CHUNK = "CHUNK"
CALL_END = "CALL_END"
MAX_MESSAGE_BYTES = 52428800

CONSUMER_SCHEMA = T.StructType([
    T.StructField("call_id", T.StringType()),
    T.StructField("chunk_index", T.StringType()),
    T.StructField("event", T.StringType()),
    T.StructField("start_timestamp", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("transcript", T.StringType()),
    T.StructField("audio_b64", T.StringType()),
    T.StructField("mfcc", T.ArrayType(T.ArrayType(T.DoubleType()))),
    T.StructField("spectrogram", T.ArrayType(T.ArrayType(T.DoubleType()))),
    T.StructField("timing", T.MapType(T.StringType(), T.DoubleType())),
])

# fields the call processor reads (audio_b64 and timing are pruned before state)
PROCESSOR_FIELDS = ("call_id", "chunk_index", "event", "event_time", "transcript", "mfcc", "spectrogram")


def chunk_message(call_id: Column, chunk_index: Column, transcript: Column, start_ts: Column | None = None,
                  mfcc: Column | None = None, spec: Column | None = None, timing: Column | None = None,
                  audio_b64: Column | None = None) -> Column:
    """The CHUNK payload as JSON text."""
    fields = [call_id.cast("string").alias("call_id"), chunk_index.cast("int").alias("chunk_index"),
              F.lit(CHUNK).alias("event")]
    if start_ts is not None:
        fields.append(iso_utc(start_ts).alias("start_timestamp"))
    fields.append(transcript.alias("transcript"))
    if mfcc is not None:
        fields.append(mfcc.alias("mfcc"))
    if spec is not None:
        fields.append(spec.alias("spectrogram"))
    if audio_b64 is not None:
        fields.append(audio_b64.alias("audio_b64"))
    if timing is not None:
        fields.append(timing.alias("timing"))
    return F.to_json(F.struct(*fields))


def end_message(call_id: Column, ts: Column | None = None) -> Column:
    """The CALL_END marker as JSON text."""
    fields = [call_id.cast("string").alias("call_id"), F.lit(CALL_END).alias("event")]
    if ts is not None:
        fields.append(iso_utc(ts).alias("timestamp"))
    return F.to_json(F.struct(*fields))


def stage_ms(start: Column, end: Column) -> Column:
    """milliseconds from one timestamp to a later one."""
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / F.lit(1000.0)


def timing_between(started: Column, featured: Column, transcribed: Column) -> Column:
    """the timing map from the times at which the stages ended."""
    return timing_map(stage_ms(started, featured), stage_ms(featured, transcribed), stage_ms(started, transcribed))


def timing_map(feature_ms: Column, transcribe_ms: Column, total_ms: Column) -> Column:
    """stage durations in ms, rounded to 2 decimals."""
    return F.create_map(F.lit("feature_ms"), F.round(feature_ms, 2), F.lit("transcribe_ms"), F.round(transcribe_ms, 2),
                        F.lit("total_ms"), F.round(total_ms, 2))


def decode(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Parse the JSON envelope (PERMISSIVE: malformed text gives nulls).

    Adds ``chunk_no`` (int via try_cast), ``kind`` (P1) and ``event_time``."""
    d = raw.withColumn("_m", F.from_json(F.col(value_col).cast("string"), CONSUMER_SCHEMA))
    d = d.select(*[c for c in raw.columns if c != value_col], "_m.*")
    is_end = F.col("event").eqNullSafe(CALL_END)
    return (d.withColumn("chunk_no", F.col("chunk_index").try_cast("int"))
             .withColumn("kind", F.when(is_end, F.lit("end")).otherwise(F.lit("chunk")))
             .withColumn("event_time", F.to_timestamp(F.coalesce("start_timestamp", "timestamp"),
                                                       "yyyy-MM-dd'T'HH:mm:ss'Z'")))


def _holds_null(m: Column) -> Column:
    return F.exists(m, lambda row: row.isNull() | F.coalesce(F.exists(row, lambda x: x.isNull()), F.lit(False)))


def _ragged(m: Column) -> Column:
    return F.exists(m, lambda row: F.size(row) != F.size(F.try_element_at(m, F.lit(1))))


def quarantine_reason(need_matrices: bool = False) -> Column:
    """Q1, Q10, Q17: why a decoded row cannot be processed (null when it can):
    no call id, no index or one below 0, a matrix with a null in it (or, with
    ``need_matrices``, none at all) or with rows of different lengths."""
    chunk, null, ragged = F.col("kind") == "chunk", F.lit(False), F.lit(False)
    for m in ("mfcc", "spectrogram"):
        m = F.col(m)
        null = null | F.coalesce(_holds_null(m), F.lit(need_matrices))
        ragged = ragged | F.coalesce(_ragged(m), F.lit(False))
    return (F.when(F.col("call_id").isNull(), F.lit("no_call_id"))
             .when(chunk & (F.col("chunk_no").isNull() | (F.col("chunk_no") < 0)), F.lit("bad_index"))
             .when(chunk & null, F.lit("null_matrix"))
             .when(chunk & ragged, F.lit("ragged_matrix")))


def split_valid(decoded: DataFrame, need_matrices: bool = False) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with a ``reason``)."""
    r = decoded.withColumn("reason", quarantine_reason(need_matrices))
    return r.filter(F.col("reason").isNull()).drop("reason"), r.filter(F.col("reason").isNotNull())


def kafka_source(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
                 max_offsets: int | None = None) -> DataFrame:
    """Keyed message stream (needs the Kafka connector on the classpath)."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
         .option("startingOffsets", starting))
    if max_offsets:
        r = r.option("maxOffsetsPerTrigger", max_offsets)
    return r.load().select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                           "offset")


def kafka_sink_frame(messages: DataFrame, key_col: str = "call_id", value_col: str = "value") -> DataFrame:
    """S3: key = call id (keeps per-call order on one partition), value = JSON."""
    return messages.select(F.col(key_col).cast("string").alias("key"), F.col(value_col).alias("value"))


def write_kafka(messages: DataFrame, servers: str, topic: str, checkpoint: str):
    return (kafka_sink_frame(messages).writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", topic).option("kafka.max.request.size", MAX_MESSAGE_BYTES)
            .option("checkpointLocation", checkpoint).start())


def b64(col) -> Column:
    """S11."""
    return F.base64(F.col(col) if isinstance(col, str) else col)


def unb64(col) -> Column:
    return F.unbase64(F.col(col) if isinstance(col, str) else col)


def producer_log(chunk_index, transcript, timing) -> Column:
    """The producer's two-line log for a sent chunk (timings at 2 decimals)."""
    t = F.col(timing) if isinstance(timing, str) else timing
    ms = lambda k: t[k].cast("string")
    return F.concat(F.lit("Chunk "), F.col(chunk_index).cast("string"), F.lit(" : Transcript: "), F.col(transcript),
                    F.lit("\nfeature_ms="), ms("feature_ms"), F.lit(" | transcribe_ms="), ms("transcribe_ms"),
                    F.lit(" | total_ms="), ms("total_ms"))


def observe_envelope(decoded: DataFrame, name: str = "envelope") -> DataFrame:
    """A14 on a stream: rows read and quarantined per micro-batch, published in
    the query progress (``observedMetrics``) without another pass."""
    return decoded.observe(name, F.count(F.lit(1)).alias("rows"),
                           F.count(quarantine_reason()).alias("quarantined"))
