"""Input views derived from the driver tables.

Each view is built with the DataFrame API (skew-safe where it orders rows
inside a key) and has a DuckDB twin (``SQL``) that the oracle queries inline
as CTEs. Table loading prunes columns at the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.prefix import running_totals, time_bucket


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Call chunks keyed by (call_id, chunk_index)."""
    c = table(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").alias("call_id"), F.col("turn").cast("int").alias("chunk_index"),
                    F.col("text").alias("transcript"))


def chunk_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chunks with two 8 x 8 matrices each, picked from the embeddings by
    (call, chunk) modulo their number."""
    c = chunks(spark, sf_dir)
    m = matrices(spark, sf_dir).select("vec_id", "m")
    n = m.agg((F.max("vec_id") + 1).alias("_n"))      # one row
    c = c.crossJoin(F.broadcast(n))
    for name, a, b in (("mfcc", 31, 1), ("spectrogram", 17, 3)):
        key = (F.col("call_id") * a + F.col("chunk_index") * b) % F.col("_n")
        c = c.withColumn("_k", key).join(m.select(F.col("vec_id").alias("_k"), F.col("m").alias(name)), "_k", "left").drop("_k")
    return c.drop("_n")


def call_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message stream with end markers; each purchase closes the user's session."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    e = e.withColumn("event", F.when(F.col("event_type") == "purchase", "CALL_END").otherwise("CHUNK"))
    is_end = (F.col("event") == "CALL_END").cast("long")
    e = running_totals(e, ["user_id"], ["ts", "event_id"], time_bucket("ts"), sums={"_ends": is_end})
    e = e.withColumn("session_no", F.col("_ends") - is_end)
    return e.select(
        F.concat(F.lit("call_"), F.col("user_id").cast("string"), F.lit("-"),
                 F.col("session_no").cast("string")).alias("call_id"),
        "event_id", "ts", "event",
        F.when((F.col("event") == "CALL_END") | (F.col("event_type") == "error"), F.lit(""))
         .otherwise(F.col("event_type")).alias("transcript"),
        "value", "props")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score table keyed by clip_id: label and three modality probabilities."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("clip_id"), "user_id",
        F.when(F.col("event_type").isin("error", "purchase"), 1).otherwise(0).cast("int").alias("label_num"),
        F.least(F.col("value") / F.lit(100.0), F.lit(1.0)).alias("p1"),
        ((F.col("event_id") * 7919) % 1000).cast("double") / F.lit(1000.0),
        ((F.col("user_id") * 31 + F.col("event_id")) % 1000).cast("double") / F.lit(1000.0),
    ).toDF("clip_id", "user_id", "label_num", "p1", "p2", "p3")


def scored_big(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bench-size score table from lineitem (no unique key)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).cast("int").alias("label_num"),
        (F.col("l_discount") * F.lit(10.0)).alias("p1"),
        (F.col("l_tax") / F.lit(0.08)).alias("p2"),
        (F.col("l_quantity") / F.lit(50.0)).alias("p3"))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as an unlabelled transcript row."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars")
    return d.select("doc_id", F.col("text").alias("transcription"), "lang",
                    (F.col("n_chars").cast("double") / F.lit(100.0)).alias("duration_sec"))


def text_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """texts plus a relative audio path and its resolved form."""
    return _with_paths(texts(spark, sf_dir))


def labelled_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw labelled rows with messy label spellings, keyed by doc_id."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    j = d.join(lab, "doc_id")
    label = F.when(F.col("toxic") == 1,
                   F.when(F.col("doc_id") % 2 == 0, " Fraudulent ").otherwise("fraud")) \
        .otherwise(F.when(F.col("doc_id") % 3 == 0, "Normal")
                   .when(F.col("doc_id") % 3 == 1, "Non_Fraud").otherwise("non_fraudulent"))
    return j.select("doc_id", F.col("text").alias("transcription"), "source", "lang",
                    label.alias("label"), (F.col("n_chars").cast("double") / F.lit(100.0)).alias("duration_sec"))


AUDIO_BASE = "corpus"
URL_PATH = r"^[a-z]+://[^/]+/([^?#]*)"
LAST_EXT = r"\.[^./]*$"


def labelled_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labelled_text plus a relative audio path and its resolved form."""
    return _with_paths(labelled_text(spark, sf_dir))


def _with_paths(rows: DataFrame) -> DataFrame:
    from ..operators.cleaning import resolve_path
    rel = F.concat(F.col("lang"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".wav"))
    return rows.withColumn("audio_rel", rel).withColumn("audio_path", resolve_path(AUDIO_BASE, "audio_rel"))


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths that exist: one per page, from the URL path with its extension swapped for .wav."""
    pg = table(spark, sf_dir, "pages").select("url")
    stem = F.regexp_replace(F.regexp_extract("url", URL_PATH, 1), LAST_EXT, "")
    return pg.select(F.concat(F.lit(AUDIO_BASE + "/"), stem, F.lit(".wav")).alias("path"))


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Framed signal keyed by (clip_id, frame_no) with a voice flag (null now and then) and level in dB."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "value")
    e = running_totals(e, ["user_id"], ["ts", "event_id"], time_bucket("ts"), rank="frame_no")
    return e.select(F.col("user_id").alias("clip_id"), "event_id", "frame_no",
                    F.col("value").alias("x"), F.when(F.col("event_id") % 97 != 0, F.col("value") > 35).alias("is_voiced"),
                    F.round(F.lit(10.0) * F.log10("value"), 6).alias("db"))


def matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as 8 x 8 double matrices, keyed by vec_id."""
    e = table(spark, sf_dir, "embeddings")
    emb = F.col("embedding").cast("array<double>")
    m = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice(emb, i * 8 + 1, 8))
    return e.select("vec_id", "label", m.alias("m"))


# ---------------------------------------------------------------- DuckDB twins
SQL = {
    "chunks": """select conv_id as call_id, cast(turn as int) as chunk_index, text as transcript
from conversations""",
    "chunk_matrices": """select c.*, a.m as mfcc_m, b.m as spec_m from chunks c
left join cell_means a on a.vec_id = (c.call_id * 31 + c.chunk_index) % (select max(vec_id) + 1 from embeddings)
left join cell_means b on b.vec_id = (c.call_id * 17 + c.chunk_index * 3) % (select max(vec_id) + 1 from embeddings)""",
    "cell_means": "select vec_id, list_avg(cast(embedding as double[])[1:64]) as m from embeddings",
    "call_events": """select concat('call_', user_id, '-', session_no) as call_id, event_id, ts, event,
  case when event = 'CALL_END' or event_type = 'error' then '' else event_type end as transcript, value, props
from (select *, coalesce(sum(case when event = 'CALL_END' then 1 else 0 end) over (partition by user_id order by ts, event_id
  rows between unbounded preceding and 1 preceding), 0) as session_no
from (select *, case when event_type = 'purchase' then 'CALL_END' else 'CHUNK' end as event from events) e) s""",
    "scored": """select event_id as clip_id, user_id,
  cast(case when event_type in ('error', 'purchase') then 1 else 0 end as int) as label_num,
  least(value / cast(100 as double), cast(1 as double)) as p1,
  cast((event_id * 7919) % 1000 as double) / cast(1000 as double) as p2,
  cast((user_id * 31 + event_id) % 1000 as double) / cast(1000 as double) as p3
from events""",
    "labelled_text": """select d.doc_id, d.text as transcription, d.source, d.lang,
  case when l.toxic = 1 then case when d.doc_id % 2 = 0 then ' Fraudulent ' else 'fraud' end
  else case when d.doc_id % 3 = 0 then 'Normal' when d.doc_id % 3 = 1 then 'Non_Fraud' else 'non_fraudulent' end end as label,
  cast(d.n_chars as double) / cast(100 as double) as duration_sec
from documents d join labels l on d.doc_id = l.doc_id""",
    "texts": """select doc_id, text as transcription, lang, cast(n_chars as double) / cast(100 as double) as duration_sec
from documents""",
    "text_paths": """select *, case when audio_rel like '/%' then audio_rel else 'corpus/' || audio_rel end as audio_path
from (select *, lang || '/' || cast(doc_id as varchar) || '.wav' as audio_rel from texts) x""",
    "labelled_paths": """select *, case when audio_rel like '/%' then audio_rel else 'corpus/' || audio_rel end as audio_path
from (select *, lang || '/' || cast(doc_id as varchar) || '.wav' as audio_rel from labelled_text) x""",
    "listing": r"""select 'corpus/' || regexp_replace(regexp_extract(url, '^[a-z]+://[^/]+/([^?#]*)', 1), '\.[^./]*$', '')
  || '.wav' as path from pages""",
    "frames": """select user_id as clip_id, event_id,
  row_number() over (partition by user_id order by ts, event_id) - 1 as frame_no,
  value as x, case when event_id % 97 <> 0 then value > 35 end as is_voiced, round(cast(10 as double) * log10(value), 6) as db
from events""",
    "matrices": """select vec_id, label,
  list_transform(range(0, 8), lambda i: cast(embedding as double[])[i * 8 + 1 : i * 8 + 8]) as m
from embeddings""",
}


def oracle(views: tuple[str, ...] | list[str], final: str, *ctes: tuple[str, str]) -> str:
    """DuckDB text: the named fixture views and extra (name, sql) CTEs, then ``final``."""
    parts = [(n, SQL[n]) for n in views] + list(ctes)
    if not parts:
        return final
    body = ",\n".join(f"{n} as (\n{q}\n)" for n, q in parts)
    return f"with {body}\n{final}"
