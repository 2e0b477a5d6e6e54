"""Per-call batch operators: running and final transcripts, segment counts,
decisions, chunk numbering, event dispatch and end-marker matching.

Scale notes
-----------
* The running transcript keeps only the first 512 (running) / 2048 (final)
  characters, so a piece matters only if its start offset in the joined
  text is within the limit. Offsets come from the skew-safe two-level
  prefix sum; only "head" pieces (at most limit + 1 per call) are ever
  collected, so no call is collected whole, however long it is.
* Per-call aggregates are plain ``groupBy`` (partial aggregation on the map
  side); per-call tables are joined back with AQE choosing broadcast at
  runtime or splitting skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import Scorer, score_columns, stand_in_scorer
from ..functions.text import preview, strip_or_empty
from . import folds
from .prefix import int_bucket, running_totals, time_bucket

# ---- fixed values ----
RUNNING_CHARS = 512
FINAL_CHARS = 2048
END_EVENT = "CALL_END"
MODALITIES = ("mfcc", "spectrogram")

INDEX_BUCKET = 4096      # chunk indexes per prefix bucket


def pieces(chunks: DataFrame) -> DataFrame:
    """(call_id, chunk_index, piece): stripped transcript, null as "".

    A redelivered (call_id, chunk_index) counts once, as in the stream (the
    delivery with the least text, so the choice is deterministic)."""
    p = chunks.select("call_id", "chunk_index", strip_or_empty("transcript").alias("piece"))
    return p.groupBy("call_id", "chunk_index").agg(F.min("piece").alias("piece"))


def with_offsets(p: DataFrame, bucket_width: int = INDEX_BUCKET) -> DataFrame:
    """Add ``pos`` (0-based order in the call) and ``start`` (offset of the
    piece in the space-joined text)."""
    w = F.length("piece") + F.lit(1)
    p = running_totals(p.withColumn("_w", w), ["call_id"], ["chunk_index"], int_bucket("chunk_index", bucket_width),
                       sums={"_end": F.col("_w")}, rank="pos")
    return p.withColumn("start", (F.col("_end") - F.col("_w")).cast("long")).drop("_end", "_w")


def _cut(limit: int):
    """Piece cut so that the concatenation never exceeds ``limit`` characters."""
    n = F.greatest(F.lit(limit) - F.col("start"), F.lit(0)).cast("int")
    return F.col("piece").substr(F.lit(1), n)


def _head_text(p: DataFrame, limit: int) -> DataFrame:
    """Per call ``n_segments`` and the first ``limit`` characters of its text,
    from the at most limit + 1 pieces that reach into them."""
    head = F.when(F.col("start") <= limit, F.struct(F.col("chunk_index").alias("i"), _cut(limit).alias("t")))
    agg = p.groupBy("call_id").agg(F.count(F.lit(1)).alias("n_segments"),
                                   F.collect_list(head).alias("_h"))
    txt = F.array_join(F.transform(F.array_sort("_h"), lambda s: s["t"]), " ")
    return agg.select("call_id", "n_segments", F.substring(txt, 1, limit).alias("text"))


def final_text(chunks: DataFrame, limit: int = FINAL_CHARS, bucket_width: int = INDEX_BUCKET) -> DataFrame:
    """A2 + A3: one row per call with ``n_segments`` and the text cut to ``limit``."""
    return _head_text(with_offsets(pieces(chunks), bucket_width), limit).withColumnRenamed("text", "full_text")


def running_text(chunks: DataFrame, limit: int = RUNNING_CHARS, bucket_width: int = INDEX_BUCKET) -> DataFrame:
    """Per chunk, the call's text so far cut to ``limit`` (plus ``n_segments``).

    The text so far is the call's settled text up to where the chunk ends, so
    one small row per call is joined to its chunks."""
    p = with_offsets(pieces(chunks), bucket_width)
    settled = _head_text(p, limit).select("call_id", "text")
    end = F.least(F.col("start") + F.length("piece"), F.lit(limit)).cast("int")
    return p.join(settled, "call_id").select("call_id", "chunk_index", (F.col("pos") + 1).alias("n_segments"),
                                             F.substring(F.col("text"), F.lit(1), end).alias("running_text"))


def decisions(df: DataFrame, text_col: str, mfcc: str | None = None, spec: str | None = None,
              scorer: Scorer = stand_in_scorer, compat: bool = False) -> DataFrame:
    """The scorer's four probabilities and the display status."""
    return score_columns(df, text_col, mfcc, spec, scorer, compat)


def _modalities(chunks: DataFrame) -> list[str]:
    return [m for m in MODALITIES if m in chunks.columns]


def _fold_args(chunks: DataFrame) -> tuple:
    return ["call_id"], "chunk_index", strip_or_empty("transcript"), {m: m for m in _modalities(chunks)}


def _one_per_chunk(chunks: DataFrame, m: str) -> DataFrame:
    """The flat matrix of each (call_id, chunk_index). A redelivered chunk
    counts once and whole, as in the folds: all its values are those of the
    delivery with the least text, and of equal texts of the one whose matrices hash least."""
    whole = F.struct(strip_or_empty("transcript").alias("piece"), F.xxhash64(*_modalities(chunks)).alias("h"))
    one = chunks.groupBy("call_id", "chunk_index").agg(F.min_by(F.flatten(m), whole).alias(m))
    return one.where(F.col(m).isNotNull())


def call_final(chunks: DataFrame, scorer: Scorer = stand_in_scorer, bucket_width: int = INDEX_BUCKET) -> DataFrame:
    """Final text, mean matrices and decision of every call. ``chunks`` may
    have the matrices ``mfcc`` and ``spectrogram``; a chunk whose matrix has
    another shape than its call's first counts in nothing (``changed_shapes``),
    and a call is there if any of its chunks counts."""
    found = _modalities(chunks)
    if not found:
        return decisions(final_text(chunks, bucket_width=bucket_width), "full_text", scorer=scorer)
    out = folds.final(chunks, *_fold_args(chunks), FINAL_CHARS, bucket_width)
    out = out.withColumnsRenamed({"n": "n_segments", "text": "full_text"})
    return decisions(out, "full_text", *[m if m in found else None for m in MODALITIES], scorer=scorer).drop(*found)


def call_running(chunks: DataFrame, scorer: Scorer = stand_in_scorer, bucket_width: int = INDEX_BUCKET) -> DataFrame:
    """For every chunk that counts the text and the mean matrices so far, scored."""
    found = _modalities(chunks)
    if not found:
        return decisions(running_text(chunks, bucket_width=bucket_width), "running_text", scorer=scorer)
    out = folds.running(chunks, *_fold_args(chunks), RUNNING_CHARS, bucket_width).drop(*[f"{m}_cols" for m in found])
    out = out.withColumnsRenamed({"n": "n_segments", "text": "running_text"})
    return decisions(out, "running_text", *[m if m in found else None for m in MODALITIES], scorer=scorer).drop(*found)


def changed_shapes(chunks: DataFrame) -> DataFrame:
    """The chunks that count in nothing: (call_id, chunk_index, text, reason), as
    the stream's ``quarantined`` rows."""
    return folds.misfits(chunks, *_fold_args(chunks)).withColumn("reason", F.lit("changed_shape"))


def _three_decimals(c: str):
    """Three decimals, rounded by the exact binary value (0.4945 is a little
    less and gives 0.494); a missing score is shown as nan."""
    return F.coalesce(F.format_number(F.col(c), 3), F.lit("nan"))


def display_lines(running: DataFrame) -> DataFrame:
    """The console line for a running decision."""
    f3 = _three_decimals
    line = F.concat(F.lit("["), F.col("call_id").cast("string"), F.lit(":"), F.col("chunk_index").cast("string"),
                    F.lit("] Transcript: "), preview("running_text"), F.lit("\n"), F.col("status"),
                    F.lit(" | Prob="), f3("final_prob"), F.lit(" ("), f3("bert_prob"), F.lit(","),
                    f3("mfcc_prob"), F.lit(","), f3("spec_prob"), F.lit(")"))
    return running.select("call_id", "chunk_index", line.alias("line"))


# ------------------------------------------------------------ message stream
def event_kind(event_col: str = "event"):
    """CALL_END is an end marker; anything else, null included, is a chunk."""
    return F.when(F.col(event_col).eqNullSafe(END_EVENT), F.lit("end")).otherwise(F.lit("chunk"))


def number_chunks(events: DataFrame) -> DataFrame:
    """P3 + W4: drop blank chunks, then number the rest from 0 in call order."""
    ch = events.filter((F.col("event") != END_EVENT) & (F.length(strip_or_empty("transcript")) > 0))
    return running_totals(ch, ["call_id"], ["ts", "event_id"], time_bucket("ts"), rank="chunk_index")


def end_markers(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event") == END_EVENT)


def orphan_ends(events: DataFrame) -> DataFrame:
    """End markers of calls that never produced a chunk."""
    # distinct first: a partial aggregate collapses a hot call's chunks before the shuffle
    started = events.filter((F.col("event") != END_EVENT) & (F.length(strip_or_empty("transcript")) > 0)) \
        .select("call_id").distinct()
    return end_markers(events).join(started, "call_id", "left_anti")


def ended_calls(events: DataFrame, limit: int = FINAL_CHARS) -> DataFrame:
    """End markers matched to the call's final text and decision."""
    ch = number_chunks(events).select("call_id", "chunk_index", "transcript")
    fin = call_final(ch) if limit == FINAL_CHARS else decisions(final_text(ch, limit), "full_text")
    return end_markers(events).select("call_id", "event_id").join(fin, "call_id")


# ---- fixed values ----
SUMMARY_RULE = "================ FINAL CALL SUMMARY ================"
SUMMARY_END = "===================================================="


def summary_text(final: DataFrame) -> DataFrame:
    """The end-of-call summary block as one text column."""
    f3 = _three_decimals
    txt = F.concat(F.lit("\n" + SUMMARY_RULE + "\nCall ID: "), F.col("call_id").cast("string"),
                   F.lit("\nTotal Segments: "), F.col("n_segments").cast("string"),
                   F.lit("\n\nFinal Transcript:\n"), F.col("full_text"), F.lit("\n\nFinal Decision: "),
                   F.col("status"), F.lit("\nProbability="), f3("final_prob"), F.lit("   (bert="), f3("bert_prob"),
                   F.lit(", mfcc="), f3("mfcc_prob"), F.lit(", spec="), f3("spec_prob"),
                   F.lit(")\n" + SUMMARY_END + "\n"))
    return final.select("call_id", txt.alias("summary"))
