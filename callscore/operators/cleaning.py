"""Labelled-table cleaning: label normalisation, path resolution and the
existence check, duration gate, transcript cleaning, audit counters.

The existence check is a semi/anti join against a file listing DataFrame
(``binaryFile`` listing in production; any table of paths in tests), never
a per-row filesystem probe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_text, label_name, label_num, text_long_enough

# ---- fixed values ----
MIN_SEC = 0.5
MAX_SEC = 30.0
SR_TARGET = 16000
DURATION_DECIMALS = 3
AUDIO_EXT = ".wav"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def resolve_path(base: str, p) -> Column:
    """``os.path.join(base, p)``: an absolute ``p`` wins."""
    p = _c(p).cast("string")
    joined = F.concat(F.lit(base.rstrip("/") + "/"), p) if base else p
    return F.when(p.startswith("/"), p).otherwise(joined)


def path_stem(p) -> Column:
    """Last path component without its last extension (a leading dot is kept)."""
    name = F.element_at(F.split(_c(p), "/"), -1)
    return F.regexp_extract(name, r"^(.+?)(\.[^.]*)?$", 1)


def output_path(label_num_col, p, root: str = "") -> Column:
    """``<root>/<label dir>/<stem>.wav``."""
    rel = F.concat(label_name(label_num_col), F.lit("/"), path_stem(p), F.lit(AUDIO_EXT))
    return F.concat(F.lit(root.rstrip("/") + "/"), rel) if root else rel


def with_labels(df: DataFrame, col: str = "label") -> DataFrame:
    """P4 + P5: numeric label and canonical name."""
    n = label_num(col)
    return df.withColumn("label_num", n).withColumn("label_clean", label_name(n))


def existing(df: DataFrame, listing: DataFrame, path_col: str = "audio_path") -> DataFrame:
    """Keep rows whose file is in the listing (``left_semi``)."""
    return df.join(listing.select(F.col("path").alias(path_col)).distinct(), path_col, "left_semi")


def missing(df: DataFrame, listing: DataFrame, path_col: str = "audio_path") -> DataFrame:
    """Rows whose file is absent (``left_anti``)."""
    return df.join(listing.select(F.col("path").alias(path_col)).distinct(), path_col, "left_anti")


def duration_gate(df: DataFrame, col: str = "duration_sec") -> DataFrame:
    """Drop clips under 0.5 s, cut longer than 30 s to 30, round to 3 dp."""
    d = F.col(col)
    return df.filter(d >= MIN_SEC).withColumn(col, F.round(F.least(d, F.lit(MAX_SEC)), DURATION_DECIMALS))


def cut_samples(samples, sr: int = SR_TARGET) -> Column:
    """P11 on sample arrays: keep at most 30 s of samples."""
    return F.slice(_c(samples), 1, int(MAX_SEC * sr))


def audit(df: DataFrame, listing: DataFrame, path_col: str = "audio_path",
          dur_col: str = "duration_sec") -> DataFrame:
    """One pass, one row: rows read, missing files, bad clips, kept."""
    flag = listing.select(F.col("path").alias(path_col)).distinct().withColumn("_exists", F.lit(True))
    j = df.join(flag, path_col, "left")
    exists = F.coalesce(F.col("_exists"), F.lit(False))
    bad = exists & (F.col(dur_col).isNull() | (F.col(dur_col) < MIN_SEC))
    return j.agg(F.count(F.lit(1)).alias("n_read"),
                 F.count(F.when(~exists, 1)).alias("n_missing"),
                 F.count(F.when(bad, 1)).alias("n_bad"),
                 F.count(F.when(exists & ~bad, 1)).alias("n_kept"))


def clean_table(df: DataFrame, listing: DataFrame, path_col: str = "audio_path", out_root: str = "clean/audio",
                keep_empty_text: bool = True) -> DataFrame:
    """The clean table: existing files, gated durations, canonical labels,
    cleaned transcripts, output paths keyed by the row id."""
    x = duration_gate(existing(with_labels(df), listing, path_col))
    x = x.withColumn("transcription_clean", clean_text("transcription"))
    if not keep_empty_text:
        x = x.filter(text_long_enough("transcription_clean"))
    return x.select("*", output_path("label_num", path_col, out_root).alias("audio_path_clean"),
                    F.lit(SR_TARGET).alias("sr"))
