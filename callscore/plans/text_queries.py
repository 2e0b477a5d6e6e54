"""Registered label / text / path queries and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import clean_text
from ..operators import cleaning
from ..sources import tables
from . import fixtures as fx
from .sqltext import clean_text as sql_clean, strip

LP = ["labelled_text", "labelled_paths", "listing"]
TP = ["texts", "text_paths", "listing"]


def _lp(spark, sf_dir):
    return fx.labelled_paths(spark, sf_dir), fx.file_listing(spark, sf_dir)


def q_label_normalise(spark, sf_dir):
    lt = cleaning.with_labels(fx.labelled_text(spark, sf_dir))
    return lt.select("doc_id", "label", "label_num", "label_clean")


def q_clean_text(spark, sf_dir):
    lt = fx.texts(spark, sf_dir)
    return lt.select("doc_id", clean_text("transcription").alias("transcription_clean"))


def q_text_length_filter(spark, sf_dir):
    lt = fx.texts(spark, sf_dir).select("doc_id", clean_text("transcription").alias("t"))
    return lt.filter(F.length("t") >= 3).select("doc_id", F.length("t").cast("long").alias("n_chars_clean"))


def q_path_resolve(spark, sf_dir):
    lp = cleaning.with_labels(fx.labelled_paths(spark, sf_dir))
    return lp.select("doc_id", "audio_path", cleaning.output_path("label_num", "audio_path").alias("out_path"))


def q_existing_files(spark, sf_dir):
    lp, ls = fx.text_paths(spark, sf_dir), fx.file_listing(spark, sf_dir)
    return cleaning.existing(lp, ls).select("doc_id", "audio_path")


def q_missing_files(spark, sf_dir):
    lp, ls = fx.text_paths(spark, sf_dir), fx.file_listing(spark, sf_dir)
    return cleaning.missing(lp, ls).select("doc_id", "audio_path")


def q_duration_gate(spark, sf_dir):
    return cleaning.duration_gate(fx.texts(spark, sf_dir)).select("doc_id", "duration_sec")


def q_audit_counts(spark, sf_dir):
    lp, ls = _lp(spark, sf_dir)
    return cleaning.audit(lp, ls)


def _clean(spark, sf_dir):
    lp, ls = _lp(spark, sf_dir)
    return cleaning.clean_table(lp, ls).select("doc_id", "audio_path_clean", F.col("label_clean").alias("label"),
                                               "label_num", "transcription_clean", "duration_sec", "sr")


def q_clean_table(spark, sf_dir):
    return _clean(spark, sf_dir)


def q_csv_roundtrip(spark, sf_dir):
    """S7 then S5: write the clean table as CSV to the shared scratch folder and
    read it back with the explicit clean-table schema."""
    return tables.csv_roundtrip(spark, _clean(spark, sf_dir), "clean_table", tables.CLEAN_SCHEMA)


def q_csv_raw_text(spark, sf_dir):
    """S7 then S5 on raw texts: commas, quotes, backslashes and line breaks come back as they were."""
    d = fx.texts(spark, sf_dir).select("doc_id", "transcription", "lang")
    return tables.csv_roundtrip(spark, d, "raw_text", d.schema)


QUERIES = {
    "csv_raw_text": q_csv_raw_text,
    "label_normalise": q_label_normalise,
    "clean_text": q_clean_text,
    "text_length_filter": q_text_length_filter,
    "path_resolve": q_path_resolve,
    "existing_files": q_existing_files,
    "missing_files": q_missing_files,
    "duration_gate": q_duration_gate,
    "audit_counts": q_audit_counts,
    "clean_table": q_clean_table,
    "csv_roundtrip": q_csv_roundtrip,
}

_LNUM = f"case when starts_with(lower({strip('label')}), 'fraud') then 1 else 0 end"
_LAB = ("lab", f"select *, {_LNUM} as label_num from labelled_paths")
_STEM = "regexp_extract(string_split(audio_path, '/')[-1], '^(.+?)(\\.[^.]*)?$', 1)"
_OUT = (f"case when label_num = 1 then 'Fraudulent' else 'Non_Fraudulent' end || '/' || {_STEM} || '.wav'")
_CLEAN = ("c", f"""select doc_id, 'clean/audio/' || {_OUT} as audio_path_clean,
  case when label_num = 1 then 'Fraudulent' else 'Non_Fraudulent' end as label, label_num,
  {sql_clean('transcription')} as transcription_clean, round(least(duration_sec, 30.0), 3) as duration_sec,
  16000 as sr from lab where audio_path in (select path from listing) and duration_sec >= 0.5""")

ORACLE = {
    "label_normalise": fx.oracle(["labelled_text"], f"""select doc_id, label, {_LNUM} as label_num,
  case when {_LNUM} = 1 then 'Fraudulent' else 'Non_Fraudulent' end as label_clean from labelled_text"""),
    "clean_text": fx.oracle(["texts"],
                            f"select doc_id, {sql_clean('transcription')} as transcription_clean from texts"),
    "text_length_filter": fx.oracle(["texts"], """select doc_id, cast(length(t) as bigint) as n_chars_clean
  from t where length(t) >= 3""", ("t", f"select doc_id, {sql_clean('transcription')} as t from texts")),
    "path_resolve": fx.oracle(LP, f"select doc_id, audio_path, {_OUT} as out_path from lab", _LAB),
    "existing_files": fx.oracle(TP, """select doc_id, audio_path from text_paths
  where audio_path in (select path from listing)"""),
    "missing_files": fx.oracle(TP, """select doc_id, audio_path from text_paths
  where audio_path not in (select path from listing)"""),
    "duration_gate": fx.oracle(["texts"], """select doc_id, round(least(duration_sec, 30.0), 3) as duration_sec
  from texts where duration_sec >= 0.5"""),
    "audit_counts": fx.oracle(LP, """select count(*) as n_read, count(*) filter (where not e) as n_missing,
  count(*) filter (where e and (duration_sec is null or duration_sec < 0.5)) as n_bad,
  count(*) filter (where e and not (duration_sec is null or duration_sec < 0.5)) as n_kept
  from (select *, audio_path in (select path from listing) as e from labelled_paths) x"""),
    "clean_table": fx.oracle(LP, "select * from c", _LAB, _CLEAN),
    "csv_raw_text": fx.oracle(["texts"], "select doc_id, transcription, lang from texts"),
    "csv_roundtrip": fx.oracle(LP, "select * from c", _LAB, _CLEAN),
}
