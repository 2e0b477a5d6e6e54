"""Sources, sinks and small column helpers."""

import os

import pytest

from callscore.functions.scoring import status
from callscore.functions.text import clamp_label, clean_text, label_num, weights_from_name
from callscore.session import scratch_path
from callscore.sources import tables


def test_required_columns_and_default(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        tables.require_columns(df, ["a", "b"])
    assert tables.with_default(df, "b", "").columns == ["a", "b"]


def test_fallback_source_reads_second_path(spark):
    base = scratch_path(spark, "fallback")
    df = spark.createDataFrame([(1, 1, 0.1, 0.2, 0.3)], tables.SCORE_SCHEMA)
    tables.write_parquet(df, f"{base}/test")
    got = tables.read_first(spark, f"{base}/missing", f"{base}/test", tables.SCORE_COLUMNS)
    assert got.count() == 1
    with pytest.raises(ValueError):
        tables.read_first(spark, f"{base}/missing", f"{base}/test", ["nope"])


def test_binary_file_listing(spark, tmp_path):
    for n in ("a.wav", "b.wav", "c.txt"):
        (tmp_path / n).write_bytes(b"xyz")
    got = tables.file_listing(spark, str(tmp_path)).collect()
    assert sorted(os.path.basename(r["path"]) for r in got) == ["a.wav", "b.wav"] and got[0]["length"] == 3


def test_csv_roundtrip_partitioned(spark):
    df = spark.createDataFrame([(1, "x", "train"), (2, "", "test")], "id long, t string, split string")
    path = tables.write_csv(df, scratch_path(spark, "csvsplit"), partition_by=["split"])
    back = spark.read.option("header", True).csv(path)
    assert sorted(r["split"] for r in back.collect()) == ["test", "train"]


def test_unscored_status_and_helpers(spark):
    df = spark.createDataFrame([(None, " Fraud-ish ", 3.7, "WeightedAvg(0.5, 0.25, 0.25)", "Héllo\tWorld  ")],
                               "p double, label string, x double, name string, t string")
    r = df.select(status("p").alias("u"), status("p", compat=True).alias("c"), label_num("label").alias("l"),
                  clamp_label("x").alias("k"), weights_from_name("name").alias("w"), clean_text("t").alias("ct")).first()
    assert r["u"] == "Unscored" and r["c"] == "Normal" and r["l"] == 1 and r["k"] == 1
    assert r["w"] == [0.5, 0.25, 0.25] and r["ct"] == "h llo world"


def test_csv_reads_what_pandas_writes(spark, tmp_path):
    import pandas as pd
    rows = [(1, 'he said "hi", ok'), (2, "two\nlines, and a \\ backslash\\"), (3, "  spaces  "), (4, ""), (5, None), (6, "a\r\nb"), (7, '"'), (8, "\\\"")]
    pd.DataFrame(rows, columns=["doc_id", "text"]).to_csv(tmp_path / "p.csv", index=False)
    schema = spark.createDataFrame([], "doc_id long, text string").schema
    got = {r["doc_id"]: r["text"] for r in tables.read_csv(spark, str(tmp_path / "p.csv"), schema).collect()}
    # pandas writes null and the empty string alike
    assert got == {i: (t or None) if i in (4, 5) else t for i, t in rows}
    df = spark.createDataFrame(rows, schema)
    back = {r["doc_id"]: r["text"] for r in tables.csv_roundtrip(spark, df, "dialect", schema).collect()}
    assert back == dict(rows)


def test_scratch_folder_of_a_cluster_must_be_set(monkeypatch):
    import pytest

    from callscore import session

    class Fake:
        class conf:
            get = staticmethod(lambda *a: None)

        class sparkContext:
            master = "spark://host:7077"
            getConf = staticmethod(lambda: Fake.conf)

    with pytest.raises(ValueError):
        session.scratch_root(Fake)
