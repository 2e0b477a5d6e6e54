"""Table sources and sinks.

Explicit schemas everywhere: CSV inference is a second full pass and not
stable across files. Writes are ``overwrite`` into the shared scratch folder
(``spark.checkpoint.dir``), never a machine-local path.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

CLEAN_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("audio_path_clean", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("label_num", T.IntegerType()),
    T.StructField("transcription_clean", T.StringType()),
    T.StructField("duration_sec", T.DoubleType()),
    T.StructField("sr", T.IntegerType()),
])

SCORE_SCHEMA = T.StructType([
    T.StructField("clip_id", T.LongType()),
    T.StructField("label_num", T.IntegerType()),
    T.StructField("bert_prob", T.DoubleType()),
    T.StructField("mfcc_prob", T.DoubleType()),
    T.StructField("spec_prob", T.DoubleType()),
])

SCORE_COLUMNS = ("bert_prob", "mfcc_prob", "spec_prob", "label_num")


def require_columns(df: DataFrame, required: Iterable[str], what: str = "input") -> DataFrame:
    """Fail before planning when a required column is missing."""
    miss = [c for c in required if c not in df.columns]
    if miss:
        raise ValueError(f"{what} lacks required columns: {', '.join(miss)}")
    return df


def with_default(df: DataFrame, name: str, value="") -> DataFrame:
    """Add a constant column when the input does not have it."""
    return df if name in df.columns else df.withColumn(name, F.lit(value))


# The dialect that pandas reads and writes: fields with a comma, a quote or a
# line break are quoted, a quote inside is doubled, a backslash is a plain
# character, white space stays, an empty unquoted field is null.
CSV_DIALECT = {
    "header": "true", "quote": '"', "escape": '"', "multiLine": "true", "lineSep": "\n",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Header CSV with an explicit schema. A quoted empty field is an empty
    string, an unquoted one null; a row that does not fit the schema fails the
    read instead of losing fields."""
    # the parser gives this mark for an unquoted empty field, so that a quoted one is told from it
    r = spark.read.options(**CSV_DIALECT).option("nullValue", "\x00null").option("emptyValue", "").option("mode", "FAILFAST").option("maxCharsPerColumn", -1)
    return (r.schema(schema) if schema is not None else r).csv(path)


def write_csv(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> str:
    """Overwrite, header, no index column. Empty strings are written quoted,
    nulls as nothing, so both come back as they were."""
    options = {k: v for k, v in CSV_DIALECT.items() if k != "multiLine"}
    w = df.write.mode("overwrite").options(**options).option("nullValue", "")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)
    return path


def write_parquet(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> str:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_first(spark: SparkSession, primary: str, fallback: str, required: Iterable[str],
               schema: T.StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """Read ``primary`` if it exists, else ``fallback`` after a column check."""
    reader = (lambda p: read_csv(spark, p, schema)) if fmt == "csv" else (lambda p: spark.read.parquet(p))
    try:
        return reader(primary)
    except Exception as e:  # noqa: BLE001  (path does not exist)
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
    return require_columns(reader(fallback), required, fallback)


def csv_roundtrip(spark: SparkSession, df: DataFrame, name: str, schema: T.StructType) -> DataFrame:
    path = write_csv(df, scratch_path(spark, name))
    return read_csv(spark, path, schema)


def file_listing(spark: SparkSession, root: str, glob: str = "*.wav") -> DataFrame:
    """Path, length and modification time of files under ``root`` (no content)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
            .load(root).select("path", "length", "modificationTime"))
