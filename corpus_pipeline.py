"""A corpus pipeline of five training-data operators, each stage written and read again.

Quality rules, exact dedup, SimHash near-dedup, mixing to target weights and
packing. All but the last return the columns of ``documents``. The classifier
of the first stage is fitted on ``labels``, so there is no SQL for the rows of
``run``; the stages are tested against brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callscore.llm import exact_dedup, mixing, packing, quality, simhash
from callscore.llm.queries import tokenizer_path
from callscore.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep."""
    docs = docs.select(*COLUMNS)
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model).where("kept").select(*COLUMNS)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    return exact_dedup.deduplicate(docs.select(*COLUMNS))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class: 3-word shingles, at most 3 bits."""
    return simhash.drop_near_duplicates(docs.select(*COLUMNS), shingle=3, max_bits=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each copy or part that it takes."""
    return mixing.take(docs.select(*COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces. A document that the mix repeats is a document each time."""
    pieces = packing.pack(docs, tokenizer_path())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("simhash near-dedup", near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: the first stage trains a classifier, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet in the shared
    folder and read as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            path = scratch_path(spark, f"pipeline-{k}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
