"""Exact duplicates behind a two-pass Bloom filter, in DataFrame functions only.

Pass one hashes every text to two cells of a filter of fixed size and keeps
the cells that were hit at least twice, as bitmaps. Pass two tests every row:
only a row whose cells were all hit twice can have a copy, and only these rows
are shuffled, by the SHA-256 of their text; all others pass straight through.
False positives are told apart by the SHA-256, so the result is exact however
full the filter is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import bloom
from .bloom import FILTER_BITS
from .common import lower_az, ref, temp_names, without

#: parts in which a group of copies meets its largest doc_id
SALTS = 32

OUTPUT = ("keep_id", "group_size", "kept", "text_sha256")


def possibly_repeated(df: DataFrame, text: Column, flag: str, bits: int = FILTER_BITS) -> DataFrame:
    """Add the boolean ``flag``: false only for rows whose text occurs once.
    The filter holds the cells that at least two rows (or both cells of one
    row) hit."""
    counted = df.select(F.explode(bloom.cells(F.xxhash64(text), bits)).alias("cell")).groupBy("cell").count()
    return bloom.possibly_in(df, F.xxhash64(text), bloom.bitmaps(counted.where("count > 1")), flag, bits)


def mark_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = FILTER_BITS) -> DataFrame:
    """Every row of ``df`` with keep_id, group_size, kept and text_sha256.

    Texts are equal when identical after lower-casing A-Z; a null text counts
    as empty. Of equal texts the row with the largest doc_id stays; a null
    doc_id is smaller than any other, and if a group has only null ids then
    keep_id is null and one of its rows stays. Of rows that repeat a doc_id
    with an equal text exactly one stays (the one with the largest hash of its
    other columns; of rows equal in every column, any). Columns called like an
    output column are replaced. An empty table gives an empty result.
    """
    df = without(df, OUTPUT)
    norm, flag, row, copy, salt = temp_names(df, "norm", "flag", "row", "copy", "salt")
    hashable = [ref(c) for c, t in df.dtypes if "map<" not in t and "variant" not in t]
    base = df.select(*[ref(c) for c in df.columns], lower_az(F.coalesce(ref(text).cast("string"), F.lit(""))).alias(norm))
    flagged = possibly_repeated(base, F.col(norm), flag, bits).withColumn("text_sha256", F.sha2(F.col(norm), 256)).drop(norm)

    own = [ref(c) for c in df.columns]
    once = flagged.where(~F.col(flag)).select(
        *own, ref(doc_id).alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("text_sha256"))

    maybe = flagged.where(F.col(flag)).withColumn(row, F.xxhash64(*hashable))
    maybe = maybe.withColumn(salt, F.pmod(F.col(row), F.lit(SALTS)))
    best = F.max(F.struct(ref(doc_id).alias("id"), F.col(row).alias("row")))
    groups = maybe.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
    # a group may hold a third of all rows: it is joined in SALTS parts
    groups = groups.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias(salt))
    joined = maybe.join(groups, ["text_sha256", salt])
    # rows alike in id and content get a number, dealt by a key of their own so that a large group spreads
    same = F.xxhash64("text_sha256", row, ref(doc_id))
    joined = joined.withColumn(copy, F.row_number().over(Window.partitionBy(same).orderBy(F.col(row))))
    kept = ref(doc_id).eqNullSafe(F.col("best.id")) & (F.col(row) == F.col("best.row")) & (F.col(copy) == 1)
    copies = joined.select(*own, F.col("best.id").alias("keep_id"), "group_size", kept.alias("kept"), "text_sha256")
    return once.unionByName(copies)


def deduplicate(df: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = FILTER_BITS) -> DataFrame:
    """The rows that stay, with the columns of ``df`` (less those named like
    an output column of ``mark_duplicates``)."""
    marked = mark_duplicates(df, doc_id, text, bits)
    return without(marked.where("kept"), OUTPUT)
