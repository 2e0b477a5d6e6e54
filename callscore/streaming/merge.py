"""A merging sink for corrected rows.

A table of the last row for each key, in hash buckets, fed by ``foreachBatch``.
A micro-batch writes its rows once, as a folder of its batch id, dealt by the
key's bucket; nothing that was written before is touched. Then the batch enters
the ledger: a file that is written under another name and renamed, so that a
batch is in the table whole or not at all. Readers take only folders of batches
in the ledger, and of each key the row of the highest (revision, batch).

* A batch that is replayed overwrites its own folder and ledger file.
* A stop between folder and ledger leaves the folder invisible; the replay of
  the batch, which the checkpoint asks for, writes it again.
* ``compact`` writes the last rows of all batches so far as a new base and then
  switches the version by one ledger file; folders of older versions are no
  longer read and can be removed when no reader holds them.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

BUCKETS = 32
_BUCKET, _BATCH = "_bucket", "_batch"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


class MergingTable:
    """The last row for each of ``keys`` by ``revision`` (then batch)."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str], revision: str, buckets: int = BUCKETS):
        self.spark, self.path, self.keys, self.revision, self.buckets = spark, path.rstrip("/"), list(keys), revision, buckets
        self.schema = spark.createDataFrame([], schema).schema

    # ------------------------------------------------------------- writing
    def write_rows(self, df: DataFrame, batch_id: int) -> None:
        """The batch's last row for each key, in its own folder."""
        rows = self._last(df.select([f.name for f in self.schema.fields]).withColumn(_BATCH, F.lit(int(batch_id)).cast("long")))
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        rows.withColumn(_BUCKET, bucket).write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{self.path}/batch-{int(batch_id)}")

    def enter(self, batch_id: int) -> None:
        """The batch becomes part of the table."""
        self._put(f"batch-{int(batch_id)}.json", {"batch": int(batch_id)})

    def writer(self) -> Callable[[DataFrame, int], None]:
        """For ``foreachBatch``."""
        def write(df: DataFrame, batch_id: int) -> None:
            self.write_rows(df, batch_id)
            self.enter(batch_id)
        return write

    def compact(self) -> None:
        """One folder in place of those of all batches so far."""
        base, batches = self._version()
        if not batches:
            return
        upto = max(batches)
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        self._rows(base, batches).withColumn(_BUCKET, bucket).write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{self.path}/base-{upto}")
        self._put(f"base-{upto}.json", {"base": upto})

    def _put(self, name: str, value: dict) -> None:
        fs, tmp = _fs(self.spark, f"{self.path}/_ledger/.{name}.tmp")
        out = fs.create(tmp, True)
        out.write(bytearray(json.dumps(value).encode()))
        out.close()
        _, final = _fs(self.spark, f"{self.path}/_ledger/{name}")
        if fs.exists(final):
            return    # a replay: what it says is there already
        if not fs.rename(tmp, final):
            raise OSError(f"could not enter {name} into the ledger")

    # ------------------------------------------------------------- reading
    def _version(self) -> tuple[int | None, list[int]]:
        """The newest base and the batches after it."""
        fs, p = _fs(self.spark, f"{self.path}/_ledger")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        number = lambda kind: sorted(int(n[len(kind) + 1:-5]) for n in names if n.startswith(kind + "-") and n.endswith(".json"))
        bases = number("base")
        base = bases[-1] if bases else None
        return base, [b for b in number("batch") if base is None or b > base]

    def _last(self, rows: DataFrame) -> DataFrame:
        others = [c for c in rows.columns if c not in self.keys and c != _BUCKET]
        newest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*others), F.struct(self.revision, _BATCH)).alias("_row"))
        return newest.select(*self.keys, *[F.col(f"_row.{c}").alias(c) for c in others])

    def _rows(self, base: int | None, batches: list[int]) -> DataFrame:
        folders = ([f"{self.path}/base-{base}"] if base is not None else []) + [f"{self.path}/batch-{b}" for b in batches]
        stored = StructType([*self.schema.fields, StructField(_BATCH, LongType())])
        # folder by folder: an empty batch has a folder without rows
        parts = [self.spark.read.schema(stored).parquet(f).select(stored.names) for f in folders]
        if not parts:
            return self.spark.createDataFrame([], stored)
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        return self._last(rows)

    def read(self) -> DataFrame:
        return self._rows(*self._version()).select([f.name for f in self.schema.fields])
