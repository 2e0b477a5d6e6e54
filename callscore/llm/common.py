"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: texts that a Python worker holds as objects at a time
TEXTS = 512
#: a word: a run of characters that are none of the six ASCII white-space characters
WORD = r"[^\x20\x09-\x0D]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop columns called like one of ``names`` in any letter case, so that an
    operator's output columns replace input columns of the same name."""
    low = {n.lower() for n in names}
    return df.select(*[ref(c) for c in df.columns if c.lower() not in low])


def ref(name: str) -> Column:
    """A column by its literal name (dots and back-ticks included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def map_text(df: DataFrame, text: str, run: Callable, added: str, keep_text: bool = True) -> DataFrame:
    """``mapInArrow`` over all columns of ``df`` and, last, the text; ``run``
    gives the same columns without that last one and the ``added`` ones (a DDL
    list). Columns go by number meanwhile, as names may hold any character."""
    own = [c for c in df.columns if keep_text or c != text]
    rows = df.select(*[ref(c) for c in own], ref(text).cast("string")).toDF(*[f"c{i}" for i in range(len(own))], "text")
    names = [a.split()[0] for a in added.split(", ")]
    schema = rows.drop("text").select("*", *[F.lit(None).cast(a.split()[1]).alias(a.split()[0]) for a in added.split(", ")]).schema
    # a few hundred texts at a time, however large Spark's batches are
    small = lambda batches: run(b.slice(k, TEXTS) for b in batches for k in range(0, b.num_rows, TEXTS))
    return rows.mapInArrow(small, schema).toDF(*own, *names)


def lower_az(text: Column) -> Column:
    """Lower-case A-Z and nothing else. ``lower`` has a fast path for ASCII
    texts; other texts go through ``translate``, as ``lower`` would also
    change letters such as É."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def temp_names(df: DataFrame, *bases: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for b in bases:
        name = f"_{b}"
        while name in taken:
            name = "_" + name
        taken.add(name)
        out.append(name)
    return out
