"""Mixing sources to target weights by Sainte-Lague apportionment, in DataFrame functions only.

Documents are dealt into shards by hash, so that no source, however large, is
ordered in one task. Inside a (source, shard) the documents in seeded order
form one stream of words, cut into blocks of equal length. Sources get whole
numbers of blocks for their targets by highest quotients (weight / 1, 3, 5,
...), and a source's blocks are apportioned to its shards the same way. What a
shard has no words for goes to the source's other shards by the room they have,
and a source whose target is less than half a block gets it in words. A
shard takes its quota as whole passes over its stream and, for the rest, a run
of consecutive blocks from a seeded start (the stream goes on at its
beginning). As the stream is shuffled by the seed, a run is a random choice of
documents, and only those at its two ends are taken in part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, ref, temp_names, without

#: words of a block
BLOCK_WORDS = 64
#: mean rows of a shard (all sources together)
SHARD_ROWS = 1024
OUTPUT = ("size", "source_size", "target", "taken", "passes", "part_from", "part_to", "head_to")


def words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(sources: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """source_key, source, source_size -> the same with target (double).

    Sources by code point, null last, have the weights in turn. The share of
    all words is dealt by weight; a target stops at ``most`` times the
    source's size and the excess goes to the others by weight. In the order of
    (most * size / weight) the sources that stop are a prefix, so one ordered
    pass over the list of sources finds them."""
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    nth = (F.row_number().over(in_order) - 1) % len(weights)
    s = sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (nth + 1).cast("int")))
    s = s.withColumn("cap", F.lit(float(most)) * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("weight"))
    rising = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(rising), F.lit(0.0))
    weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(rising), F.lit(0.0))
    s = s.withColumn("level", left / weight).withColumn("stops", F.col("ratio") <= F.col("level"))
    level = F.max(F.when(~F.col("stops"), F.col("level"))).over(everything)
    return s.withColumn("target", F.when(F.col("stops"), F.col("cap")).otherwise(F.col("weight") * level)).select(
        "source_key", "source_size", "target")


def apportion(items: DataFrame, group: list[str], item: str, exact: str, seats: str) -> DataFrame:
    """Sainte-Lague: add ``seats``, whole numbers that sum to round(sum of
    ``exact``) in each group and are the highest quotients exact / 1, 3, 5, ...

    Rounding every ``exact`` share is the right apportionment of the rounded
    sum; the few seats too many or too few are then taken or given in the order
    of their quotients (of equal ones the first by ``item``). An item can gain or lose at most
    exact * (difference + items) / total + 1 of them, so that many quotients
    an item are ranked: a small multiple of the number of items."""
    g = Window.partitionBy(*group)
    total = F.round(F.sum(exact).over(g)).cast("long")
    d = items.withColumn("_base", F.floor(F.col(exact) + 0.5).cast("long")).withColumn("_total", total)
    d = d.withColumn("_gap", F.col("_total") - F.sum("_base").over(g)).withColumn("_n", F.count(F.lit(1)).over(g))
    reach = F.ceil(F.col(exact) * (F.abs("_gap") + F.col("_n")) / F.greatest(F.col("_total"), F.lit(1))) + 1
    tries = F.when(F.col("_gap") == 0, F.array()).otherwise(F.sequence(F.lit(1).cast("long"), reach.cast("long")))
    d = d.withColumn("_try", F.explode_outer(tries))
    seat = F.when(F.col("_gap") > 0, F.col("_base") + F.col("_try")).otherwise(F.col("_base") + 1 - F.col("_try"))
    d = d.withColumn("_seat", F.when(seat >= 1, seat)).withColumn("_quotient", F.col(exact) / (2 * F.col("_seat") - 1))
    best_first = F.when(F.col("_gap") > 0, -F.col("_quotient")).otherwise(F.col("_quotient"))
    rank = F.row_number().over(g.orderBy(best_first.asc_nulls_last(), item, "_seat"))
    moved = F.when(F.col("_seat").isNotNull() & (rank <= F.abs("_gap")), F.signum(F.col("_gap")).cast("long")).otherwise(F.lit(0))
    d = d.withColumn("_moved", moved)
    keep = [c for c in items.columns if c not in (*group, item)]
    return d.groupBy(*group, item).agg(*[F.first(c).alias(c) for c in keep], F.first("_base").alias("_base"), F.sum("_moved").alias("_moved")).select(
        *group, item, *keep, F.greatest(F.col("_base") + F.col("_moved"), F.lit(0)).alias(seats))


def _fill(quota: DataFrame, limit: Column, most: int, block_words: int) -> DataFrame:
    """Raise ``quota`` where its sum in a source is below the source's words:
    the missing words go to the shards by the room they have below ``limit``."""
    g = Window.partitionBy("source_key")
    wanted = F.when(F.col("blocks") > 0, F.col("blocks") * block_words).otherwise(F.round("target").cast("long"))
    wanted = F.least(wanted, (F.lit(most) * F.col("source_size")).cast("long"))
    q = quota.withColumn("_room", (limit - F.col("quota")).cast("long"))
    q = q.withColumn("_missing", wanted - F.sum("quota").over(g)).withColumn("_rooms", F.sum("_room").over(g))
    q = q.withColumn("_upto", F.sum("_room").over(g.orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # whole parts of a running share: they sum to what is missing, and none is above its room
    upto = lambda x: F.expr(f"cast(_missing as decimal(19, 0)) * cast({x} as decimal(19, 0)) div cast(_rooms as decimal(19, 0))")
    more = F.when((F.col("_missing") > 0) & (F.col("_rooms") > 0), upto("_upto") - upto("(_upto - _room)")).otherwise(F.lit(0))
    return q.withColumn("quota", F.col("quota") + more).drop("_room", "_missing", "_rooms", "_upto")


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: int = 2, block_words: int = BLOCK_WORDS,
        shard_rows: int = SHARD_ROWS, seed: int = 7, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Every row of ``docs`` with what the mix takes of it.

    size (words of the text; null text: 0), source_size, target (double, of
    the source), taken (words, repeats counted, at most ``most`` * size), and
    how: ``passes`` whole copies, the words [part_from, part_to) once more, and
    the words [0, head_to) once more (head_to is 0 unless the run of blocks
    both starts and ends in this document).

    Null sources are one source, the last in the order. Null ids, repeated
    ids and repeated rows are ordinary rows; rows that tie in the seeded order
    are ordered by all that distinguishes them. Empty texts have size 0 and
    nothing is taken. A source without words has target 0. No rows give no
    rows. Columns called like an output column are replaced. One number, the
    row count, comes to the driver.
    """
    docs = without(docs, OUTPUT)
    key, shard, order, at = temp_names(docs, "source_key", "shard", "order", "at")
    shards = max(1, -(-docs.count() // shard_rows))
    # md5 of (seed, id, size): the same order in every run and on every engine
    hashed = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(ref(doc_id).cast("string"), F.lit("null")), F.col("size").cast("string")))
    base = (docs.select(*[ref(c) for c in docs.columns], words(ref(text).cast("string")).alias("size"))
            .withColumn(order, hashed)
            .withColumn(shard, (F.conv(F.substring(order, 1, 8), 16, 10).cast("long") % shards))
            .withColumn(key, F.coalesce(F.concat(F.lit("s"), ref(source).cast("string")), F.lit("null"))))

    per_shard = base.groupBy(F.col(key).alias("source_key"), F.col(shard).alias("shard")).agg(
        F.sum("size").alias("shard_size"), F.first(ref(source).cast("string"), ignorenulls=True).alias("source"))
    per_source = per_shard.groupBy("source_key").agg(F.sum("shard_size").alias("source_size"), F.first("source", ignorenulls=True).alias("source"))
    dealt = targets(per_source, weights, share, most).withColumn("exact", F.col("target") / block_words).withColumn("all", F.lit(0))
    dealt = apportion(dealt, ["all"], "source_key", "exact", "blocks").drop("all", "exact")
    quota = per_shard.drop("source").join(dealt, "source_key")
    quota = quota.withColumn("exact", F.when(F.col("source_size") > 0, F.col("blocks") * F.col("shard_size") / F.col("source_size")).otherwise(F.lit(0.0)))
    quota = apportion(quota, ["source_key"], "shard", "exact", "shard_blocks")

    # a source at its limit is taken whole, without the rounding to blocks
    limit = F.lit(most) * F.col("shard_size")
    at_limit = F.col("target") >= F.lit(most) * F.col("source_size")
    quota_words = F.when(at_limit, limit).otherwise(F.least(F.col("shard_blocks") * block_words, limit))
    quota = _fill(quota.withColumn("quota", quota_words.cast("long")), limit, most, block_words)
    quota = quota.withColumn(
        "_passes", F.when(F.col("shard_size") > 0, F.floor(F.col("quota") / F.col("shard_size"))).otherwise(F.lit(0)).cast("long"))
    quota = quota.withColumn("_rest", F.col("quota") - F.col("_passes") * F.col("shard_size"))
    start = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), "source_key", F.col("shard").cast("string"))), 1, 8), 16, 10).cast("long")
    blocks = F.greatest(F.ceil(F.col("shard_size") / block_words), F.lit(1))
    quota = quota.withColumn("_start", (start % blocks) * block_words)
    quota = quota.select(F.col("source_key").alias(key), F.col("shard").alias(shard), "source_size", "target",
                         *[F.col(c) for c in ("_passes", "_rest", "_start")], F.col("shard_size").alias("_shard_size"))
    names = temp_names(base, "passes", "rest", "start", "shard_size")
    for old, new in zip(("_passes", "_rest", "_start", "_shard_size"), names):
        quota = quota.withColumnRenamed(old, new)
    passes, rest, start, shard_size = map(F.col, names)

    stream = Window.partitionBy(key, shard).orderBy(order, ref(doc_id), "size", F.xxhash64(ref(text).cast("string")))
    placed = base.withColumn(at, F.sum("size").over(stream.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size"))
    joined = placed.join(quota, [key, shard])
    begin, size = F.col(at), F.col("size")
    low = F.greatest(start - begin, F.lit(0))
    high = F.least(start + rest - begin, size)
    head = F.least(start + rest - shard_size - begin, size)    # the run goes on at the stream's beginning
    joined = joined.withColumns({"passes": passes, "part_from": low, "part_to": F.greatest(high, low), "head_to": F.greatest(head, F.lit(0))})
    # a run that only reaches this document from the stream's beginning is its part
    only_head = (F.col("part_to") == F.col("part_from")) & (F.col("head_to") > 0)
    joined = joined.withColumns({"part_from": F.when(only_head, F.lit(0)).otherwise(F.col("part_from")),
                                 "part_to": F.when(only_head, F.col("head_to")).otherwise(F.col("part_to")),
                                 "head_to": F.when(only_head, F.lit(0)).otherwise(F.col("head_to"))})
    taken = F.col("passes") * size + F.col("part_to") - F.col("part_from") + F.col("head_to")
    return joined.withColumn("taken", taken).select(*[ref(c) for c in docs.columns], *[F.col(c).cast("double" if c == "target" else "long").alias(c) for c in OUTPUT])


def _words_between(text: Column, first: Column, end: Column) -> Column:
    """The text from its word number ``first`` up to word ``end``, with the
    white space between them."""
    found = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    gaps = F.split(text, WORD, -1)
    n = (end - first - 1).cast("int")
    inner = F.zip_with(F.slice(found, (first + 1).cast("int"), n), F.slice(gaps, (first + 2).cast("int"), n), lambda w, g: F.concat(w, g))
    return F.concat(F.array_join(inner, ""), F.element_at(found, end.cast("int")))


def take(docs: DataFrame, text: str = "text", length: str | None = "n_chars", **how) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for every whole copy
    and one for every part (its words with the white space between them;
    ``length``, if there is such a column, is then its length)."""
    docs = without(docs, OUTPUT)
    mixed = mix(docs, text=text, **how)
    piece, = temp_names(mixed, "piece")
    whole = F.struct(F.lit(0).cast("long").alias("a"), F.col("size").alias("b"))
    pieces = F.concat(F.array_repeat(whole, F.when(F.col("size") > 0, F.col("passes")).otherwise(F.lit(0)).cast("int")),
                      F.array(F.struct(F.col("part_from").alias("a"), F.col("part_to").alias("b")),
                              F.struct(F.lit(0).cast("long").alias("a"), F.col("head_to").alias("b"))))
    mixed = mixed.withColumn(piece, F.explode(F.filter(pieces, lambda p: p["b"] > p["a"])))
    a, b = F.col(f"{piece}.a"), F.col(f"{piece}.b")
    is_whole = (a == 0) & (b == F.col("size"))
    cut, = temp_names(mixed, "cut")
    mixed = mixed.withColumn(cut, F.when(is_whole, ref(text)).otherwise(_words_between(ref(text), a, b)))
    columns = []
    for c, t in docs.dtypes:
        if c == text:
            columns.append(F.col(cut).alias(c))
        elif c == length:
            columns.append(F.when(is_whole, ref(c)).otherwise(F.length(cut).cast(t)).alias(c))
        else:
            columns.append(ref(c))
    return mixed.select(*columns)
