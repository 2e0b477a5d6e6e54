"""Merkle manifest of a table: persistent path-copying trees, built block by block.

Every row is a leaf, every key (source) has a tree over its leaves in order,
and the subroots of the keys have one tree above them. A run of ``ARITY``
nodes becomes one node.

A tree is cut into aligned blocks of ``ARITY ** levels`` leaves. A block is one
group of bounded size, whatever a key holds; its root is a leaf of the blocks
above, until one block is left. Going down again, every block hands its
children the path from them to the root. Each tampered leaf then makes a
version of its block's tree: the nodes from the leaf to the block's root are
copied, all others are shared with the untampered tree; the version goes on
above the block along the path that the block was handed.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callscore.session import scratch_path

from .common import ref

ARITY = 3
#: levels of one block, so a block has at most 729 leaves
LEVELS = 6

#: of every level from a node up: the siblings before and after it, as hex digests joined
PATH = "array<struct<before:string,after:string>>"


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    """SHA-256, in lowercase hex, of the fields of a row."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _node(digests) -> str:
    return sha256("".join(digests).encode()).hexdigest()


class Tree:
    """The untampered tree over one block's nodes. Versions share its levels."""

    def __init__(self, digests: list[str], levels: int | None):
        """``levels``: how many to build; None builds until one node is left."""
        self.levels = [digests]
        while len(self.levels) <= levels if levels is not None else len(self.levels[-1]) > 1:
            below = self.levels[-1]
            self.levels.append([_node(below[i:i + ARITY]) for i in range(0, len(below), ARITY)])

    @property
    def root(self) -> str:
        return self.levels[-1][0]

    def path(self, i: int) -> list[dict]:
        """The siblings before and after leaf ``i`` and each of its ancestors."""
        out = []
        for nodes in self.levels[:-1]:
            run = i - i % ARITY
            out.append({"before": "".join(nodes[run:i]), "after": "".join(nodes[i + 1:run + ARITY])})
            i //= ARITY
        return out

    def version(self, i: int, leaf: str) -> list[str]:
        """The nodes that a version with another leaf ``i`` copies, from that
        leaf to the root; every other node is this tree's own."""
        copied = [leaf]
        for nodes in self.levels[:-1]:
            run = i - i % ARITY
            copied.append(_node([*nodes[run:i], copied[-1], *nodes[i + 1:run + ARITY]]))
            i //= ARITY
        return copied


def _tree(t: pa.Table, levels: int) -> tuple[Tree, list[int]]:
    """The tree of one block's rows (in any order), and their places in it. A
    block that is its key's only one ends where one node is left."""
    position, digests = t["position"].to_pylist(), t["digest"].to_pylist()
    order = sorted(range(len(digests)), key=position.__getitem__)
    place = [0] * len(order)
    for p, row in enumerate(order):
        place[row] = p
    return Tree([digests[row] for row in order], levels if t["total"][0].as_py() > ARITY**levels else None), place


def _block_root(t: pa.Table, levels: int) -> pa.Table:
    blocks = -(-t["total"][0].as_py() // ARITY**levels)
    return pa.table({"grp": t["grp"][:1], "position": t["block"][:1], "digest": pa.array([_tree(t, levels)[0].root]), "total": pa.array([blocks])})


_ARROW_PATH = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def _paths(t: pa.Table, levels: int) -> pa.Table:
    """The path of every node: inside its block, and on along the block's own."""
    tree, place = _tree(t, levels)
    on = t["above"][0].as_py()
    return pa.table({"grp": t["grp"], "position": t["position"], "path": pa.array([tree.path(p) + on for p in place], _ARROW_PATH), "subroot": t["subroot"]})


def _versions(t: pa.Table, levels: int) -> pa.Table:
    """The leaves of one block with their path and the root of their version."""
    tree, place = _tree(t, levels)
    on = t["above"][0].as_py()

    def upwards(x: str) -> str:
        for level in on:
            x = _node((level["before"], x, level["after"]))
        return x

    untouched = upwards(tree.root)
    folded = [untouched if other == own else upwards(tree.version(p, other)[-1])
              for p, own, other in zip(place, t["digest"].to_pylist(), t["version"].to_pylist())]
    return pa.table({"key": t["key"], "ord": t["ord"], "leaf": t["digest"], "subroot": t["subroot"],
                     "path": pa.array([tree.path(p) + on for p in place], _ARROW_PATH), "folded_root": pa.array(folded, pa.string())})


def _written(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def _in_blocks(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.call_function("div", F.col("position"), F.lit(ARITY**levels)))


def _raised(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """``nodes`` (grp, position, digest, and total: the key's nodes on this
    level), then the roots of their blocks, of those blocks' blocks and so on,
    until every key has one node. One number a level is read."""
    out, most = [nodes], 2
    while most > 1:
        roots = _in_blocks(out[-1], levels).groupBy("grp", "block").applyInArrow(lambda t: _block_root(t, levels), "grp string, position long, digest string, total long")
        out.append(_written(roots, "merkle-nodes"))
        most = out[-1].agg(F.max("total")).first()[0] or 0
    return out


def _with_above(nodes: DataFrame, path: DataFrame, levels: int) -> DataFrame:
    """The nodes with their block and its path. Both sides are dealt by the
    block, which the grouping that follows needs anyway."""
    above = path.select("grp", F.col("position").alias("block"), F.col("path").alias("above"), "subroot")
    return _in_blocks(nodes, levels).join(above, ["grp", "block"])


def _node_paths(nodes: DataFrame, above: DataFrame, levels: int) -> DataFrame:
    """grp, position, path, subroot of ``nodes``, given those of their blocks."""
    blocks = _with_above(nodes, above, levels).groupBy("grp", "block")
    return blocks.applyInArrow(lambda t: _paths(t, levels), f"grp string, position long, path {PATH}, subroot string")


def _handed_down(raised: list[DataFrame], top: DataFrame, levels: int) -> DataFrame:
    """The paths of the nodes of ``raised[1]``, given those of every key's last
    node (grp, path, subroot)."""
    path = raised[-1].join(top, "grp").select("grp", "position", "path", "subroot")
    for nodes in reversed(raised[1:-1]):
        path = _written(_node_paths(nodes, path, levels), "merkle-paths")
    return path


def _numbered(rows: DataFrame) -> DataFrame:
    """Add ``position`` in the key's order and ``total``, the key's rows. One
    sort deals all rows in ranges, so that a key of any size is spread; the
    ranges' counts give each its first position."""
    order = [F.col("ord").asc_nulls_first(), F.col("digest"), F.col("version")]
    dealt = _written(rows.orderBy("grp", *order).withColumn("part", F.spark_partition_id()), "merkle-sorted")
    own = Window.partitionBy("grp")
    before = F.sum("n").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    starts = dealt.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("n")).select("grp", "part", F.sum("n").over(own).alias("total"), before.alias("begins"))
    inside = F.row_number().over(Window.partitionBy("grp", "part").orderBy(*order))
    return _written(dealt.join(starts, ["grp", "part"]).withColumn("position", F.col("begins") + inside - 1).drop("part", "begins"), "merkle-leaves")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(path, leaf, lambda x, level: F.sha2(F.concat(level["before"], x, level["after"]), 256))


def manifest(rows: DataFrame, leaf: Column, tampered: Column, key: str = "source", order: str = "doc_id", levels: int = LEVELS) -> DataFrame:
    """``key`` and ``order`` of every row, with leaf, subroot, root, path (the
    siblings before and after the leaf and each of its ancestors, up to the
    root), folded_root (of the tampered leaf and the untampered siblings) and
    verified (it equals root).

    ``leaf`` and ``tampered`` are the digest of a row and of what a reader
    finds in its place; a null ``tampered`` stands for an untampered row. Keys
    go by their UTF-8 bytes, null first; the leaves of a key by ``order``, null
    first, and rows of equal order by their digests, so that repeated rows are
    leaves of their own. A key with a single row has that leaf as its subroot,
    and a single key's subroot is the root: there the path has no level. A run
    that ends with one node has a level without siblings. Texts count whole
    whatever their length, and only digests are shuffled. Other columns, also
    those named like an output column, take no part. No rows give no rows.
    """
    shape = rows.schema
    kept = rows.select(F.coalesce(F.concat(F.lit("s"), ref(key).cast("string")), F.lit("")).alias("grp"), ref(key).alias("key"), ref(order).alias("ord"),
                       leaf.alias("digest"), F.coalesce(tampered, leaf).alias("version"))
    leaves = _numbered(_written(kept, "merkle-digests"))
    raised = _raised(leaves.select("grp", "position", "digest", "total"), levels)

    subroot = F.col("digest")
    keys = _numbered(raised[-1].select(F.lit("").alias("grp"), F.col("grp").alias("ord"), subroot.alias("digest"), subroot.alias("version")))
    own = keys.select("grp", "position", "digest", "total")
    top = _raised(own, levels)
    last = top[-1].first()
    root = F.lit(last["digest"] if last else None).cast("string")
    down = _handed_down(top, top[-1].select("grp", F.array().cast(PATH).alias("path"), F.col("digest").alias("subroot")), levels)
    ends = _node_paths(own, down, levels).select("position", "path").join(keys, "position")
    ends = _written(ends.select(F.col("ord").alias("grp"), "path", subroot.alias("subroot")), "merkle-ends")

    schema = f"key {shape[key].dataType.simpleString()}, ord {shape[order].dataType.simpleString()}, leaf string, subroot string, path {PATH}, folded_root string"
    blocks = _with_above(leaves, _handed_down(raised, ends, levels), levels).groupBy("grp", "block")
    folded = blocks.applyInArrow(lambda t: _versions(t, levels), schema)
    return folded.select(F.col("key").alias(key), F.col("ord").alias(order), "leaf", "subroot", root.alias("root"), "path", "folded_root",
                         (F.col("folded_root") == root).alias("verified"))
