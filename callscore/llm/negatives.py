"""Hard negatives by inner-product search in an STR-packed R-tree.

Rows are dealt into tiles of a few thousand rows by sort-tile-recursive
packing: ranges of the first coordinate, inside them ranges of the second, with
a hash to break ties, so that many equal vectors are many tiles. Inside a tile
packing goes on over the next coordinates, down to leaves. A node's minimum
bounding box gives every coordinate's interval of products with a query, and
their sum bounds the scores of all its rows.

A search has two steps, each a shuffle in which boxes or rows meet the queries
that need them: queries are routed to the tiles whose boxes reach into their
score windows, and searched in each of these with a queue that takes the node
with the highest bound first and drops nodes outside all windows or strictly
below the k-th score found. A tile's finds are merged by a window over
at most k rows a tile. Nothing but counts comes to the driver.
"""

from __future__ import annotations

import heapq
import math
from bisect import insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callscore.session import scratch_path

from .common import ref

#: components are scaled by this and rounded down
SCALE = 256
#: about so many rows are a tile, and at most so many a leaf
TILE_ROWS, LEAF_ROWS = 4096, 64
#: children of a node inside a tile
FANOUT = 4
#: queries that meet one page of tile boxes in a task, and tile boxes in a page
QUERY_BLOCK, PAGE_TILES = 1024, 4096
#: tasks among which tiles are dealt, at most
TASKS = 8192

_EXACT = 1 << 53
_MIN, _MAX = -(1 << 63), (1 << 63) - 1


# ---- boxes and trees, inside a task ----

def _matrix(lists: pa.Array, width: int = 0) -> np.ndarray:
    """Rows of whole numbers as float64, padded with zeros."""
    lengths = np.diff(lists.offsets.to_numpy())
    width = max(width, int(lengths.max(initial=0)))
    out = np.zeros((len(lists), width))
    # row by row, the first of each row's places are filled
    out[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _widened(m: np.ndarray, width: int) -> np.ndarray:
    return m if m.shape[1] >= width else np.hstack([m, np.zeros((m.shape[0], width - m.shape[1]))])


def _in_floats(rows: np.ndarray, queries: np.ndarray) -> bool:
    """Every partial sum of their products is a whole number below 2^53."""
    most = lambda m: float(np.abs(m).max(initial=0))
    return most(rows) * most(queries) * max(1, rows.shape[1]) < _EXACT


def _products(rows: np.ndarray, queries: np.ndarray, in_floats: bool) -> np.ndarray:
    """Exact inner products of rows and queries: in float64 where that is
    exact, else in Python's integers."""
    if in_floats:
        return rows @ queries.T
    whole = [[int(x) for x in q] for q in queries]
    exact = [[sum(int(x) * y for x, y in zip(r, q)) for q in whole] for r in rows]
    if any(abs(s) >> 62 for row in exact for s in row):
        raise OverflowError("an inner product of scaled vectors is beyond 2^62")
    return np.array(exact, np.int64).reshape(len(rows), len(queries))


def bounds(low: np.ndarray, high: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of each query (a row of the results)
    with any point of each box."""
    width = max(low.shape[1], queries.shape[1])
    low, high, queries = _widened(low, width), _widened(high, width), _widened(queries, width)
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    floats = _in_floats(np.maximum(np.abs(low), np.abs(high)), queries)
    product = lambda a, b: _products(a, b, floats).T
    return product(low, up) + product(high, down), product(high, up) + product(low, down)


class RTree:
    """An STR-packed tree over one tile's rows, which are kept in the order of
    its leaves: every node is a run of rows."""

    def __init__(self, vectors: np.ndarray, labels: np.ndarray, ids: np.ndarray, nulls: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.children, self.runs, self.leaf_rows = [], [], leaf_rows
        order: list[np.ndarray] = []
        self._pack(vectors, ids, np.arange(len(ids)), 2, order)
        order = np.concatenate(order)
        self.vectors, self.labels, self.ids, self.nulls = vectors[order], labels[order], ids[order], nulls[order]
        self.low = np.array([self.vectors[a:b].min(axis=0) for a, b in self.runs])
        self.high = np.array([self.vectors[a:b].max(axis=0) for a, b in self.runs])

    def _pack(self, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, coordinate: int, order: list) -> int:
        node, begin = len(self.children), sum(map(len, order))
        self.children.append([])
        self.runs.append((begin, begin + len(rows)))
        if len(rows) <= self.leaf_rows:
            order.append(rows)
            return node
        width = vectors.shape[1]
        key = vectors[rows, coordinate % width] if width else np.zeros(len(rows))
        rows = rows[np.lexsort((ids[rows], key))]
        # whole leaves: every slice but the last holds a power of FANOUT of them
        size = self.leaf_rows
        while size * FANOUT < len(rows):
            size *= FANOUT
        self.children[node] = [self._pack(vectors, ids, rows[i:i + size], coordinate + 1, order) for i in range(0, len(rows), size)]
        return node

    def search(self, queries: np.ndarray, labels: list[int], same: bool, windows: list[list[tuple[int, int]]], k: int) -> Iterator[list[list[tuple]]]:
        """For each query and each of its windows (least, largest score) the
        first ``k`` rows of the query's label, or of others: (-score, no id,
        id) in order."""
        low, high = bounds(self.low, self.high, queries)
        width = max(self.vectors.shape[1], queries.shape[1])
        vectors, queries = _widened(self.vectors, width), _widened(queries, width)
        floats = _in_floats(vectors, queries)
        for n, (label, asked) in enumerate(zip(labels, windows)):
            allowed = self.labels == label if same else self.labels != label
            yield self._best_first(vectors, queries[n:n + 1], floats, allowed, low[n].tolist(), high[n].tolist(), asked, k)

    def _best_first(self, vectors, q, floats, allowed, low, high, windows, k) -> list[list[tuple]]:
        found: list[list[tuple]] = [[] for _ in windows]
        floor = [least for least, _ in windows]    # of scores that can still enter
        most = [largest for _, largest in windows]
        top = max(most)
        queue = [(-min(high[0], top), 0)]
        while queue:
            node = heapq.heappop(queue)[1]
            if not any(high[node] >= f and low[node] <= m for f, m in zip(floor, most)):
                continue
            if self.children[node]:
                for child in self.children[node]:
                    heapq.heappush(queue, (-min(high[child], top), child))
                continue
            a, b = self.runs[node]
            scores = _products(vectors[a:b], q, floats)[:, 0]
            fits = np.flatnonzero((scores >= min(floor)) & (scores <= top) & allowed[a:b])
            if not fits.size:
                continue
            hits = list(zip((-scores[fits]).astype(np.int64).tolist(), self.nulls[a:b][fits].tolist(), self.ids[a:b][fits].tolist()))
            for w, best in enumerate(found):
                for hit in hits:
                    if floor[w] <= -hit[0] <= most[w] and (len(best) < k or hit < best[-1]):
                        insort(best, hit)
                        if len(best) >= k:
                            del best[k:]
                            floor[w] = max(floor[w], -best[-1][0])
        return found


# ---- rows, tiles and queries as tables ----

_ROW = "tile long, kind int, id long, label long, vec array<double>, high array<double>, query long, windows array<struct<low:long,high:long>>"
_KIND_ROW, _KIND_QUERY = 0, 1


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def scaled(vector: Column) -> Column:
    """Components times SCALE, rounded down, as whole doubles."""
    # from 2^53 on every double is whole, and floor() would cut it to a long
    whole = lambda v: F.when(F.abs(v) < float(_EXACT), F.floor(v).cast("double")).otherwise(v)
    return F.transform(vector, lambda x: whole(x.cast("double") * SCALE))


def _whole(vector: Column) -> Column:
    """The vector is there and all its components are finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(False))


def _boxes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The box of every tile's rows in each batch."""
    for b in batches:
        tiles, vectors = b["tile"].to_numpy(zero_copy_only=False), _matrix(b["vec"])
        out = []
        for tile in np.unique(tiles).tolist():
            m = vectors[tiles == tile]
            out.append((tile, m.min(axis=0).tolist(), m.max(axis=0).tolist()))
        yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), *[pa.array([o[i] for o in out], pa.list_(pa.float64())) for i in (1, 2)]],
                                         names=["tile", "vec", "high"])


def _joined_boxes(t: pa.Table) -> pa.Table:
    """The box around boxes of one tile. A shorter vector has zeros at its end."""
    low, high = _matrix(t["vec"].combine_chunks()).min(axis=0), _matrix(t["high"].combine_chunks()).max(axis=0)
    return pa.table({"tile": t["tile"][:1], "vec": pa.array([low.tolist()], pa.list_(pa.float64())), "high": pa.array([high.tolist()], pa.list_(pa.float64()))})


def pack_tiles(rows: DataFrame, tile_rows: int = TILE_ROWS) -> DataFrame:
    """``rows`` (row: a number of their own, id, label, vec) with ``tile``,
    written to the shared folder."""
    spark = rows.sparkSession
    n = rows.count()
    tiles = max(1, -(-n // tile_rows))
    slabs = max(1, math.isqrt(tiles))
    tie = F.xxhash64("row")
    by = lambda i: [F.coalesce(F.get("vec", F.lit(i)), F.lit(0.0)), tie]
    slabbed = rows.repartitionByRange(slabs, *by(0)).withColumn("slab", F.spark_partition_id())
    tiled = slabbed.repartitionByRange(tiles, "slab", *by(1)).withColumn("tile", F.spark_partition_id().cast("long"))
    tiled = tiled.drop("slab")
    return _written(tiled, "rtree-tiles") if n else spark.createDataFrame([], tiled.schema)


def tile_boxes(tiles: DataFrame) -> DataFrame:
    """tile, vec (the box's lower corner), high (its upper corner)."""
    parts = tiles.select("tile", "vec").mapInArrow(_boxes, "tile long, vec array<double>, high array<double>")
    return _written(parts.groupBy("tile").applyInArrow(_joined_boxes, "tile long, vec array<double>, high array<double>"), "rtree-boxes")


def _meeting(left: DataFrame, queries: DataFrame, run, schema: str, units: int) -> DataFrame:
    """Rows or boxes and the queries of the same ``tile`` meet in one task; the
    queries stream past. ``run(held, queries)`` gets what a tile holds and a
    batch of queries."""
    both = left.unionByName(queries, allowMissingColumns=True)
    fields = [f.split()[0] for f in _ROW.split(", ")]
    columns = {f.split()[0]: f.split(" ", 1)[1] for f in _ROW.split(", ")}
    both = both.select(*[(F.col(c) if c in both.columns else F.lit(None)).cast(columns[c]).alias(c) for c in fields])

    def walk(batches):
        tile, held, made = None, [], None
        for b in batches:
            at, kind = b["tile"].to_numpy(zero_copy_only=False), b["kind"].to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero((at[1:] != at[:-1]) | (kind[1:] != kind[:-1])) + 1).tolist(), len(at)]
            for i, j in zip(edges, edges[1:]):
                if i == j:
                    continue
                if at[i] != tile:
                    tile, held, made = at[i], [], None
                part = b.slice(i, j - i)
                if kind[i] == _KIND_ROW:
                    held.append(part)
                elif held:
                    made = made if made is not None else run.prepare(held)
                    yield from run(made, part, int(tile))

    # the work is far more than the bytes tell, so the units are dealt by their number
    return both.repartition(min(units, TASKS), "tile").sortWithinPartitions("tile", "kind").mapInArrow(walk, schema)


class _Route:
    """Queries to the tiles whose boxes reach into their windows."""

    def __init__(self, best: bool):
        self.best = best

    @staticmethod
    def prepare(held: list[pa.RecordBatch]):
        t = pa.Table.from_batches(held)
        return t["id"].to_pylist(), _matrix(t["vec"].combine_chunks()), _matrix(t["high"].combine_chunks())

    def __call__(self, made, part: pa.RecordBatch, _tile: int):
        ids, low, high = made
        out = ([], [], [])
        each = bounds(low, high, _matrix(part["vec"]))
        for query, lows, highs, windows in zip(part["query"].to_pylist(), *each, part["windows"].to_pylist()):
            if self.best:
                reached = [int(np.argmax(highs))]
            else:
                meets = np.zeros(len(ids), bool)
                for w in windows:
                    meets |= (highs >= w["low"]) & (lows <= w["high"])
                reached = np.flatnonzero(meets).tolist()
            out[0].extend([query] * len(reached))
            out[1].extend(ids[i] for i in reached)
            out[2].extend(int(highs[i]) for i in reached)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["query", "tile", "bound"])


class _Search:
    """Queries in one tile's tree."""

    def __init__(self, same: bool, k: int):
        self.same, self.k = same, k

    @staticmethod
    def prepare(held: list[pa.RecordBatch]) -> RTree:
        t = pa.Table.from_batches(held)
        ids = t["id"].combine_chunks()
        return RTree(_matrix(t["vec"].combine_chunks()), t["label"].to_numpy(), np.array(ids.fill_null(0).to_pylist(), np.int64), np.array(ids.is_null().to_pylist()))

    def __call__(self, tree: RTree, part: pa.RecordBatch, _tile: int):
        out = ([], [], [], [], [])
        queries, asked = _matrix(part["vec"]), [[(w["low"], w["high"]) for w in windows] for windows in part["windows"].to_pylist()]
        results = tree.search(queries, part["label"].to_pylist(), self.same, asked, self.k)
        for n, (query, found) in enumerate(zip(part["query"].to_pylist(), results)):
            q = queries[n:n + 1]
            itself = int(_products(q, q, _in_floats(q, q))[0, 0])
            for w, hits in enumerate(found):
                for score, null, i in hits:
                    for column, value in zip(out, (query, w, -score, None if null else i, itself)):
                        column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["query", "window", "score", "id", "own_score"])


def _routed(boxes: DataFrame, n_tiles: int, queries: DataFrame, best: bool) -> DataFrame:
    """query, tile, bound. Boxes go by pages, queries by blocks; every block
    meets every page. With ``best`` only the tile of the highest bound."""
    pages = -(-n_tiles // PAGE_TILES)
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    meet = lambda page, block: page * F.lit(blocks) + block
    left = boxes.select(F.col("tile").alias("id"), "vec", "high", F.lit(_KIND_ROW).alias("kind"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    left = left.withColumn("tile", meet(F.pmod(F.hash("id"), F.lit(pages)), F.col("block"))).drop("block")
    right = queries.select("query", "vec", "windows", F.lit(_KIND_QUERY).alias("kind"), F.explode(F.sequence(F.lit(0), F.lit(pages - 1))).alias("page"))
    right = right.withColumn("tile", meet(F.col("page"), F.pmod(F.xxhash64("query"), F.lit(blocks)))).drop("page")
    hits = _meeting(left, right, _Route(best), "query long, tile long, bound long", pages * blocks)
    if not best or pages == 1:
        return hits
    return hits.groupBy("query").agg(F.max_by("tile", F.struct("bound", "tile")).alias("tile"))


def _searched(tiles: DataFrame, tile_count: int, queries: DataFrame, routes: DataFrame, same: bool, k: int) -> DataFrame:
    """query, window, score, id: at most ``k`` of every tile. ``own_score`` is
    the query's with itself."""
    left = tiles.select("tile", "id", "label", "vec", F.lit(_KIND_ROW).alias("kind"))
    right = routes.select("query", "tile").join(queries.select("query", "label", "vec", "windows"), "query").withColumn("kind", F.lit(_KIND_QUERY))
    return _meeting(left, right, _Search(same, k), "query long, window long, score long, id long, own_score long", tile_count)


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query", "window").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, is_anchor: Column, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding", positives: int = 5,
                   negatives: int = 5, least_percent: int = 80, tile_rows: int = TILE_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and
    negative_score: of every anchor its first ``positives`` other rows of the
    same label, and for each the first ``negatives`` rows of other labels whose
    score is at least ``least_percent`` percent of the positive's and at most
    the positive's. Higher scores come first, ties by smaller id, null ids last.

    Rows with a null label, a null vector, or a null or non-finite component
    take no part. A vector that is shorter than another counts as if zeros
    followed, also an empty one. Repeated rows are rows of their own: a copy of
    an anchor is an anchor, and a positive of it. A negative positive score has
    no negatives. ``is_anchor`` null is false. No anchor, no positives or no
    negatives give no rows; other columns take no part. Scores are exact; one
    beyond 2^62 ends the query.
    """
    kept = rows.select(ref(vec_id).cast("long").alias("id"), ref(label).cast("long").alias("label"), ref(vector).alias("raw"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    kept = kept.where(F.col("label").isNotNull() & _whole(F.col("raw"))).select("id", "label", scaled(F.col("raw")).alias("vec"), "anchor")
    kept = _written(kept.withColumn("row", F.monotonically_increasing_id()), "negatives-rows")
    tiles = pack_tiles(kept.select("row", "id", "label", "vec"), tile_rows)
    boxes = tile_boxes(tiles)
    n_tiles = boxes.count()
    every = F.array(F.struct(F.lit(_MIN).cast("long").alias("low"), F.lit(_MAX).cast("long").alias("high")))
    anchors = _written(kept.where("anchor").select(F.col("row").alias("query"), "id", "label", "vec", every.alias("windows")), "negatives-anchors")
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n_tiles or not anchors.take(1):
        return rows.sparkSession.createDataFrame([], result)

    # the tile of the highest bound first: what it gives is a floor for all others. One more than asked, as the anchor finds itself.
    k = positives + 1
    home = _written(_routed(boxes, n_tiles, anchors, best=True).select("query", "tile"), "negatives-home")
    near = _written(_searched(tiles, n_tiles, anchors, home, True, k), "negatives-near")
    floor = near.groupBy("query").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(F.lit(_MIN)).alias("low"))
    floored = anchors.join(floor, "query", "left").withColumn(
        "windows", F.array(F.struct(F.coalesce("low", F.lit(_MIN)).alias("low"), F.lit(_MAX).cast("long").alias("high")))).drop("low")
    rest = _routed(boxes, n_tiles, floored, best=False).join(home, ["query", "tile"], "left_anti")
    far = _searched(tiles, n_tiles, floored, rest, True, k)
    own = anchors.select("query", F.col("id").alias("own_id"))
    first = _first(near.unionByName(far), k).join(own, "query")
    is_own = (F.col("score") == F.col("own_score")) & F.col("id").eqNullSafe(F.col("own_id"))
    ordered = Window.partitionBy("query").orderBy("rank")
    # of rows that look like the anchor one is the anchor; if none came this far, the last is one too many
    first = first.withColumn("itself", is_own & (F.row_number().over(Window.partitionBy("query", is_own).orderBy("rank")) == 1))
    chosen = first.where(~F.col("itself")).withColumn("place", F.row_number().over(ordered)).where(F.col("place") <= positives)
    chosen = _written(chosen.select("query", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-positives")

    # windows in order of score, so that a window's number is the positive's place
    p = F.col("positive_score")
    low = F.call_function("div", p, F.lit(100)) * least_percent + F.ceil(p % 100 * least_percent / 100)
    window = F.struct("place", F.when(p >= 0, low).otherwise(F.lit(1)).alias("low"), F.greatest(p, F.lit(0)).alias("high"))
    windows = chosen.groupBy("query").agg(F.array_sort(F.collect_list(window)).alias("w"))
    windows = windows.select("query", F.transform("w", lambda x: F.struct(x["low"].cast("long").alias("low"), x["high"].alias("high"))).alias("windows"))
    asked = _written(anchors.drop("windows").join(windows, "query"), "negatives-windows")
    found = _first(_searched(tiles, n_tiles, asked, _routed(boxes, n_tiles, asked, best=False), False, negatives), negatives)
    found = found.select("query", (F.col("window") + 1).cast("int").alias("place"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return (found.join(chosen, ["query", "place"]).join(own.select("query", F.col("own_id").alias("anchor_id")), "query")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))
