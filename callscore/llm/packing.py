"""Packing documents into fixed-length sequences by the sum-of-squares rule.

Each partition packs its own documents in one pass, without any shuffle: an
array holds for every fill level the number of partially filled windows at
that level, and a piece goes to the level that makes the sum of the squared
counts smallest. Documents longer than a window are first cut into whole
windows and a rest. A look-ahead buffer holds back as many tokens as the open
windows still lack; when the input ends, these are cut to fill the open
windows, so that a partition pads at most one sequence.

Sequences whose fill is a power of two need no padding, so their levels do not
count as partially filled.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ref
from .tokens import broadcast_tokenizer, encoder_of

#: partially filled windows of a partition that are open at a time; beyond it pieces are cut to fill the fullest
MAX_OPEN = 4096
#: output rows of an Arrow batch are flushed at this many bytes of ids
FLUSH_BYTES = 8 << 20

PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def is_padded(fill: int, capacity: int) -> bool:
    """Whether a sequence of this fill is padded up to ``capacity``."""
    return 0 < fill < capacity and bool(fill & (fill - 1))


class SumOfSquares:
    """Open windows by fill level and the rule that picks a level."""

    def __init__(self, capacity: int, first_window: int = 0):
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, dtype=np.int64)
        self.partial = np.array([is_padded(h, capacity) for h in range(capacity + 1)])
        self.windows: dict[int, list[int]] = {}
        self.next_window = first_window
        self.lacking = 0    # tokens that fill every partially filled window

    def open_windows(self) -> int:
        return sum(map(len, self.windows.values()))

    def choose(self, size: int) -> int:
        """The level (0: a new window) whose use makes the sum of squares
        smallest; of equals the fullest."""
        cap, n, part = self.capacity, self.counts, self.partial
        to = np.where(part[size:], 2 * n[size:] + 1, 0)                  # cost of the level reached
        fro = np.where(part[:cap - size + 1], 2 * n[:cap - size + 1] - 1, 0)   # saved at the level left
        cost = to - fro
        usable = n[:cap - size + 1] > 0
        usable[0] = True
        cost[~usable] = np.iinfo(np.int64).max
        return int(len(cost) - 1 - np.argmin(cost[::-1]))

    def fullest(self) -> int:
        return max((h for h in self.windows if self.partial[h]), default=0)

    def put(self, level: int, size: int) -> int:
        """Move a window from ``level`` by ``size`` tokens; returns its id."""
        if level:
            at = self.windows[level]
            window = at.pop()
            if not at:
                del self.windows[level]
            self.counts[level] -= 1
            if self.partial[level]:
                self.lacking -= self.capacity - level
        else:
            window, self.next_window = self.next_window, self.next_window + 1
        new = level + size
        if new < self.capacity:
            self.windows.setdefault(new, []).append(window)
            self.counts[new] += 1
            if self.partial[new]:
                self.lacking += self.capacity - new
        return window


def pack_pieces(docs: Iterator[tuple[object, bytes]], capacity: int, max_open: int = MAX_OPEN,
                first_window: int = 0) -> Iterator[tuple]:
    """Pack (doc_id, ids) pairs in the order given; yields
    (doc_id, start, length, doc_tokens, window, offset, ids) as soon as a
    piece has its place."""
    bins = SumOfSquares(capacity, first_window)
    held: deque[tuple[object, int, int, bytes]] = deque()    # doc_id, start, doc tokens, ids of the piece
    held_tokens = 0

    def out(piece, level):
        doc_id, start, total, ids = piece
        size = len(ids) // 4
        return doc_id, start, size, total, bins.put(level, size), level, ids

    def cut(piece, size):
        doc_id, start, total, ids = piece
        return (doc_id, start, total, ids[:4 * size]), (doc_id, start + size, total, ids[4 * size:])

    for doc_id, ids in docs:
        total = len(ids) // 4
        whole = total - total % capacity
        for start in range(0, whole, capacity):
            yield out((doc_id, start, total, ids[4 * start:4 * (start + capacity)]), 0)
        if whole == total:
            continue
        held.append((doc_id, whole, total, ids[4 * whole:]))
        held_tokens += total - whole
        while held_tokens >= bins.lacking + 2 * capacity:
            piece = held.popleft()
            size = len(piece[3]) // 4
            level = bins.choose(size)
            if not level and bins.open_windows() >= max_open and bins.fullest():
                level = bins.fullest()
                if level + size > capacity:
                    piece, rest = cut(piece, capacity - level)
                    held.appendleft(rest)
                    size = capacity - level
            held_tokens -= size
            yield out(piece, level)
    # the rest fills what is open, fullest first, and then new windows one after another
    while held:
        piece = held.popleft()
        size = len(piece[3]) // 4
        level = bins.fullest()
        if level + size > capacity:
            piece, rest = cut(piece, capacity - level)
            held.appendleft(rest)
        yield out(piece, level)


def _packer(definition, capacity: int, end_id: int, max_open: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder_of(definition)
        end = np.array([end_id], dtype="<u4").tobytes()
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
                            ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])

        docs = ((doc_id, ids + end) for doc_id, ids in encode.stream(batches))
        first = TaskContext.get().partitionId() << 40
        rows, size = [], 0
        for row in pack_pieces(docs, capacity, max_open, first):
            rows.append(row)
            size += len(row[6])
            if size >= FLUSH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1, doc_id: str = "doc_id",
         text: str = "text", max_open: int = MAX_OPEN) -> DataFrame:
    """Pack every document into sequences of at most ``capacity`` tokens.

    One row per piece: doc_id, start (the document's tokens before it),
    length, doc_tokens (all of them, the end id included), sequence_id,
    offset in the sequence, ids (little-endian unsigned 32-bit integers).
    ``tokenizer`` is the path of a tokenizer file that drops white space.

    Null or empty texts are documents of the end id alone. A null doc_id stays
    null. Repeated rows are packed as often as they occur. Other columns are
    not read, whatever their names. No rows give no pieces. A text of any
    length is cut; nothing is dropped. Sequences do not span partitions: a
    lost task packs the same rows again, and no other task depends on it.
    """
    definition = broadcast_tokenizer(docs.sparkSession, tokenizer)
    src = docs.select(ref(doc_id).cast("long").alias("doc_id"), F.coalesce(ref(text).cast("string"), F.lit("")).alias("text"))
    return src.mapInArrow(_packer(definition, capacity, end_id, max_open), PIECES)
