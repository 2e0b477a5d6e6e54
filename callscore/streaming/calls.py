"""Keyed progressive call state on Structured Streaming.

``groupBy(call_id).transformWithState`` keeps a call's state by entry:

* ``head``: the next expected index, the runs of waiting indexes, the call's
  revision, its timers and a closed flag that acts as a tombstone; with it
  ``settled``: the fold of all chunks before the first gap (text cut to 2048
  characters, as later text can never reach the output; segment count; running
  sum and count of the matrices of each modality); and, while chunks wait,
  ``front``: the fold of the settled and all waiting chunks, so that a chunk
  that comes in order after a gap costs one step, however long the gap stays;
* ``waiting``: one map entry for each chunk after the first gap.

So a lost chunk, or a start in the middle of a call, stops nothing, and nothing
is dropped silently, in whatever order chunks arrive:

* every chunk emits a ``running`` row (text cut to 512, mean matrices so far)
  over what has been delivered up to its index. Rows after a gap are
  ``provisional``; they are emitted at once or after a bounded wait;
* when a late chunk arrives, it and all later chunks emit rows again, of a
  higher ``revision``. ``latest`` keeps the last one for each chunk, which
  equals the batch result over the delivered chunks;
* an index seen before is a redelivery and counts once;
* a chunk whose matrix differs in shape from the first by index of its call
  emits a ``quarantined`` row and counts in nothing;
* with ``hold_chunks``, a gap before more waiting chunks than that is given up:
  they are settled, and a chunk that still comes for it emits a ``late`` row;
* a chunk whose call has ended emits a ``late`` row with its text.

A CALL_END emits the ``final`` row (text cut to 2048) and tombstones the call;
an end marker of an unknown call emits an ``orphan_end`` row; a call idle
longer than the timeout emits an ``expired`` row and is tombstoned too.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from itertools import batched

import numpy as np
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.arrays import n_cols
from ..functions.scoring import Scorer, score_columns, stand_in_scorer
from ..operators.calls import FINAL_CHARS, RUNNING_CHARS
from ..sources.envelope import observe_envelope, split_valid

MODALITIES = ("mfcc", "spec")
OUTPUT_SCHEMA = ("kind string, call_id string, chunk_index int, n_segments long, text string, mfcc array<double>, mfcc_cols int, "
                 "spec array<double>, spec_cols int, reason string, provisional boolean, revision long")
OUT_ROW = Row(*[f.split()[0] for f in OUTPUT_SCHEMA.split(", ")])
HEAD_SCHEMA = "closed boolean, next_index long, runs array<long>, skipped array<long>, front_last long, revision long, last_at long, idle_at long, wait_at long"
HEAD_FIELDS = 9
# sums are the bytes of doubles: arrays are converted cell by cell on each way
FOLD_SCHEMA = "n long, text string, mfcc_sum binary, mfcc_cols int, mfcc_n long, spec_sum binary, spec_cols int, spec_n long"
FRONT_SCHEMA = ", ".join(f"front_{f}" for f in FOLD_SCHEMA.split(", "))
FOLD_FIELDS = len(FOLD_SCHEMA.split(", "))
CHUNK_SCHEMA = "text string, mfcc binary, mfcc_cols int, spec binary, spec_cols int"
TAKE_ROWS = 10_000      # rows of a call folded at a time
IDLE_TIMEOUT_MS = 30 * 60 * 1000
TOMBSTONE_MS = 60 * 60 * 1000
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


_bytes = lambda x: None if x is None else np.asarray(x, dtype=np.float64).tobytes()
_array = lambda x: None if x is None else np.frombuffer(bytes(x), dtype=np.float64)


class Fold:
    """Chunks folded in index order. A modality's shape is that of the first
    matrix; (sum, columns, count), with a count of 0 until one is added."""

    def __init__(self, state=None):
        self.n, self.text, self.sums = 0, "", {m: (None, None, 0) for m in MODALITIES}
        if state is not None:
            self.n, self.text = state[0], state[1] or ""
            self.sums = {m: (_array(state[k]), state[k + 1], state[k + 2] or 0) for m, k in (("mfcc", 2), ("spec", 5))}

    def state(self) -> tuple:
        flat = [x for s, cols, n in self.sums.values() for x in (_bytes(s), cols, n)]
        return (self.n, self.text, *flat)

    def copy(self) -> "Fold":
        other = Fold()
        other.n, other.text, other.sums = self.n, self.text, dict(self.sums)
        return other

    def add(self, chunk: tuple) -> bool:
        """Take the next chunk; False if its matrices do not fit the call's."""
        matrices = dict(zip(MODALITIES, (chunk[1:3], chunk[3:5])))
        for m, (cells, cols) in matrices.items():       # a chunk that does not count sets a shape, too
            if cells is not None and self.sums[m][0] is None:
                self.sums[m] = (np.zeros(len(cells)), cols, 0)
        for m, (cells, cols) in matrices.items():
            if cells is not None and (len(self.sums[m][0]) != len(cells) or self.sums[m][1] != cols):
                return False
        for m, (cells, cols) in matrices.items():
            if cells is not None:
                total, width, count = self.sums[m]
                self.sums[m] = (total + np.asarray(cells, dtype=np.float64), width, count + 1)
        self.text = (chunk[0] if self.n == 0 else self.text + " " + chunk[0])[:FINAL_CHARS]
        self.n += 1
        return True

    def matrices(self) -> list:
        """mean, columns of each modality."""
        return [x for s, cols, n in self.sums.values() for x in ((s / n, cols) if n else (None, None))]


def add_index(runs: list[list[int]], i: int) -> bool:
    """Add ``i`` to sorted runs of indexes; False if it is in one already."""
    low, high = 0, len(runs)
    while low < high:
        mid = (low + high) // 2
        if runs[mid][1] < i:
            low = mid + 1
        else:
            high = mid
    if low < len(runs) and runs[low][0] <= i:
        return False
    joins_before = low > 0 and runs[low - 1][1] == i - 1
    joins_after = low < len(runs) and runs[low][0] == i + 1
    if joins_before and joins_after:
        runs[low - 1][1] = runs.pop(low)[1]
    elif joins_before:
        runs[low - 1][1] = i
    elif joins_after:
        runs[low][0] = i
    else:
        runs.insert(low, [i, i])
    return True


_pairs = lambda flat: [list(p) for p in zip(flat[::2], flat[1::2])]
_flat = lambda pairs: [x for p in pairs for x in p]


class CallState:
    """One call while rows of it are handled. ``waiting`` is the map state (or
    anything with its methods): entries are read and written one by one."""

    def __init__(self, call_id: str, waiting, head=None, settled=None, front=None):
        self.call_id, self.waiting, self.out = call_id, waiting, []
        self.closed, self.next, self.runs, self.skipped, self.front_last, self.revision, self.last_at, self.idle_at, self.wait_at = False, 0, [], [], -1, 0, 0, 0, 0
        if head is not None:
            (self.closed, self.next, runs, skipped, self.front_last, self.revision, self.last_at, self.idle_at, self.wait_at) = head
            self.runs, self.skipped = _pairs(runs or []), _pairs(skipped or [])
        self.settled = Fold(settled)
        self.front = None if front is None else Fold(front)

    def head(self) -> tuple:
        return (self.closed, self.next, _flat(self.runs), _flat(self.skipped), self.front_last, self.revision, self.last_at, self.idle_at, self.wait_at)

    @property
    def seen(self) -> bool:
        return bool(self.next or self.runs)

    def emit(self, kind: str, index=None, text=None, fold: Fold | None = None, reason=None, provisional=False) -> None:
        matrices = fold.matrices() if fold is not None else [None] * 4
        self.out.append((kind, self.call_id, index, fold.n if fold is not None else 0, text, *matrices, reason, provisional, self.revision))

    def rows(self) -> Iterator[Row]:
        rows, self.out = self.out, []
        return (OUT_ROW(*r) for r in rows)

    # -------------------------------------------------------------- chunks
    def take(self, chunks: list[tuple[int, tuple]], hold_chunks: int | None = None, emit_front: bool = True) -> None:
        """Chunks of a batch, in any order."""
        self.revision += 1
        fresh: dict[int, tuple] = {}
        for i, chunk in chunks:
            if self.closed:
                self.emit("late", i, chunk[0], reason="after_end")
            elif i < self.next:
                gap = next((g for g in self.skipped if g[0] <= i <= g[1]), None)
                if gap is not None:
                    self.skipped.remove(gap)
                    self.skipped += [g for g in ([gap[0], i - 1], [i + 1, gap[1]]) if g[0] <= g[1]]
                    self.emit("late", i, chunk[0], reason="gap_given_up")
            elif i not in fresh and add_index(self.runs, i):
                fresh[i] = chunk
        if not fresh:
            return
        first = min(fresh)
        before = self.next
        self._settle(fresh)
        while hold_chunks is not None and self.runs and sum(b - a + 1 for a, b in self.runs) > hold_chunks:
            self._store(fresh)
            fresh = {}
            self.skipped.append([self.next, self.runs[0][0] - 1])
            self.next = self.runs[0][0]
            self._settle(fresh)
        self._store(fresh)
        if not self.runs:
            self.front, self.front_last = None, -1
        elif emit_front or self.front is not None:
            # what came before the front's end, or moved what is settled, changes every row after it
            anew = self.front is None or self.next != before or first < self.front_last
            self._advance(fresh, first if self.front is not None else 0, anew)

    def _store(self, fresh: dict[int, tuple]) -> None:
        """Entries of new chunks that wait."""
        for i in [i for i in fresh if i >= self.next]:
            text, mfcc, mfcc_cols, spec, spec_cols = fresh[i]
            self.waiting.updateValue((i,), (text, _bytes(mfcc), mfcc_cols, _bytes(spec), spec_cols))

    def _chunk(self, i: int, fresh: dict[int, tuple]) -> tuple:
        if i in fresh:
            return fresh[i]
        text, mfcc, mfcc_cols, spec, spec_cols = self.waiting.getValue((i,))
        return (text, _array(mfcc), mfcc_cols, _array(spec), spec_cols)

    def _settle(self, fresh: dict[int, tuple]) -> None:
        """Fold what is in turn, and emit it for good."""
        while self.runs and self.runs[0][0] == self.next:
            a, b = self.runs.pop(0)
            for i in range(a, b + 1):
                chunk = self._chunk(i, fresh)
                self._step(self.settled, i, chunk, provisional=False)
                if i not in fresh:
                    self.waiting.removeKey((i,))
                else:
                    del fresh[i]
            self.next = b + 1

    def _step(self, fold: Fold, i: int, chunk: tuple, provisional: bool, emit: bool = True) -> None:
        fits = fold.add(chunk)
        if emit and fits:
            self.emit("running", i, fold.text[:RUNNING_CHARS], fold, provisional=provisional)
        elif emit:
            self.emit("quarantined", i, chunk[0], fold, "changed_shape", provisional)

    def _advance(self, fresh: dict[int, tuple], first: int, anew: bool) -> None:
        """Fold the front up to the last waiting chunk; rows from ``first`` on are emitted."""
        if anew:
            self.front, self.front_last = self.settled.copy(), self.next - 1
        for a, b in self.runs:
            for i in range(max(a, self.front_last + 1), b + 1):
                self._step(self.front, i, self._chunk(i, fresh), provisional=True, emit=i >= first)
                self.front_last = i

    def show_waiting(self) -> None:
        """The bounded wait is over: rows for all that waits."""
        self.revision += 1
        if self.runs and self.front is None:
            self._advance({}, 0, True)

    def close(self, kind: str) -> None:
        """The last row of a call; what is left is a tombstone."""
        self.revision += 1
        self.show_waiting()
        fold = self.front if self.runs else self.settled
        self.emit(kind, None, fold.text[:FINAL_CHARS], fold)
        self.closed, self.runs, self.skipped, self.settled, self.front = True, [], [], Fold(), None
        self.next = max(self.next, 1)


def _millis(t: datetime) -> int:
    return (t - EPOCH) // timedelta(milliseconds=1)


def _chunk(r: Row) -> tuple:
    flat = lambda x, c: (x, c) if x else (None, None)
    return ((r.transcript or "").strip(), *flat(r.mfcc, r.mfcc_cols), *flat(r.spec, r.spec_cols))


class CallProcessor(StatefulProcessor):
    """The processor of one call's rows and timers. ``wait_ms`` delays the rows
    after a new gap; 0 emits them at once."""

    def __init__(self, idle_ms: int = IDLE_TIMEOUT_MS, hold_chunks: int | None = None, wait_ms: int = 0, event_time: bool = False):
        self.idle_ms, self.hold_chunks, self.wait_ms, self.event_time = idle_ms, hold_chunks, wait_ms, event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # head, settled and front change together, so they are one entry
        self.head = handle.getValueState("head", f"{HEAD_SCHEMA}, {FOLD_SCHEMA}, {FRONT_SCHEMA}")
        self.waiting = handle.getMapState("waiting", "chunk_index long", CHUNK_SCHEMA)

    def _load(self, key) -> CallState:
        state = self.head.get()
        if state is None:
            return CallState(key[0], self.waiting)
        head, settled, front = state[:HEAD_FIELDS], state[HEAD_FIELDS:-FOLD_FIELDS], state[-FOLD_FIELDS:]
        return CallState(key[0], self.waiting, head, settled, None if front[0] is None else front)

    def _save(self, call: CallState) -> None:
        front = call.front.state() if call.front is not None else (None,) * FOLD_FIELDS
        self.head.update((*call.head(), *call.settled.state(), *front))

    def _timer(self, old: int, at: int) -> int:
        if old != at:
            if old:
                self.handle.deleteTimer(old)
            if at:
                self.handle.registerTimer(at)
        return at

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        call = self._load(key)
        ended, last_event_ms = False, None
        now = timerValues.getCurrentWatermarkInMs() if self.event_time else timerValues.getCurrentProcessingTimeInMs()
        for some in batched(rows, TAKE_ROWS):       # however long the call's micro-batch is
            if self.event_time:
                last_event_ms = max((x for x in (last_event_ms, *(_millis(r.event_time) for r in some if r.event_time is not None)) if x is not None), default=None)
            ended = ended or any(r.kind == "end" for r in some)
            call.take([(r.chunk_no, _chunk(r)) for r in some if r.kind != "end"], self.hold_chunks, emit_front=not self.wait_ms)
            yield from call.rows()
        if ended and not call.closed:       # after the chunks of the same micro-batch
            if call.seen:
                self._close(call, "final")
            else:
                call.emit("orphan_end")
        if call.seen:
            call.last_at = max(call.last_at, now if last_event_ms is None else last_event_ms)
            # one timer a call: it looks at the last event when it fires, so that rows need not move it
            call.idle_at = call.idle_at or self._timer(0, max(self._due(call), now + 1))
            waits = self.wait_ms and call.runs and call.front is None
            call.wait_at = self._timer(call.wait_at, (call.wait_at or now + self.wait_ms) if waits else 0)
            self._save(call)
        yield from call.rows()

    def _due(self, call: CallState) -> int:
        return call.last_at + (TOMBSTONE_MS if call.closed else self.idle_ms)

    def _close(self, call: CallState, kind: str) -> None:
        waits = bool(call.runs)
        call.close(kind)
        if waits:       # every access to the state is a message to the JVM
            self.waiting.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        call, at = self._load(key), expiredTimerInfo.getExpiryTimeInMs()
        now = timerValues.getCurrentWatermarkInMs() if self.event_time else timerValues.getCurrentProcessingTimeInMs()
        if at == call.wait_at and not call.closed:
            call.wait_at = 0
            call.show_waiting()
            self._save(call)
        elif at == call.idle_at and at < self._due(call):
            call.idle_at = self._timer(0, self._due(call))
            self._save(call)
        elif at == call.idle_at and call.closed:      # the tombstone's time is up
            self.head.clear()
        elif at == call.idle_at:
            self._close(call, "expired")
            call.wait_at, call.last_at = self._timer(call.wait_at, 0), max(now, at)
            call.idle_at = self._timer(0, self._due(call))
            self._save(call)
        yield from call.rows()

    def close(self) -> None:
        pass


def call_states(decoded: DataFrame, watermark: str | None = None, event_idle_ms: int | None = None, need_matrices: bool = False,
                hold_chunks: int | None = None, wait_ms: int = 0) -> DataFrame:
    """T1-T4 on a decoded message stream (``sources.envelope.decode``).

    By default idle calls are closed after a processing-time timeout. With
    ``watermark`` (e.g. "10 minutes") and ``event_idle_ms`` the stream gets an
    event-time watermark and a call expires once the watermark passes its last
    event plus the idle limit. Either way it leaves an ``expired`` row and a
    tombstone. Matrices travel as flat arrays and a width."""
    valid, _ = split_valid(observe_envelope(decoded), need_matrices)
    v = valid.select("call_id", "kind", "chunk_no", "transcript", F.flatten("mfcc").alias("mfcc"), n_cols("mfcc").alias("mfcc_cols"),
                     F.flatten("spectrogram").alias("spec"), n_cols("spectrogram").alias("spec_cols"), *(["event_time"] if watermark else []))
    if watermark:
        v = v.withWatermark("event_time", watermark)
        processor, mode = CallProcessor(event_idle_ms or IDLE_TIMEOUT_MS, hold_chunks, wait_ms, event_time=True), "eventTime"
    else:
        processor, mode = CallProcessor(IDLE_TIMEOUT_MS, hold_chunks, wait_ms), "processingTime"
    return v.groupBy("call_id").transformWithState(processor, OUTPUT_SCHEMA, "append", mode)


def latest(rows: DataFrame) -> DataFrame:
    """The last revision of every chunk's ``running`` or ``quarantined`` row;
    rows of the other kinds as they are (of a call's last rows there is one)."""
    values = [c for c in rows.columns if c not in ("call_id", "chunk_index")]
    of_chunks = rows.where(F.col("kind").isin("running", "quarantined"))
    last = of_chunks.groupBy("call_id", "chunk_index").agg(F.max_by(F.struct(*values), "revision").alias("_r"))
    last = last.select("call_id", "chunk_index", *[F.col(f"_r.{c}").alias(c) for c in values]).select(*rows.columns)
    return last.unionByName(rows.where(~F.col("kind").isin("running", "quarantined")))


def with_decisions(rows: DataFrame, scorer: Scorer = stand_in_scorer) -> DataFrame:
    """Score the emitted rows with ``scorer``."""
    return score_columns(rows, "text", "mfcc", "spec", scorer)
