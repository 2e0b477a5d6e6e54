"""Streaming voice-segment sessioniser (T5): the W5 state machine as keyed
state. Per clip: open flag, ring of at most 10 flags, segment start, next
segment number, the next frame expected, the frames that came before their
turn, the ranges of frames that were given up, and a closed flag.

Frames are processed in frame order, whatever order they arrive in. Frames
ahead of their turn wait as sorted runs: first frame and length of each, and
one bit a frame for the flags. A batch is merged into the runs as a whole, and
the machine takes a run at a time, so 10^7 frames that arrive in reverse are a
state of some 1.3 MB. They wait until the gap closes or the clip idles out
(``HOLD_FRAMES``, if set, bounds them and gives gaps up earlier).

A clip that idles out is closed: its gaps are given up, and a tombstone stays.
A frame that comes when its gap was given up, or a new one after the end, emits a
row with ``seg`` -1 (f0 and frame_no are the frame's number, n is 0); a frame
seen before counts once. A frame without a flag is unvoiced, as in batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.segments import NO_F0, SEGMENT_SCHEMA, VadMachine

FRAME_SCHEMA = "clip_id long, frame_no long, is_voiced boolean"
STATE_SCHEMA = ("open boolean, ring array<int>, f0 long, seg long, next long, run_from binary, run_len binary, bits binary, "
                "skipped_from array<long>, skipped_to array<long>, closed boolean")
IDLE_TIMEOUT_MS = 30 * 60 * 1000
TOMBSTONE_MS = 60 * 60 * 1000
#: frames of a clip that may wait for a gap to close; None: any number
HOLD_FRAMES: int | None = None
#: frames that the machine takes at a time
STEP_FRAMES = 1 << 16
LATE = -1
COLUMNS = ["clip_id", "seg", "f0", "frame_no", "n"]


class FrameRuns:
    """Frames with flags, as sorted, disjoint runs that do not touch."""

    def __init__(self, first=b"", length=b"", bits=b""):
        self.first, self.length = np.frombuffer(first, np.int64), np.frombuffer(length, np.int64)
        self.flags = np.unpackbits(np.frombuffer(bits, np.uint8), count=int(self.length.sum()))

    def state(self) -> tuple[bytes, bytes, bytes]:
        return self.first.tobytes(), self.length.tobytes(), np.packbits(self.flags).tobytes()

    def __len__(self) -> int:
        return len(self.flags)

    def add(self, frames: np.ndarray, flags: np.ndarray) -> None:
        """Frames in any order; of equal ones the first counts, and one that is
        in a run already does not."""
        frames, at = np.unique(frames, return_index=True)
        if len(self.first):
            run = np.searchsorted(self.first, frames, "right") - 1
            new = (run < 0) | (frames >= self.first[run] + self.length[run])
            frames, at = frames[new], at[new]
        if not len(frames):
            return
        begins = np.flatnonzero(np.concatenate([[True], np.diff(frames) != 1]))
        first, length = frames[begins], np.diff(np.concatenate([begins, [len(frames)]]))
        flags = flags[at].astype(np.uint8)
        place = np.searchsorted(self.first, first)
        if place[0] == place[-1]:        # all between the same two runs
            cut = int(self.length[:place[0]].sum())
            self.flags = np.concatenate([self.flags[:cut], flags, self.flags[cut:]])
            self.first, self.length = np.insert(self.first, place[0], first), np.insert(self.length, place[0], length)
        else:
            first, length, flags = np.concatenate([self.first, first]), np.concatenate([self.length, length]), np.concatenate([self.flags, flags])
            order = np.argsort(first)
            begin = np.cumsum(length) - length
            self.first, self.length = first[order], length[order]
            moved = begin[order] - (np.cumsum(self.length) - self.length)
            self.flags = flags[np.repeat(moved, self.length) + np.arange(len(flags))]
        apart = np.flatnonzero(np.concatenate([[True], self.first[1:] != self.first[:-1] + self.length[:-1]]))
        self.length = np.add.reduceat(self.length, apart)
        self.first = self.first[apart]

    def pop(self) -> tuple[int, np.ndarray]:
        """The first run."""
        n = int(self.length[0])
        first, flags = int(self.first[0]), self.flags[:n]
        self.first, self.length, self.flags = self.first[1:], self.length[1:], self.flags[n:]
        return first, flags


class _Clip:
    def __init__(self, clip, state=None):
        self.clip, self.out = clip, []
        self.machine, self.seg, self.next, self.closed = VadMachine(), 0, 0, False
        self.held = FrameRuns()
        self.skipped: list[list[int]] = []
        if state is not None:
            open_, ring, f0, self.seg, self.next, first, length, bits, a, b, self.closed = state
            self.machine = VadMachine(open_, list(ring or []), f0)
            self.held = FrameRuns(bytes(first), bytes(length), bytes(bits))
            self.skipped = [list(x) for x in zip(a or [], b or [])]

    def state(self) -> tuple:
        m = self.machine
        return (m.open, m.ring, m.f0 if m.open else NO_F0, self.seg, self.next, *self.held.state(),
                [a for a, _ in self.skipped], [b for _, b in self.skipped], self.closed)

    def add(self, frames: np.ndarray, flags: np.ndarray) -> None:
        ahead = frames >= self.next
        if self.closed:
            for f in np.unique(frames[ahead]).tolist():
                self.out.append((self.clip, LATE, f, f, 0))
        elif ahead.any():
            self.held.add(frames[ahead], flags[ahead])
        if self.skipped:
            for f in frames[~ahead].tolist():
                self._given_up(f)

    def _given_up(self, frame: int) -> None:
        gap = next((g for g in self.skipped if g[0] <= frame <= g[1]), None)
        if gap is not None:
            self.skipped.remove(gap)
            self.skipped += [g for g in ([gap[0], frame - 1], [frame + 1, gap[1]]) if g[0] <= g[1]]
            self.out.append((self.clip, LATE, frame, frame, 0))

    def settle(self, flush: bool = False) -> None:
        """Run what is in turn; with ``flush`` (or too many held) give up gaps."""
        while len(self.held):
            first = int(self.held.first[0])
            if first > self.next:
                if not (flush or HOLD_FRAMES is not None and len(self.held) > HOLD_FRAMES):
                    return
                self.skipped.append([self.next, first - 1])
            first, flags = self.held.pop()
            for k in range(0, len(flags), STEP_FRAMES):
                part = flags[k:k + STEP_FRAMES].astype(np.int64)
                for f0, last, n in self.machine.run(np.arange(first + k, first + k + len(part), dtype=np.int64), part):
                    self.out.append((self.clip, self.seg, f0, last, n))
                    self.seg += 1
            self.next = first + len(flags)

    def close(self) -> None:
        self.settle(flush=True)
        self.closed = True

    def rows(self) -> pd.DataFrame:
        rows, self.out = self.out, []
        return pd.DataFrame(rows, columns=COLUMNS)


def process_clip(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    clip = _Clip(key[0], state.get if state.exists else None)
    if state.hasTimedOut:
        if clip.closed:
            state.remove()      # the tombstone's time is up
            return
        clip.close()
        state.update(clip.state())
        state.setTimeoutDuration(TOMBSTONE_MS)
        if clip.out:
            yield clip.rows()
        return
    for pdf in pdfs:
        clip.add(pdf["frame_no"].to_numpy(np.int64), pdf["is_voiced"].to_numpy(bool))
        clip.settle()
        if clip.out:
            yield clip.rows()
    state.update(clip.state())
    state.setTimeoutDuration(TOMBSTONE_MS if clip.closed else IDLE_TIMEOUT_MS)


def segment_stream(frames_text: DataFrame) -> DataFrame:
    """Frames as JSON text lines -> closed segments (append mode)."""
    f = frames_text.select(F.from_json("value", FRAME_SCHEMA).alias("f")).select("f.*")
    f = f.filter(F.col("clip_id").isNotNull() & F.col("frame_no").isNotNull())
    f = f.withColumn("is_voiced", F.coalesce("is_voiced", F.lit(False)))
    return f.groupBy("clip_id").applyInPandasWithState(
        process_clip, SEGMENT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.ProcessingTimeTimeout)
