"""Voice-segment sessioniser (W5), batch form.

Semantics (fixed): a ring of the last 10 voice flags. Idle: push the
frame; when more than 6 of the ring are voiced, open a segment that starts
with every frame in the ring and clear the ring. Open: append and push the
frame; when more than 6 of the ring are unvoiced, close and emit the
segment (trailing silence included) without clearing the ring, so the next
segment may start inside the previous one. A segment still open at the end
is not emitted (``flush_open`` changes that).

Scale form, one plan for every size. After any frame the state is
(open?, m = ring length) and, when open, the first frame of the segment: the
ring always holds the last m flags. So a clip is cut into buckets of
``BUCKET_FRAMES`` frames. The first bucket of every clip is run from the known
start and emits its segments at once; for most clips that is all. Of a clip
with more, every bucket is run from all 22 (open, m) start states; what it does
to each is one small row, and these rows are composed in a tree of fixed depth
(``SUPER`` buckets at a time), which gives the later buckets their real start
states; they are run once more from these to emit their segments. No task
holds more than a bucket of frames or the rows of ``SUPER`` buckets, except
that the composed rows of one clip, one for 2**28 frames, are walked together.

A run takes its steps from one opening or closing to the next: rolling counts
of voiced flags say where the next one is.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .grouped import map_groups

# ---- fixed values ----
RING = 10
OPEN_ABOVE = 6      # voiced count in the ring that opens (> 6 of 10)
CLOSE_ABOVE = 6     # unvoiced count in the ring that closes

BUCKET_FRAMES = 1 << 16
SUPER = 4096        # buckets that are composed together
SHORT = 64          # runs of fewer frames go frame by frame
NO_F0 = -1

SEGMENT_SCHEMA = "clip_id long, seg long, f0 long, frame_no long, n long"


class VadMachine:
    """The sessioniser state machine for one clip (shared by batch and stream)."""

    __slots__ = ("open", "ring", "f0")

    def __init__(self, open_: bool = False, ring: Iterable[int] = (), f0: int = NO_F0):
        self.open = open_
        self.ring = list(ring)[-RING:]
        self.f0 = f0

    def step(self, pos: int, v: int):
        """Feed one frame; return (f0, last, n) when a segment closes."""
        ring = self.ring
        ring.append(v)
        if len(ring) > RING:
            del ring[0]
        if not self.open:
            if sum(ring) > OPEN_ABOVE:
                self.open = True
                self.f0 = pos - len(ring) + 1
                ring.clear()
            return None
        if len(ring) - sum(ring) > CLOSE_ABOVE:
            self.open = False
            out = (self.f0, pos, pos - self.f0 + 1)
            self.f0 = NO_F0
            return out
        return None

    def run(self, frames: np.ndarray, flags: np.ndarray) -> list[tuple[int, int, int]]:
        """Feed a run of frames; the (f0, last, n) of every segment that closes.
        The same as ``step`` frame by frame, but stepping from change to change."""
        k = len(self.ring)
        x = np.concatenate([np.asarray(self.ring, dtype=np.int64), flags])
        n, start, i, out = len(x), 0, k, []      # start: where the ring begins
        total = np.concatenate([[0], np.cumsum(x)])
        rolling = total[RING:] - total[:-RING] if n >= RING else np.zeros(0, np.int64)
        # last frames of full windows that open or close
        opens = np.flatnonzero(rolling > OPEN_ABOVE) + RING - 1
        closes = np.flatnonzero(RING - rolling > CLOSE_ABOVE) + RING - 1
        while i < n:
            hit = None
            for j in range(max(i, start), min(start + RING - 1, n)):      # the ring is not full yet
                voiced = total[j + 1] - total[start]
                if (j + 1 - start - voiced > CLOSE_ABOVE) if self.open else voiced > OPEN_ABOVE:
                    hit = j
                    break
            if hit is None:
                full = closes if self.open else opens
                at = np.searchsorted(full, max(i, start + RING - 1))
                if at == len(full):
                    break
                hit = int(full[at])
            position = int(frames[hit - k])
            if self.open:
                out.append((self.f0, position, position - self.f0 + 1))
                self.open, self.f0 = False, NO_F0
            else:
                self.open, self.f0 = True, position - min(RING, hit + 1 - start) + 1
                start = hit + 1
            i = hit + 1
        self.ring = x[max(start, n - RING):].tolist()
        return out

    def state(self):
        return self.open, list(self.ring), self.f0


def sessionise(positions: list[int], flags: list[int], flush_open: bool = False) -> list[tuple[int, int, int]]:
    """Plain sequential form over one clip (reference model for tests)."""
    m = VadMachine()
    out = []
    for p, v in zip(positions, flags):
        r = m.step(p, v)
        if r:
            out.append(r)
    if flush_open and m.open:
        out.append((m.f0, positions[-1], positions[-1] - m.f0 + 1))
    return out


# ------------------------------------------------------------- scale form
# a bucket's effect on a start state (closes: segments closed; end: its last frame)
EFFECT_SCHEMA = "clip_id long, b long, s_open boolean, s_m int, e_open boolean, e_m int, e_f0 long, closes long, end long"
START_SCHEMA = "clip_id long, b long, st_open boolean, st_m int, st_f0 long, seg0 long, flush long"
_EFFECT = [f.split()[0] for f in EFFECT_SCHEMA.split(", ")]
_START = [f.split()[0] for f in START_SCHEMA.split(", ")]
_SEGMENT = ["clip_id", "seg", "f0", "frame_no", "n"]


def voiced(flag: str):
    """1 for a voiced frame, 0 for an unvoiced one and for one without a flag."""
    return F.coalesce(F.col(flag).cast("int"), F.lit(0))


def _bucketed(frames: DataFrame, clip: str, pos: str, flag: str, width: int) -> DataFrame:
    """Frames tagged with bucket ``b``; the last RING frames of each bucket are
    repeated in the next bucket as halo rows."""
    f = frames.select(F.col(clip).cast("long").alias("clip_id"), F.col(pos).cast("long").alias("pos"),
                      voiced(flag).alias("v"))
    b = F.floor(F.col("pos") / F.lit(width)).cast("long")
    off = F.col("pos") - b * F.lit(width)
    copies = F.array(F.struct(b.alias("b"), F.lit(False).alias("halo"), F.lit(True).alias("_keep")),
                     F.struct((b + 1).alias("b"), F.lit(True).alias("halo"), (off >= width - RING).alias("_keep")))
    return f.select("*", F.inline(F.filter(copies, lambda c: c["_keep"]))).drop("_keep")


def _first_buckets(batches):
    """Frames sorted by clip and frame, the first bucket of each clip: its closed
    segments, and a row with ``seg`` -1 - closed segments for one left open.
    Clips are walked in the sorted partition, without a call per group."""
    held = None

    def clips(clip, pos, v):
        starts = np.flatnonzero(np.concatenate([[True], clip[1:] != clip[:-1]]))
        rows = []
        for a, e in zip(starts.tolist(), [*starts[1:].tolist(), len(clip)]):
            c, m = int(clip[a]), VadMachine()
            if e - a < SHORT:
                closed = [r for r in map(m.step, pos[a:e].tolist(), v[a:e].tolist()) if r]
            else:
                closed = m.run(pos[a:e], v[a:e])
            rows += [(c, seg, *r) for seg, r in enumerate(closed)]
            if m.open:
                rows.append((c, -1 - len(closed), m.f0, int(pos[e - 1]), int(pos[e - 1]) - m.f0 + 1))
        return pd.DataFrame(rows, columns=_SEGMENT)

    for pdf in batches:
        now = [pdf[c].to_numpy(np.int64) for c in ("clip_id", "pos", "v")]
        if held is not None:
            now = [np.concatenate(x) for x in zip(held, now)]
        if not len(now[0]):
            continue
        other = np.flatnonzero(now[0] != now[0][-1])
        cut = int(other[-1]) + 1 if len(other) else 0        # the last clip may go on; it has at most a bucket here
        held = [x[cut:] for x in now]
        if cut:
            yield clips(*[x[:cut] for x in now])
    if held is not None and len(held[0]):
        yield clips(*held)


def _split(pdf: pd.DataFrame):
    pdf = pdf.sort_values("pos")
    h = pdf[pdf["halo"]]
    c = pdf[~pdf["halo"]]
    return h["v"].tolist(), c["pos"].to_numpy(np.int64), c["v"].to_numpy(np.int64)


def _effects(pdf: pd.DataFrame) -> pd.DataFrame:
    """What a bucket does to each start state it can have."""
    halo, pos, v = _split(pdf)
    clip, b, rows = int(pdf["clip_id"].iloc[0]), int(pdf["b"].iloc[0]), []
    if len(pos):
        starts = [(False, 0)] if b == 0 else [(o, k) for o in (False, True) for k in range(min(RING, len(halo)) + 1)]
        for s_open, s_m in starts:
            m = VadMachine(s_open, halo[len(halo) - s_m:] if s_m else [], NO_F0)
            closed = m.run(pos, v)
            rows.append((clip, b, s_open, s_m, m.open, len(m.ring), m.f0 if m.open else NO_F0, len(closed), int(pos[-1])))
    return pd.DataFrame(rows, columns=_EFFECT)


def _walk(pdf: pd.DataFrame, open_: bool, m: int, f0: int, seg: int):
    """Go through effects in bucket order from a start state: yields the state
    before each bucket, and last (None, the state after all)."""
    table = {(int(r.b), bool(r.s_open), int(r.s_m)): r for r in pdf.itertuples(index=False)}
    end = -1
    for b in sorted({k[0] for k in table}):
        yield b, (open_, m, f0, seg, end)
        r = table[b, open_, m]
        seg += int(r.closes)
        f0 = (int(r.e_f0) if int(r.e_f0) != NO_F0 else f0) if bool(r.e_open) else NO_F0
        open_, m, end = bool(r.e_open), int(r.e_m), int(r.end)
    yield None, (open_, m, f0, seg, end)


def _compose(pdf: pd.DataFrame) -> pd.DataFrame:
    """The effect of all buckets of a super-bucket on each start state."""
    clip, b, first = int(pdf["clip_id"].iloc[0]), int(pdf["super"].iloc[0]), int(pdf["b"].min())
    rows = []
    for r in pdf[pdf["b"] == first].itertuples(index=False):
        for _, (open_, m, f0, seg, end) in _walk(pdf, bool(r.s_open), int(r.s_m), NO_F0, 0):
            pass
        rows.append((clip, b, bool(r.s_open), int(r.s_m), open_, m, f0, seg, end))
    return pd.DataFrame(rows, columns=_EFFECT)


def _starts(pdf: pd.DataFrame) -> pd.DataFrame:
    """Real start state of every bucket of the group, from the group's own
    start (``g_*`` columns; the clip's beginning without them); the row of the
    last bucket of a clip left open has the clip's last frame in ``flush``."""
    clip, out = int(pdf["clip_id"].iloc[0]), []
    first = pdf.iloc[0]
    whole = "g_open" not in pdf.columns
    start = (False, 0, NO_F0, 0) if whole else (bool(first["g_open"]), int(first["g_m"]), int(first["g_f0"]), int(first["g_seg0"]))
    for b, (open_, m, f0, seg, end) in _walk(pdf, *start):
        if b is not None:
            out.append((clip, b, open_, m, f0, seg, None))
        elif whole and open_:
            out.append((clip, None, True, m, f0, seg, end))
    return pd.DataFrame(out, columns=_START)


def _emit(pdf: pd.DataFrame) -> pd.DataFrame:
    halo, pos, v = _split(pdf)
    rows = []
    if len(pos):
        r = pdf.iloc[0]
        st_m = int(r["st_m"])
        m = VadMachine(bool(r["st_open"]), halo[len(halo) - st_m:] if st_m else [], int(r["st_f0"]))
        rows = [(int(r["clip_id"]), int(r["seg0"]) + k, *s) for k, s in enumerate(m.run(pos, v))]
    return pd.DataFrame(rows, columns=_SEGMENT)


def voice_segments(frames: DataFrame, clip: str = "clip_id", pos: str = "frame_no", flag: str = "is_voiced",
                   bucket_frames: int = BUCKET_FRAMES, super_buckets: int = SUPER, flush_open: bool = False) -> DataFrame:
    """One row per closed segment (clip_id, seg, f0, frame_no = last frame, n).

    ``pos`` must be a dense 0-based frame number inside each clip; rows without
    a clip or a frame number are left out, and a null flag is unvoiced. ``flush_open`` also emits a segment
    still open at the clip's last frame."""
    width = max(bucket_frames, RING)     # a bucket's halo comes from one bucket
    frames = frames.where(F.col(clip).isNotNull() & F.col(pos).isNotNull())
    plain = frames.select(F.col(clip).cast("long").alias("clip_id"), F.col(pos).cast("long").alias("pos"), voiced(flag).alias("v"))
    first = (plain.where(F.col("pos") < width).repartition("clip_id").sortWithinPartitions("clip_id", "pos")
             .mapInPandas(_first_buckets, SEGMENT_SCHEMA))
    found = first.where("seg >= 0")

    # clips of more than one bucket
    long_clips = plain.where(F.col("pos") >= width).select("clip_id").distinct()
    long_frames = frames.join(long_clips.select(F.col("clip_id").alias("_long")), F.col(clip).cast("long") == F.col("_long"), "left_semi")
    effects = map_groups(_bucketed(long_frames, clip, pos, flag, width), ["clip_id", "b"], ["pos"], _effects, EFFECT_SCHEMA)
    effects = effects.withColumn("super", F.floor(F.col("b") / F.lit(super_buckets)).cast("long"))
    supers = map_groups(effects, ["clip_id", "super"], ["b"], _compose, EFFECT_SCHEMA)
    super_starts = map_groups(supers, ["clip_id"], ["b"], _starts, START_SCHEMA)
    group = super_starts.where("b is not null").select(
        "clip_id", F.col("b").alias("super"), F.col("st_open").alias("g_open"), F.col("st_m").alias("g_m"), F.col("st_f0").alias("g_f0"),
        F.col("seg0").alias("g_seg0"))
    starts = map_groups(effects.join(group, ["clip_id", "super"]), ["clip_id", "super"], ["b"], _starts, START_SCHEMA).where("b > 0")
    rest = _bucketed(frames.where(F.col(pos) >= width - RING), clip, pos, flag, width).where("b > 0")
    found = found.unionByName(map_groups(rest.join(starts, ["clip_id", "b"]), ["clip_id", "b"], ["pos"], _emit, SEGMENT_SCHEMA))
    if flush_open:
        short = first.where("seg < 0").join(long_clips, "clip_id", "left_anti").withColumn("seg", -1 - F.col("seg"))
        left = super_starts.where("flush is not null")
        left = left.select("clip_id", F.col("seg0").alias("seg"), F.col("st_f0").alias("f0"), F.col("flush").alias("frame_no"),
                           (F.col("flush") - F.col("st_f0") + 1).alias("n"))
        found = found.unionByName(short).unionByName(left)
    return found
