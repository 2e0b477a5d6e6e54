"""Stream = batch, redelivery, tombstones and restarts for the call processor."""

import numpy as np

from callscore.operators import calls
from callscore.sources import envelope as env
from callscore.streaming import calls as scalls
from callscore.streaming.runner import run_waves


def _msgs(spark, rows):
    return spark.createDataFrame(rows, "wave int, value string")


def _chunk(cid, i, t):
    return f'{{"call_id":"{cid}","chunk_index":{i},"event":"CHUNK","transcript":"{t}"}}'


def _end(cid):
    return f'{{"call_id":"{cid}","event":"CALL_END"}}'


def _run(spark, rows, name):
    build = lambda s: scalls.with_decisions(scalls.call_states(env.decode(s)))
    schema = scalls.OUTPUT_SCHEMA + ", bert_prob double, mfcc_prob double, spec_prob double, final_prob double, status string"
    return run_waves(spark, _msgs(spark, rows), build, schema, name).collect()


def test_redelivery_late_chunk_and_orphan(spark):
    rows = [
        (0, _chunk("a", 0, "hello")), (0, _chunk("a", 1, "there")),
        (1, _chunk("a", 1, "there")),            # redelivered
        (1, _chunk("a", 2, "friend")), (1, _end("a")),
        (2, _chunk("a", 3, "late")),             # after CALL_END: tombstoned
        (2, _end("b")),                          # end marker without a call
        (2, 'not json'), (2, '{"chunk_index":"x"}'),
    ]
    out = _run(spark, rows, "t_redelivery")
    running = sorted((r["chunk_index"], r["text"]) for r in out if r["kind"] == "running")
    assert running == [(0, "hello"), (1, "hello there"), (2, "hello there friend")]
    final = [r for r in out if r["kind"] == "final"]
    assert len(final) == 1 and final[0]["text"] == "hello there friend" and final[0]["n_segments"] == 3
    assert [r["call_id"] for r in out if r["kind"] == "orphan_end"] == ["b"]


def test_stream_equals_batch_with_restarts(spark, small_dir):
    from callscore.plans import fixtures as fx
    from callscore.plans import stream_queries as sq
    got = sq.q_stream_running(spark, small_dir)
    want = calls.call_running(fx.chunk_matrices(spark, small_dir))
    cols = sorted(want.columns)
    a = sorted(tuple(r) for r in got.select(cols).collect())
    b = sorted(tuple(r) for r in want.select(cols).collect())
    assert a == b and len(a) > 0


def test_matrix_means_in_state(spark):
    rows = [(0, '{"call_id":"m","chunk_index":0,"event":"CHUNK","transcript":"x","mfcc":[[1.0,2.0]]}'),
            (1, '{"call_id":"m","chunk_index":1,"event":"CHUNK","transcript":"y","mfcc":[[3.0,6.0]]}')]
    out = _run(spark, rows, "t_matrix")
    last = [r for r in out if r["kind"] == "running" and r["chunk_index"] == 1][0]
    assert last["mfcc"] == [2.0, 4.0] and last["mfcc_cols"] == 2 and last["spec"] is None


def test_foreach_batch_sink_is_idempotent(spark):
    build = lambda s: scalls.call_states(env.decode(s))
    rows = [(0, _chunk("z", 0, "one")), (1, _chunk("z", 1, "two")), (2, _end("z"))]
    out = run_waves(spark, _msgs(spark, rows), build, scalls.OUTPUT_SCHEMA, "t_feb", sink="foreachBatch").collect()
    kinds = sorted(r["kind"] for r in out)
    assert kinds == ["final", "running", "running"]


def test_event_time_expiry_and_tombstone(spark):
    def chunk_at(cid, i, t, ts):
        return (f'{{"call_id":"{cid}","chunk_index":{i},"event":"CHUNK","transcript":"{t}",'
                f'"start_timestamp":"{ts}"}}')
    rows = [
        (0, chunk_at("a", 0, "hi", "2024-01-01T00:00:00Z")),
        (0, chunk_at("b", 0, "yo", "2024-01-01T00:00:00Z")),
        (1, chunk_at("b", 1, "still", "2024-01-01T03:00:00Z")),   # moves the watermark past a's idle limit
        (2, chunk_at("b", 2, "here", "2024-01-01T03:10:00Z")),
        (3, chunk_at("a", 1, "late", "2024-01-01T03:20:00Z")),    # a already expired: tombstoned
    ]
    build = lambda s: scalls.call_states(env.decode(s), watermark="1 minute", event_idle_ms=3600 * 1000)
    out = run_waves(spark, _msgs(spark, rows), build, scalls.OUTPUT_SCHEMA, "t_event_time").collect()
    expired = [(r["call_id"], r["text"]) for r in out if r["kind"] == "expired"]
    assert expired == [("a", "hi")]
    assert not [r for r in out if r["call_id"] == "a" and r["kind"] == "running" and r["chunk_index"] == 1]
    assert sorted(r["chunk_index"] for r in out if r["call_id"] == "b" and r["kind"] == "running") == [0, 1, 2]


def test_observed_envelope_counters(spark):
    from callscore.streaming.runner import LAST_STATE
    rows = [(0, _chunk("q", 0, "a")), (0, "not json"), (1, '{"call_id":"q","chunk_index":"x"}'), (1, _end("q"))]
    _run(spark, rows, "t_observe")
    st = LAST_STATE["t_observe"]
    assert st["rows_read"] == 4 and st["quarantined"] == 2


def test_disorder_redelivery_and_gaps_give_the_batch_result(spark):
    rows = [(0, _chunk("a", 0, "zero")), (0, _chunk("a", 2, "two")), (0, _chunk("a", 4, "four")),
            (1, _chunk("a", 2, "two")), (1, _chunk("a", 1, "one")),                # closes the first gap; a redelivery
            (2, _chunk("a", 0, "zero")), (2, _chunk("a", 5, "five")), (2, _end("a")),      # 3 never came
            (3, _chunk("a", 3, "three")), (3, _chunk("a", 1, "one"))]
    out = _run(spark, rows, "t_disorder")
    last = {r["chunk_index"]: r["text"] for r in sorted(out, key=lambda r: r["revision"]) if r["kind"] == "running"}
    assert last == {0: "zero", 1: "zero one", 2: "zero one two", 4: "zero one two four", 5: "zero one two four five"}
    final = [r for r in out if r["kind"] == "final"]
    assert [(r["text"], r["n_segments"]) for r in final] == [("zero one two four five", 5)]
    # nothing is silent: what comes after the end is a row
    assert sorted((r["chunk_index"], r["text"], r["reason"]) for r in out if r["kind"] == "late") == [(1, "one", "after_end"), (3, "three", "after_end")]


class _Map(dict):
    """The methods of a map state."""

    def updateValue(self, key, value):
        self[key] = value

    def getValue(self, key):
        return self[key]

    def removeKey(self, key):
        del self[key]


def _piece(i, mfcc=None, cols=None):
    return (str(i), mfcc, cols, None, None)


def _again(call):
    """The call as the next micro-batch finds it."""
    front = call.front.state() if call.front is not None else None
    return scalls.CallState(call.call_id, call.waiting, call.head(), call.settled.state(), front)


def _latest(rows):
    """The last row of each chunk, by revision."""
    found = {}
    for r in rows:
        if r[0] in ("running", "quarantined") and (r[2] not in found or found[r[2]][-1] <= r[-1]):
            found[r[2]] = r
    return found


def test_too_many_waiting_chunks_give_up_the_gap():
    call = scalls.CallState("c", _Map())
    for i in (1, 2, 3, 4, 9):
        call.take([(i, _piece(i))], hold_chunks=3)
    assert call.skipped == [[0, 0]] and call.next == 5 and list(call.waiting) == [(9,)]
    assert {i: r[4] for i, r in _latest(call.out).items()} == {1: "1", 2: "1 2", 3: "1 2 3", 4: "1 2 3 4", 9: "1 2 3 4 9"}
    again = _again(call)
    again.take([(0, _piece(0)), (0, _piece(0)), (2, _piece(2))], hold_chunks=3)
    assert [(r[0], r[2], r[9]) for r in again.out] == [("late", 0, "gap_given_up")] and not again.skipped


def test_any_arrival_gives_the_rows_of_the_delivered_chunks():
    """Lost, late and repeated chunks, of two shapes, in random batches: the last rows equal a fold in order."""
    import random
    for seed in range(60):
        r = random.Random(seed)
        n = r.randint(1, 40)
        chunk = {i: _piece(i, *r.choice([((1.0 * i, 2.0), 2), ((1.0 * i,), 1), (None, None)])) for i in range(n) if r.random() > 0.1}
        arrivals = sorted([(i + r.choice([0, 0, 0, r.randint(0, 30)]), i) for i in [*chunk, *r.sample(sorted(chunk), len(chunk) // 4)]])
        call, out = scalls.CallState("c", _Map()), []
        while arrivals:
            k = r.randint(1, 6)
            call.take([(i, chunk[i]) for _, i in arrivals[:k]])
            assert set(i for (i,) in call.waiting) == {i for a, b in call.runs for i in range(a, b + 1)} and (call.front is None) == (not call.runs)
            out, arrivals, call = out + call.out, arrivals[k:], _again(call)
        fold, got = scalls.Fold(), _latest(out)
        assert sorted(got) == sorted(chunk)
        for i in sorted(chunk):
            fits = fold.add(chunk[i])
            assert got[i][0] == ("running" if fits else "quarantined") and got[i][3] == fold.n and list(map(str, got[i][5:7])) == list(map(str, fold.matrices()[:2]))
            assert not fits or got[i][4] == fold.text
        call.close("final")
        assert call.out[-1][3:5] == (fold.n, fold.text)


def test_a_lost_chunk_costs_one_step_a_chunk_and_one_entry():
    class Counted(_Map):
        reads = 0

        def getValue(self, key):
            Counted.reads += 1
            return self[key]

    call = scalls.CallState("c", Counted())
    for i in range(400):
        if i != 5:
            call.take([(i, _piece(i))])
            assert call.out[-1][:4] == ("running", "c", i, i + (i < 5)) and len(call.out) == 1
            call = _again(call)
    assert Counted.reads == 0 and len(call.waiting) == 394
    call.take([(5, _piece(5))])          # late: it and every later chunk are corrected, once
    assert [r[2] for r in call.out] == list(range(5, 400)) and not call.waiting and all(not r[10] for r in call.out)


def test_rows_after_a_gap_wait_when_asked():
    call = scalls.CallState("c", _Map())
    call.take([(0, _piece(0)), (2, _piece(2))], emit_front=False)
    assert [r[2] for r in call.out] == [0] and call.front is None
    call = _again(call)
    call.show_waiting()
    assert [(r[2], r[10]) for r in call.out] == [(2, True)]
    call.take([(3, _piece(3)), (1, _piece(1))], emit_front=False)
    assert [(r[2], r[10]) for r in call.out[1:]] == [(1, False), (2, False), (3, False)]


def test_timers_show_waiting_rows(spark):
    """With a wait, rows after a gap come with a timer of a later micro-batch."""
    build = lambda s: scalls.call_states(env.decode(s), wait_ms=1)
    rows = [(0, _chunk("w", 0, "a")), (0, _chunk("w", 2, "c")), (1, _chunk("x", 0, "other")), (2, _chunk("x", 1, "other"))]
    out = run_waves(spark, _msgs(spark, rows), build, scalls.OUTPUT_SCHEMA, "t_wait").collect()
    assert sorted((r["chunk_index"], r["text"], r["provisional"]) for r in out if r["call_id"] == "w") == [(0, "a", False), (2, "a c", True)]


def test_started_in_the_middle_and_negative_indexes(spark):
    rows = [(0, _chunk("m", 57, "late start")), (0, _chunk("m", -1, "no such index")), (1, _chunk("m", 59, "on")), (2, _chunk("m", 58, "and")), (3, _end("m"))]
    out = _run(spark, rows, "t_middle")
    got = {r["chunk_index"]: r["text"] for r in sorted(out, key=lambda r: r["revision"]) if r["kind"] == "running"}
    assert got == {57: "late start", 58: "late start and", 59: "late start and on"}
    assert [(r["n_segments"], r["text"]) for r in out if r["kind"] == "final"] == [(3, "late start and on")]


def test_means_count_matrices_and_shapes_are_checked(spark):
    def chunk(i, m):
        return f'{{"call_id":"m","chunk_index":{i},"event":"CHUNK","transcript":"t{i}"{m}}}'
    rows = [(0, chunk(0, ',"mfcc":[[2.0,4.0]]')), (0, chunk(1, "")), (0, chunk(2, ',"mfcc":[[1.0],[1.0]]')), (1, chunk(3, ',"mfcc":[[4.0,8.0]]')),
            (1, chunk(4, ',"mfcc":[[1.0,2.0],[3.0]]')), (1, chunk(5, ',"mfcc":[[1.0,null]]')), (2, chunk(6, ',"mfcc":[[0.0,0.0]],"spectrogram":[[5.0]]')), (2, _end("m"))]
    out = _run(spark, rows, "t_shapes")
    got = {r["chunk_index"]: (r["text"], r["mfcc"]) for r in out if r["kind"] == "running"}
    assert got[0] == ("t0", [2.0, 4.0]) and got[1] == ("t0 t1", [2.0, 4.0]) and got[3] == ("t0 t1 t3", [3.0, 6.0])
    assert [(r["chunk_index"], r["reason"]) for r in out if r["kind"] == "quarantined"] == [(2, "changed_shape")]
    final = [r for r in out if r["kind"] == "final"][0]
    assert final["mfcc"] == [2.0, 4.0] and final["spec"] == [5.0] and final["n_segments"] == 4 and 0 < final["mfcc_prob"] <= 1


def test_segments_do_not_depend_on_arrival(spark):
    import json

    from callscore.operators import segments
    from callscore.streaming import segments as ssegs
    flags = [(i // 17) % 2 for i in range(200)]
    want = segments.sessionise(list(range(200)), flags)
    rows = [((i * 7) % 3, json.dumps({"clip_id": 1, "frame_no": i, "is_voiced": bool(f)})) for i, f in enumerate(flags)]
    rows += [(2, rows[k][1]) for k in range(0, 200, 9)]
    out = run_waves(spark, _msgs(spark, rows), ssegs.segment_stream, ssegs.SEGMENT_SCHEMA, "t_seg").collect()
    assert sorted((r["seg"], r["f0"], r["frame_no"], r["n"]) for r in out) == [(k, *s) for k, s in enumerate(want)]


def _frames(*numbers):
    return np.array(numbers, np.int64)


def test_frames_after_a_gap_was_given_up_are_rows(monkeypatch):
    from callscore.streaming import segments as ssegs
    monkeypatch.setattr(ssegs, "HOLD_FRAMES", 4)
    clip = ssegs._Clip(1)
    for f in (2, 3, 4, 5, 6, 0):
        clip.add(_frames(f), np.zeros(1, bool))
        clip.settle()
    assert clip.next == 7 and clip.skipped == [[1, 1]] and clip.out == [(1, ssegs.LATE, 0, 0, 0)]


def test_a_closed_clip_is_a_tombstone():
    from callscore.streaming import segments as ssegs
    clip = ssegs._Clip(1)
    clip.add(_frames(0, 1, 4), np.ones(3, bool))
    clip.settle()
    clip.close()
    again = ssegs._Clip(1, clip.state())
    again.add(_frames(5, 2, 1, 5), np.ones(4, bool))
    again.settle()
    assert again.closed and again.next == 5 and sorted(r[1:3] for r in again.out) == [(ssegs.LATE, 2), (ssegs.LATE, 5)]


def test_ten_million_frames_in_reverse_stay_small():
    from callscore.operators.segments import VadMachine
    from callscore.streaming import segments as ssegs
    n, step = 10_000_000, 500_000
    flags = np.random.default_rng(1).random(n // 1000) < 0.5
    flags = np.repeat(flags, 1000)
    clip, most = ssegs._Clip(1), 0
    for k in range(n - step, -1, -step):
        clip = ssegs._Clip(1, clip.state())
        clip.add(np.arange(k + step - 1, k - 1, -1), flags[k:k + step][::-1])
        most = max(most, sum(len(x) for x in clip.state() if isinstance(x, bytes)))
        clip.settle()
    assert most < 2_000_000 and not len(clip.held) and clip.next == n
    machine, want = VadMachine(), []
    for k in range(0, n, step):
        want += machine.run(np.arange(k, k + step), flags[k:k + step].astype(np.int64))
    assert [r[2:] for r in clip.out] == want and len(want) > 1000


def test_frames_in_random_batches():
    import random

    from callscore.operators import segments
    from callscore.streaming import segments as ssegs
    for seed in range(60):
        r = random.Random(seed)
        n = r.randint(1, 400)
        flags = [r.random() < (0.8 if (i // 30) % 2 else 0.2) for i in range(n)]
        order = [i for i in range(n)] + [r.randrange(n) for _ in range(n // 5)]
        order.sort(key=lambda i: i + r.randint(0, 60) if seed % 2 else r.random())
        clip = ssegs._Clip(1)
        while order:
            k = r.randint(1, 50)
            clip = ssegs._Clip(1, clip.state()) if r.random() < 0.5 and not clip.out else clip
            clip.add(_frames(*order[:k]), np.array([flags[i] for i in order[:k]]))
            assert (np.diff(clip.held.first) > clip.held.length[:-1]).all() and clip.held.length.sum() == len(clip.held.flags)
            clip.settle()
            order = order[k:]
        assert [x[2:] for x in clip.out] == segments.sessionise(list(range(n)), [int(f) for f in flags])


def test_null_flags_are_unvoiced_in_batch_and_stream(spark):
    import json

    from callscore.operators import segments, signal
    from callscore.streaming import segments as ssegs
    flags = [None if i % 13 == 5 else (i // 17) % 2 == 1 for i in range(200)]
    want = segments.sessionise(list(range(200)), [int(bool(f)) for f in flags])
    frames = spark.createDataFrame([(1, i, f) for i, f in enumerate(flags)], "clip_id long, frame_no long, is_voiced boolean")
    batch = segments.voice_segments(frames, bucket_frames=32).collect()
    assert sorted((r["seg"], r["f0"], r["frame_no"], r["n"]) for r in batch) == [(k, *s) for k, s in enumerate(want)]
    rows = [(i % 2, json.dumps({"clip_id": 1, "frame_no": i} | ({} if f is None else {"is_voiced": f}))) for i, f in enumerate(flags)]
    out = run_waves(spark, _msgs(spark, rows), ssegs.segment_stream, ssegs.SEGMENT_SCHEMA, "t_null_flags").collect()
    assert sorted((r["seg"], r["f0"], r["frame_no"], r["n"]) for r in out) == [(k, *s) for k, s in enumerate(want)]
    rolling = {r["frame_no"]: r["n_voiced"] for r in signal.rolling_voiced(frames).collect()}
    assert rolling == {i: sum(bool(f) for f in flags[max(0, i - 9):i + 1]) for i in range(200)}


def test_any_number_of_waiting_chunks_gives_the_batch_result(spark):
    n = 3000
    chunks = spark.createDataFrame([("a", i, f"t{i}") for i in range(n)], "call_id string, chunk_index int, transcript string")
    want = calls.final_text(chunks).collect()[0]
    # all but the first chunk wait over a restart, and come in falling order
    rows = [(0 if i else 1, _chunk("a", i, f"t{i}")) for i in reversed(range(n))] + [(2, _end("a"))]
    out = _run(spark, rows, "t_many_waiting")
    assert [(r["n_segments"], r["text"]) for r in out if r["kind"] == "final"] == [(n, want["full_text"])]
    assert {r["chunk_index"] for r in out if r["kind"] == "running"} == set(range(n))
    assert {r["kind"] for r in out} == {"running", "final"}


def test_any_number_of_waiting_frames_gives_the_batch_result():
    from callscore.operators import segments
    from callscore.streaming import segments as ssegs
    flags = [(i // 17) % 2 for i in range(70_000)]
    clip = ssegs._Clip(1)
    clip.add(np.arange(1, len(flags)), np.array(flags[1:], bool))
    clip.settle()
    clip = ssegs._Clip(1, clip.state())
    clip.add(_frames(0), np.array(flags[:1], bool))
    clip.settle()
    assert [r[1:] for r in clip.out] == [(k, *s) for k, s in enumerate(segments.sessionise(list(range(len(flags))), flags))]


class _Cell:
    """A value state, a map state and a handle that count what the processor sends them."""

    def __init__(self):
        self.value, self.sent = None, []

    def __getattr__(self, name):
        return lambda *a: self.sent.append(name)

    def get(self):
        self.sent.append("get")
        return self.value

    def update(self, value):
        self.sent.append("update")
        self.value = value


def test_a_call_costs_few_messages_and_no_frames():
    """rows go in and out as rows, and a visit of a call reads and writes its state once."""
    from pyspark.sql import Row
    at = Row("call_id", "kind", "chunk_no", "transcript", "mfcc", "mfcc_cols", "spec", "spec_cols")
    times = type("Times", (), {"getCurrentProcessingTimeInMs": lambda self: 1_000_000})()
    p = scalls.CallProcessor()
    p.handle, p.head, p.front, p.waiting = _Cell(), _Cell(), _Cell(), _Cell()
    out = list(p.handleInputRows(("a",), iter([at("a", "chunk", i, f"t{i}", [1.0, i], 1, None, None) for i in (1, 0)]), times))
    assert [(r.kind, r.chunk_index, r.text) for r in out] == [("running", 0, "t0"), ("running", 1, "t0 t1")]
    assert list(out[1].mfcc) == [1.0, 0.5] and out[1].spec is None
    out = list(p.handleInputRows(("a",), iter([at("a", "end", None, None, None, None, None, None), at("a", "chunk", 2, " t2 ", None, None, None, None)]), times))
    assert [(r.kind, r.chunk_index, r.text) for r in out] == [("running", 2, "t0 t1 t2"), ("final", None, "t0 t1 t2")]
    assert p.head.sent == ["get", "update"] * 2 and p.handle.sent == ["registerTimer"] and not p.front.sent and not p.waiting.sent


def test_a_call_with_a_gap_is_read_and_written_as_one_entry():
    """Besides its waiting chunks: one message each way a micro-batch, the front with it."""
    from pyspark.sql import Row

    class Value:
        kept, messages = None, 0

        def get(self):
            Value.messages += 1
            return self.kept

        def update(self, new):
            Value.messages += 1
            self.kept = new

    class Handle:
        getValueState = staticmethod(lambda name, schema: Value())
        getMapState = staticmethod(lambda name, keys, values: _Map())
        registerTimer = deleteTimer = staticmethod(lambda at: None)

    class Timers:
        getCurrentProcessingTimeInMs = staticmethod(lambda: 1000)

    def batch(i):
        row = Row(kind="chunk", chunk_no=i, transcript=str(i), mfcc=[1.0 * i, 2.0], mfcc_cols=2, spec=None, spec_cols=None)
        return list(processor.handleInputRows(("c",), iter([row]), Timers))

    processor = scalls.CallProcessor()
    processor.init(Handle)
    assert [(r.chunk_index, r.text, r.provisional) for r in batch(2)] == [(2, "2", True)]
    assert [(r.chunk_index, r.text, r.provisional) for r in batch(3)] == [(3, "2 3", True)]
    assert Value.messages == 4 and set(processor.waiting) == {(2,), (3,)}
    assert [(r.chunk_index, r.text, r.provisional) for r in batch(1)] == [(1, "1", True), (2, "1 2", True), (3, "1 2 3", True)]
    last = batch(0)
    assert [(r.chunk_index, r.text, r.provisional) for r in last] == [(0, "0", False), (1, "0 1", False), (2, "0 1 2", False), (3, "0 1 2 3", False)]
    assert list(last[-1].mfcc) == [1.5, 2.0] and Value.messages == 8 and not processor.waiting
