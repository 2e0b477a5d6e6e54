"""Registered per-call queries and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scoring import failing_scorer, stand_in_scorer
from ..operators import calls
from . import fixtures as fx
from .sqltext import modal_scores, scores, strip_or_empty


def q_call_final(spark, sf_dir):
    return calls.call_final(fx.chunk_matrices(spark, sf_dir))


def q_call_running(spark, sf_dir):
    return calls.call_running(fx.chunk_matrices(spark, sf_dir))


def q_call_unscored(spark, sf_dir):
    """A scorer that fails for some texts; these calls are Unscored."""
    scorer = failing_scorer(stand_in_scorer, lambda text: F.length(text) % 7 == 0, "timeout")
    return calls.call_final(fx.chunk_matrices(spark, sf_dir), scorer).drop("full_text")


def q_call_display_lines(spark, sf_dir):
    return calls.display_lines(calls.call_running(fx.chunk_matrices(spark, sf_dir)))


def q_event_dispatch(spark, sf_dir):
    ev = fx.call_events(spark, sf_dir)
    return ev.select("event_id", "call_id", calls.event_kind().alias("kind"))


def q_chunk_numbering(spark, sf_dir):
    ch = calls.number_chunks(fx.call_events(spark, sf_dir))
    return ch.select("call_id", "event_id", "chunk_index", "transcript")


def q_orphan_ends(spark, sf_dir):
    return calls.orphan_ends(fx.call_events(spark, sf_dir)).select("call_id", "event_id")


def q_ended_calls(spark, sf_dir):
    return calls.ended_calls(fx.call_events(spark, sf_dir)) \
        .select("call_id", "event_id", "n_segments", "full_text", "bert_prob", "mfcc_prob", "spec_prob",
                "final_prob", "status")


QUERIES = {
    "call_final": q_call_final,
    "call_running": q_call_running,
    "call_unscored": q_call_unscored,
    "call_display_lines": q_call_display_lines,
    "event_dispatch": q_event_dispatch,
    "chunk_numbering": q_chunk_numbering,
    "orphan_ends": q_orphan_ends,
    "ended_calls": q_ended_calls,
}

_PIECES = ("p", f"select call_id, chunk_index, {strip_or_empty('transcript')} as piece from chunks")
_FINAL = ("f", """select call_id, count(*) as n_segments,
  substring(string_agg(piece, ' ' order by chunk_index), 1, 2048) as full_text from p group by call_id""")
_RUN = ("r", """select call_id, chunk_index,
  row_number() over (partition by call_id order by chunk_index) as n_segments,
  substring(array_to_string(list(piece) over (partition by call_id order by chunk_index
    rows between unbounded preceding and current row), ' '), 1, 512) as running_text from p""")
_NUMBERED = ("n", f"""select call_id, event_id, (row_number() over (partition by call_id order by ts, event_id) - 1)
  as chunk_index, transcript from call_events
  where event <> 'CALL_END' and length({strip_or_empty('transcript')}) > 0""")

_LINE = ("'[' || cast(call_id as varchar) || ':' || cast(chunk_index as varchar) || '] Transcript: ' || "
         "substring(running_text, 1, 80) || case when length(running_text) > 80 then '...' else '' end || "
         "chr(10) || status || ' | Prob=' || printf('%.3f', final_prob) || ' (' || printf('%.3f', bert_prob) || "
         "',' || printf('%.3f', mfcc_prob) || ',' || printf('%.3f', spec_prob) || ')'")

_CM = ["chunks", "cell_means", "chunk_matrices"]
# all matrices have the same shape, so the mean cell of a mean matrix is the mean of the mean cells
_MEANS = ("fm", "select f.*, fm, fs from f join (select call_id, avg(mfcc_m) as fm, avg(spec_m) as fs from chunk_matrices group by call_id) using (call_id)")
_RUN_MEANS = ("rm", """select r.*, fm, fs from r join (select call_id, chunk_index, avg(mfcc_m) over w as fm, avg(spec_m) over w as fs
  from chunk_matrices window w as (partition by call_id order by chunk_index)) using (call_id, chunk_index)""")

ORACLE = {
    "call_final": fx.oracle(_CM, f"select call_id, n_segments, full_text, {modal_scores('full_text', 'fm', 'fs')} from fm",
                            _PIECES, _FINAL, _MEANS),
    "call_running": fx.oracle(_CM, f"select call_id, chunk_index, n_segments, running_text, "
                              f"{modal_scores('running_text', 'fm', 'fs')} from rm", _PIECES, _RUN, _RUN_MEANS),
    "call_unscored": fx.oracle(_CM, f"select call_id, n_segments, {modal_scores('full_text', 'fm', 'fs', 'length(full_text) % 7 = 0')} from fm",
                               _PIECES, _FINAL, _MEANS),
    "call_display_lines": fx.oracle(_CM, f"select call_id, chunk_index, {_LINE} as line from s", _PIECES,
                                    _RUN, _RUN_MEANS, ("s", f"select *, {modal_scores('running_text', 'fm', 'fs')} from rm")),
    "event_dispatch": fx.oracle(["call_events"], """select event_id, call_id,
  case when event is not distinct from 'CALL_END' then 'end' else 'chunk' end as kind from call_events"""),
    "chunk_numbering": fx.oracle(["call_events"], "select * from n", _NUMBERED),
    "orphan_ends": fx.oracle(["call_events"], """select e.call_id, e.event_id from call_events e
  where e.event = 'CALL_END' and not exists (select 1 from n where n.call_id = e.call_id)""", _NUMBERED),
    "ended_calls": fx.oracle(["call_events"], f"""select e.call_id, e.event_id, f.n_segments, f.full_text,
  {scores('f.full_text')} from call_events e join f on e.call_id = f.call_id where e.event = 'CALL_END'""",
                             _NUMBERED, ("p", f"select call_id, chunk_index, {strip_or_empty('transcript')} as piece from n"),
                             _FINAL),
}
