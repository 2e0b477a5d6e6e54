"""Registered voice-segment query and its recursive DuckDB twin."""

from __future__ import annotations

from ..operators import segments
from . import fixtures as fx


def q_voice_segments(spark, sf_dir):
    return segments.voice_segments(fx.frames(spark, sf_dir))


QUERIES = {
    "voice_segments": q_voice_segments,
}

# Recursive twin: one row per frame carrying (ring, open, f0, n, seg); emits closed segments.
_REC = """with recursive st as (
 select clip_id, frame_no, case when is_voiced then 1 else 0 end v from frames),
 r as (
 select clip_id, frame_no, [v] ring, false trig, null::int f0, 0 n, -1 seg, false closed from st where frame_no=0
 union all
 select clip_id, frame_no,
   case when not ptrig and list_sum(nr)>6 then []::int[] else nr end ring,
   case when not ptrig then list_sum(nr)>6 else not (len(nr)-list_sum(nr)>6) end trig,
   case when not ptrig then case when list_sum(nr)>6 then frame_no-len(nr)+1 end else pf0 end f0,
   case when not ptrig then case when list_sum(nr)>6 then len(nr) else 0 end else pn+1 end n,
   case when ptrig and len(nr)-list_sum(nr)>6 then pseg+1 else pseg end seg,
   (ptrig and len(nr)-list_sum(nr)>6) closed
 from (select s.clip_id, s.frame_no, list_append(case when len(r.ring)=10 then r.ring[2:10] else r.ring end, s.v) nr,
       r.trig ptrig, r.f0 pf0, r.n pn, r.seg pseg
       from r join st s on s.clip_id=r.clip_id and s.frame_no=r.frame_no+1) z)
select cast(clip_id as bigint) as clip_id, cast(seg as bigint) as seg, cast(f0 as bigint) as f0,
  cast(frame_no as bigint) as frame_no, cast(n as bigint) as n from r where closed"""

ORACLE = {
    "voice_segments": _REC.replace("with recursive st as (", "with recursive frames as (\n" + fx.SQL["frames"] + "\n),\n st as (", 1),
}
