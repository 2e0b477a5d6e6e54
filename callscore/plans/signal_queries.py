"""Registered framed-signal queries and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import signal
from ..operators.prefix import running_totals, time_bucket
from . import fixtures as fx

R = 6


def _frames(spark, sf_dir):
    return fx.frames(spark, sf_dir)


def day_series(spark, sf_dir):
    """Per clip and day: position ``t`` (0-based) of each frame in its day series."""
    e = fx.table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "value")
    e = e.withColumn("day", F.date_format(F.to_date("ts"), "yyyy-MM-dd"))
    e = running_totals(e, ["user_id", "day"], ["ts", "event_id"], time_bucket("ts"), rank="t")
    return e.select(F.col("user_id").alias("clip_id"), "day", "event_id", "t",
                    F.col("value").alias("x"))


def q_rolling_voiced(spark, sf_dir):
    return signal.rolling_voiced(_frames(spark, sf_dir)).select("clip_id", "frame_no", "n_voiced")


def q_delta(spark, sf_dir):
    d = signal.delta(_frames(spark, sf_dir), ["clip_id"], "frame_no", "x", order=1)
    return d.select("clip_id", "frame_no", F.round("delta", R).alias("delta"))


def q_delta2(spark, sf_dir):
    d = signal.delta(_frames(spark, sf_dir), ["clip_id"], "frame_no", "x", order=2, out="delta2")
    return d.select("clip_id", "frame_no", F.round("delta2", R).alias("delta2"))


def q_delta_adaptive(spark, sf_dir):
    d = signal.delta_adaptive(day_series(spark, sf_dir), ["clip_id", "day"], "t", "x")
    return d.select("clip_id", "day", "t", F.col("width").cast("int"), F.round("delta", R).alias("delta"))


def q_silence_trim(spark, sf_dir):
    return signal.silence_trim(_frames(spark, sf_dir)).select("clip_id", "frame_no")


QUERIES = {
    "rolling_voiced": q_rolling_voiced,
    "delta": q_delta,
    "delta2": q_delta2,
    "delta_adaptive": q_delta_adaptive,
    "silence_trim": q_silence_trim,
}


# ------------------------------------------------------------------ twins
def _arr(x: str, halo: int) -> str:
    vals = [f"lag({x}, {-o}) over w" if o < 0 else (x if o == 0 else f"lead({x}, {o}) over w")
            for o in range(-halo, halo + 1)]
    return "list_value(" + ", ".join(vals) + ")"


# weights of the least-squares slope (order 1) and of the second derivative of
# the local quadratic (order 2), as tables of smoothing filters print them
_WEIGHTS = {(3, 1): ([-1, 0, 1], 2), (5, 1): ([-2, -1, 0, 1, 2], 10), (7, 1): ([-3, -2, -1, 0, 1, 2, 3], 28),
            (9, 1): ([-4, -3, -2, -1, 0, 1, 2, 3, 4], 60), (9, 2): ([28, 7, -8, -17, -20, -17, -8, 7, 28], 462)}


def _delta_sql(arr: str, halo: int, t: str, n: str, width: int, order: int) -> str:
    """The weighted sum around the nearest frame that has a full window."""
    half = width // 2
    weights, scale = _WEIGHTS[width, order]
    centre = f"(case when {t} < {half} then {half} when {t} > {n} - {half + 1} then {n} - {half + 1} else {t} end - {t} + {halo + 1})"
    total = " + ".join(f"{w} * {arr}[{centre} + {k - half}]" for k, w in enumerate(weights) if w)
    return f"(case when {n} >= {width} then ({total}) / cast({scale} as double) else 0.0 end)"


_FN = ("fn", "select *, count(*) over (partition by clip_id) as n from frames")
_DA = ("fa", f"select *, {_arr('x', 8)} as arr from fn window w as (partition by clip_id order by frame_no)")
_SD = ("sd", """select user_id as clip_id, strftime(cast(ts as date), '%Y-%m-%d') as day, event_id, value as x,
  row_number() over (partition by user_id, cast(ts as date) order by ts, event_id) - 1 as t,
  count(*) over (partition by user_id, cast(ts as date)) as n from events""")
_SDA = ("sa", f"""select *, least(9, greatest(3, cast(floor(n / 2) as int) * 2 + 1)) as width, {_arr('x', 8)} as arr
  from sd window w as (partition by clip_id, day order by t)""")
_ADAPT = "case " + " ".join(f"when width = {wd} then {_delta_sql('arr', 8, 't', 'n', wd, 1)}"
                            for wd in reversed(signal.WIDTHS)) + " else 0.0 end"

ORACLE = {
    "rolling_voiced": fx.oracle(["frames"], """select clip_id, frame_no,
  cast(sum(case when is_voiced then 1 else 0 end) over (partition by clip_id order by frame_no
  rows between 9 preceding and current row) as bigint) as n_voiced from frames"""),
    "delta": fx.oracle(["frames"], f"select clip_id, frame_no, round({_delta_sql('arr', 8, 'frame_no', 'n', 9, 1)}, 6) + 0.0"
                                   " as delta from fa", _FN, _DA),
    "delta2": fx.oracle(["frames"], f"select clip_id, frame_no, round({_delta_sql('arr', 8, 'frame_no', 'n', 9, 2)}, 6) + 0.0"
                                    " as delta2 from fa", _FN, _DA),
    "delta_adaptive": fx.oracle([], f"select clip_id, day, t, width, round({_ADAPT}, 6) + 0.0 as delta from sa", _SD, _SDA),
    "silence_trim": fx.oracle(["frames"], """select f.clip_id, f.frame_no from frames f join (
  select f.clip_id, min(frame_no) filter (where db > mx - 30.0) as lo, max(frame_no) filter (where db > mx - 30.0) as hi
  from frames f join (select clip_id, max(db) as mx from frames group by clip_id) m on f.clip_id = m.clip_id
  group by f.clip_id) r on f.clip_id = r.clip_id where f.frame_no >= r.lo and f.frame_no <= r.hi"""),
}
