"""Registered array / matrix queries on the ``matrices`` view and their DuckDB twins.

Results are returned as long cell tables (key, i, j, v) so both engines
compare scalars only.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays as A
from ..operators import matrices as MX
from . import fixtures as fx

R = 6


def cells(df, keys, m):
    """(keys..., i, j, v) for a matrix column, v rounded."""
    x = df.select(*keys, F.posexplode(m).alias("i", "_row"))
    x = x.select(*keys, "i", F.posexplode("_row").alias("j", "v"))
    return x.select(*keys, F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"),
                    F.round("v", R).alias("v"))


def cells1d(df, keys, y):
    x = df.select(*keys, F.posexplode(y).alias("k", "v"))
    return x.select(*keys, F.col("k").cast("long").alias("k"), F.round("v", R).alias("v"))


def _m(spark, sf_dir):
    return fx.matrices(spark, sf_dir)


def q_peak_norm(spark, sf_dir):
    return cells1d(_m(spark, sf_dir).select("vec_id", A.peak_normalize(F.flatten("m")).alias("y")), ["vec_id"], "y")


def q_minmax_norm(spark, sf_dir):
    return cells(_m(spark, sf_dir).select("vec_id", A.minmax_normalize("m").alias("r")), ["vec_id"], "r")


def q_db_window(spark, sf_dir):
    return cells(_m(spark, sf_dir).select("vec_id", A.db_window(A.map_cells("m", lambda x: x * 40.0 - 40.0))
                                          .alias("r")), ["vec_id"], "r")


def q_power_db(spark, sf_dir):
    return cells(_m(spark, sf_dir).select("vec_id", A.power_to_db(A.map_cells("m", lambda x: x * x)).alias("r")),
                 ["vec_id"], "r")


def q_pad_cut(spark, sf_dir):
    m = _m(spark, sf_dir)
    pad = cells(m.select("vec_id", A.pad_or_cut_rows("m", 12).alias("r")), ["vec_id"], "r")
    cut = cells(m.select("vec_id", A.pad_or_cut_rows("m", 5).alias("r")), ["vec_id"], "r")
    return pad.withColumn("variant", F.lit("pad12")).unionByName(cut.withColumn("variant", F.lit("cut5")))


def q_transpose(spark, sf_dir):
    return cells(_m(spark, sf_dir).select("vec_id", A.transpose("m").alias("r")), ["vec_id"], "r")


def q_stack_blocks(spark, sf_dir):
    m = _m(spark, sf_dir)
    return cells(m.select("vec_id", A.stack_rows("m", A.transpose("m"), F.slice("m", 1, 3)).alias("r")),
                 ["vec_id"], "r")


def q_resize(spark, sf_dir):
    return cells(_m(spark, sf_dir).select("vec_id", A.resize("m", 5, 12).alias("r")), ["vec_id"], "r")


def q_pcm16(spark, sf_dir):
    y = A.pcm16_roundtrip(A.peak_normalize(F.flatten("m")))
    return cells1d(_m(spark, sf_dir).select("vec_id", y.alias("y")), ["vec_id"], "y")


def q_softmax(spark, sf_dir):
    return cells(_m(spark, sf_dir).select("vec_id", A.softmax_rows("m").alias("r")), ["vec_id"], "r")


def q_soft_pool(spark, sf_dir):
    m = _m(spark, sf_dir)
    scores = F.transform("m", lambda row: F.aggregate(row, F.lit(0.0), lambda a, x: a + x) / F.size(row))
    return cells1d(m.select("vec_id", A.attention_pool("m", scores).alias("y")), ["vec_id"], "y")


def q_band_mask(spark, sf_dir):
    return cells(_m(spark, sf_dir).select("vec_id", A.band_mask("m", F.col("vec_id"), freq_max=3, time_max=4)
                                          .alias("r")), ["vec_id"], "r")


def q_array_misc(spark, sf_dir):
    m = _m(spark, sf_dir)
    oh = A.one_hot("label", 10)
    return m.select(
        "vec_id",
        A.n_rows("m").cast("long").alias("n_rows"), A.n_cols("m").cast("long").alias("n_cols"),
        F.size(A.repeat_channels("m")).cast("long").alias("n_channels"),
        F.array_join(F.transform(oh, lambda x: x.cast("string")), "").alias("one_hot"),
        A.argmax(F.element_at("m", 1)).cast("long").alias("argmax_row0"),
        F.round(F.aggregate(F.flatten(A.zero_fallback("m", 65, 2, 2)), F.lit(0.0), lambda a, x: a + x), R)
        .alias("fallback_sum"),
        F.size(F.flatten(A.zero_fallback("m", 65, 2, 2))).cast("long").alias("fallback_cells"))


def q_matrix_json(spark, sf_dir):
    m = _m(spark, sf_dir).select("vec_id", A.parse_matrix(A.matrix_json("m")).alias("r"))
    return cells(m, ["vec_id"], "r")


def q_elementwise_mean(spark, sf_dir):
    return MX.elementwise_mean(_m(spark, sf_dir), ["label"], "m").select(
        "label", F.col("i").cast("long"), F.col("j").cast("long"), F.round("v", R).alias("v"))


def q_running_elementwise_mean(spark, sf_dir):
    return MX.running_elementwise_mean(_m(spark, sf_dir), ["label"], "vec_id", "m").select(
        "vec_id", "label", F.col("i").cast("long"), F.col("j").cast("long"), F.round("v", R).alias("v"))


QUERIES = {
    "peak_norm": q_peak_norm,
    "minmax_norm": q_minmax_norm,
    "db_window": q_db_window,
    "power_db": q_power_db,
    "pad_cut": q_pad_cut,
    "transpose": q_transpose,
    "stack_blocks": q_stack_blocks,
    "resize": q_resize,
    "pcm16": q_pcm16,
    "softmax": q_softmax,
    "soft_pool": q_soft_pool,
    "band_mask": q_band_mask,
    "array_misc": q_array_misc,
    "matrix_json": q_matrix_json,
    "elementwise_mean": q_elementwise_mean,
    "running_elementwise_mean": q_running_elementwise_mean,
}

# ------------------------------------------------------------------ twins
# "+ 0.0" turns a rounded -0.0 into 0.0, as Spark's decimal rounding does
_CELLS = ("select vec_id, i, j, round(r[i + 1][j + 1], 6) + 0.0 as v from (select vec_id, r, i, unnest(range(len(r[i + 1]))) "
          "as j from (select vec_id, r, unnest(range(len(r))) as i from {src}) a) b")
_CELLS1 = "select vec_id, k, round(y[k + 1], 6) + 0.0 as v from (select vec_id, y, unnest(range(len(y))) as k from {src}) a"


def _cells(src):
    return _CELLS.format(src=src)


def _map(m, body):
    """list_transform over cells; ``body`` uses ``x``."""
    return f"list_transform({m}, lambda row: list_transform(row, lambda x: {body}))"


def _transpose(m):
    return f"list_transform(range(1, len({m}[1]) + 1), lambda jj: list_transform({m}, lambda rr: rr[jj]))"


def _resize_rows(m, out):
    n = f"len({m})"
    src = f"greatest((cast(ii as double) + 0.5) * {n} / {float(out)} - 0.5, 0.0)"
    i0 = f"cast(floor({src}) as bigint)"
    i1 = f"least({i0} + 1, {n} - 1)"
    lam = f"({src} - {i0})"
    return (f"list_transform(range({out}), lambda ii: list_transform(range(len({m}[1])), lambda cc: "
            f"{m}[{i0} + 1][cc + 1] * (1.0 - {lam}) + {m}[{i1} + 1][cc + 1] * {lam}))")


def _softmax_row(v):
    return (f"list_transform({v}, lambda x: exp(x - list_max({v})) / list_reduce(list_transform({v}, "
            f"lambda z: exp(z - list_max({v}))), lambda a, b: a + b))")


_PEAK = ("pk", """select vec_id, case when len(f) = 0 or not (peak > 0) then f
  else list_transform(f, lambda x: x * least(0.98 / peak, 10.0)) end as y
  from (select vec_id, f, list_max(list_transform(f, lambda x: abs(x))) as peak
  from (select vec_id, flatten(m) as f from matrices) a) b""")


def _hx(key, k):
    return f"cast('0x' || substr(md5({key} || ':' || '{k}'), 1, 8) as bigint)"


def _ri(key, k, lo, hi):
    return f"(({lo}) + {_hx(key, k)} % (({hi}) - ({lo}) + 1))"


_KEY = "(cast(vec_id as varchar) || ':42')"
_MASK = ("mk", f"""select vec_id, m,
  {_hx(_KEY, 0)} % 2 = 0 as do_f, {_ri(_KEY, 1, 1, 2)} as nf,
  {_ri(_KEY, 2, 0, 'least(3, len(m))')} as f1, {_ri(_KEY, 4, 0, 'least(3, len(m))')} as f2,
  {_hx(_KEY, 6)} % 2 = 0 as do_t, {_ri(_KEY, 7, 0, 'least(4, len(m[1]))')} as t from matrices""")
_MASK2 = ("mk2", f"""select *, {_ri(_KEY, 3, 0, 'len(m) - f1')} as f10, {_ri(_KEY, 5, 0, 'len(m) - f2')} as f20,
  {_ri(_KEY, 8, 0, 'len(m[1]) - t')} as t0 from mk""")

ORACLE = {
    "peak_norm": fx.oracle(["matrices"], _CELLS1.format(src="pk"), _PEAK),
    "minmax_norm": fx.oracle(["matrices"], _cells("mm"), ("mm", f"""select vec_id,
  {_map('m', '(x - lo) / (hi - lo + 1e-6)')} as r from (select vec_id, m, list_min(flatten(m)) as lo,
  list_max(flatten(m)) as hi from matrices) a""")),
    "db_window": fx.oracle(["matrices"], _cells("dw"), ("dw", f"""select vec_id,
  {_map(_map('m', 'x * 40.0 - 40.0'), 'greatest(0.0, least(1.0, (x - -80.0) / 80.0))')} as r from matrices""")),
    "power_db": fx.oracle(["matrices"], _cells("p3"),
                          ("p1", f"select vec_id, {_map('m', 'x * x')} as pw from matrices"),
                          ("p2", f"""select vec_id, {_map('pw', 'cast(10 as double) * log10(greatest(x, 1e-10)) - ref')} as db
  from (select *, cast(10 as double) * log10(greatest(list_max(flatten(pw)), 1e-10)) as ref from p1) a"""),
                          ("p3", f"select vec_id, {_map('db', 'greatest(x, top - 80.0)')} as r from "
                                 "(select *, list_max(flatten(db)) as top from p2) a")),
    "pad_cut": fx.oracle(["matrices"], f"""select *, 'pad12' as variant from ({_cells('pd')}) x
  union all select *, 'cut5' from ({_cells('ct')}) y""",
                         ("pd", "select vec_id, list_resize(m, 12, list_transform(range(len(m[1])), lambda z: 0.0)) "
                                "as r from matrices"),
                         ("ct", "select vec_id, m[1:5] as r from matrices")),
    "transpose": fx.oracle(["matrices"], _cells("tp"), ("tp", f"select vec_id, {_transpose('m')} as r from matrices")),
    "stack_blocks": fx.oracle(["matrices"], _cells("sb"),
                              ("sb", f"select vec_id, list_concat(list_concat(m, {_transpose('m')}), m[1:3]) as r "
                                     "from matrices")),
    "resize": fx.oracle(["matrices"], _cells("rz4"),
                        ("rz1", f"select vec_id, {_resize_rows('m', 5)} as a from matrices"),
                        ("rz2", f"select vec_id, {_transpose('a')} as b from rz1"),
                        ("rz3", f"select vec_id, {_resize_rows('b', 12)} as c from rz2"),
                        ("rz4", f"select vec_id, {_transpose('c')} as r from rz3")),
    "pcm16": fx.oracle(["matrices"], _CELLS1.format(src="pc"), _PEAK,
                       ("pc", "select vec_id, list_transform(y, lambda x: cast(trunc(x * 32767) as smallint) / 32767.0)"
                              " as y from pk")),
    "softmax": fx.oracle(["matrices"], _cells("sx"),
                         ("sx", f"select vec_id, list_transform(m, lambda rw: {_softmax_row('rw')}) as r from matrices")),
    "soft_pool": fx.oracle(["matrices"], _CELLS1.format(src="sp2"),
                           ("sp1", f"""select vec_id, m, {_softmax_row('e')} as a from (select vec_id, m,
  list_transform(m, lambda rw: list_reduce(rw, lambda p, q: p + q) / len(rw)) as e from matrices) z"""),
                           ("sp2", """select vec_id, list_transform(range(len(m[1])), lambda jj: list_reduce(
  list_transform(range(len(m)), lambda tt: a[tt + 1] * m[tt + 1][jj + 1]), lambda p, q: p + q)) as y from sp1""")),
    "band_mask": fx.oracle(["matrices"], _cells("mk3"), _MASK, _MASK2,
                           ("mk3", """select vec_id, list_transform(m, lambda rw, ii: list_transform(rw, lambda x, jj:
  case when (do_f and ii - 1 >= f10 and ii - 1 < f10 + f1) or (do_f and nf = 2 and ii - 1 >= f20 and ii - 1 < f20 + f2)
  or (do_t and jj - 1 >= t0 and jj - 1 < t0 + t) then 0.0 else x end)) as r from mk2""")),
    "array_misc": fx.oracle(["matrices"], """select vec_id, cast(len(m) as bigint) as n_rows,
  cast(len(m[1]) as bigint) as n_cols, cast(3 as bigint) as n_channels,
  array_to_string(list_transform(range(10), lambda i: case when i = label then '1' else '0' end), '') as one_hot,
  cast(list_position(m[1], list_max(m[1])) - 1 as bigint) as argmax_row0,
  round(case when len(flatten(m)) < 65 then 0.0 else list_reduce(flatten(m), lambda a, b: a + b) end, 6)
    as fallback_sum,
  cast(case when len(flatten(m)) < 65 then 4 else len(flatten(m)) end as bigint) as fallback_cells
  from matrices"""),
    "matrix_json": fx.oracle(["matrices"], _cells("mj"), ("mj", "select vec_id, m as r from matrices")),
    "elementwise_mean": fx.oracle(["matrices"], """select label, i, j, round(avg(v), 6) as v from (
  select label, i, j, r[i + 1][j + 1] as v from (select label, r, i, unnest(range(len(r[i + 1]))) as j from
  (select label, m as r, unnest(range(len(m))) as i from matrices) a) b) c group by label, i, j"""),
    "running_elementwise_mean": fx.oracle(["matrices"], """select vec_id, label, i, j,
  round(avg(v) over (partition by label, i, j order by vec_id rows between unbounded preceding and current row), 6) as v
  from (select vec_id, label, i, j, r[i + 1][j + 1] as v from (select vec_id, label, r, i, unnest(range(len(r[i + 1])))
  as j from (select vec_id, label, m as r, unnest(range(len(m))) as i from matrices) a) b) c"""),
}
