"""DuckDB snippets shared by the oracle texts (same fixed values as the
Spark expressions in ``callscore.functions``)."""

from __future__ import annotations

from ..functions.text import ASCII_WS_RUN, NON_PRINTABLE, WS


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def strip_or_empty(x: str) -> str:
    return strip(f"coalesce({x}, '')")


def clean_text(x: str) -> str:
    t = strip(f"lower(coalesce({x}, ''))")
    t = f"regexp_replace({t}, '{NON_PRINTABLE}', ' ', 'g')"
    t = f"regexp_replace({t}, '{ASCII_WS_RUN}', ' ', 'g')"
    return strip(t)


def text_prob(x: str, min_chars: int = 2) -> str:
    return (f"(case when {x} is null or length({strip(x)}) < {min_chars} then cast(0.5 as double) "
            f"else cast(length({x}) % 101 as double) / cast(100 as double) end)")


def fused(b: str, m: str = "cast(0.5 as double)", s: str = "cast(0.5 as double)",
          w=(0.6, 0.2, 0.2)) -> str:
    return (f"(cast({w[0]} as double) * {b} + cast({w[1]} as double) * {m} + cast({w[2]} as double) * {s})")


def scores(text: str, min_chars: int = 2) -> str:
    """bert/mfcc/spec/final/status select list for the stand-in scorer."""
    tp = text_prob(text, min_chars)
    fin = f"round({fused(tp)}, 4)"
    return (f"round({tp}, 4) as bert_prob, cast(0.5 as double) as mfcc_prob, cast(0.5 as double) as spec_prob, "
            f"{fin} as final_prob, case when {fin} > 0.5 then 'FRAUDULENT' else 'Normal' end as status")


def matrix_prob(mean_cell: str) -> str:
    return f"(1.0 / (1.0 + exp(-10.0 * ({mean_cell}))))"


def modal_scores(text: str, mfcc: str, spec: str, fails: str = "false") -> str:
    """As ``scores`` with the mean cells of two matrices; no scores and
    ``Unscored`` where ``fails``."""
    tp, mp, sp = text_prob(text), matrix_prob(mfcc), matrix_prob(spec)
    fin = f"round({fused(tp, mp, sp)}, 4)"
    one = lambda e, name: f"case when {fails} then null else {e} end as {name}"
    return ", ".join([one(f"round({tp}, 4)", "bert_prob"), one(f"round({mp}, 4)", "mfcc_prob"), one(f"round({sp}, 4)", "spec_prob"), one(fin, "final_prob"),
                      f"case when {fails} then 'Unscored' when {fin} > 0.5 then 'FRAUDULENT' else 'Normal' end as status"])


# ---------------------------------------------------------------- metrics
CLASSES = (0, 1)


def sdiv(a: str, b: str) -> str:
    return f"(case when ({b}) <> 0 then ({a}) / ({b}) else 0.0 end)"


def cells(src: str, y: str, pred: str, group: list[str]) -> str:
    g = ", ".join(group)
    cc = ", ".join(f"count(*) filter (where {y} = {a} and ({pred}) = {b}) as c_{a}_{b}"
                   for a in CLASSES for b in CLASSES)
    return f"select {g + ', ' if g else ''}{cc} from {src}" + (f" group by {g}" if g else "")


def _sum(xs) -> str:
    return "(" + " + ".join(xs) + ")"


def summary(src: str, group: list[str]) -> str:
    """accuracy, f1_weighted, f1_macro, precision/recall/f1 of class 1 from a cells CTE."""
    n = _sum([f"c_{a}_{b}" for a in CLASSES for b in CLASSES])
    correct = _sum([f"c_{c}_{c}" for c in CLASSES])
    f1 = {}
    sup, prd = {}, {}
    for c in CLASSES:
        sup[c] = _sum([f"c_{c}_{b}" for b in CLASSES])
        prd[c] = _sum([f"c_{a}_{c}" for a in CLASSES])
        f1[c] = sdiv(f"2 * c_{c}_{c}", f"{sup[c]} + {prd[c]}")
    wsum = "0.0" + "".join(f" + {sup[c]} * {f1[c]}" for c in CLASSES)
    macro = "(0.0" + "".join(f" + {f1[c]}" for c in CLASSES) + f") / {float(len(CLASSES))}"
    g = ", ".join(group)
    return (f"select {g + ', ' if g else ''}cast({n} as bigint) as n, {sdiv(correct, n)} as accuracy, "
            f"{sdiv('(' + wsum + ')', n)} as f1_weighted, {macro} as f1_macro, "
            f"{sdiv('c_1_1', prd[1])} as precision, {sdiv('c_1_1', sup[1])} as recall, {f1[1]} as f1 from {src}")


def auc_ctes(src: str, y: str, p: str, group: list[str], prefix: str = "a") -> list[tuple[str, str]]:
    g = ", ".join(group)
    gp = g + ", " if g else ""
    part = f"partition by {g} " if g else ""
    return [
        (f"{prefix}_d", f"select {gp}{p} as s, sum({y}) as pos, sum(1 - {y}) as neg from {src} group by {gp}{p}"),
        (f"{prefix}_r", f"""select *, coalesce(sum(neg) over ({part}order by s rows between unbounded preceding
  and 1 preceding), 0) as nb from {prefix}_d"""),
        (f"{prefix}_u", f"""select {gp}case when sum(pos) > 0 and sum(neg) > 0 then
  sum(cast(pos as double) * (nb + neg * 0.5)) / (cast(sum(pos) as double) * cast(sum(neg) as double)) end as auc
  from {prefix}_r""" + (f" group by {g}" if g else "")),
    ]


def md5key(id_col: str, seed: int = 42) -> str:
    return f"md5(cast({id_col} as varchar) || ':{seed}')"


def folds(src: str, y: str = "label_num", id_col: str = "clip_id", k: int = 5) -> str:
    return (f"select *, cast((row_number() over (order by {y}, {md5key(id_col)}, {id_col}) - 1) % {k} as int) as fold "
            f"from {src}")


def split(src: str, y: str = "label_num", id_col: str = "clip_id") -> str:
    return f"""select * exclude (r, n), case when r < floor((floor((n + 3) / 4) * 2 + 4) / 5) then 'test'
  when r < floor((n + 3) / 4) then 'val' else 'train' end as split
  from (select *, row_number() over (partition by {y} order by {md5key(id_col)}, {id_col}) - 1 as r,
  count(*) over (partition by {y}) as n from {src}) x"""
