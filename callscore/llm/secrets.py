r"""Secret scan: fixed patterns, and sliding-window entropy over candidate strings.

DataFrame functions only, a map over rows without any shuffle. Spans count in
code points, the end is exclusive.

* ``assign``: a keyword, ``=`` or ``:``, and a value of 6 or more characters;
* ``access``: an access key id of 20 or more characters;
* ``hex``: a run of 24 or more hexadecimal digits;
* ``entropy``: a run of key-like characters in which some window of
  ``WINDOW`` characters has a Shannon entropy at or above the threshold of the
  run's character class. The window moves one character at a time; the sum of
  c * log2(c) over its character counts is updated from the counts of the
  character that leaves and the one that enters. Of a run that touches spans
  of other kinds, every part outside of them that is long enough is a run of
  its own. Runs on the allow-list give no span.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callscore.functions.arrays import let

from .common import ref, temp_names, without

# ---- fixed values ----
ASSIGN = (r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"""
          r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"      # runs are maximal, so this equals AKIA[A-Z0-9]+ of 20 or more
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

#: candidate runs of the entropy scan; at least one window long
WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/=_-]{20,}"
#: characters of the pieces of a long run, two levels
BLOCKS = (65_536, 256)
#: classes in the order they are tried: pattern of the whole run, least entropy in bits a character
#: (a window of 20 characters has at most 4.32; the tables' prose letters have at most 3.72). None: never a secret.
#: The README has the recall on random keys.
CLASSES = (
    ("digits", r"^[0-9=_+/-]+$", None),
    ("hex", r"^[0-9a-fA-F]+$", 3.0),
    ("letters", r"^[A-Za-z]+$", 3.75),
    ("alnum", r"^[A-Za-z0-9]+$", 3.65),
    ("base64", r"^[A-Za-z0-9+/=_-]+$", 3.85),
)
#: a path segment that looks like a word: up to three capitalised parts and a short number, or capitals, or a number
_SEGMENT = r"(?:[A-Z]?[a-z]{1,14}(?:[A-Z][a-z]{1,14}){0,2}[0-9]{0,4}|[A-Z]{1,14}|[0-9]{0,8})"
#: runs that match one of these are no secrets; each is about the whole run, since a key may stand beside any word
ALLOW = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",      # identifiers with hyphens
    r"(?i)^(?:example|sample|dummy|placeholder|changeme|your|my|test|api|access|key|secret|token|password|x|0123456789|01234567|1234567890|12345678"
    r"|abcdefghijklmnopqrstuvwxyz|abcdefgh|qwertyuiop|qwertyui|[/_=+-]){1,80}$",            # documentation, keyboard and alphabet runs
    r"^wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY$",                                         # the key of public documentation
    rf"^{_SEGMENT}(?:[/_=+-]{_SEGMENT}){{1,30}}(?:[/_=+-][A-Za-z0-9]{{0,8}})?$",            # paths and joined words
)
_SCALE = 1_000_000
#: c * log2(c) for c = 0 .. WINDOW in millionths, so that incremental sums are exact
_CLOG = [round(c * math.log2(c) * _SCALE) if c else 0 for c in range(WINDOW + 1)]


def _running(values: Column, combine, none: Column) -> Column:
    """Inclusive running values of an array in log2(n) passes."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(values) + 1)).cast("int"))

    def step(acc, k):
        # each pass adds what lies 2^k places before
        gap = F.call_function("shiftleft", F.lit(1), k)
        return F.transform(acc, lambda x, i: combine(x, F.when(i >= gap, F.get(acc, i - gap)).otherwise(none)))

    return F.aggregate(steps, values, step)


def _running_sums(values: Column) -> Column:
    return _running(values, lambda a, b: a + b, F.lit(0))


def _outside(runs: Column, spans: Column, base: Column) -> Column:
    """array<struct<span, run>>: the parts of the runs (with their ``spans``)
    outside the spans ``base`` that are at least a window long. All borders are
    sorted and counted in one sweep: between two borders the text is inside a
    run or not, and inside so many spans."""
    border = lambda at, run, span, begun: F.struct(at.alias("at"), F.lit(run).alias("run"), F.lit(span).alias("base"), F.lit(begun).alias("begun"))
    borders = F.array_sort(F.concat(
        F.transform(spans, lambda s: border(s["start"], 1, 0, 1)), F.transform(spans, lambda s: border(s["end"], -1, 0, 0)),
        F.transform(base, lambda s: border(s["start"], 0, 1, 0)), F.transform(base, lambda s: border(s["end"], 0, -1, 0))))
    add = lambda a, b: F.struct(a["at"].alias("at"), *[(a[f] + b[f]).alias(f) for f in ("run", "base", "begun")])

    def parts(b):
        counted = _running(b, add, border(F.lit(0), 0, 0, 0))
        # the last border ends a run or a span, so nothing is inside a run after it
        found = F.transform(counted, lambda c, i: F.struct(c["at"].alias("start"), F.get(b, i + 1)["at"].alias("end"), c["run"].alias("run"), c["base"].alias("base"), (c["begun"] - 1).alias("k")))
        return F.filter(found, lambda f: (f["run"] == 1) & (f["base"] == 0) & (f["end"] - f["start"] >= WINDOW))

    def texts(own, at, found):
        return F.transform(found, lambda f: F.struct(
            F.struct(f["start"].alias("start"), F.get(at, f["k"])["kind"].alias("kind"), f["end"].alias("end")).alias("span"),
            F.substring(F.get(own, f["k"]), f["start"] - F.get(at, f["k"])["start"] + 1, f["end"] - f["start"]).alias("run")))

    empty = F.array().cast("array<struct<span:struct<start:int,kind:int,end:int>,run:string>>")
    # bound once: an expression inside a lambda would be computed for every element
    cut = let(runs, lambda own: let(spans, lambda at: let(borders, lambda b: let(parts(b), lambda found: texts(own, at, found)))))
    return F.when(F.size(runs) == 0, empty).otherwise(cut)


def _spans(text: Column, found: Column, pattern: str, kind: int) -> Column:
    """array<struct<start, kind, end>> of the matches ``found`` of ``pattern``:
    the pieces between matches tell where each begins."""
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    lengths = F.zip_with(gaps, found, lambda g, m: F.length(g) + F.length(m))
    spans = F.zip_with(_running_sums(lengths), found, lambda e, m: F.struct(
        (e - F.length(m)).alias("start"), F.lit(kind).alias("kind"), e.alias("end")))
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return F.when(F.size(found) == 0, empty).otherwise(spans)


def _blocks(run: Column, size: int) -> Column:
    """Overlapping pieces of a run; each window of it lies in one whole."""
    starts = F.sequence(F.lit(0), F.greatest(F.length(run) - WINDOW, F.lit(0)), F.lit(size))
    return F.transform(starts, lambda k: F.substring(run, k + 1, F.lit(size + WINDOW - 1)))


def largest_entropy(run: Column) -> Column:
    """``window_entropy`` of a run of any length, piece by piece: to find a
    character costs its place in the string."""
    pieces = F.flatten(F.transform(_blocks(run, BLOCKS[0]), lambda b: _blocks(b, BLOCKS[1])))
    return F.array_max(F.transform(pieces, window_entropy))


def window_entropy(run: Column) -> Column:
    """Largest entropy, in millionths of a bit a character, of any window of
    ``WINDOW`` characters of ``run`` (at least that long)."""
    w = WINDOW
    clog = F.array(*[F.lit(v).cast("long") for v in _CLOG])
    count = lambda s, c: F.length(s) - F.length(F.replace(s, c, F.lit("")))
    f = lambda n: F.get(clog, n)

    def step(acc, i):
        before = F.substring(run, F.greatest(i - w, F.lit(1)), F.least(i - 1, F.lit(w)))
        enters, leaves = F.substring(run, i, F.lit(1)), F.substring(run, i - w, F.lit(1))
        full = i > w
        gone = count(before, leaves)
        less = F.when(full, f(gone - 1) - f(gone)).otherwise(F.lit(0).cast("long"))
        inside = F.when(full, F.substring(before, F.lit(2), F.lit(w))).otherwise(before)
        had = count(inside, enters)
        total = acc["total"] + less + f(had + 1) - f(had)
        least = F.when(i >= w, F.least(acc["least"], total)).otherwise(acc["least"])
        return F.struct(total.alias("total"), least.alias("least"))

    start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(1 << 40).cast("long").alias("least"))
    least = F.aggregate(F.sequence(F.lit(1), F.length(run)), start, step)["least"]
    return F.lit(round(math.log2(w) * _SCALE)) - F.floor(least / w)


def _is_secret(run: Column) -> Column:
    threshold = F.lit(None).cast("long")
    for _, pattern, bits in reversed(CLASSES):
        threshold = F.when(run.rlike(pattern), F.lit(None if bits is None else round(bits * _SCALE)).cast("long")).otherwise(threshold)
    allowed = F.lit(False)
    for pattern in ALLOW:
        allowed = allowed | run.rlike(pattern)
    return F.coalesce(~allowed & (F.when(~allowed, largest_entropy(run)) >= threshold), F.lit(False))


def scan_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row with ``base`` and ``spans``: array<struct<start, kind, end>>
    sorted by start and then kind (an index into ``KINDS``); ``base`` has the
    three fixed kinds, ``spans`` also the entropy spans.

    Null texts count as empty, and empty texts have empty arrays. Texts of any
    length are scanned whole, in time about proportional to their length (the
    spans of a text are sorted and counted, which adds the logarithm of their number).
    Repeated rows are scanned one by one. Columns called ``base`` or ``spans``
    are replaced. No rows give no rows.
    """
    docs = without(docs, ("base", "spans"))
    t, assign, value, access, hexes, runs, base, part, more = temp_names(docs, "text_", "assign", "value", "access", "hex", "run", "base_", "part", "more")
    all_of = lambda p, group=0: F.regexp_extract_all(F.col(t), F.lit(p), F.lit(group))
    out = docs.withColumn(t, F.coalesce(ref(text).cast("string"), F.lit("")))
    out = out.withColumns({assign: all_of(ASSIGN), access: all_of(ACCESS), hexes: all_of(HEX), runs: all_of(CANDIDATE)})
    out = out.withColumn(value, F.when(F.size(assign) > 0, all_of(ASSIGN, 1)).otherwise(F.array().cast("array<string>")))
    long_enough = F.filter(_spans(F.col(t), F.col(assign), ASSIGN, 0), lambda s, i: F.length(F.get(F.col(value), i)) >= ASSIGN_VALUE)
    out = out.withColumn(base, F.concat(long_enough, _spans(F.col(t), F.col(access), ACCESS, 1), _spans(F.col(t), F.col(hexes), HEX, 2)))
    parts = _outside(F.col(runs), _spans(F.col(t), F.col(runs), CANDIDATE, 3), F.col(base))
    out = out.withColumn(part, parts)
    secret = F.filter(F.col(part), lambda x: _is_secret(x["run"]))
    out = out.withColumn(more, F.transform(secret, lambda x: x["span"]))
    return out.select(*[ref(c) for c in docs.columns], F.array_sort(base).alias("base"), F.array_sort(F.concat(base, more)).alias("spans"))


def spans_text(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")
