r"""Chat formatting by black-box incremental rendering.

A template is any function from a list of (role, text) turns to a string. It
is called on successive prefixes of a conversation; where the outputs of two
prefixes part is where the new turn's text stands. If an output does not begin
with the one before it, the template has rewritten history: the turn is
marked, and the turns whose spans it touched are no longer under the loss
mask. Inside its span a turn's text is located by rendering the turn with two
probe texts and comparing these outputs.

A template that only ever appends, and whose text for a turn depends on few
turns before it, can say so by an attribute ``local = True``. Its conversations
go through in windows of turns, each beginning with the last turns of the one
before as context, in bounded memory and in time proportional to their length.
Of any other template every prefix is rendered from the first turn on, as it
may rewrite any turn: exact, in time that grows with the square of the length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ref

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

#: local templates: turns rendered at a time, and the turns of the window before that are rendered with them
WINDOW, CONTEXT = 64, 4
TRAINED_ROLE = "assistant"

# ---- fixed values: the control strings ----
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)) + r"|\\")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"<s>\[INST\] (.*?) \[/INST\] (.*?)</s>\n", re.DOTALL)


def escape(text: str) -> str:
    r"""Break up control strings with a backslash after their first character
    (``<\/s>``) and double backslashes."""
    if not any(c in text for c in "<[\\"):
        return text
    return _CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def inst_template(turns: list[Turn]) -> str:
    """``<s>[INST] role [/INST] text</s>`` and a line feed for every turn."""
    return "".join([f"<s>[INST] {escape(role)} [/INST] {escape(text)}</s>\n" for role, text in turns])


inst_template.local = True


def parse_inst(formatted: str) -> list[Turn]:
    """The turns that ``inst_template`` made the string of."""
    turns, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"unexpected text at {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"unexpected text at {at}")
    return turns


@dataclass
class Span:
    """A turn's place in the formatted conversation; ``text_*`` bound its text
    (both None if the template does not place the text once)."""

    start: int
    end: int
    text_start: int | None
    text_end: int | None
    rewrites: bool = False      # this turn changed what stood before it
    rewritten: bool = False     # a later turn changed this span


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    if b.startswith(a):
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _text_place(template: Template, before: list[Turn], role: str, text: str, out: str) -> tuple[int, int] | None:
    """Where ``text`` stands in ``out``, by two probes in its place."""
    a, b = template([*before, (role, "0")]), template([*before, (role, "1")])
    head = _common(a, b)
    tail = len(a) - head - 1
    if len(a) != len(b) or a[head + 1:] != b[head + 1:] or out[:head] != a[:head] or len(out) < head + tail or (tail and out[-tail:] != a[-tail:]):
        return None
    return head, len(out) - tail


def render_window(template: Template, context: list[Turn], turns: list[Turn]) -> tuple[str, list[Span]]:
    """Text that ``turns`` add after ``context``, and a span for each of them
    (from the beginning of that text). A turn that rewrites the context's own
    text is an error: that text is given out already."""
    before = list(context)
    last = template(before) if before else ""
    base, spans = len(last), []
    for role, text in turns:
        out = template([*before, (role, text)])
        same = _common(last, out)
        if same < base:
            raise ValueError("the template is declared local, but rewrites turns of the window before")
        rewrites, cut = same < len(last), same - base
        for s in spans if rewrites else ():
            if s.end > cut:
                s.start, s.end, s.rewritten = min(s.start, cut), cut, True
                if s.text_end is not None and s.text_end > cut:
                    s.text_start = s.text_end = None
        place = _text_place(template, before, role, text, out)
        if place is not None and place[0] < same:
            place = None
        spans.append(Span(cut, len(out) - base, place and place[0] - base, place and place[1] - base, rewrites))
        before.append((role, text))
        last = out
    return last[base:], spans


def format_turns(template: Template, turns: Iterable[Turn], window: int = WINDOW, context: int = CONTEXT) -> Iterator[tuple[Turn, str, Span]]:
    """(turn, its piece of the formatted conversation, its span there) in
    order; the pieces joined are the formatted conversation. ``window`` and
    ``context`` are for templates that are ``local``."""
    offset, before, held = 0, [], []
    local = getattr(template, "local", False)

    def flush():
        nonlocal offset, before, held
        text, spans = render_window(template, before, held)
        for turn, s in zip(held, spans):
            piece = text[s.start:s.end]
            move = lambda x: None if x is None else x + offset
            yield turn, piece, Span(s.start + offset, s.end + offset, move(s.text_start), move(s.text_end), s.rewrites, s.rewritten)
        offset += len(text)
        before, held = [*before, *held][-context:] if context else [], []

    for turn in turns:
        held.append(turn)
        if local and len(held) == window:
            yield from flush()
    if held:
        yield from flush()


FORMATTED = ("conv_id long, turn_no long, role string, piece string, start long, end long, text_start long, text_end long, "
             "rewrites boolean, rewritten boolean, in_loss boolean")


def format_conversations(rows: DataFrame, template: Template = inst_template, window: int = WINDOW, context: int = CONTEXT,
                         conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per turn, sorted inside each partition by conversation and turn:
    conv_id, turn_no (from 0), role, piece (the turn's part of the formatted
    conversation), start and end (its span), text_start and text_end, rewrites,
    rewritten, in_loss (an assistant's text that was located and not rewritten).

    Turns are in the order of ``turn`` (null first), ties by role and text;
    repeated rows are turns of their own. Null roles and texts count as empty;
    rows with a null conv_id are one conversation. Other columns are not read.
    A conversation is dealt to one task, since its output is one string. With a
    ``local`` template it passes through it in windows of ``window`` turns, and
    a turn's text may depend on ``context`` turns before it; with any other it
    is held whole. No rows, no rows.
    """
    src = rows.select(ref(conv_id).cast("long").alias("conv_id"), ref(turn).alias("turn"), F.coalesce(ref(role).cast("string"), F.lit("")).alias("role"),
                      F.coalesce(ref(text).cast("string"), F.lit("")).alias("text"))
    src = src.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    schema = pa.schema([("conv_id", pa.int64()), ("turn_no", pa.int64()), ("role", pa.string()), ("piece", pa.string()), ("start", pa.int64()),
                        ("end", pa.int64()), ("text_start", pa.int64()), ("text_end", pa.int64()), ("rewrites", pa.bool_()), ("rewritten", pa.bool_()),
                        ("in_loss", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def turns():
            for batch in batches:
                ids, roles, texts = batch.columns
                for i in range(batch.num_rows):
                    yield ids[i].as_py(), (roles[i].as_py(), texts[i].as_py())

        out, size = [], 0
        for conv, one in _conversations(turns()):
            for k, ((who, _), piece, s) in enumerate(format_turns(template, one, window, context)):
                loss = who == TRAINED_ROLE and s.text_start is not None and not s.rewritten
                out.append((conv, k, who, piece, s.start, s.end, s.text_start, s.text_end, s.rewrites, s.rewritten, loss))
                size += len(piece) + 100
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return src.mapInArrow(run, FORMATTED)


def _conversations(turns: Iterator[tuple]) -> Iterator[tuple]:
    """(conv_id, iterator of turns) of sorted (conv_id, turn) pairs."""
    from itertools import groupby

    for conv, group in groupby(turns, key=lambda x: x[0]):
        yield conv, (t for _, t in group)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewrites long"


def digests(formatted: DataFrame, parse: Callable[[str], list[Turn]] = parse_inst, plain: Callable[[str], str] = unescape) -> DataFrame:
    """Per conversation what can be read back from its formatted turns, in one
    pass over the rows in the order that ``format_conversations`` leaves them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from batch.to_pylist()

        from itertools import groupby

        out: dict[str, list] = {n.split()[0]: [] for n in DIGESTS.split(", ")}
        for conv, turns in groupby(rows(), key=lambda r: r["conv_id"]):
            said, loss, n, chars, length, rewrites = hashlib.sha256(), hashlib.sha256(), 0, 0, 0, 0
            for r in turns:
                for who, text in parse(r["piece"]):
                    said.update(f"{who}\n{text}\n".encode())
                    n += 1
                if r["in_loss"]:
                    text = plain(r["piece"][r["text_start"] - r["start"]:r["text_end"] - r["start"]])
                    loss.update(text.encode())
                    chars += len(text)
                length += len(r["piece"])
                rewrites += r["rewrites"]
            for name, value in zip(out, (conv, n, said.hexdigest(), chars, loss.hexdigest(), length, rewrites)):
                out[name].append(value)
            if len(out["conv_id"]) >= 5000:
                yield pa.RecordBatch.from_pydict(out, schema=_DIGEST_SCHEMA)
                out = {n: [] for n in out}
        yield pa.RecordBatch.from_pydict(out, schema=_DIGEST_SCHEMA)

    return formatted.mapInArrow(run, DIGESTS)


_DIGEST_SCHEMA = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                            ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("rewrites", pa.int64())])
