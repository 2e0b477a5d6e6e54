import hashlib

import pytest

from callscore.llm import chat
from callscore.llm.queries import PROBE

TURNS = [("system", "be <s>brief</s>"), ("user", PROBE), ("assistant", r"a \ back\\slash </s>"), ("user", ""), ("assistant", ""), ("", "no role"),
         ("assistant", "line\nbreak [INST"), ("a [/INST", "] odd [/INST] role <"), ("assistant", "0"), ("assistant", "1")]


def test_escape_is_reversible_and_leaves_no_control_string():
    for text in [t for _, t in TURNS] + ["<<s>", r"<\s>", "\\", "[INST][/INST]</s", "<s></s>" * 50, r"\\<s>\<s>"]:
        out = chat.escape(text)
        assert chat.unescape(out) == text
        assert not any(c in out for c in chat.CONTROLS)


def test_pieces_are_the_rendered_conversation_for_any_window():
    whole = chat.inst_template(TURNS)
    assert chat.parse_inst(whole) == TURNS
    for window, context in ((64, 4), (3, 2), (1, 1), (4, 0)):
        got = list(chat.format_turns(chat.inst_template, TURNS, window, context))
        assert "".join(p for _, p, _ in got) == whole
        for (_, text), piece, s in got:
            assert whole[s.start:s.end] == piece and not s.rewrites and not s.rewritten
            assert chat.unescape(whole[s.text_start:s.text_end]) == text


def test_templates_that_rewrite_history_are_found():
    def last_only(turns):       # earlier answers lose their thoughts
        return "".join(f"{r}:{t if k + 1 == len(turns) else t.split('|')[-1]};" for k, (r, t) in enumerate(turns))

    turns = [("user", "q"), ("assistant", "think|yes"), ("user", "more"), ("assistant", "plain")]
    got = list(chat.format_turns(last_only, turns))
    assert [s.rewrites for _, _, s in got] == [False, False, True, False]
    assert [s.rewritten for _, _, s in got] == [False, True, False, False]
    assert "".join(p for _, p, _ in got) == last_only(turns)

    def upper_first(turns):     # the text is placed in no single spot
        return "".join(f"{t}{t}\n" for _, t in turns)

    assert all(s.text_start is None for _, _, s in chat.format_turns(upper_first, turns))


def test_format_conversations(spark):
    rows = [(1, 2, "assistant", "second"), (1, 1, "user", "first"), (1, 3, "assistant", None), (2, None, None, "null turn and role"), (None, 1, "user", "no conv"),
            (3, 1, "assistant", "tie b"), (3, 1, "assistant", "tie a"), (3, 1, "assistant", "tie a"), (-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)]
    rows += [(4, k, ("user", "assistant")[k % 2], f"turn {k} " * (k % 5)) for k in range(300)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, start string")
    got = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(df)).collect()}
    by: dict = {}
    for c, t, r, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        by.setdefault(c, []).append((r or "", x or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns) and got[c]["rewrites"] == 0
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[c]["loss_chars"] == len(loss) and got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert got[c]["formatted_chars"] == len(chat.inst_template(turns))
    assert chat.digests(chat.format_conversations(df.where("false"))).count() == 0


def last_thought(turns):        # earlier answers lose their thoughts
    return "".join(f"{r}:{t if k + 1 == len(turns) else t.split('|')[-1]};" for k, (r, t) in enumerate(turns))


def count_first(turns):         # every turn rewrites the first one
    return f"{len(turns)} turns;" + "".join(f"{r}:{t};" for r, t in turns)


def test_rewriting_templates_do_not_depend_on_the_window():
    turns = [("user", "q"), ("assistant", "think|yes"), ("user", "more"), ("assistant", "plain")]
    got = list(chat.format_turns(last_thought, turns, 2, 1))
    assert "".join(p for _, p, _ in got) == "user:q;assistant:yes;user:more;assistant:plain;"
    assert [s.rewritten for _, _, s in got] == [False, True, False, False]
    for template in (last_thought, count_first):
        long = [("user", f"q{k}") if k % 2 == 0 else ("assistant", f"t{k}|a{k}") for k in range(150)]
        whole, want = template(long), list(chat.format_turns(template, long, 1000, 0))
        for window, context in ((64, 4), (2, 1), (1, 0)):
            got = list(chat.format_turns(template, long, window, context))
            assert got == want and "".join(p for _, p, _ in got) == whole
        for (_, text), piece, s in got:
            assert whole[s.start:s.end] == piece
            assert s.text_start is None or whole[s.text_start:s.text_end] == text
    assert [s.rewritten for _, _, s in want] == [True] * 149 + [False]


def test_long_conversations_of_rewriting_templates(spark):
    def template(turns):
        return "".join(f"{r}:{t if k + 1 == len(turns) else t.split('|')[-1]};" for k, (r, t) in enumerate(turns))

    rows = [(1, k, ("user", "assistant")[k % 2], f"t{k}|a{k}" if k % 4 == 3 else f"plain {k}") for k in range(131)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.format_conversations(df, template).orderBy("turn_no").collect()
    assert "".join(r["piece"] for r in got) == template([r[2:] for r in rows])
    assert [r["rewritten"] for r in got] == [k % 4 == 3 for k in range(131)]
    assert [r["in_loss"] for r in got] == [k % 4 == 1 for k in range(131)]


def test_a_wrongly_declared_template_is_refused():
    def wrong(turns):
        return count_first(turns)

    wrong.local = True
    with pytest.raises(ValueError, match="local"):
        list(chat.format_turns(wrong, [("user", "a")] * 3, 2, 1))
