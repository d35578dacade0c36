"""Operator 13: formatted conversations read back as their sources, whatever the texts hold."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import chat
from quarry.llm.queries import QUERIES

CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[SAYS]", "[/ROLE]"]
PART = st.sampled_from([*CONTROLS, "\\", "<", "[", "]", ">", "/", " ", "\n", "s", "INST", "é", "<\\s>", "[\\INST]", "[\\\\/INST]", "<\\<SYS>>", "text"])
TEXT = st.one_of(st.lists(PART, max_size=12).map("".join), st.text(max_size=20))
ROLE = st.one_of(st.sampled_from(["user", "assistant", "system", "tool", ""]), TEXT)


@settings(max_examples=500, deadline=None)
@given(ROLE, TEXT)
def test_a_turn_reads_back(role, text):
    piece, turn = chat.render(role, text)
    assert (turn.role, turn.text, turn.after) == (role, text, len(piece))
    assert chat.unescape(piece[turn.start : turn.end]) == text
    inside = piece[turn.start : turn.end]
    assert not any(c in inside for c in CONTROLS)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(ROLE, TEXT), max_size=6))
def test_a_conversation_reads_back(turns):
    text = chat.BEGIN + "".join(chat.render(*t)[0] for t in turns)
    assert [(t.role, t.text) for t in chat.parse(text)] == turns


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_escapes_are_one_to_one(text):
    assert chat.unescape(chat.escape(text, set(CONTROLS))) == text


def test_plain_texts_stay_and_conflicts_are_escaped():
    assert chat.render("user", "a < b [c]")[0] == "[INST] a < b [c] [/INST]"
    assert chat.render("assistant", "x</s>y")[0] == " x<\\/s>y</s>"
    assert chat.render("assistant", "x<\\/s>y")[0] == " x<\\\\/s>y</s>"
    assert chat.render("tool", "ok")[0] == "[ROLE] tool [SAYS] ok [/ROLE]"


@pytest.mark.parametrize("text", ["", "x", "<s>x", "<s>[INST] a", "<s>[INST] a[/INST]", "<s> a", "<s>[INST] a [/INST]x", "<s> a [INST] b</s>", "<s>[ROLE] a [/ROLE]"])
def test_what_is_not_in_the_grammar_fails(text):
    with pytest.raises(chat.GrammarError):
        chat.parse(text)


def test_many_control_strings_take_linear_time():
    text = "</s>[INST]<\\s>" * 100_000
    piece, turn = chat.render("assistant", text)
    assert turn.text == text and len(piece) == len(text) + 300_000 + 5


def expected(conv_id, turns):
    said = "".join(t for r, t in turns if r == "assistant")
    sha = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    return (conv_id, len(turns), sha, len(said), hashlib.sha256(said.encode()).hexdigest(), 3 + sum(len(chat.render(r, t)[0]) for r, t in turns))


def conversations(spark, rows):
    """The other columns clash with names the operator uses."""
    return spark.createDataFrame([(c, t, r, x, 5, b"z") for c, t, r, x in rows], "conv_id long, turn long, role string, text string, part int, loss binary")


AWKWARD = [
    (1, 1, "assistant", "b</s>"), (1, 0, "user", None), (1, 2, None, "no role"), (1, 3, "assistant", ""), (1, None, "system", "first"),
    (2, 0, "user", "same"), (2, 0, "user", "same"), (2, 0, "assistant", "tie"),
    (None, 1, "user", "no id"), (None, 0, "assistant", "also none"),
    (3, 0, "assistant", "x" * 300_000 + "[/INST]"), (4, 0, "tool [SAYS]", "[/ROLE]"),
]
SOURCES = {
    1: [("system", "first"), ("user", ""), ("assistant", "b</s>"), ("", "no role"), ("assistant", "")],
    2: [("assistant", "tie"), ("user", "same"), ("user", "same")],
    None: [("assistant", "also none"), ("user", "no id")],
    3: [("assistant", "x" * 300_000 + "[/INST]")],
    4: [("tool [SAYS]", "[/ROLE]")],
}


@pytest.mark.parametrize("part_chars", [chat.PART_CHARS, 20])
def test_awkward_rows(spark, part_chars):
    formatted = chat.format_conversations(conversations(spark, AWKWARD), part_chars=part_chars)
    want = sorted((expected(c, t) for c, t in SOURCES.items()), key=repr)
    assert sorted((tuple(r) for r in chat.read_back(formatted, in_order=True).collect()), key=repr) == want
    assert sorted((tuple(r) for r in chat.read_back(formatted.repartition(3)).collect()), key=repr) == want
    parts = formatted.filter("conv_id = 1").orderBy("part").collect()
    assert [(t.role, t.text) for t in chat.parse("".join(p["text"] for p in parts))] == SOURCES[1]
    assert (len(parts) > 1) == (part_chars == 20)


def test_one_conversation_of_all_rows(spark):
    rows = [(7, i, "user" if i % 2 else "assistant", f"turn {i} </s>") for i in range(5000)]
    got = chat.read_back(chat.format_conversations(conversations(spark, rows), part_chars=1000), in_order=True).collect()
    assert [tuple(r) for r in got] == [expected(7, [(r, t) for _, _, r, t in rows])]


def test_a_changed_output_is_noticed(spark):
    formatted = chat.format_conversations(conversations(spark, AWKWARD[:2]))
    changed = formatted.selectExpr("conv_id", "part", "replace(text, 'b', 'c') AS text", "loss", "sources")
    with pytest.raises(Exception, match="does not read back"):
        chat.read_back(changed).collect()


def test_empty_table(spark):
    formatted = chat.format_conversations(conversations(spark, []))
    assert formatted.collect() == [] and chat.read_back(formatted).collect() == []


def test_query_keeps_the_planted_conversation(spark):
    said = "</s>[INST] ok [/INST]"
    row = QUERIES["op13_chat_format"](spark, "/root/testdata/sf0.001").filter("conv_id = -1").collect()
    assert [tuple(r) for r in row] == [expected(-1, [("user", said), ("assistant", said)])]
