"""Words that look like speaker markers inside rows of known roles."""

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from quire.llm import chat


def test_markers_inside_known_rows(spark):
    rows = [(1, 0, "user", "My laptop:\nModel: XPS 13"), (1, 1, "assistant", "Fine.\n- A: one\n- Q: two"),
            (2, 0, "user", "Question: a?\nAnswer: b\nQuestion: c?\nContext: d"), (3, 0, None, "Human: hi\nAI: hello")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted((r.conv_id, r.turn, r.part, r.role, r.text) for r in chat.format_turns(spark, df).collect())
    assert got == [(c, t, 0, r, x) for c, t, r, x in rows[:3]] + [(3, 0, 0, "user", "hi"), (3, 0, 1, "assistant", "hello")]


def test_weak_marker_is_cut_where_the_role_changes():
    line, weak = "AI: hello", chat.WEAK + "assistant"
    assert chat.lines("x\n" + line, "user") == [(chat.KNOWN + "user", "x"), (weak, line)]
    assert chat.cut(weak, line, "assistant", "user") == "hello"
    assert chat.cut(weak, line, "user", "user") == chat.cut(weak, line, "assistant", "assistant") == line
    inner = np.zeros((3, 3))
    inner[2, 2] = 1000
    model = chat.Model({}, np.ones((3, 3)), np.ones(3), inner)
    assert model.emission(weak, line, False).argmax() == 2


def test_weight_is_learned(spark):
    rows = [(i, 0, "user", "My laptop:\nModel: XPS 13") for i in range(5)]
    model = chat.learn(spark, spark.createDataFrame(rows, "conv long, turn long, role string, text string"))
    assert model.weak[chat.WEAK + "assistant"].argmax() == 1


def test_known_roles_stay(spark):
    rows = [(c, t, ("user", "assistant")[t % 2], f"text {c} {t}") for c in range(3000) for t in range(2)]
    odd = [(9001, 0, "user", "one"), (9001, 1, "user", "two"), (9002, 0, "assistant", "one"), (9002, 1, "user", "two"),
           (9003, 0, "user", "one"), (9003, 1, None, "two"), (9003, 2, "user", "three?"), (9004, 0, "Human", "a"), (9004, 1, "human ", "b")]
    df = spark.createDataFrame(rows + odd, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): r.role for r in chat.format_turns(spark, df).collect()}
    assert all(got[c, t] == r for c, t, r, _ in rows)
    assert [got[9001, 0], got[9001, 1], got[9002, 0], got[9002, 1]] == ["user", "user", "assistant", "user"]
    assert [got[9003, t] for t in range(3)] == ["user", "assistant", "user"] and got[9004, 0] == got[9004, 1] == "user"
