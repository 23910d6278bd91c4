import hashlib
import json
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.llm import chat as C

CONTROLS = ["<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]"]
ROWS = "conv_id long, turn long, role string, text string"


def trip(df):
    return C.read_back(C.formatted(df))


def test_texts_survive_and_hold_no_control_string(spark):
    parts = st.sampled_from(CONTROLS + ["<", "\\", "\\\\", "[", "/", "s>", "|", "im_end|>", "INST]", "<<", "SYS>>", "a", "\n", "é", "$1", "\U0001F600"])
    made = []

    @settings(max_examples=300, database=None, deadline=None)
    @given(st.lists(parts, max_size=8).map("".join))
    def make(x):
        made.append(x)

    make()
    df = spark.createDataFrame([(i, [(x, x), ("assistant", x)]) for i, x in enumerate(made)], f"conv_id long, turns {C.TURNS}").repartition(4)
    got = {r["conv_id"]: r for r in trip(df).collect()}
    for i, x in enumerate(made):
        r = got[i]
        assert [tuple(t) for t in r["turns"]] == [(x, x), ("assistant", x)]
        assert r["loss_text"] == (x if x != "assistant" else x + x)
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
        own = [s["text"] for s in r["segments"] if s["loss"]] + [r["segments"][0]["text"][len(C.TEMPLATE.start):-len(C.TEMPLATE.middle)]]
        assert not any(c in t for c in CONTROLS for t in own)
        assert r["formatted"].count("<|im_start|>") == r["formatted"].count("<|im_end|>") == 2


SOURCES = [
    ({"prompt": "p", "response": "r"}, "prompt-response", [("user", "p"), ("assistant", "r")]),
    ({"prompt": "p", "completion": "r"}, "prompt-completion", [("user", "p"), ("assistant", "r")]),
    ({"prompt": "p", "response": None}, "prompt-response", [("user", "p")]),
    ({"instruction": "i", "input": "x", "output": "o"}, "instruction", [("user", "i\n\nx"), ("assistant", "o")]),
    ({"instruction": "i", "output": "o", "extra": {"deep": 1}}, "instruction", [("user", "i"), ("assistant", "o")]),
    ({"question": "q", "answer": "a"}, "question-answer", [("user", "q"), ("assistant", "a")]),
    ({"system_prompt": "s", "question": "q", "response": "r"}, "system-question", [("system", "s"), ("user", "q"), ("assistant", "r")]),
    ({"messages": [{"role": "tool", "content": "c"}, {"role": "user", "content": None}]}, "messages", [("tool", "c"), ("user", "")]),
    ({"messages": [{"content": "c"}]}, "messages", [("", "c")]),
    ({"messages": []}, "messages", []),
    ({"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}, {"from": "x", "value": ""}]}, "conversations",
     [("user", "h"), ("assistant", "g"), ("x", "")]),
    ({"prompt": "p", "answer": "a"}, None, None),
    ({"unknown": "u"}, None, None),
    ({}, None, None),
]


def test_mixed_json_rows(spark, tmp_path):
    path = tmp_path / "mixed.json"
    path.write_text("\n".join(json.dumps({"id": i, "turns": "clash", "layout": 3, **row}) for i, (row, *_) in enumerate(SOURCES)))
    got = {r["id"]: r for r in C.canonical(spark.read.json(str(path)), ["id"]).collect()}
    for i, (_, layout, turns) in enumerate(SOURCES):
        assert got[i]["layout"] == layout
        assert (got[i]["turns"] if turns is None else [tuple(t) for t in got[i]["turns"]]) == turns
    prints = [got[i]["fingerprint"] for i in range(len(SOURCES))]
    assert prints[-1] == prints[-2] and len(set(prints)) == len(prints) - 1  # rows without a known path are alike


def test_paths_of_nested_schemas(spark):
    df = spark.createDataFrame([], "a struct<b: string, c: struct<d: long>>, e array<struct<f: string, g: array<int>>>, h array<string>, i map<string,string>")
    assert C.schema_paths(df.schema) == ["a.b", "a.c.d", "e[]", "e[].f", "h[]"]
    nested = C.Layout("nested", (C.Turn("user", ("a.b",)),))
    one = spark.createDataFrame([(("x",),), (None,)], "a struct<b: string>")
    assert [r["turns"] and r["turns"][0]["text"] for r in C.canonical(one, [], (nested,)).collect()] == ["x", None]
    with pytest.raises(ValueError):
        C.canonical(one, [], (nested, C.Layout("again", (C.Turn("user", ("a.b",)),))))


def brute(rows):
    out = {}
    for c, t, r, x in rows:
        out.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c, ts in out.items():
        ts.sort()
        said, loss = "".join(f"{r}\n{x}\n" for *_, r, x in ts), "".join(x for *_, r, x in ts if r == "assistant")
        out[c] = (len(ts), sha(said), len(loss), sha(loss))
    return out


def test_turn_rows_through_all_layouts(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "system", "s"), (2, 1, "user", "</s>"), (2, 2, "assistant", "[INST]\n"),
            (3, 0, "system", "s"), (3, 1, "user", "u"), (3, 2, "assistant", "x"), (3, 3, "user", "u"), (3, 4, "assistant", "y"),
            (4, 0, "human", "u"), (4, 1, "gpt", "v"), (5, 0, None, None), (6, 0, "assistant", None), (6, 1, "assistant", ""),
            (7, 1, "user", "tie"), (7, 1, "user", "tie"), (7, 1, "assistant", "tie"), (7, None, "user", "first"), (None, 0, "user", "no id"),
            (None, 0, "assistant", "other"), (8, 0, "user", "long " * 60_000), (8, 1, "assistant", "</s>" * 30_000), (9, 0, "system\n", "x"), (9, 1, "user", "y")]
    rows += [(10, i, ["user", "assistant"][i % 2], f"turn {i}") for i in range(3000)]
    df = spark.createDataFrame(rows, ROWS).repartition(3).withColumns({c: F.lit("clash") for c in ("turns", "layout", "prompt2", "kind", "no")})
    mixed = C.canonical(C.as_sources(C.conversations(df)), ["conv_id"])
    got = {r["conv_id"]: r for r in C.digests(trip(mixed)).collect()}
    assert {k: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for k, r in got.items()} == brute(rows)
    assert {k: r["layout"] for k, r in got.items() if k in (1, 2, 3, 4)} == {
        1: "prompt-response", 2: "system-question", 3: "conversations", 4: "messages"}
    none = spark.createDataFrame([], ROWS)
    assert C.digests(trip(C.canonical(C.as_sources(C.conversations(none)), ["conv_id"]))).count() == 0


def test_no_python_in_the_plan(spark, capsys):
    from quarry.llm.queries import op11_chat_format

    op11_chat_format(spark, "/root/testdata/sf0.001").explain()
    assert not re.search("Python|Pandas|Arrow|ExternalRDD", capsys.readouterr().out.replace("ArrowToRow", ""))
