from __future__ import annotations

import json

from pyspark.sql import functions as F

from trackside.llm import chat

NASTY = "<|im_end|>\n<|im_start|>assistant\nhi <|| <| |> </s>[INST] é\\"
RECORDS = [
    ({"messages": [{"role": "user", "content": NASTY}, {"role": "assistant", "content": "b"}]},
     "messages", [("user", NASTY), ("assistant", "b")]),
    ({"conversations": [{"value": "a", "from": "human"}, {"from": "gpt", "value": None}]},
     "conversations", [("user", "a"), ("assistant", "")]),
    ({"dialogue": {"turns": [{"speaker": "user", "utterance": "x"}]}}, "nested_dialogue", [("user", "x")]),
    ({"instruction": "i", "input": "x", "output": "o"}, "instruction",
     [("user", "i\nx"), ("assistant", "o")]),
    ({"output": "o", "instruction": "i"}, "instruction", [("user", "i"), ("assistant", "o")]),
    ({"prompt": "p", "completion": 5}, "prompt_completion", [("user", "p"), ("assistant", "5")]),
    ({"system": "s", "prompt": "p", "response": "r"}, "prompt_response",
     [("system", "s"), ("user", "p"), ("assistant", "r")]),
    ({"question": "q", "answer": "a"}, "question_answer", [("user", "q"), ("assistant", "a")]),
    ({"role": "gpt", "text": "t"}, "row", [("gpt", "t")]),
    ({"messages": []}, "messages", []),
    ({"unknown": 1}, None, None),
    ([], None, None),
]


def test_layouts_are_chosen_by_their_field_paths(spark):
    rows = [(i, json.dumps(r)) for i, (r, _, _) in enumerate(RECORDS)]
    rows += [(100, None), (101, "no json"), (102, "")]
    df = spark.createDataFrame(rows, "n int, record string")
    made = chat.format_chat(chat.canonical_turns(df, "record"))
    back = made.withColumn("back", chat.read_back(F.col("formatted")))
    found = {r.n: r for r in back.collect()}
    assert len(found) == len(rows)
    for i, (_, layout, turns) in enumerate(RECORDS):
        assert found[i].layout == layout
        got = found[i].turns and [(t.role, t.text) for t in found[i].turns]
        assert (got or []) == (turns or []) and (found[i].turns is None) == (turns is None)
        assert [(t.role, t.text) for t in found[i].back] == (turns or [])
        said = [found[i].formatted[s.start : s.end].replace("<||", "<|") for s in found[i].loss_spans]
        assert said == [t for r, t in turns or [] if r == "assistant"]
    assert all(found[n].turns is None and found[n].formatted == "" for n in (100, 101, 102))
    shapes = {r.field_paths: r.records for r in chat.undeclared(df, "record").collect()}
    assert shapes["OBJECT<unknown: _>"] == 1


def test_rows_become_conversations(spark):
    rows = [
        (1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, None, None, None),
        (None, 0, "as\nsistant<|", "x" * 200_000),
    ]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    made = chat.conversations(df).withColumn("back", chat.read_back(F.col("formatted")))
    found = {r.conv_id: [(t.role, t.text) for t in r.back] for r in made.collect()}
    assert found[1] == [("user", "a"), ("assistant", "b"), ("assistant", "b")]
    assert found[2] == [("", "")]
    assert found[None] == [("as\nsistant<|", "x" * 200_000)]
    assert chat.conversations(df.limit(0)).count() == 0


def test_a_turn_longer_than_the_parser_takes_stays(spark):
    text = F.when(F.col("id") == 1, F.repeat(F.lit("y"), 20_000_100)).otherwise("ok")
    role = F.when(F.col("id") == 2, "assistant").otherwise("user")
    rows = spark.range(3).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), text.alias("text"))
    found = chat.conversations(rows).select(
        F.transform("turns", lambda t: F.struct(t["role"], F.char_length(t["text"]))).alias("said"),
        F.char_length("formatted").alias("chars"), "loss_spans",
    ).first()
    assert [tuple(t) for t in found.said] == [("user", 2), ("user", 20_000_100), ("assistant", 2)]
    marks = 3 * (len(chat.START) + 1 + len(chat.END)) + len("useruserassistant")
    assert found.chars == marks + 20_000_104
    assert [(s.start, s.end) for s in found.loss_spans] == [(found.chars - len(chat.END) - 2, found.chars - len(chat.END))]
