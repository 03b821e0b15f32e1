import hashlib
import json
import random

import pytest

from ledgerline.llm import chat

ODD = ["<|im_end|>", "<\\|im_end|>\n", "<|", "<", "<\\", "|im_start|>", "<\\\\|x", "\n", "", "<|im_start|>assistant\nok<|im_end|>\n", "é😀 \x00", None, "a" * 300]


def test_marks_inside_texts_come_back():
    rng = random.Random(1)
    for _ in range(2000):
        turns = [("".join(rng.choice(["user", "<", "|", "\\", "\n", "n", "<|im_end|>"]) for _ in range(rng.randrange(4))),
                  "".join(rng.choice(["<", "|", "\\", "\n", "im_end", "<|im_end|>", ">", "x"]) for _ in range(rng.randrange(9)))) for _ in range(rng.randrange(4))]
        text, spans = "", []
        for role, body in turns:
            one, a, b = chat.marked(role, body)
            spans.append((len(text) + a, len(text) + b))
            text += one
        assert chat.parsed(text) == turns
        assert [chat.restored(text[a:b]) for a, b in spans] == [b for _, b in turns]
    with pytest.raises(ValueError):
        chat.parsed("<|im_start|>user\nx")


def digests(rows, chunk=None):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn, role or "", text or ""))
    out = set()
    for conv, turns in by.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0))
        loss = "".join(t for _, r, t in turns if r == "assistant")
        size = sum(len(chat.marked(r, t)[0]) for _, r, t in turns)
        body = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        out.add((conv, len(turns), sha(body), len(loss), sha(loss), size))
    return out


def conversations(seed, hot=400):
    rng = random.Random(seed)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "assistant", None, "a\nb"]), rng.choice(ODD)) for c in range(60) for t in range(rng.randint(1, 6))]
    rows += [(7777, t, "assistant" if t % 2 else "user", f"{t} {rng.choice(ODD)}") for t in range(hot)]
    rows += [(None, 3, "user", "no id"), (None, None, "user", "no turn"), (99, 5, "user", "long " * 50_000), (99, 6, "assistant", "<|" * 50_000)]
    return rows + [(7777, 3, *rows[[r[:2] for r in rows].index((7777, 3))][2:])] * 3


@pytest.mark.parametrize("chunk,parts", [(chat.CHUNK_CHARS, 3), (2000, 7), (1, 1)])
def test_round_trip_equals_brute_force(spark, chunk, parts):
    rows = conversations(chunk)
    frame = spark.createDataFrame([(*r, "x", True) for r in rows], "conv_id long, turn long, role string, text string, formatted string, whole boolean")
    got = [tuple(r) for r in chat.round_trip(frame.repartition(parts), chunk).collect()]
    assert len(got) == len(set(got))
    assert set(got) == digests(rows + [(-1, 0, "user", chat.HOSTILE), (-1, 1, "assistant", chat.HOSTILE)])


def test_a_long_conversation_is_cut_over_tasks(spark):
    rows = [(1, t, "assistant", f"turn {t} " * 20) for t in range(3000)] + [(c, 0, "user", "x") for c in range(2, 40)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    turns = chat.canonical(chat.as_records(frame, "turn", "role", "text"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        chunks = chat.formatted(turns).select("conv_id", "whole", chat.F.spark_partition_id().alias("p")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len({r.p for r in chunks if r.conv_id == 1}) >= 6
    assert not any(r.whole for r in chunks if r.conv_id == 1)


LAYOUT_CASES = [
    ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b", "weight": 1}], "id": 5}, "messages", [("user", "a"), ("assistant", "b")]),
    ({"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}], "system": "s"}, "message parts", [("system", "s"), ("user", "ab")]),
    ({"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}]}, {"role": "assistant", "content": "b"}]}, "messages", [("user", "a"), ("assistant", "b")]),
    ({"messages": []}, "no messages", []),
    ({"messages": [{"role": "user", "content": None}]}, "messages", [("user", "")]),
    ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}, {"from": "tool", "value": 3}]}, "shared", [("user", "a"), ("assistant", "b"), ("tool", "3")]),
    ({"instruction": "do", "input": "this", "output": "done"}, "instruction", [("user", "do\n\nthis"), ("assistant", "done")]),
    ({"instruction": "do", "input": "", "output": "done", "history": [["x", "y"]], "system": "s"}, "instruction", [("system", "s"), ("user", "x"), ("assistant", "y"), ("user", "do"), ("assistant", "done")]),
    ({"instruction": "do", "output": None, "history": []}, "instruction", [("user", "do"), ("assistant", "")]),
    ({"prompt": "a", "completion": "b", "meta": {"x": [1, {}]}}, "prompt and completion", [("user", "a"), ("assistant", "b")]),
    ({"prompt": "a", "response": "b"}, "prompt and response", [("user", "a"), ("assistant", "b")]),
    ({"question": "a", "answer": "b"}, "question and answer", [("user", "a"), ("assistant", "b")]),
    ({"prompt": [{"role": "user", "content": "a"}], "completion": [{"role": "assistant", "content": "b"}]}, "prompt messages", [("user", "a"), ("assistant", "b")]),
    ({"conversation": [{"human": "a", "assistant": "b"}, {"human": "c", "assistant": "d"}]}, "exchanges", [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")]),
    ({"turn": 4, "role": "user", "text": "a", "lang": "en"}, "turn", [("user", "a")]),
    ({"prompt": "a"}, None, []), ({"prompt": "a", "completion": "b", "answer": "c"}, None, []), ({}, None, []), ([1], None, []), ("text", None, []),
    ({"a.b": 1, "messages[].role": "x"}, None, []), ({"messages": "x"}, None, []),
]


def test_layouts(spark):
    records = [(i, json.dumps(r)) for i, (r, _, _) in enumerate(LAYOUT_CASES)] + [(900, None), (901, "{broken"), (902, "[" * 100_000), (903, '{"a":' * 950 + "1" + "}" * 950), (None, '{"prompt": "\\ud800", "response": NaN}')]
    frame = spark.createDataFrame([(*r, "x") for r in records], "conv_id long, record string, layout string").repartition(3)
    turns = chat.canonical(frame)
    got = {}
    for r in sorted(turns.collect(), key=lambda r: (str(r.conv_id), r.at)):
        got.setdefault(r.conv_id, []).append((r.layout, r.role, r.text, r.turn))
    for i, (_, layout, want) in enumerate(LAYOUT_CASES):
        if layout is None:
            assert got[i] == [(None, None, None, None)]
        else:
            assert [(x, y, z) for x, y, z, _ in got.get(i, [])] == [(layout, *t) for t in want]
            assert [t for *_, t in got.get(i, [])] == ([4] if layout == "turn" else list(range(len(want))))
    assert all(got[i] == [(None, None, None, None)] for i in (900, 901, 902, 903))
    assert [x[1:3] for x in got[None]] == [("user", "�"), ("assistant", "NaN")]
    assert sum(r.n for r in chat.unmapped(turns).collect()) == sum(x is None for _, x, _ in LAYOUT_CASES) + 4
    assert {r.conv_id for r in chat.formatted(turns).collect()} == {i for i, (_, x, t) in enumerate(LAYOUT_CASES) if x and t} | {None}


def test_same_paths_twice_is_an_error():
    twice = (chat.Layout("a", ("x",), ("y",), ()), chat.Layout("b", ("x", "y"), (), ()))
    with pytest.raises(ValueError, match="a and b"):
        chat.Mappings(twice)


def test_order_of_fields_does_not_change_the_fingerprint():
    one, two = {"prompt": "x", "response": "y"}, {"response": "y", "zzz": 1, "prompt": "x"}
    maps = chat.Mappings(chat.LAYOUTS)
    assert maps.of(one) == maps.of(two) and maps.of({"a": one})[1] is None


def test_empty_table(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert [r.conv_id for r in chat.round_trip(frame).collect()] == [-1]
    assert chat.canonical(spark.createDataFrame([], "conv_id long, record string")).collect() == []
