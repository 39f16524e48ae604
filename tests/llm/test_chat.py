"""Layouts become the same turns; formatted text reads back exactly."""

import hashlib
import json
import random

from carespark.llm import catalog, chat


def turns(record):
    name = chat.Registry().layout_of(record)
    return name and [(r, t) for _, _, r, t in chat.turns_of(record, chat.LAYOUTS[name])]


def test_layouts():
    want = [("user", "Hi"), ("assistant", "Yo")]
    full = [("system", "Be kind"), *want]
    assert len(chat.Registry()) == sum(2 ** len(x.get("optional", [])) for x in chat.LAYOUTS.values())
    for r in ({"messages": [{"role": "user", "content": "Hi"}, {"role": "assistant", "content": "Yo"}]},
              {"messages": [{"role": "user", "content": [{"type": "text", "text": "Hi"}]},
                            {"role": "assistant", "content": [{"type": "text", "text": "Yo"}]}]},
              {"id": 7, "conversations": [{"from": "human", "value": "Hi"}, {"from": "gpt", "value": "Yo"}]},
              {"dialog": [{"speaker": "human", "utterance": "Hi"}, {"speaker": "bot", "utterance": "Yo"}]},
              {"instruction": "Hi", "input": "", "output": "Yo"}, {"instruction": "Hi", "output": "Yo"},
              {"instruction": "Hi", "response": "Yo", "category": {"a": 1}}, {"prompt": "Hi", "completion": "Yo"},
              {"prompt": "Hi", "response": "Yo"}, {"question": "Hi", "answer": "Yo"}):
        assert turns(r) == want, r
    assert turns({"system": "Be kind", "prompt": "Hi", "completion": "Yo"}) == full
    assert turns({"system": "Be kind", "messages": [{"role": "user", "content": "Hi"}, {"role": "assistant", "content": "Yo"}]}) == full
    assert turns({"instruction": "Sum", "input": "1 2", "output": "3"}) == [("user", "Sum\n\n1 2"), ("assistant", "3")]
    assert turns({"prompt": "Hi"}) is None and turns({}) is None and turns({"messages": []}) is None


def test_fields_of_other_layouts_do_not_hide_a_record():
    want = [("user", "Hi"), ("assistant", "Yo")]
    assert turns({"instruction": "Hi", "input": "", "output": "Yo", "text": "### Instruction: Hi"}) == want
    assert turns({"prompt": "Hi", "response": "Yo", "context": "c"}) == want
    assert turns({"prompt": "Hi", "completion": "Yo", "turn": 3}) == want
    # the most specific mapping: four fields of a turn row rather than two of a pair
    assert turns({"conv_id": 1, "turn": 0, "role": "user", "text": "Hi", "prompt": "x", "response": "y"}) == [("user", "Hi")]
    mixed = {"messages": [{"role": "user", "content": "Hi"}, {"role": "assistant", "content": [{"type": "text", "text": "Yo"}]}]}
    assert turns(mixed) == want
    mixed["messages"] = mixed["messages"][::-1]
    assert turns(mixed) == want[::-1]
    assert turns({"messages": [{"role": "user", "content": None}, {"role": "assistant", "content": 5}]}) == [("user", ""), ("assistant", "5")]


def test_unmatched_records_are_counted_and_not_formatted(spark):
    rows = [(1, json.dumps({"prompt": "Hi", "response": "é"})), (1, "no json"), (2, json.dumps({"prompt": "alone"})), (2, None), (None, "[1]")]
    got = chat.canonical_turns(spark.createDataFrame(rows, "key long, record string"))
    assert sorted(map(tuple, chat.unmatched_records(got).collect()), key=str) == [(1, 1), (2, 2), (None, 1)]
    assert sorted((r.conv_id, r.formatted) for r in chat.format_conversations(got).collect()) == [
        (1, "<|im_start|>assistant\né<|im_end|>\n"), (1, "<|im_start|>user\nHi<|im_end|>\n")]


BITS = ["<", "[", "\\", "/", "s>", "</s>", "<s>", "[INST]", "[/INST]", "<|im_end|>", "<|im_start|>", "|im_end|>", "<<SYS>>", "<</SYS>>",
        "\n", "é", "user", "<\\s>", "INST]", "n", "|"]


def test_escapes_are_reversible():
    rng = random.Random(4)
    seen = {}
    for _ in range(20_000):
        t = "".join(rng.choice(BITS) for _ in range(rng.randrange(9)))
        e = chat.escape(t)
        assert chat.unescape(e) == t and seen.setdefault(e, t) == t
        for mark in ("</s>", "<s>", "[INST]", "[/INST]", chat.OPEN, chat.CLOSE, "<<SYS>>", "<</SYS>>"):
            assert mark not in e
        role = "".join(rng.choice(BITS) for _ in range(rng.randrange(4)))
        piece, a, b = chat.formatted_turn(role, t)
        assert chat.read_turn(piece) == (role, t) and chat.unescape(piece[a:b]) == t


def digests(rows):
    convs = {}
    for c, turn, role, text in rows:
        convs.setdefault(c, []).append((turn is not None, turn, role or "", text or ""))
    out = []
    for c, ts in convs.items():
        ts.sort()
        said = "".join(t for _, _, r, t in ts if r == "assistant")
        out.append((c, len(ts), hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in ts).encode()).hexdigest(), len(said),
                    hashlib.sha256(said.encode()).hexdigest(), sum(len(chat.formatted_turn(r, t)[0]) for _, _, r, t in ts)))
    return sorted(out, key=str)


def test_round_trip(spark):
    rng = random.Random(5)
    rows = [(rng.choice([1, 2, 3, None, 9]), rng.randrange(6), rng.choice(["user", "assistant", "system", None, "a\nb"]),
             rng.choice([None, "", "".join(rng.choice(BITS) for _ in range(8)), "long " * 3000])) for _ in range(80)]
    rows += rows[:5] + [(4, 0, "assistant", "</s>[INST] ok [/INST]")] + [(5, i, "assistant", str(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = chat.read_back(chat.format_conversations(df)).collect()
    assert sorted(map(tuple, got), key=str) == digests(rows)
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0


def test_records(spark):
    rows = [(1, json.dumps({"prompt": "Hi", "response": "é"})), (2, "no json"), (3, None), (4, "[1]"),
            (5, json.dumps({"conv_id": 8, "turn": 2, "role": "user", "text": None, "extra": {"a": [1]}}))]
    got = sorted(map(tuple, chat.canonical_turns(spark.createDataFrame(rows, "key long, record string")).collect()), key=str)
    assert got == sorted([(1, 0, "user", "Hi", "prompt and response"), (1, 1, "assistant", "é", "prompt and response"),
                          (2, None, None, None, None), (3, None, None, None, None), (4, None, None, None, None),
                          (8, 2, "user", "", "turn rows")], key=str)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    assert sorted(map(tuple, catalog.op8_chat(spark, sf).collect()), key=str) == digests(rows)
