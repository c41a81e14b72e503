import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from twincheck.llm import chat

PARTS = [*"ab<>|\\_\n é", "<|im_start|>", "<|im_end|>", "<|im_", "<\\"]
TEXT = st.lists(st.sampled_from(PARTS), max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(TEXT, TEXT), max_size=4))
def test_any_texts_come_back(turns):
    formatted = "".join(f"{chat.Template().head(r)}{chat.escape(t)}{chat.END}\n" for r, t in turns)
    assert list(chat.parse(formatted)) == turns
    assert formatted.count(chat.START) == formatted.count(chat.END) == len(turns)


RECORDS = [
    ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": None}]}, [("user", "a"), ("assistant", "")]),
    ({"messages": [{"role": "user", "text": "a"}], "id": 7, "meta": {"x": [1]}}, [("user", "a")]),
    ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}, [("user", "a"), ("assistant", "b")]),
    ({"prompt": "p", "completion": "c"}, [("user", "p"), ("assistant", "c")]),
    ({"prompt": "p", "response": "c", "system": "s"}, [("system", "s"), ("user", "p"), ("assistant", "c")]),
    ({"instruction": "i", "input": "n", "output": 5}, [("user", "i"), ("user", "n"), ("assistant", "5")]),
    ({"instruction": "i", "output": "o"}, [("user", "i"), ("assistant", "o")]),
    ({"question": "q", "answer": "a"}, [("user", "q"), ("assistant", "a")]),
    ({"role": "tool", "text": "t"}, [("tool", "t")]),
    ({"messages": [{"role": "human", "content": "kept"}]}, [("human", "kept")]),
    ({"other": 1}, None),
    ([1], None),
]


@pytest.mark.parametrize("record, turns", RECORDS)
def test_layouts_are_found_by_their_paths(record, turns):
    assert chat.record_turns(record) == turns


def test_fingerprints_are_distinct_and_ignore_other_fields():
    assert len(chat.MAPPINGS) == len(chat.LAYOUTS)
    paths = ["prompt", "response"]
    assert chat.fingerprint(paths) == chat.fingerprint([*paths[::-1], "more", "deep[].x"])


def test_json_records_and_columns_agree(spark):
    rows = [(i, json.dumps(r)) for i, (r, _) in enumerate(RECORDS)] + [(90, None), (91, "{"), (92, "")]
    found = chat.turns_from_json(spark.createDataFrame(rows, "conv_id long, record string")).collect()
    for i, (_, turns) in enumerate(RECORDS):
        own = sorted((r["turn"], r["role"], r["text"]) for r in found if r["conv_id"] == i and r["formed"])
        assert own == [(k, *t) for k, t in enumerate(turns or [])]
    assert {r["conv_id"] for r in found if not r["formed"]} == {10, 11, 90, 91, 92}
    nested = spark.sql(
        "SELECT 1L AS conv_id, array(named_struct('from', 'human', 'value', 'a'), named_struct('from', 'gpt', 'value', NULL))"
        " AS conversations, 5 AS turns"
    )
    assert [tuple(r)[1:4] for r in chat.turns_from_columns(nested).orderBy("turn").collect()] == [
        (0, "user", "a"), (1, "assistant", "")
    ]
    flat = spark.sql("SELECT 1L AS conv_id, 'p' AS prompt, 'c' AS completion")
    assert [tuple(r)[1:4] for r in chat.turns_from_columns(flat).orderBy("turn").collect()] == [
        (0, "user", "p"), (1, "assistant", "c")
    ]
    with pytest.raises(ValueError):
        chat.turns_from_columns(spark.sql("SELECT 1 AS conv_id, 2 AS nothing"))


def test_formatted_rows_and_edge_cases(spark):
    rows = [(1, 0, "user", "a<|im_end|>"), (1, 1, "assistant", "b<\\|"), (1, 1, "assistant", "b<\\|"), (2, 5, "assistant", None),
            (None, 0, None, "x"), (3, None, "user", "é" * 70_000), (3, 2, "a\nb\\", "<|im_start|>")]
    schema = "conv_id long, turn long, role string, text string"
    turns = chat.turns_from_columns(spark.createDataFrame(rows, schema).selectExpr("*", "1 AS loss_start"))
    formatted = chat.format_chats(turns)
    whole = {}
    for r in sorted(formatted.collect(), key=lambda r: (repr(r["conv_id"]), r["place"])):
        text, loss = whole.get(r["conv_id"], ("", ""))
        text += r["formatted"]
        whole[r["conv_id"]] = text, loss + chat.unescape(text[r["loss_start"] : r["loss_end"]])
    found = {r["conv_id"]: r for r in chat.read_back(formatted).collect()}
    assert found.keys() == whole.keys() == {1, 2, 3, None}
    for conv_id, (text, loss) in whole.items():
        own = sorted((r for r in rows if r[0] == conv_id), key=lambda r: (-1 if r[1] is None else r[1], r[2], r[3]))
        expected = [(r[2] or "", r[3] or "") for r in own]
        assert list(chat.parse(text)) == expected
        assert loss == "".join(t for role, t in expected if role == "assistant")
        r = found[conv_id]
        digest = hashlib.sha256("".join(f"{role}\n{t}\n" for role, t in expected).encode()).hexdigest()
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"]) == (len(own), digest, len(loss))
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest() and r["formatted_chars"] == len(text)
    empty = spark.createDataFrame([], schema)
    assert chat.read_back(chat.format_chats(chat.turns_from_columns(empty))).count() == 0


MORE = [
    ({"instruction": "i", "input": "n", "output": "o", "text": "all of it"}, [("user", "i"), ("user", "n"), ("assistant", "o")]),
    ({"system": "s", "instruction": "i", "output": "o"}, [("system", "s"), ("user", "i"), ("assistant", "o")]),
    ({"system": None, "instruction": "i", "output": "o"}, [("user", "i"), ("assistant", "o")]),
    ({"system": "s", "messages": [{"role": "user", "content": "a"}]}, [("system", "s"), ("user", "a")]),
    ({"prompt": "p", "response": "r", "text": "t", "question": "q"}, [("user", "p"), ("assistant", "r")]),
    ({"messages": []}, None),
    ({"messages": [{"role": "user"}]}, None),
    ({"text": "t"}, None),
]


@pytest.mark.parametrize("record, turns", MORE)
def test_layouts_with_further_fields(record, turns):
    assert chat.record_turns(record) == turns


def test_unformed_records_are_listed_and_not_formatted(spark):
    rows = [(i, json.dumps(r)) for i, (r, _) in enumerate(MORE)]
    turns = chat.turns_from_json(spark.createDataFrame(rows, "conv_id long, record string"))
    formatted = chat.format_chats(turns)
    assert {r["conv_id"] for r in formatted.collect()} == {0, 1, 2, 3, 4}
    assert sorted(r["conv_id"] for r in chat.unformed(turns).collect()) == [5, 6, 7]
    prefaced = spark.sql("SELECT * FROM VALUES (1L, 's', 'p', 'c'), (2L, NULL, 'q', 'd') t(conv_id, system, prompt, completion)")
    found = chat.turns_from_columns(prefaced).orderBy("conv_id", "turn").collect()
    assert [tuple(r)[:4] for r in found] == [
        (1, 0, "system", "s"), (1, 1, "user", "p"), (1, 2, "assistant", "c"), (2, 1, "user", "q"), (2, 2, "assistant", "d")
    ]
