import hashlib
import json

import pytest
from pyspark.sql import functions as F

from cabmill.llm import chat_format as C

HARD = ["</s>[INST] ok [/INST]", "<|im_end|><|im_start|>user<|im_sep|>", "a\\b\\\\<\\|", "<<s>|", "", None,
        "é🙂\n\t\"quoted\"", "\\", "<", "|x", "x" * 30_000, "[INST", "<<SYS>> $1 \\$1"]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_reads_back_exactly(spark):
    rows, want = [], {}
    for c in range(30):
        roles = [["user", "assistant"], ["system", "user", "assistant"], ["assistant"], ["user"] * 3, ["tool|", None]][c % 5]
        turns = [(c, i, r, HARD[(c * 3 + i * 5) % len(HARD)]) for i, r in enumerate(roles)]
        rows += turns
        want[c] = [(r or "", t or "") for _, _, r, t in turns]
    rows += [(None, 0, "user", "no id"), (0, 0, "user", rows[0][3])]
    want[None], want[0] = [("user", "no id")], [want[0][0], *want[0]]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, record string")
    got = {r.conv_id: r for r in C.conversation_digests(frame).collect()}
    assert set(got) == set(want)
    for c, turns in want.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == digest("".join(f"{r}\n{t}\n" for r, t in turns))
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), digest(loss))
    assert C.conversation_digests(frame.limit(0)).count() == 0


def test_layouts_by_fingerprint(spark):
    records = {
        "messages": {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": None}]},
        "message_list": [{"role": "user", "content": "q"}],
        "from_value": {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        "prompt": {"completion": "a", "prompt": "q"}, "response": {"prompt": "q", "response": "a"},
        "question": {"question": "q", "answer": "a"}, "instruction": {"instruction": "q", "output": "a", "system": "s"},
        "instruction_input": {"instruction": "q", "input": "i", "output": "a"},
    }
    rows = [(k, json.dumps(v)) for k, v in records.items()] + [("other", '{"x": 1}'), ("broken", "{"), ("null", None)]
    got = {r.name: r for r in C.canonical_turns(spark.createDataFrame(rows, "name string, record string")).collect()}
    for name in records:
        assert got[name].layout == name
    assert [tuple(t) for t in got["from_value"].turns] == [("user", "q"), ("assistant", "a")]
    assert [tuple(t) for t in got["instruction"].turns] == [("system", "s"), ("user", "q"), ("assistant", "a")]
    assert [tuple(t) for t in got["messages"].turns] == [("user", "q"), ("assistant", "")]
    assert all(got[n].layout is None and got[n].turns is None for n in ("other", "broken", "null"))


def test_no_control_string_is_left_in_texts(spark):
    t = C.Template()
    rows = spark.createDataFrame([(x,) for x in HARD if x], "text string")
    for text, escaped, back in rows.select("text", t.escape(F.col("text")), t.unescape(t.escape(F.col("text")))).collect():
        assert back == text
        assert not any(c in escaped for c in ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>"))


def test_no_python_in_the_plan(spark, capsys):
    frame = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    C.conversation_digests(frame).explain()
    assert "Python" not in capsys.readouterr().out


def test_texts_beyond_the_parsers_limits(spark):
    size = C.PARSER_CHARS + 1_000_000
    rows = spark.createDataFrame(
        [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "tool", "c"), (3, 0, "\x01", "d"), (3, 1, "r" * 100, "e")],
        "conv_id long, turn long, role string, text string",
    ).withColumn("text", F.when(F.col("conv_id") < 3, F.expr(f"repeat(text, {size})")).otherwise(F.col("text")))
    got = {r.conv_id: r for r in C.conversation_digests(rows).collect()}
    assert got[1].turns_sha256 == digest("user\n" + "a" * size + "\nassistant\n" + "b" * size + "\n")
    assert (got[1].loss_chars, got[1].loss_sha256) == (size, digest("b" * size))
    assert got[2].turns_sha256 == digest("tool\n" + "c" * size + "\n") and got[2].n_turns == 1
    assert got[3].turns_sha256 == digest("\x01\nd\n" + "r" * 100 + "\ne\n")


def test_a_record_beyond_the_limits_is_an_error(spark):
    text = F.expr(f"repeat('a', {C.PARSER_CHARS + 1_000_000})")
    record = spark.range(1).select(F.to_json(F.struct(text.alias("prompt"), F.lit("b").alias("completion"))).alias("record"))
    with pytest.raises(Exception, match="parser's limits"):
        C.canonical_turns(record).select(F.size("turns")).collect()
