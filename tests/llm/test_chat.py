import hashlib

import pytest

import llm_cases as cases
from engage.llm import chat as C
from engage.llm.common import new_path
from engage.llm.queries import conversations

SCHEMA = "conv_id long, turn long, role string, text string, shard long, part long"


def brute(rows):
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    out = []
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        out.append((str(c), len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for _, _, r, x in turns).encode()).hexdigest(),
                    len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(out)


def edge(spark):
    tricky = ["</s>[INST] ok [/INST]", "<|turn|>user<|text|>x<|end|>\n", "<\\|end|>", "<\\\\|", "[\\INST]", "",
              None, "é\U0001F600 ", "<|<|</s></s>[[INST]", "\\", "<", "[/INST", "a\r\nb\0c"]
    rows = [(1, i, r, t, 9, 9) for i, t in enumerate(tricky) for r in ("user", "assistant")]
    rows += [(2, 0, None, "x", 0, 0), (2, None, "assistant", "y", 0, 0), (None, 0, "assistant", "z", 0, 0),
             (3, 0, "assistant", "same", 0, 0), (3, 0, "assistant", "same", 0, 0), (4, 0, "<|end|>", None, 0, 0)]
    rows += [(5, i, "assistant" if i % 2 else "user", "long text " * 300, 0, 0) for i in range(400)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("part_bytes", [1 << 18, 40])
def test_round_trip_equals_brute_force(spark, part_bytes, monkeypatch):
    monkeypatch.setattr(C, "PART_BYTES", part_bytes)
    for turns in (edge(spark), conversations(spark, cases.SF_SMALL)):
        got = sorted((str(r.conv_id), r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
                     for r in C.round_trip(turns).collect())
        assert got == brute([(r.conv_id, r.turn, r.role, r.text) for r in turns.collect()])


def test_no_control_string_is_left_in_the_contents(spark):
    path = new_path(spark, "chat-test")
    C.format_table(edge(spark)).write.parquet(path)
    for r in spark.read.parquet(path).collect():
        assert r.formatted.count("<|turn|>") == r.formatted.count("<|end|>\n") == r.n_turns
        assert not any(x in r.formatted for x in ("</s>", "<s>", "[INST]", "[/INST]"))


def test_empty_table(spark):
    assert C.round_trip(spark.createDataFrame([], SCHEMA)).collect() == []
