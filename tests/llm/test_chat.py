from __future__ import annotations

import hashlib
import random

import pytest
from llm_cases import LONG, saved

from ampflow.llm import chat as S

TURNS = "conv_id long, turn int, role string, text string"
PIECES = ["[INST] ", " [/INST]", "<s>", "</s>", "\\", "[", "<", "[SYS]", "\\[INST]", "[\\INST]", "<\\\\s>", "[ROLE]", "[/ROLE][TURN] ", " [/TURN]", "é🙂", " ", "\n"]


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    out = {}
    for conv, turns in groups.items():
        turns.sort(key=lambda r: (r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode()))
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.mark.parametrize("size", [200, 1 << 20])
def test_random_turns_come_back(spark, monkeypatch, size):
    monkeypatch.setattr(S, "PIECE_BYTES", size)
    rng = random.Random(size)
    roles = ["user", "assistant", "system", None, "tool[/ROLE]", "", "x\\"]
    rows = [
        (rng.choice([None, 1, 2, 3]), rng.choice([None, *range(20)]), rng.choice(roles), rng.choice([None, "".join(rng.choices(PIECES, k=rng.randint(0, 12)))]))
        for _ in range(900)
    ]
    got = S.read_back(S.format_conversations(spark.createDataFrame(rows, TURNS))).collect()
    assert {r.conv_id: tuple(r)[1:5] for r in got} == brute(rows) and len(got) == 4


def test_no_control_string_of_a_text_survives(spark):
    rows = [(1, 0, "user", "".join(PIECES))]
    formatted = S.format_conversations(spark.createDataFrame(rows, TURNS)).collect()[0].formatted
    inside = formatted[len("[INST] ") : -len(" [/INST]")]
    assert not any(mark in inside for mark in ("[INST]", "[/INST]", "<s>", "</s>", "[SYS]", "[ROLE]", "[TURN]"))


def test_query(spark, tmp_path):
    rows = [(4, 1, "assistant", LONG), (4, 0, "user", None), (9, 0, "assistant", ""), (9, 0, "assistant", "")]
    got = S.op5_chat(spark, saved(spark, tmp_path, conversations=spark.createDataFrame(rows, TURNS))).collect()
    added = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    assert {r.conv_id: tuple(r)[1:5] for r in got} == brute(rows + added)
    assert [r.loss_chars for r in got if r.conv_id == -1] == [21]


def test_empty_table(spark, tmp_path):
    rows = spark.createDataFrame([], TURNS)
    assert S.read_back(S.format_conversations(rows)).collect() == []
    assert [r.conv_id for r in S.op5_chat(spark, saved(spark, tmp_path, conversations=rows)).collect()] == [-1]
