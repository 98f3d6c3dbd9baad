from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest
from llm_cases import saved

from ampflow.llm import repair as R

TURNS = "conv_id long, turn long, role string, text string"
PATTERN = re.compile("(s?(ua)+)?")


def applied(rows, audit):
    """The pattern that an audit gives, with its cost; None if it cannot be applied."""
    out, cost, rest = "", 0, list(rows)

    def wanted():
        return "a" if out.endswith("u") else "u"

    for kind in audit:
        if kind == "I":
            out, cost = out + wanted(), cost + 2
            continue
        if not rest:
            return None
        initial, fault = rest.pop(0)
        if kind == "D":
            cost += 3
        elif fault in ("B", "D"):
            return None
        else:
            out += initial if kind == "K" else wanted()
            cost += (2 if kind == "R" else 0) + (fault == "T")
    return None if rest or not PATTERN.fullmatch(out) else cost


def brute_audit(rows):
    """All audits with at most one insertion before each row and two at the end."""
    best = None
    for kinds in itertools.product("KRD", repeat=len(rows)):
        for holes in itertools.product(("", "I"), repeat=len(rows)):
            for end in ("", "I", "II"):
                audit = "".join(h + k for h, k in zip(holes, kinds, strict=True)) + end
                cost = applied(rows, audit)
                if cost is not None and (best is None or (cost, audit) < best):
                    best = cost, audit
    return best


def test_lightest_derivations_against_all_audits():
    rng = random.Random(4)
    cases = [[]] + [[(rng.choice("uuaasx"), rng.choice(["", "", "", "T", "B", "D"])) for _ in range(rng.randint(1, 5))] for _ in range(150)]
    for rows in cases:
        assert R.repair(rows) == brute_audit(rows), rows


def test_joined_spans_equal_one_agenda(monkeypatch):
    rng = random.Random(5)
    for _ in range(60):
        rows = [(rng.choice("uaus "), rng.choice(["", "", "T", "B", "D"])) for _ in range(rng.randint(1, 40))]
        whole = R.repair(rows)
        monkeypatch.setattr(R, "STRETCH", 3)
        assert R.repair(rows) == whole
        monkeypatch.setattr(R, "STRETCH", 48)


def test_items_are_final_when_popped_and_goal_ends_the_work():
    rows = [("u", ""), ("u", "T"), ("a", ""), ("a", "")]
    final = R.lightest(rows)
    weights = list(final.values())
    assert weights == sorted(weights) and list(final)[-1] == ("goal",)
    assert len(final) < len(R.lightest(rows, goal=False))


def expected(turns):
    """Every conversation by plain Python, with the order of rows within a turn that the operator defines."""
    convs = {}
    for conv, turn, role, text in turns:
        shown = [" " if v is None else str(v) for v in (conv, turn, role, text)]
        code = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        rows = convs.setdefault(conv, [])
        role, text = shown[2:]
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        role = "user" if code == 4 else role
        rows += [(turn, role, text)] * (2 if code == 3 else 1)
    out = []
    for conv, rows in convs.items():
        digest = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, digest(r)))
        seen, marks = set(), []
        for _, role, text in rows:
            signs = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "B" if not signs else "D" if (role, text) in seen else "T" if signs[-1] not in ".!?" else ""
            seen.add((role, text))
            marks.append((role[:1], fault))
        cost, audit = R.repair(marks)
        state, kept, left = "", [], list(rows)
        for kind in audit:
            wanted = "assistant" if state.endswith("u") else "user"
            if kind == "I":
                role, text = wanted, ""
            else:
                _, role, text = left.pop(0)
                if kind == "D":
                    continue
                role = wanted if kind == "R" else role
            state += role[:1]
            kept.append(f"{role}:{text}")
        dated = [t for t, _, _ in rows if t is not None]
        gaps = max(dated) - min(dated) + 1 - len(set(dated)) if dated else 0
        faults = [f for _, f in marks]
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marks, marks[1:], strict=False))
        counts = [faults.count(f) for f in "BDT"]
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(rng):
    texts = ["Well.", "no stop", "", " \t", "Ends!\n ", "why?", "same.", "a.b", "é"]
    roles = ["user", "assistant", "system", "tool", "", None]
    turns = []
    for conv in range(150):
        for turn in range(rng.randint(1, 9)):
            turns.append((conv, turn * rng.choice([1, 1, 1, 2]), rng.choices(roles, [8, 8, 2, 1, 1, 1])[0], rng.choice([*texts, None])))
    turns += [(500, turn, rng.choice(["user", "assistant"]), f"{rng.choice(texts)} {turn % 400}.") for turn in range(1500)]
    turns += [(None, turn, "user", "x.") for turn in (3, None, 4, None)] + [(600, None, "user", "y."), (601, 1, None, None)]
    return turns + [(602, 1, "user", "twice."), (602, 1, "user", "twice."), (602, 1, "assistant", "other.")] + [(700 + i, 0, "user", "alone.") for i in range(30)]


@pytest.mark.parametrize("width", ["2", "7"])
def test_query_against_plain_python(spark, tmp_path, width):
    turns = conversations(random.Random(int(width)))
    held = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", width)
    try:
        stored = spark.createDataFrame(turns, TURNS).selectExpr("*", "1 AS audit", "2 AS copies", "'x' AS kind").repartition(5)
        got = R.op13_repair(spark, saved(spark, tmp_path, conversations=stored)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)
    want = expected(turns)
    assert sorted(map(tuple, got), key=repr) == want
    assert any(w[7] == "" and w[8] == hashlib.sha256(b"").hexdigest() for w in want)


def test_repaired_turns(spark):
    turns = spark.createDataFrame(conversations(random.Random(1)), TURNS)
    rows = R.damaged(turns)
    found = R.repairs(R.marked(rows)).cache()
    made = {}
    for r in sorted(R.repaired_turns(found, rows).collect(), key=lambda r: (repr(r.conv_id), r.place)):
        made.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for r in R.repaired_digests(found, rows).collect():
        assert hashlib.sha256("\n".join(made.get(r.conv_id, [])).encode()).hexdigest() == r.repaired_sha256
        assert PATTERN.fullmatch("".join(t[0] for t in made.get(r.conv_id, [])))


def test_empty_table(spark, tmp_path):
    assert R.op13_repair(spark, saved(spark, tmp_path, conversations=spark.createDataFrame([], TURNS))).collect() == []
