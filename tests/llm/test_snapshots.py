import random

import pytest

from tracewell.llm import snapshots


def brute(data):
    """Every conversation against every other."""
    logs = {}
    for conv, turn, role, text in set(data):
        logs.setdefault(conv, set()).add((turn is not None, turn or 0, role or "", text or ""))
    lists = {c: [(r, t) for *_, r, t in sorted(x)] for c, x in logs.items()}
    kept = {}
    for c, own in lists.items():
        equal = [o for o, x in lists.items() if x == own]
        first = min(equal, key=lambda o: (o is None, o or 0))
        if first == c and not any(len(x) > len(own) and x[:len(own)] == own for x in lists.values()):
            kept[c] = (len(own), len(equal), "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in own))
    return kept


def run(rows, data):
    df = rows(data, "conv_id long, turn int, role string, text string").selectExpr("*", "1 AS conv", "2 AS place", "3 AS n")
    got = snapshots.collapse_and_render(df, "conv_id", "turn", "role", "text").orderBy("part").collect()
    out = {}
    for r in got:
        old = out.get(r["conv"], (r["n"], r["copies"], ""))
        out[r["conv"]] = (*old[:2], old[2] + r["rendered"])
    return out


@pytest.mark.parametrize("part", [256, 2])
def test_against_all_pairs(rows, monkeypatch, part):
    monkeypatch.setattr(snapshots, "PART", part)
    random.seed(part)
    data = []
    for c in range(60):
        turns = [("user" if i % 2 == 0 else "assistant", random.choice("ab")) for i in range(random.randint(1, 5))]
        data += [(c, i * random.choice([1, 1, 1, 3]), r, t) for i, (r, t) in enumerate(turns)]
    data += data[:20] + [(100, None, None, None), (100, 1, "user", "x"), (None, 0, "user", "alone"), (101, 0, "user", "t" * 50_000),
                         (102, 0, "user", "t" * 50_000), (102, 1, None, ""), (103, 5, "user", "a"), (103, 5, "user", "b")]
    assert run(rows, data) == brute(data)


def test_no_rows(rows):
    assert run(rows, []) == {}


def test_long_conversation_comes_in_parts(rows):
    data = [(1, i, "user", str(i)) for i in range(600)] + [(2, i, "user", str(i)) for i in range(300)]
    assert run(rows, data) == brute(data)
    df = rows(data, "conv_id long, turn int, role string, text string")
    assert snapshots.collapse_and_render(df, "conv_id", "turn", "role", "text").count() == 3
