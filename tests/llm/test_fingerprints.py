import hashlib
import random

import numpy as np
import pytest

from tracewell.llm import fingerprints as fp


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(data):
    groups = {}
    for key, text in data:
        groups.setdefault(lower(text), []).append(key)
    order = lambda k: (k is not None, k or 0)
    return sorted(((key, max(groups[lower(t)], key=order), len(groups[lower(t)]), hashlib.sha256(lower(t).encode()).hexdigest())
                   for key, t in data), key=str)


@pytest.mark.parametrize("n", [0, 1, 5, 3000])
def test_golomb_round_trip(n):
    numbers = np.sort(np.random.default_rng(n).choice(1 << 40, n, replace=False)).astype(np.int64)
    width, unary, binary = fp.encode(numbers, 1 << 40)
    assert fp.decode(n, width, unary, binary).tolist() == numbers.tolist()
    if n == 3000:
        assert len(unary) + len(binary) < n * 31 / 8  # 64 bits each as they are
    close = np.arange(n, dtype=np.int64)
    assert fp.decode(n, *fp.encode(close, max(1, n))).tolist() == close.tolist()


def sample():
    random.seed(3)
    data = [(i, random.choice(["a", "A", "b c", "É", "é", "", None, "İx", f"t{i}", "x" * 100_000])) for i in range(400)]
    return data + [(None, "a"), (None, "only"), (7, "twice"), (7, "TWICE"), (7, "twice")]


def test_against_brute_force(rows, monkeypatch):
    data = sample()
    df = rows(data, "doc_id long, text string").repartition(5).selectExpr("*", "1 AS key", "2 AS sha")
    got = fp.exact_duplicates(df, "doc_id", "text").collect()
    assert sorted(((r["key"], r["keep_key"], r["group_size"], bytes(r["sha"]).hex()) for r in got), key=str) == brute(data)
    assert sum(r["kept"] for r in got) == len({lower(t) for _, t in data})
    assert all(r["key"] == r["keep_key"] for r in got if r["kept"])


def test_rows_that_stay(rows):
    data = sample()
    df = rows(data, "doc_id long, text string").selectExpr("*", "1 AS key", "2 AS sha", "3 AS kept")
    left = fp.deduplicate(df, "doc_id", "text")
    assert left.columns == df.columns
    got = left.collect()
    assert len(got) == len({lower(t) for _, t in data})
    assert {(r["doc_id"], lower(r["text"])) for r in got} == {(k, t) for k, t in {
        lower(t): max((k2 for k2, t2 in data if lower(t2) == lower(t)), key=lambda k: (k is not None, k or 0))
        for _, t in data}.items() for k, t in [(t, k)]}


def test_no_rows(rows):
    df = rows([], "doc_id long, text string")
    assert fp.exact_duplicates(df, "doc_id", "text").count() == 0
    assert fp.deduplicate(df, "doc_id", "text").count() == 0
