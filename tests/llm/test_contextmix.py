import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tracewell.llm import contextmix as cm
from tracewell.llm.queries import op7_lm_score


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def model(texts):
    code = cm.Code(np.bincount(cm.with_ends(pa.array(texts))[0], minlength=256))
    counts = np.zeros((cm.CONTEXTS, 2 << cm.TABLE_BITS), np.uint32)
    cm.count_bits(pa.array(texts), counts, code)
    own = counts.reshape(cm.CONTEXTS, -1, 2).astype(float)
    return cm.log_odds(own[:, :, 0], own[:, :, 1]), code, own


def brute_bits(text, tables, code, weights, rate):
    """One bit after the other."""
    raw = lower(text).encode() + b"\0"
    ctx = cm.contexts(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    w, bits, at, step = weights.astype(np.float64).copy(), 0.0, 0, 0
    while at < len(raw):
        stop = min(len(raw), at + cm.STRETCHES[min(step, len(cm.STRETCHES) - 1)])
        move = np.zeros_like(w)
        for i in range(at, stop):
            for d in range(code.length[raw[i]]):
                x = [float(tables[k][cm.slots(c[i:i + 1], code.node[d][raw[i]:raw[i] + 1])[0]]) for k, c in enumerate(ctx)] + [1.0]
                gate = 2 * min(d, 7) + (x[1] != 0)
                p = 1 / (1 + math.exp(-max(-15, min(15, float(w[gate] @ x)))))
                bit = code.bit[d][raw[i]]
                bits -= math.log2(p if bit else 1 - p)
                move[gate] += (bit - p) * np.array(x)
        w += rate * move / math.sqrt(stop - at)
        at, step = stop, step + 1
    return bits


def test_bits(monkeypatch):
    random.seed(4)
    texts = [" ".join(random.choices(["the", "cat", "sat", "Été", "on"], k=random.randint(0, 60))) for _ in range(30)] + ["", None, "x" * 3000]
    tables, code, _ = model(texts[:20])
    got, _ = cm.bits_of(pa.array(texts), tables, code, cm.start_weights(), 0.05)
    assert got == pytest.approx([brute_bits(t, tables, code, cm.start_weights(), 0.05) for t in texts], rel=1e-3)
    alone = [cm.bits_of(pa.array([t], pa.string()), tables, code, cm.start_weights(), 0.05)[0][0] for t in texts]
    assert got == pytest.approx(alone, rel=1e-5)


def test_counts_are_of_all_bits():
    texts = ["abc abd", "ABC", None]
    _, code, counts = model(texts)
    every = sum(int(code.length[b]) for t in texts for b in lower(t).encode() + b"\0")
    assert counts.sum(axis=(1, 2)).tolist() == [every] * cm.CONTEXTS


def test_code_is_a_prefix_code():
    code = cm.Code(np.random.default_rng(0).integers(0, 10**6, 256) ** 3)
    paths = {"".join(str(code.bit[d][b]) for d in range(code.length[b])) for b in range(256)}
    assert len(paths) == 256 and sum(2.0 ** -len(p) for p in paths) == 1
    assert not any(a != b and b.startswith(a) for a in paths for b in paths)


def brute_tokens(data):
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", lower(t)) + [None]
    counts = Counter(w for _, t, trains in data if trains for w in words(t))
    n, v = sum(counts.values()), len(counts)
    return sorted(((k, len(words(t)), sum(counts[w] > 0 for w in words(t)), n,
                    round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words(t)), 6)) for k, t, _ in data), key=str)


@pytest.mark.parametrize("block", [1 << 21, 50])
def test_token_scores(rows, monkeypatch, block):
    monkeypatch.setattr(cm, "BLOCK_TOKENS", block)
    random.seed(8)
    data = [(i, " ".join(random.choices("a b c d É é Zz\tzz".split(" "), k=random.randint(0, 30))), i % 3 > 0) for i in range(120)]
    data += [(None, "a b", True), (5, None, True), (6, "", False), (5, None, True), (7, "never seen", False), (7, "a " * 30_000, True)]
    df = rows(data, "doc_id long, text string, t boolean").repartition(4).selectExpr("*", "1 AS key", "2 AS name")
    got = cm.token_scores(df, "doc_id", "text", F.col("t")).collect()
    assert sorted(((r["key"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got), key=str) == brute_tokens(data)
    both = cm.scores(df, "doc_id", "text", F.col("t"))
    assert both.count() == len(data) and both.filter("score > 0 or score is null").count() == 0


def test_nothing_to_learn_from(rows):
    df = rows([(1, "some text")], "doc_id long, text string")
    row = cm.scores(df, "doc_id", "text", F.lit(False)).first()
    assert (row["train_tokens"], row["n_known"], row["n_tokens"]) == (0, 0, 3) and row["base_score"] == 0 and row["score"] < 0
    assert cm.scores(df.limit(0), "doc_id", "text", F.lit(True)).count() == 0


def test_held_out_texts_are_predicted(spark):
    got = op7_lm_score(spark, "/root/testdata/sf0.01").cache()
    held = got.filter("held_out and n_tokens > 50")
    mean = held.agg(F.sum(F.col("bits_per_byte") * F.col("n_tokens")) / F.sum("n_tokens")).first()[0]
    assert held.count() > 50 and mean < 2.9  # bytes alone have more than 4 bits
    assert got.agg(F.countDistinct("train_tokens")).first()[0] == 1
    got.unpersist()


def test_code_and_weights_are_of_all_training_texts(rows):
    random.seed(2)
    texts = [random.choice("abcdefghij") * random.randint(1, 9) for _ in range(6000)]
    mixer = cm.train(rows([(t,) for t in texts], "text string").coalesce(1), "text")
    code = cm.Code(np.bincount(cm.with_ends(pa.array(texts))[0], minlength=256))
    assert (mixer.code.length == code.length).all() and (mixer.code.node == code.node).all()
    # In two partitions; the weights are the mean by bytes.
    weights, share = {}, np.array([len(t) + 1.0 for t in texts])
    halves = [slice(0, 3000), slice(3000, 6000)]
    for i, half in enumerate(halves):
        weights[i] = cm.start_weights()
        for _ in range(2):
            _, ends = cm.bits_of(pa.array(texts[half]), mixer.tables, code, weights[i], 2 * cm.RATE)
            weights[i] = np.average(ends, axis=0, weights=share[half]).astype(np.float32)
    both = [rows([(t,) for t in texts[h]], "text string").coalesce(1) for h in halves]
    got = cm.train(both[0].union(both[1]), "text").weights
    want = np.average([weights[0], weights[1]], axis=0, weights=[share[h].sum() for h in halves])
    assert got == pytest.approx(want, abs=0.02)


def test_rows_of_weights_are_not_gathered_for_each_bit(monkeypatch):
    """The cost of a bit: weights are looked up column by column, sums taken without scattering every bit."""
    texts = pa.array(["the cat sat on the mat " * 200] * 4)
    tables, code, _ = model(texts.to_pylist())
    real, counted = np.bincount, []
    monkeypatch.setattr(cm.np, "bincount", lambda x, *a, **k: counted.append(len(x)) or real(x, *a, **k))
    cm.bits_of(texts, tables, code, cm.start_weights())
    bits = int(code.length[cm.with_ends(texts)[0]].sum())
    assert sum(counted) < bits  # five times as many before


def test_each_pair_of_contexts_and_byte_is_looked_up_once():
    texts = pa.array(["the cat sat on the mat " * 200] * 4)
    tables, code, _ = model(texts.to_pylist())
    looked = []

    class Table:
        def __init__(self, own):
            self.own = own

        def take(self, at):
            looked.append(len(at))
            return self.own.take(at)

    got, _ = cm.bits_of(texts, [Table(t) for t in tables], code, cm.start_weights())
    assert got == pytest.approx(cm.bits_of(texts, tables, code, cm.start_weights())[0])
    bits = int(code.length[cm.with_ends(texts)[0]].sum())
    assert sum(looked) < bits / 50  # three for each bit before


def test_one_of_each():
    rng = np.random.default_rng(5)
    for n, kinds in ((0, 1), (1, 1), (5000, 40), (5000, 4000)):
        key = rng.integers(0, 1 << 62, kinds).astype(np.uint64)[rng.integers(0, kinds, n)]
        stands = cm.one_of_each(key)
        assert (key[stands] == key).all() and (stands[stands] == stands).all()
        assert len(np.unique(stands)) <= 1.05 * len(np.unique(key))


def test_contexts_do_not_depend_on_pieces(monkeypatch):
    texts = ["é" * 400 + " a bc\tdef", None, "ABC", "", "ab c " * 90]
    data, starts = cm.with_ends(pa.array(texts))
    whole = cm.contexts(data, starts)
    monkeypatch.setattr(cm, "PIECE", 7)
    assert all((a == b).all() for a, b in zip(whole, cm.contexts(data, starts)))
    for a, b in zip(starts[:-1], starts[1:]):  # nor on neighbours
        assert all((w[a:b] == o).all() for w, o in zip(whole, cm.contexts(data[a:b], np.array([0, b - a]))))


def test_shared_weights_move_by_the_mean():
    random.seed(6)
    texts = [" ".join(random.choices(["the", "cat", "Été", "zzz"], k=k)) for k in (3, 30, 90)]
    tables, code, _ = model(texts[:2])
    size = [len(lower(t).encode()) + 1 for t in texts]
    want, low = cm.start_weights().astype(float), 0
    for length in cm.STRETCHES:
        move = np.zeros_like(want)
        for t, n in zip(texts, size):
            raw = lower(t).encode() + b"\0"
            ctx, own, at = cm.contexts(np.frombuffer(raw, np.uint8), np.array([0, n])), np.zeros_like(want), range(low, min(n, low + length))
            for i in at:
                for d in range(code.length[raw[i]]):
                    node = code.node[d][raw[i]:raw[i] + 1]
                    x = np.array([float(tables[k][cm.slots(c[i:i + 1], node)[0]]) for k, c in enumerate(ctx)] + [1.0])
                    gate = 2 * min(d, 7) + (x[1] != 0)
                    own[gate] += (code.bit[d][raw[i]] - 1 / (1 + math.exp(-max(-15, min(15, float(want[gate] @ x)))))) * x
            move += n / sum(size) * own / math.sqrt(max(1, len(at)))
        want += 0.05 * move
        low += length
    assert cm.learned(pa.array(texts), tables, code, cm.start_weights(), 0.05, 1) == pytest.approx(want, abs=1e-4)
