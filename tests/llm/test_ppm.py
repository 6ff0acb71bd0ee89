import math
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tracewell.llm import ppm
from tracewell.llm.queries import op1_language_id


def brute_bits(texts, text, order=ppm.ORDER):
    """Byte by byte, with exclusion."""
    tree = defaultdict(Counter)
    for t in texts:
        raw = ppm.START.encode() + t.encode()
        for i in range(order, len(raw)):
            for k in range(order + 1):
                tree[raw[i - k:i]][raw[i]] += 1
    raw, bits = ppm.START.encode() + text.encode(), 0.0
    for i in range(order, len(raw)):
        out = set()
        for k in range(order, -1, -1):
            seen = tree.get(raw[i - k:i])
            if not seen:
                continue
            left = {b: c for b, c in seen.items() if b not in out}
            n, d = sum(left.values()), len(left)
            if raw[i] in left:
                bits -= math.log2(left[raw[i]] / (n + d))
                break
            if d:
                bits -= math.log2(d / (n + d))
            out |= set(left)
        else:
            bits += math.log2(256 - len(out))
    return bits


def test_code_lengths(rows):
    english, german = ["the cat sat on the mat", "a hat"], ["die katze saß auf der matte", "der hut"]
    data = rows([(i, t, g) for i, (t, g) in enumerate([(t, "en") for t in english] + [(t, "de") for t in german])],
                "doc_id long, text string, lang string")
    model = ppm.train(data, "text", "lang", F.col("doc_id"))
    assert model.languages == ["de", "en"]
    texts = ["the katze", "", "ß", "hat der", "Ünïcode", "the cat sat on the mat", "中文" * 40]
    got = model.bits(pa.array(texts))
    for text, row in zip(texts, got):
        assert row[0] == pytest.approx(brute_bits(german, text), rel=1e-5)
        assert row[1] == pytest.approx(brute_bits(english, text), rel=1e-5)


def test_probabilities_add_up(rows):
    model = ppm.train(rows([(1, "abracadabra", "x")], "doc_id long, text string, lang string"), "text", "lang", F.col("doc_id"))
    for context in (b"abr", b"rab", b"zzz", b"\n\n\n"):
        grams = [int.from_bytes(context + bytes([b]), "big") for b in range(256)]
        import numpy as np
        assert np.exp2(-model.trees[0].bits(np.array(grams))).sum() == pytest.approx(1)


def test_long_texts_score_as_a_whole(rows, monkeypatch):
    model = ppm.train(rows([(1, "abcab cabc", "x"), (2, "xyz zy x", "y")], "doc_id long, text string, lang string"),
                      "text", "lang", F.col("doc_id"))
    texts = pa.array(["abc " * 50, "", "zyx" * 30, "q"])
    whole = model.bits(texts)
    monkeypatch.setattr(ppm, "SLICE_BYTES", 7)
    assert model.bits(texts) == pytest.approx(whole)


def test_odd_rows(rows):
    data = rows([(1, "the cat", "en"), (None, "der hund", "de"), (3, None, "en"), (4, "", "de"), (5, "12 !?", None),
                 (1, "the cat", "en")], "doc_id long, text string, lang string").withColumn("language", F.lit(1))
    model = ppm.train(data, "text", "lang", F.col("doc_id"))
    got = [tuple(r) for r in ppm.predict(data, model, "text", "guess").select("text", "guess.lang", "guess.score").collect()]
    assert got.count(("the cat", "en", got[0][2])) == 2
    assert {(t, g) for t, g, _ in got} == {("the cat", "en"), ("der hund", "de"), (None, "und"), ("", "und"), ("12 !?", "und")}
    assert all(0 <= s <= 1 and (s == 0) == (g == "und") for _, g, s in got)
    none = ppm.train(data.limit(0), "text", "lang", F.col("doc_id"))
    assert {r[0] for r in ppm.predict(data, none, "text").select("language.lang").collect()} == {"und"}
    assert ppm.predict(data.limit(0), model, "text").count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = op1_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right, n = got.filter("held_out and lang is not null").select(
        F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 100 and right / n > 0.97
