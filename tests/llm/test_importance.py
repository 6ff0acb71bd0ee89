import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tracewell.llm import importance as im

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def runs(text, longest):
    found = words(text)
    return [" ".join(found[i:i + n]) for n in range(1, longest + 1) for i in range(len(found) - n + 1)]


def brute(docs, target, longest, buckets, percent, least, seed):
    crc = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(crc(f) for _, t in docs for f in runs(t, longest))
    t = Counter(crc(f) for x in target for f in runs(x, longest))
    S, T = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)}
    out = []
    for key, text in docs:
        found = runs(text, longest)
        weight = sum(gain[crc(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(words(text)), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[3], r[2]))
    for i, row in enumerate(able[:len(able) * percent // 100]):
        row[5] = i + 1
    return sorted(map(tuple, out), key=str)


def sample():
    random.seed(2)
    pool = ["the", "The", "é", "日本", "x9", "naïve", "\x85a", "b\xa0c", "w" * 1500, "don't", "a-b", "\0", "_", "𝒳y"]
    docs = [(i, " ".join(random.choice(pool) for _ in range(random.choice([0, 1, 19, 20, 60])))) for i in range(200)]
    docs += [(1000, None), (1001, ""), (1002, "--"), (None, "null key " * 30), (3, docs[3][1]), (3, docs[3][1])]
    docs += [(1003, "long " * 90_000), (1004, " ".join(f"w{i}" for i in range(300_000))), (1005, "q" * 3_000_000)]
    return docs, ["the the é", None, "x9 the naïve don't", ""]


@pytest.mark.parametrize("longest, buckets", [(1, 10_000), (3, 50)])
def test_against_brute_force(rows, longest, buckets):
    docs, target = sample()
    df = rows(docs, "doc_id long, text string").repartition(4).selectExpr("*", "1 AS key", "2 AS score", "3 AS pos")
    got = im.resampled(df, "doc_id", "text", rows([(t,) for t in target], "text string"), "text",
                       percent=30, longest=longest, buckets=buckets)
    got = sorted((tuple(r) for r in got.collect()), key=str)
    assert got == brute(docs, target, longest, buckets, 30, 20, 2024)


def test_composed_checksums():
    texts = [b"one two", b"", b"three", ("é " * 5 + "z" * 2000 + " end").encode()]
    bucket, of, n = im.features(texts, 3, 1 << 32 - 1)
    want = [(i, zlib.crc32(run.encode()) % (1 << 31)) for n_ in (1, 2, 3) for i, t in enumerate(texts)
            for run in (" ".join(words(t.decode())[k:k + n_]) for k in range(len(words(t.decode())) - n_ + 1))]
    assert list(zip(of.tolist(), bucket.tolist())) == want
    assert n.tolist() == [2, 0, 1, 7]
    a, b = b"some bytes", b"x" * 70_000
    assert im.combine(np.array([zlib.crc32(a)], np.uint32), np.array([zlib.crc32(b)], np.uint32), np.array([len(b)]))[0] == zlib.crc32(a + b)


def test_pieces_cover_the_text():
    text = (b"ab " * 700_000 + b"c" * 2_000_000 + b" d" + b" e" * 10).translate(im._PLAIN)
    pieces = list(im._pieces(text))
    assert b"".join(pieces) == text
    assert all(len(p) <= im.BLOCK_BYTES or b" " not in p for p in pieces)


def test_empty_tables(rows):
    none = rows([], "doc_id long, text string")
    assert im.resampled(none, "doc_id", "text", none, "text").count() == 0
    some = rows([(1, "word " * 25)], "doc_id long, text string")
    assert im.resampled(some, "doc_id", "text", none, "text", percent=100).first()["rank"] == 1
    assert im.resampled(some, "doc_id", "text", none, "text").first()["rank"] is None
