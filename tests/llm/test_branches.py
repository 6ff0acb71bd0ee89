import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tracewell.llm import branches as b


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def build(text):
    """(root, [(section, [(paragraph, [piece])])]) with sizes, by the definition."""
    sections, run = [], []
    lines = (text or "").split("\n")
    for i, line in enumerate(lines):
        pieces = [(hashlib.md5(p.encode()).hexdigest()[:8], len(p)) for p in re.findall(b.PIECE, line + "\n")]
        assert sum(n for _, n in pieces) == len(line) + 1
        run.append((sha(line), len(line) + 1, pieces))
        if i == len(lines) - 1 or sha(line)[-1] < "4":
            sections.append((sha("".join(p[0] for p in run)), sum(p[1] for p in run), run))
            run = []
    return sha("".join(s[0] for s in sections)), sections


def render(text):
    root, sections = build(text)
    return root + "/" + ";".join(f"{s[:16]}{n}=" + ",".join(
        f"{p[:16]}{m}-" + ".".join(f"{h}{k}" for h, k in pieces) for p, m, pieces in run) for s, n, run in sections)


def likeness(one, other):
    (ra, a), (rb, c) = build(one), build(other)
    if ra == rb:
        return 1.0
    total = sum(s[1] for s in a) + sum(s[1] for s in c)
    shared, x, y = 0, a, c
    for depth in range(3):
        name = lambda t: str(t)
        cx, cy = Counter(map(name, x)), Counter(map(name, y))
        both = cx & cy
        sizes = {name(t): t[1] for t in x}
        shared += sum(sizes[k] * n for k, n in both.items())
        if depth < 2:
            by = {name(t): t[2] for t in [*x, *y]}
            x = [child for k, n in (cx - both).items() for _ in range(n) for child in by[k]]
            y = [child for k, n in (cy - both).items() for _ in range(n) for child in by[k]]
    return 2 * shared / total


def texts():
    random.seed(4)
    line = lambda: " ".join(random.choice(["the", "Café.", "x,y", "end!", "what?", "日本語", "𝒳", "a#1", "n=2;3/4-5"]) for _ in range(random.randint(0, 25)))
    out = ["\n".join(line() for _ in range(random.randint(1, 30))) for _ in range(40)]
    out += ["", None, "\n", "\n\n", "a", "same line.\n" * 40, "q" * 200_000, "..........!!!!!!!!!!?????????", "s. " * 3000]
    return out + [out[0], out[5] + "\nmore", out[6][:-3]]


@pytest.fixture(scope="module")
def pairs(spark):
    found = texts()
    data = [(x, y) for x in found[::3] for y in found[::4]] + [(t, t) for t in found] + list(zip(found, found[1:]))
    return spark.createDataFrame(data, "x string, y string").repartition(8)


def test_fingerprints_and_likeness(pairs):
    got = pairs.withColumns({"fx": b.fingerprint(F.col("x")), "fy": b.fingerprint(F.col("y"))}) \
        .withColumns({"like": b.likeness(F.col("fx"), F.col("fy")), "root": b.root(F.col("fx"))}).collect()
    for r in got:
        assert r["fx"] == render(r["x"]) and r["root"] == build(r["x"])[0]
        assert (r["fx"] == r["fy"]) == ((r["x"] or "") == (r["y"] or ""))
        assert r["like"] == pytest.approx(likeness(r["x"], r["y"]), abs=1e-12)
        assert 0 <= r["like"] <= 1 and (r["like"] == 1) == (r["fx"] == r["fy"]) or r["like"] == 1


def test_edits_are_located(rows):
    text = "\n".join(f"Line {i} says {i * i}." for i in range(60))
    lines = text.split("\n")
    changed = "\n".join(lines[:20] + ["Line 20 was changed."] + lines[21:40] + ["Put in between."] + lines[40:])
    got = rows([(text, changed), (text, text), (text, "\n".join(lines[:30])), ("", "new")], "x string, y string").select(
        "x", "y", b.edits(b.fingerprint(F.col("x")), b.fingerprint(F.col("y"))).alias("spans")).collect()
    marked = [[(r["y"] + "\n")[s["start"]:s["stop"]] for s in r["spans"]] for r in got]
    assert marked == [["Line 20 was changed.\n", "Put in between.\n"], [], [], ["new\n"]]


def brute(data):
    """(key, edited, next text) in the order that the operator states."""
    distinct = sorted(set(data), key=lambda r: (r[0] is None, -(r[0] or 0), sha(f"{'-' if r[0] is None else r[0]}:{r[1] or ''}")))
    out = {}
    for i, (key, text) in enumerate(distinct):
        text, follows = text or "", distinct[(i + 1) % len(distinct)][1] or ""
        out[key, text] = (text[:len(text) - len(text) // 3] + follows[:len(text) // 3], follows)
    return sorted(((k, t or "", *out[k, t or ""]) for k, t in data), key=str)


def test_edited_texts(rows):
    found = texts()
    data = [(i, t) for i, t in enumerate(found)] + [(None, "no key"), (3, "again"), (3, "again"), (3, found[3]), (10 ** 12, "ééé")]
    docs = rows(data, "doc_id long, text string").repartition(5).selectExpr("*", "1 AS id", "2 AS key", "3 AS pos", "4 AS edited")
    got = b.edited(docs, "doc_id", "text").collect()
    assert sorted(((r["key"], r["text"], r["edited"]) for r in got), key=str) == [r[:3] for r in brute([(k, t or "") for k, t in data])]
    assert sorted(r["next_print"] for r in got) == sorted(render(r[3]) for r in brute([(k, t or "") for k, t in data]))


def test_one_document_and_none(rows):
    got = b.compared(rows([(1, "abcdef")], "doc_id long, text string"), "doc_id", "text").first()
    assert got["edited"] == "abcdab" and got["near_next"] == 1.0
    assert b.compared(rows([], "doc_id long, text string"), "doc_id", "text").count() == 0
