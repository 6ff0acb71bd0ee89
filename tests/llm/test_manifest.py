import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tracewell.llm import manifest as m
from tracewell.llm.ranks import placed

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes, fanout):
    """The root of ``nodes`` and each one's siblings, by the definition."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + fanout] for i in range(0, len(nodes), fanout)]
        for k, a in enumerate(at):
            proofs[k] += [n for j, n in enumerate(runs[a // fanout]) if j != a % fanout]
            at[k] = a // fanout
        nodes = [H(*run) for run in runs]
    return nodes[0], proofs


def brute(data, fanout=2):
    groups = {}
    for row in data:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees, out = {}, []
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = tree([leaf(r) for r in groups[g]], fanout)
    root, above = tree([trees[g][0] for g in order], fanout)
    for g, upper in zip(order, above):
        out += [(r[0], leaf(r), trees[g][0], root, H(*p, *upper)) for r, p in zip(groups[g], trees[g][1])]
    return sorted(out, key=str)


def sample(n):
    random.seed(n)
    langs = ["en"] * 9 + ["de", "", None, "é", "z", "Z", "ö"]
    data = [(i, random.choice([None, "web", "a:b"]), random.choice(langs), random.choice([None, 3, 12]),
             random.choice([None, "", "é" * 50_000, "-", f"text {i}"])) for i in range(n)]
    return data + [(None, None, None, None, None)] * 3 + [(5, "twice", "en", 1, "x")] * 2 + [(5, "more", "en", 1, "x")]


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("n, fanout, levels", [(0, 2, 3), (203, 2, 2), (120, 3, 1), (60, 2, 11), (70, 5, 0)])
def test_against_brute_force(rows, n, fanout, levels):
    data = sample(n)
    docs = rows(data, SCHEMA).repartition(5).selectExpr("*", "1 AS tree", "2 AS leaf", "3 AS key", "4 AS pos", "5 AS _row")
    columns = [F.col(c) for c in COLUMNS]
    got = m.manifest(docs, "doc_id", "lang", columns, m.leaf([F.lit("other")]), fanout, levels)
    got = got.select("*", F.sha2(m.proof_text(F.col("proof")), 256).alias("sha"), m.fold(F.col("leaf"), F.col("proof")).alias("up"),
                     m.fold(F.col("probe"), F.col("proof")).alias("down")).collect()
    assert sorted(((r["key"], r["leaf"], r["subroot"], r["root"], r["sha"]) for r in got), key=str) == brute(data, fanout)
    assert all(r["up"] == r["root"] != r["down"] for r in got)


def test_one_row_and_none(rows):
    docs = rows([(1, "s", "en", 4, "text")], SCHEMA)
    got = m.manifest(docs, "doc_id", "lang", [F.col("text")]).first()
    assert got["leaf"] == got["subroot"] == got["root"] == H("4:text") and got["proof"] == []
    assert m.manifest(docs.filter("doc_id > 1"), "doc_id", "lang", [F.col("text")]).count() == 0


def test_query_on_a_table_with_odd_rows(spark, rows, tmp_path):
    from tracewell.llm.queries import op13_merkle_manifest

    data = sample(90)
    rows(data, SCHEMA).selectExpr("*", "1 AS verified").write.parquet(f"{tmp_path}/documents.parquet")
    got = op13_merkle_manifest(spark, str(tmp_path)).collect()
    assert sorted(((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"]) for r in got), key=str) == brute(data)
    leaves = {leaf(r): r for r in data}
    for r in got:
        doc = leaves[r["leaf"]]
        tampered = zlib.crc32(str(doc[0] if doc[0] is not None else "").encode()) % 7 == 0 and doc[3] is not None
        assert r["verified"] == (not tampered) == (r["folded_root"] == r["root"])


def test_places_of_ties(rows):
    data = [(i % 3, 7) for i in range(900)]
    got = placed(rows(data, "g long, v long").repartition(4), [F.col("v")], "g").collect()
    for g in range(3):
        assert sorted(r["pos"] for r in got if r["g"] == g) == list(range(300))
    assert {r["total"] for r in got} == {300}
    got = placed(rows([(5,), (None,), (2,), (9,)], "v long"), [F.col("v").desc_nulls_last()]).collect()
    assert [r["v"] for r in sorted(got, key=lambda r: r["pos"])] == [9, 5, 2, None]
