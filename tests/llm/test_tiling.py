import random

import numpy as np
import pytest

from tracewell.llm import tiling


def brute(item, doc, size):
    """Longest free match first; ties by item place, then document place."""
    free_i, free_d, tiles = [True] * len(item), [True] * len(doc), []
    while True:
        best = None
        for i in range(len(item)):
            for d in range(len(doc)):
                k = 0
                while i + k < len(item) and d + k < len(doc) and item[i + k] == doc[d + k] and free_i[i + k] and free_d[d + k]:
                    k += 1
                if k >= size and (best is None or k > best[2]):
                    best = (i, d, k)
        if best is None:
            return sorted(tiles)
        tiles.append(best)
        for k in range(best[2]):
            free_i[best[0] + k] = free_d[best[1] + k] = False


@pytest.mark.parametrize("seed", range(12))
def test_tiles(seed):
    random.seed(seed)
    letters = "abcde" if seed % 2 else "ab"
    for _ in range(15):
        item = [random.choice(letters) for _ in range(random.randint(2, 14))]
        doc = [random.choice(letters) for _ in range(random.randint(0, 6))] + item[5:] + item[:5] + item[3:7]
        for size in (2, 3):
            pairs = [(i, d) for i in range(len(item) - size + 1) for d in range(len(doc) - size + 1) if item[i:i + size] == doc[d:d + size]]
            got = sorted(tiling.tile(np.array(pairs), size, len(item))) if pairs else []
            assert got == brute(item, doc, size)


ITEM = "One two three four five six seven eight, nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
WORDS = ITEM.lower().replace(",", "").split()
BENCH = [(1, ITEM), (2, "short item"), (3, None), (4, "..."), (5, "Été «où» voilà déjà ainsi soit"), (1, ITEM)]


def found(rows, docs, bench=BENCH, **options):
    df = rows(docs, "doc_id long, text string").selectExpr("*", "1 AS key", "2 AS item")
    items = rows(bench, "item_id long, text string").selectExpr("*", "1 AS key")
    return df, items, tiling.contaminated(df, "doc_id", "text", items, "item_id", "text", **options)


def test_documents(rows):
    reordered = " ".join(["x"] * 30 + WORDS[10:] + ["y"] + WORDS[:10])
    docs = [(1, "Some words before. " + ITEM.upper() + " and after"), (2, reordered), (3, " ".join(WORDS[:15])), (4, " ".join(WORDS[:16])),
            (5, "a short-item here"), (6, None), (7, ""), (8, "ÉTÉ, où “voilà” déjà—ainsi soit"), (9, " ".join(w + " no" for w in WORDS)),
            (None, ITEM), (1, "clean"), (11, "word " * 50_000 + ITEM), (12, "five six seven " * 4)]
    df, items, got = found(rows, docs)
    pairs = sorted(((r["key"], r["item"]) for r in got.collect()), key=str)
    twice = [(1, 1), (2, 1), (4, 1), (11, 1), (None, 1)]
    assert pairs == sorted(twice * 2 + [(5, 2), (8, 5)], key=str)
    row = got.filter("key = 2").first()
    assert row["coverage"] == 1 and sorted(t[2] for t in row["tiles"]) == [10, 10]
    left = tiling.clean(df, "text", items, "item_id", "text")
    assert left.columns == df.columns
    assert sorted(((r[0], r[1]) for r in left.collect()), key=str) == sorted(
        [d for d in docs if (d[0], d[1]) not in [docs[i] for i in (0, 1, 3, 4, 7, 9, 11)]], key=str)


def test_blocks_and_empty_tables(rows, monkeypatch):
    monkeypatch.setattr(tiling, "BLOCK_BYTES", 60)
    _, _, got = found(rows, [(1, ITEM), (2, "short item"), (3, "none")])
    assert sorted((r["key"], r["item"]) for r in got.collect()) == [(1, 1), (1, 1), (2, 2)]
    assert found(rows, [])[2].count() == 0
    df, items, got = found(rows, [(1, ITEM)], [])
    assert got.count() == 0 and tiling.clean(df, "text", items, "item_id", "text").count() == 1


def test_whole_items_are_found(spark, sf_dir):
    """Every document that holds an item word for word, and none that shares few words."""
    from tracewell.llm.queries import op3_decontamination
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = {(r["doc_id"], r["item_id"]) for r in op3_decontamination(spark, sf_dir).collect()}
    verbatim = {(d, i) for d, text in docs for i, item in items if item.lower() in text.lower()}
    assert verbatim and verbatim <= got
