import random
import re

import numpy as np
import pytest

from tracewell.llm import toccurrence as to
from tracewell.llm.components import components
from tracewell.llm.queries import op10_jaccard_join


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(data, size, at_least, of):
    """All pairs that share a shingle."""
    sets = [shingles(t, size) for _, t in data]
    parent, lists = list(range(len(data))), {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        for x in s:
            lists.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        near = {}
        for x in s:
            for j in lists[x]:
                if j < i:
                    near[j] = near.get(j, 0) + 1
        for j, both in near.items():
            if of * both >= at_least * (len(s) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(data):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return sorted(((key, len(sets[i]), least.get(find(i))) for i, (key, _) in enumerate(data)), key=str)


def families(seed, n, longest):
    """Texts with copies that differ in a few words, chained, and a passage in many."""
    random.seed(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = random.choices(vocabulary, k=15)
    texts = []
    while len(texts) < n:
        words = random.choices(vocabulary, k=random.randint(0, longest))
        if random.random() < 0.4:
            words = words + passage
        for _ in range(random.choice([1, 1, 1, 2, 4, 8])):
            texts.append(" ".join(w.upper() if random.random() < 0.1 else w for w in words))
            words = list(words)
            for _ in range(random.choice([0, 1, 1, 2, 3])):
                if words:
                    at = random.randrange(len(words))
                    words[at:at + 1] = random.choice([[], ["x"], [words[at], "y"]])
    return texts


@pytest.mark.parametrize(("size", "at_least", "unit"), [(3, 90, 2000), (5, 80, 2000), (3, 90, 3)])
def test_against_all_pairs(rows, monkeypatch, size, at_least, unit):
    monkeypatch.setattr(to, "UNIT", unit)
    texts = families(size, 250, 20) + families(unit, 150, 120) + [None, "", " \t", "one", "One", "a b", "b a", "z " * 3000]
    data = list(enumerate(texts)) + [(None, texts[0]), (None, "all alone here is a null"), (3, texts[3]), (3, texts[3])]
    df = rows(data, "doc_id long, text string").repartition(6).selectExpr("*", "1 AS name", "2 AS key", "3 AS id")
    got = to.jaccard_components(df, "doc_id", "text", size=size, at_least=at_least).collect()
    assert sorted(((r["key"], r["n"], r["component"]) for r in got), key=str) == brute(data, size, at_least, 100)


@pytest.mark.parametrize("seed", range(3))
def test_linked_sets_share_a_signature(seed):
    """Exactness of the candidates, empty parts included."""
    random.seed(seed)
    for at_least in (90, 80):
        rule = to.Rule(3, at_least, 100)
        for _ in range(300):
            n = random.choice([5, 9, 10, 12, 15, 20, 40, 100, 400])
            a = set(random.sample(range(10**6), n))
            b = set(a)
            for _ in range(random.randint(0, n // 6 + 1)):
                b.discard(random.choice(sorted(b))) if random.random() < 0.5 and len(b) > 1 else b.add(random.randrange(10**6, 2 * 10**6))
            if a == b or 100 * len(a & b) < at_least * len(a | b):
                continue
            both = [np.sort(to.mix(np.array(sorted(x), np.uint64))) for x in (a, b)]
            first = np.array([0, len(a), len(a) + len(b)])
            sig, of = to.signatures(np.concatenate(both), first, rule)
            assert set(sig[of == 0].tolist()) & set(sig[of == 1].tolist()), (n, len(a), len(b))


def test_components(rows):
    random.seed(5)
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 130)] + [(7, 7), (200, 201), (201, 200), (200, 201)]
    random.shuffle(edges)
    got = dict(tuple(r) for r in components(rows(edges, "a long, b long")).collect())
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 130), 100), 200: 200, 201: 200}
    assert components(rows([], "a long, b long")).count() == 0


def test_no_rows(rows):
    assert to.jaccard_components(rows([], "doc_id long, text string"), "doc_id", "text").count() == 0


def test_query_on_a_table(spark, sf_dir):
    data = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in op10_jaccard_join(spark, sf_dir).collect()), key=str) == brute(data, 3, 90, 100)


def test_one_document_of_each_group_stays(rows):
    texts = families(9, 200, 40) + ["", None, "x y", "X y"]
    data = list(enumerate(texts)) + [(3, texts[3]), (3, "another text for key three"), (None, texts[0]), (None, "null alone"), (None, "null alone")]
    df = rows(data, "doc_id long, text string").repartition(5).selectExpr("*", "1 AS key", "2 AS name", "3 AS component")
    left = to.one_of_each(df, "doc_id", "text")
    assert left.columns == df.columns
    component = {}
    for (key, text), c in zip(data, by_row(data)):
        component.setdefault(c, []).append((key, text))
    got = sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str)
    assert len(got) == sum(len(m) if not shingles(m[0][1], 5) else 1 for m in component.values())
    of = {}
    for c, members in component.items():
        for m in members:
            of[m] = c
    kept = [of[m] for m in got if shingles(m[1], 5)]
    assert len(kept) == len(set(kept))


def by_row(data):
    """Component number of each row, all pairs compared."""
    sets, parent = [shingles(t, 5) for _, t in data], list(range(len(data)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(data))]


def test_sets_that_share_little_are_not_compared(rows):
    """Texts with a passage in common, which chains them through parts of one shingle, have no links to look for."""
    random.seed(11)
    passage = [f"p{i}" for i in range(30)]
    texts = [" ".join([*(f"u{i}x{j}" for j in range(100)), *passage]) for i in range(40)]
    near = [texts[0] + " end", texts[1].replace("u1x50", "other")]
    df = rows(list(enumerate([*texts, *near])), "doc_id long, text string").repartition(4)
    nodes, sharing = to.often_shared(df, "doc_id", "text", to.Rule(5, 80, 100))
    names = {r["key"]: bytes(r["name"]) for r in nodes.collect()}
    assert len(names) == 42
    assert {bytes(r["name"]) for r in sharing.collect()} == {names[i] for i in (0, 1, 40, 41)}
    some, _ = to.candidates(df, "doc_id", "text", to.Rule(5, 80, 100), to.name_bits(sharing))
    assert sorted(r["key"] for r in some.collect()) == [0, 1, 40, 41]
