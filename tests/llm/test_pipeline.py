import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_toccurrence import brute
from tracewell.llm.shared import written


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """What each stage returned, the input first."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf_dir), f"test-{name}")
        out.append(docs)
    return out


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_columns(stages):
    for docs in stages[1:-1]:
        assert docs.columns == stages[0].columns
    assert stages[-1].columns == [*stages[0].columns, "size", "taken"]


def test_language_id_keeps_clean_documents(stages):
    before, after = dict(pairs(stages[0])), dict(pairs(stages[1]))
    assert all(not any(c.isalpha() for c in before[k]) for k in before.keys() - after.keys())


def test_exact_dedup(stages):
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    last = {}
    for key, text in pairs(stages[1]):
        last[lower(text)] = max(key, last.get(lower(text), key))
    assert sorted(last.values()) == sorted(k for k, _ in pairs(stages[2]))


def test_jaccard_join(stages):
    names = {c for _, _, c in brute(pairs(stages[2]), 5, 80, 100)}
    assert sorted(names) == sorted(k for k, _ in pairs(stages[3]))


def test_decontamination(stages, spark, sf_dir):
    items = [r["text"].lower() for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    before, after = dict(pairs(stages[3])), dict(pairs(stages[4]))
    verbatim = {k for k, t in before.items() if any(i in t.lower() for i in items)}
    assert verbatim and not verbatim & after.keys()
    words = [set(i.split()) for i in items]
    for k in before.keys() - after.keys() - verbatim:  # others share most words of some item
        own = set(before[k].lower().split())
        assert any(len(w & own) >= 0.6 * len(w) for w in words)


def test_source_mix(stages):
    assert stages[-1].filter("taken <= 0 or taken > 2 * size").count() == 0
    total = stages[4].agg(F.sum(F.size(F.expr("regexp_extract_all(text, '[^\\\\x20\\\\x09-\\\\x0D]+', 0)")))).first()[0]
    assert stages[-1].agg(F.sum("taken")).first()[0] == pytest.approx(1.5 * total, rel=0.05)


def test_odd_rows(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    data = [(1, None, None, None, None), (None, "a text", "en", None, 6), (2, "", "en", "s", 0), (3, "a text", "en", "s", 6),
            (3, "a text", "en", "s", 6), (4, "A TEXT", None, "s", 6), (5, "word " * 40_000, "en", "s", 1), (6, "noch ein text", "de", "", 1)]
    for rows in (data, []):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, sf_dir), f"odd-{name}")
        assert docs.count() <= len(rows)
