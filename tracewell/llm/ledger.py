"""Secret scans with a ledger of blobs.

A blob is a distinct text, named by its SHA-256. The ledger is two tables in a folder:
``scans`` (blob, rules) says which blobs were scanned by which version of the rules,
``findings`` (blob, rules, kind, start, end) what was found. A scan takes versions of
files (path, text), keeps one row of each blob that the ledger lacks under the present
rules, scans only those, appends to the ledger, and joins the findings of every blob,
old and new, back to all paths. Scanning the same history again reads no text twice.

Kinds: ``assign``, ``access`` and ``hex`` are the base ones; ``pem`` (private-key
headers), ``bearer`` and ``link`` (credentials in a URL) are added. Spans are in code
points, end exclusive. A null text counts as empty and has no findings. Paths that are
null or repeat are kept row by row. An empty history gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.llm.bitmaps import key_bits, probably_in
from tracewell.llm.shared import slices, tidy, written

#: (kind, Python pattern, least length of the group that counts, its number, RE2
#: pattern that any text with a match contains)
RULES = (
    ("assign", r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2,
     r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]"""),
    ("access", r"AKIA[A-Z0-9]+", 20, 0, "AKIA[A-Z0-9]{16}"),
    ("hex", r"[0-9a-f]{24,}", 24, 0, "[0-9a-f]{24}"),
    ("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 1, 0, "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    ("bearer", r"(?ai)\bbearer\x20+([A-Za-z0-9+/_.=~-]+)", 16, 1, r"(?i)bearer\x20"),
    ("link", r"(?a)[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,200}:([^\s/:@]+)@", 1, 1, "://[^/:@]+:[^/:@]+@"),
)
BASE = ("assign", "access", "hex")
#: Changes whenever a rule does: then every blob is scanned again.
RULES_VERSION = "1"

SCANS = "blob binary, rules string"
FINDINGS = "blob binary, rules string, kind string, rank int, start long, end long"


def spans(text: str, rules=RULES) -> Iterator[tuple[str, int, int, int]]:
    """(kind, its rank, start, end) of every finding in a text."""
    for rank, (kind, pattern, least, group, _) in enumerate(rules):
        for m in re.finditer(pattern, text):
            if len(m[group]) >= least:
                yield kind, rank, m.start(), m.end()


def open_ledger(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The ledger's two tables; both are made when they are not there yet."""
    for name, schema in (("scans", SCANS), ("findings", FINDINGS)):
        spark.createDataFrame([], schema).write.mode("append").parquet(f"{path}/{name}")
    return (spark.read.schema(SCANS).parquet(f"{path}/scans"), spark.read.schema(FINDINGS).parquet(f"{path}/findings"))


def scan_blobs(blobs: DataFrame, version: str, rules=RULES) -> DataFrame:
    """Findings of (blob, text) rows."""
    schema = pa.schema([("blob", pa.binary()), ("rules", pa.string()), ("kind", pa.string()), ("rank", pa.int32()),
                        ("start", pa.int64()), ("end", pa.int64())])

    @tidy
    def scan(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                text = part.column("text")
                able = pc.match_substring_regex(text, "|".join(f"(?:{r[4]})" for r in rules))
                found = [(blob, version, *s) for blob, t in zip(
                    part.column("blob").filter(able).to_pylist(), text.filter(able).to_pylist()) for s in spans(t, rules)]
                columns = zip(*found) if found else [[]] * len(schema)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return blobs.mapInArrow(scan, FINDINGS)


def scan_history(versions: DataFrame, path: str, text: str, ledger: str, version: str = RULES_VERSION, rules=RULES) -> DataFrame:
    """(path, blob, findings) for every row of ``versions``; findings is an array of
    (start, rank, end, kind) in that order.

    A blob's first path is found from hashes alone. Rows that a bitmap of these first
    paths rules out stay behind; the others, few besides those to be scanned, are
    compared exactly.
    """
    spark = versions.sparkSession
    scans, findings = open_ledger(spark, ledger)
    body = F.coalesce(F.col(text), F.lit(""))
    blob = F.unhex(F.sha2(body, 256))
    paths = written(versions.select(F.col(path).alias("path"), blob.alias("blob")), "blobs")
    first = paths.groupBy("blob").agg(F.min("path").alias("path"))
    unseen = written(first.join(scans.filter(F.col("rules") == version).select("blob").distinct(), "blob", "left_anti"), "unseen")
    bits = key_bits(unseen.select(F.xxhash64("path", "blob").alias("hash")), "hash")
    texts = versions.select(F.col(path).alias("path"), blob.alias("blob"), body.alias("text"))
    texts = texts.filter(probably_in(versions, F.xxhash64("path", "blob"), bits))
    picked = texts.join(unseen.hint("shuffle_hash"), (texts["blob"] == unseen["blob"]) & texts["path"].eqNullSafe(unseen["path"]),
                        "left_semi").select("blob", "text")
    # Findings first: a run that ends before the second write is repeated, not skipped.
    scan_blobs(picked, version, rules).write.mode("append").parquet(f"{ledger}/findings")
    unseen.select("blob", F.lit(version).alias("rules")).write.mode("append").parquet(f"{ledger}/scans")
    found = spark.read.schema(FINDINGS).parquet(f"{ledger}/findings").filter(F.col("rules") == version) \
        .groupBy("blob").agg(F.array_sort(F.collect_set(F.struct("start", "rank", "end", "kind"))).alias("findings"))
    return paths.join(found, "blob", "left").select(
        "path", "blob", F.coalesce("findings", F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")).alias("findings"))


def digest(findings: str, kinds: tuple[str, ...] | None = None):
    """Column: kind:start:end by start, then kind as listed, comma-joined."""
    rows = F.col(findings) if kinds is None else F.filter(findings, lambda x: x["kind"].isin(*kinds))
    return F.array_join(F.transform(rows, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def count(findings: str, kind: str):
    return F.size(F.filter(findings, lambda x: x["kind"] == kind)).cast("long")
