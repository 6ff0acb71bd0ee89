"""Exact duplicates by an exchange of Golomb-coded fingerprints.

1. Every partition hashes its texts (A-Z lowered, null as empty), sorts the distinct
   48-bit fingerprints, cuts them by owner and sends each owner one Golomb-Rice coded
   block. A text repeated within the block is sent once, marked.
2. An owner decodes its blocks, finds fingerprints that occur twice anywhere, and
   answers each block with a bitmap over its sorted fingerprints.
3. Rows whose bit is set are suspects. Only their texts are shuffled, grouped by the
   bytes themselves; a fingerprint shared by chance ends here.

Equal texts form a group, of which the row with the largest key stays; of rows that
also share the key, one. A null key is smaller than any other. Input without rows gives
no rows. Other columns are not looked at. Blocks and rows of step 1 are written to the
shared folder, so later steps survive a lost executor without reading texts again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell.llm.bitmaps import KeyBits, key_bits
from tracewell.llm.shared import lower_ascii, release, slices, tidy, written

FINGERPRINT_BITS = 48
#: Rows of a partition that go into one round of blocks.
BLOCK_ROWS = 1 << 17


def encode(sorted_numbers: np.ndarray, universe: int) -> tuple[int, bytes, bytes]:
    """Golomb-Rice code of distinct ascending numbers: the parameter, the quotients in
    unary, the remainders in binary."""
    n = len(sorted_numbers)
    if not n:
        return 0, b"", b""
    gaps = np.diff(sorted_numbers, prepend=np.int64(-1)) - 1
    width = max(0, int(np.log2(max(1.0, 0.69 * universe / n))))
    quotient, rest = gaps >> width, gaps & ((1 << width) - 1)
    unary = np.zeros(int(quotient.sum()) + n, np.uint8)
    unary[np.cumsum(quotient + 1) - 1] = 1
    binary = np.empty((n, width), np.uint8)
    for i in range(width):
        binary[:, i] = (rest >> (width - 1 - i)) & 1
    return width, np.packbits(unary).tobytes(), np.packbits(binary.ravel()).tobytes()


def decode(n: int, width: int, unary: bytes, binary: bytes) -> np.ndarray:
    if not n:
        return np.zeros(0, np.int64)
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[:n]
    quotient = np.diff(ends, prepend=-1) - 1
    rest = np.zeros(n, np.int64)
    if width:
        bits = np.unpackbits(np.frombuffer(binary, np.uint8))[:n * width].reshape(n, width)
        for i in range(width):
            rest = rest << 1 | bits[:, i]
    return np.cumsum((quotient << width | rest) + 1) - 1


def digests(text: pa.Array) -> list[bytes]:
    """SHA-256 of the normalised text of every row."""
    return [hashlib.sha256(x).digest() for x in memoryviews(lower_ascii(text))]


def memoryviews(binary: pa.LargeBinaryArray) -> Iterator[memoryview]:
    _, offsets, data = binary.buffers()
    ends, view = np.frombuffer(offsets, np.int64), memoryview(data)
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        yield view[a:b]


def fingerprints(sha: list[bytes]) -> np.ndarray:
    """The first bits of each digest, as signed 64-bit hashes."""
    return np.frombuffer(b"".join(sha), ">u8").reshape(-1, 4)[:, 0].astype(np.uint64).view(np.int64)


def text_digest(text: str):
    """Column: SHA-256 of the normalised text."""
    return F.arrow_udf(lambda t: pa.array(
        [d for part in slices(pa.RecordBatch.from_arrays([t], ["t"]), "t") for d in digests(part.column("t"))],
        pa.binary()), "binary")(F.col(text))


def exchange(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Steps 1 and 2: one row per input row: key, sha, block, pos, suspect."""
    owners = max(16, docs.rdd.getNumPartitions() // 8)
    key_type = docs.schema[key].dataType
    schema = T.StructType([T.StructField("kind", T.StringType()), T.StructField("block", T.StringType()),
                           T.StructField("owner", T.IntegerType()), T.StructField("pos", T.LongType()),
                           T.StructField("rank", T.IntegerType()), T.StructField("key", key_type),
                           T.StructField("sha", T.BinaryType()), T.StructField("width", T.IntegerType()),
                           T.StructField("quotients", T.BinaryType()), T.StructField("remainders", T.BinaryType()),
                           T.StructField("repeated", T.BinaryType())])
    step = -(-(1 << FINGERPRINT_BITS) // owners)

    def send(keys: list[pa.Array], sha: list[bytes], block: str):
        n = len(sha)
        prints = (fingerprints(sha).view(np.uint64) >> np.uint64(64 - FINGERPRINT_BITS)).astype(np.int64)
        distinct, where, times = np.unique(prints, return_inverse=True, return_counts=True)
        owner = distinct // step
        first = np.searchsorted(owner, np.arange(owners + 1))

        def nulls(kind, n):
            return pa.nulls(n, kind)

        yield pa.RecordBatch.from_arrays([
            pa.array(["row"] * n, pa.string()), pa.array([block] * n, pa.string()), pa.array(owner[where].astype(np.int32)),
            pa.array(np.arange(n)), pa.array((where - first[owner[where]]).astype(np.int32)),
            pa.concat_arrays(keys), pa.array(sha, pa.binary()), nulls(pa.int32(), n), nulls(pa.binary(), n),
            nulls(pa.binary(), n), nulls(pa.binary(), n)], schema.names)
        blocks = []
        for o in np.unique(owner):
            a, b = first[o], first[o + 1]
            width, quotients, remainders = encode(distinct[a:b] - o * step, step)
            blocks.append((int(o), int(b - a), width, quotients, remainders, np.packbits(times[a:b] > 1).tobytes()))
        m = len(blocks)
        owner_, size, width, quotients, remainders, repeated = zip(*blocks)
        yield pa.RecordBatch.from_arrays([
            pa.array(["block"] * m, pa.string()), pa.array([block] * m, pa.string()), pa.array(owner_, pa.int32()),
            pa.array(size, pa.int64()), nulls(pa.int32(), m), nulls(keys[0].type, m), nulls(pa.binary(), m),
            pa.array(width, pa.int32()), pa.array(quotients, pa.binary()), pa.array(remainders, pa.binary()),
            pa.array(repeated, pa.binary())], schema.names)

    @tidy
    def partition(batches):
        keys, sha, number = [], [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                keys.append(part.column("key"))
                sha += digests(part.column("text"))
                if len(sha) >= BLOCK_ROWS:
                    yield from send(keys, sha, f"{TaskContext.get().partitionId()}-{number}")
                    keys, sha, number = [], [], number + 1
        if sha:
            yield from send(keys, sha, f"{TaskContext.get().partitionId()}-{number}")

    sent = written(docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(partition, schema),
                   "fingerprints", "kind")

    def answer(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        prints = [decode(r["pos"], r["width"], r["quotients"], r["remainders"]) for r in rows]
        again = [np.unpackbits(np.frombuffer(r["repeated"], np.uint8))[:r["pos"]].astype(bool) for r in rows]
        _, where, times = np.unique(np.concatenate(prints), return_inverse=True, return_counts=True)
        double = np.concatenate(again) | (times[where] > 1)
        out, at = [], 0
        for p in prints:
            own = double[at:at + len(p)]
            words = np.zeros(-(-len(p) // 64) * 64, np.uint8)
            words[:len(p)] = own
            out.append(np.packbits(words, bitorder="little").view(np.int64))
            at += len(p)
        release()
        return pa.table({"block": pa.array([r["block"] for r in rows]), "owner": pa.array([r["owner"] for r in rows], pa.int32()),
                         "bits": pa.array(out, pa.list_(pa.int64()))})

    answers = sent.filter("kind = 'block'").select("block", "owner", "pos", "width", "quotients", "remainders", "repeated") \
        .groupBy("owner").applyInArrow(answer, "block string, owner int, bits array<long>")
    rows = sent.filter("kind = 'row'").select("block", "owner", "pos", "rank", "key", "sha")
    suspect = F.getbit(F.element_at("bits", (F.col("rank") / 64).cast("int") + 1), F.col("rank") % 64) == 1
    return rows.join(answers, ["block", "owner"]).select("key", "sha", "block", "pos", suspect.alias("suspect"))


def exact_duplicates(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row per input row: key, sha, keep_key, group_size, kept."""
    rows = written(exchange(docs, key, text), "suspects")
    alone, suspects = rows.filter("not suspect"), rows.filter("suspect")
    hashed = F.arrow_udf(lambda s: pa.array(fingerprints(s.to_pylist()) if len(s) else np.zeros(0, np.int64)), "long")
    bits = key_bits(suspects.select("sha").distinct().select(hashed("sha").alias("hash")), "hash")
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    @tidy
    def bodies(batches):
        bits: KeyBits = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                body = lower_ascii(part.column("text"))
                sha = [hashlib.sha256(x).digest() for x in memoryviews(body)]
                hit = pa.array(bits.hit(fingerprints(sha))) if sha else pa.array([], pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(sha, pa.binary()).filter(hit), body.cast(pa.binary()).filter(hit)],
                                                 ["sha", "body"])

    # Grouped by the bytes: copies meet in the task that reads them, then across tasks.
    same = docs.select(F.col(text).alias("text")).mapInArrow(bodies, "sha binary, body binary") \
        .groupBy("sha", "body").agg(F.count("*").alias("n"))
    verified = same.groupBy("sha").agg(F.sum("n").alias("n_bytes"), F.count("*").alias("n_texts"))
    keep = suspects.groupBy("sha").agg(F.max(F.struct("key", "block", "pos")).alias("keep"), F.count("*").alias("n"))
    checked = F.when((F.col("n_texts") == 1) & (F.col("n_bytes") == F.col("n")), F.col("n")).otherwise(
        F.raise_error(F.lit("texts changed between two reads, or differ with one SHA-256")).cast("long"))
    # Written, so that the join below has plain shuffles on both sides and a hot group can be split.
    groups = written(keep.join(verified, "sha").select("sha", "keep", checked.alias("group_size")), "groups")
    stays = (F.col("block") == F.col("keep.block")) & (F.col("pos") == F.col("keep.pos"))
    decided = suspects.join(groups, "sha").select("key", "sha", F.col("keep.key").alias("keep_key"), "group_size", stays.alias("kept"))
    return alone.select("key", "sha", F.col("key").alias("keep_key"), F.lit(1).cast("long").alias("group_size"),
                        F.lit(True).alias("kept")).unionByName(decided)


def deduplicate(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The rows of ``docs`` that stay, all columns. Where rows share key and text, the
    largest by its other columns stays."""
    decided = written(exact_duplicates(docs, key, text), "duplicates")
    dropped = decided.filter("group_size > 1").groupBy("key", "sha").agg(
        F.max("kept").alias("_stays"), F.count("*").alias("_times")).filter("not _stays or _times > 1") \
        .withColumnsRenamed({"key": "_k", "sha": "_s"})
    head = F.conv(F.hex(F.substring("_s", 1, 8)), 16, -10).cast("long")
    bits = key_bits(dropped.select(F.xxhash64("_k").bitwiseXOR(head).alias("hash")), "hash")
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    kind = pa.struct([("sha", pa.binary()), ("maybe", pa.bool_())])

    def marks(texts: pa.Array, keys: pa.Array) -> pa.Array:
        """Digest and bitmap in one function: two would take two Python workers for each task."""
        sha = [d for part in slices(pa.RecordBatch.from_arrays([texts], ["t"]), "t") for d in digests(part.column("t"))]
        maybe = shared.value.hit(fingerprints(sha) ^ keys.to_numpy(zero_copy_only=False).astype(np.int64)) if sha else []
        return pa.StructArray.from_arrays([pa.array(sha, pa.binary()), pa.array(maybe, pa.bool_())], fields=list(kind))

    marked = docs.withColumn("_marks", F.arrow_udf(marks, "sha binary, maybe boolean")(F.col(text), F.xxhash64(key)))
    marked = marked.select(*docs.columns, F.col("_marks.sha").alias("_sha"), F.col("_marks.maybe").alias("_maybe"))
    joined = marked.filter("_maybe").join(
        dropped, marked[key].eqNullSafe(dropped["_k"]) & (marked["_sha"] == dropped["_s"]), "left")
    one = joined.filter("_stays").groupBy("_k", "_sha").agg(
        F.max(F.struct(*docs.columns)).alias("_row")).select("_row.*")
    return marked.filter("not _maybe").select(*docs.columns).unionByName(
        joined.filter("_stays is null").select(*docs.columns)).unionByName(one)
