"""Importance resampling towards a target distribution of hashed word runs.

A text's features are its runs of 1 to ``longest`` words, hashed into buckets by crc32.
Texts are scanned with an Aho-Corasick automaton over their distinct words, each between
two delimiters, that carry the word's crc and length as payload. The crc of a run is composed
from its words' payloads, so no byte is hashed twice, however many runs cover it.

The dictionary belongs to a block of at most BLOCK_BYTES of text: its size does not
depend on the corpus, and no word of any text is missing from it.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.llm.ranks import placed
from tracewell.llm.shared import slices, text_bytes, tidy, written

#: Bytes of text that share a dictionary.
BLOCK_BYTES = 1 << 20
#: Longer words (bytes) are hashed where they stand: they would fill the automaton.
LONG_WORD = 1000

#: Words are runs of the digits, a-z after lower-casing, and all but ASCII.
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_LONG = re.compile(rb"[^ ]{%d,}" % (LONG_WORD + 1))
_CRC_SPACE = np.uint32(zlib.crc32(b" "))
_POLYNOMIAL = 0xEDB88320


@lru_cache(4096)
def _zeros(length: int) -> np.ndarray:
    """What appending ``length`` zero bytes does to a crc, as the images of its 32 bits."""
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    power = (bits >> np.uint32(1)) ^ np.where(bits & np.uint32(1), np.uint32(_POLYNOMIAL), np.uint32(0))  # one zero bit
    result = bits
    n = 8 * length
    while n:
        if n & 1:
            result = _apply(power, result)
        power, n = _apply(power, power), n >> 1
    return result


def _apply(images: np.ndarray, crc: np.ndarray) -> np.ndarray:
    out = np.zeros_like(crc)
    for bit in range(32):
        out ^= np.where((crc >> np.uint32(bit)) & np.uint32(1), images[bit], np.uint32(0))
    return out


def combine(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """crc32 of two byte strings end to end, from theirs and the second's length."""
    out = np.empty_like(first)
    for n in np.unique(length):
        some = length == n
        out[some] = _apply(_zeros(int(n)), first[some])
    return out ^ second


def _pieces(text: bytes) -> Iterator[bytes]:
    """``text`` in pieces of at most BLOCK_BYTES that end between words; a long word
    is a piece of its own."""
    at = 0
    for end in [*_LONG.finditer(text), None]:
        stop = end.start() if end else len(text)
        while at < stop:
            cut = stop
            if stop - at > BLOCK_BYTES:
                cut = text.rfind(b" ", at + 1, at + BLOCK_BYTES) + 1
            yield text[at:cut]
            at = cut
        if end:
            yield end.group()
            at = end.end()


def _scan(pieces: list[bytes]) -> list[np.ndarray]:
    """The payloads (crc | length << 32) of the words of every piece, in order."""
    automaton = ahocorasick.Automaton()
    for word in {word for piece in pieces if len(piece) <= LONG_WORD or b" " in piece for word in piece.split()}:
        automaton.add_word(f" {word.decode('latin-1')} ", zlib.crc32(word) | len(word) << 32)
    if len(automaton):
        automaton.make_automaton()
    out = []
    for piece in pieces:
        if len(piece) > LONG_WORD and b" " not in piece:
            out.append(np.array([zlib.crc32(piece) | len(piece) << 32], np.int64))
        elif len(automaton):
            found = automaton.iter(f" {piece.decode('latin-1')} ")
            out.append(np.fromiter((payload for _, payload in found), np.int64))
        else:
            out.append(np.zeros(0, np.int64))
    return out


def payloads(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(crc, length, first): crc and length of all words of all texts, and where each
    text's words begin (one more entry than texts)."""
    found: list[np.ndarray] = []
    counts = np.zeros(len(texts), np.int64)
    waiting, of, size = [], [], 0

    def flush():
        for i, words in zip(of, _scan(waiting)):
            found.append(words)
            counts[i] += len(words)

    for i, text in enumerate(texts):
        for piece in _pieces(text.translate(_PLAIN)):
            if waiting and size + len(piece) > BLOCK_BYTES:
                flush()
                waiting, of, size = [], [], 0
            waiting.append(piece)
            of.append(i)
            size += len(piece)
    flush()
    words = np.concatenate(found) if found else np.zeros(0, np.int64)
    return (words & 0xFFFFFFFF).astype(np.uint32), words >> 32, np.concatenate([[0], np.cumsum(counts)])


def features(texts: list[bytes], longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, text, words): the bucket of every feature and the text it belongs to; the
    number of words of each text."""
    crc, length, first = payloads(texts)
    words = np.diff(first)
    text = np.repeat(np.arange(len(texts)), words)
    run, at = crc, np.arange(len(crc))
    out, of = [run], [text]
    spaced = combine(np.full(len(crc), _CRC_SPACE), crc, length) if longest > 1 else None
    for n in range(2, longest + 1):
        inside = at + n - 1 < first[text[at] + 1] if len(at) else np.zeros(0, bool)
        at, run = at[inside], run[inside]
        last = at + n - 1
        run = combine(run, spaced[last], length[last] + 1)
        out.append(run)
        of.append(text[at])
    return (np.concatenate(out) % np.uint32(buckets)).astype(np.int64), np.concatenate(of), words


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    data, offsets = text_bytes(batch.column("text"))
    data = data.tobytes()
    return [data[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


def bucket_counts(docs: DataFrame, text: str, longest: int = 1, buckets: int = 10_000) -> np.ndarray:
    """How many features of all texts lie in each bucket. A task returns a row for
    each bucket at most, the driver gets ``buckets`` rows at most."""
    @tidy
    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, "text", BLOCK_BYTES):
                total += np.bincount(features(_texts(part), longest, buckets)[0], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    counted = docs.select(F.col(text).alias("text")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in counted.collect():
        out[row["bucket"]] = row["n"]
    return out


def log_ratios(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """floor(1000 ln(target share / source share)) of each bucket, one added to every count."""
    buckets = len(source)
    own = (target + 1).astype(np.float64) * float(source.sum() + buckets)
    other = (source + 1).astype(np.float64) * float(target.sum() + buckets)
    return np.array([math.floor(1000 * math.log(ratio)) for ratio in (own / other).tolist()], np.int64)


def weighed(docs: DataFrame, key: str, text: str, gains: np.ndarray, longest: int = 1) -> DataFrame:
    """(key, n_words, n_features, weight): the floored mean of the gains of a text's features;
    0 without any. ``gains`` has a number for each bucket, whatever the corpus."""
    buckets = len(gains)

    @tidy
    def weigh(batches):
        for batch in batches:
            for part in slices(batch, "text", BLOCK_BYTES):
                bucket, of, words = features(_texts(part), longest, buckets)
                n = np.bincount(of, minlength=part.num_rows)
                total = np.zeros(part.num_rows, np.int64)
                np.add.at(total, of, gains[bucket])
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(words), pa.array(n), pa.array(total // np.maximum(n, 1))],
                    ["key", "n_words", "n_features", "weight"])

    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return docs.mapInArrow(weigh, f"key {dict(docs.dtypes)['key']}, n_words long, n_features long, weight long")


def gumbel(key: Column, seed: int) -> Column:
    """floor(1000 g) for a Gumbel variable g that depends on the seed and the key alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296
    return F.floor(-1000 * F.log(-F.log(uniform)))


def resampled(docs: DataFrame, key: str, text: str, target: DataFrame, target_text: str, *, percent: int = 10,
              least_words: int = 20, longest: int = 1, buckets: int = 10_000, seed: int = 2024) -> DataFrame:
    """Draws ``percent`` of the documents with at least ``least_words`` words, without
    replacement and in proportion to how much likelier the target makes their features
    (the highest weights plus Gumbel noise).

    Returns for every row of ``docs``: ``key``, ``n_words``, ``n_features``, ``weight``,
    ``score`` and ``rank`` (from 1; null where not drawn). Ties go to the smaller key,
    null first; rows with one key and score are ordered by weight and features. A
    null text counts as empty; a null key as empty text in the noise. An empty target or table is
    a distribution without counts. Further columns of either table are not read.
    """
    source = bucket_counts(docs, text, longest, buckets)
    gains = log_ratios(bucket_counts(target, target_text, longest, buckets), source)
    scored = weighed(docs, key, text, gains, longest).withColumn("score", F.col("weight") + gumbel(F.col("key"), seed))
    scored = written(scored.withColumn("eligible", F.col("n_words") >= least_words), "scored")
    drawn = scored.filter("eligible").count() * percent // 100
    order = [F.col("eligible").desc(), F.col("score").desc(), F.col("key").asc_nulls_first(), F.col("weight"), F.col("n_features")]
    return placed(scored, order).select(
        "key", "n_words", "n_features", "weight", "score", F.when(F.col("pos") < drawn, F.col("pos") + 1).alias("rank"))
