"""Benchmark decontamination by greedy string tiling with running Karp-Rabin hashes.

Words are lower-cased runs of letters and digits. Rolling hashes of every ``shortest``
words of a document are looked up among those of all test items; shared ones are the
seeds, and seeds that follow each other on both sides grow into matches. The longest
match whose words are free on both sides is marked as a tile; what other matches lose to
it is cut off, and the search goes on until no free match of ``shortest`` words is left.
An item is found in a document when its tiles cover ``threshold`` of the item's words,
in whatever order they stand.

An item of fewer words than ``shortest`` must occur whole. Items and documents without
words match nothing. Of matches of one length, the first in the item, then in the
document, goes first. Repeated rows and repeated items are each reported. Extra columns
are not looked at.

The items are a test set: they are sent to all tasks in blocks of about ``BLOCK_BYTES``
of text, each block in a pass over the documents, so memory has a bound for any number.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell.llm.shared import release, slices, text_bytes, tidy
from tracewell.llm.words import BASE, mix, number_spans, split_words

SHORTEST = 5
THRESHOLD = 0.8
BLOCK_BYTES = 16 << 20

_apart = np.ones(256, bool)
for _from, _to in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _apart[_from:_to] = False


def tokens(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words, and where each text's begin. Signs of Latin-1 and of the
    block U+2000-U+203F part words as ASCII's do."""
    data, offsets = text_bytes(text)
    data = data.copy()
    if len(data) > 1:
        two = np.flatnonzero((data[:-1] == 0xC2) & ~np.isin(data[1:], (0xAA, 0xB5, 0xBA)))
        data[two] = data[two + 1] = 32
    if len(data) > 2:
        three = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x80))
        data[three] = data[three + 1] = data[three + 2] = 32
    starts, ends = split_words(data, offsets, _apart)
    return number_spans(data, starts, ends), np.searchsorted(starts, offsets)


def rolled(numbers: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hash of every ``size`` words in a row."""
    out = np.zeros(max(0, len(numbers) - size + 1), np.uint64)
    for i in range(size):
        out = out * np.uint64(BASE) + numbers[i:len(numbers) - size + 1 + i]
    return mix(out + np.uint64(size))


def tile(pairs: np.ndarray, size: int, item_words: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (item start, document start, length) from seeds (item place, document
    place) of ``size`` words."""
    order = np.lexsort((pairs[:, 0], pairs[:, 1] - pairs[:, 0]))
    item, doc = pairs[order, 0], pairs[order, 1]
    cut = np.flatnonzero((np.diff(item) != 1) | (np.diff(doc) != 1)) + 1
    starts, ends = np.append(0, cut), np.append(cut, len(item))
    heap = [(-int(b - a + size - 1), int(item[a]), int(doc[a])) for a, b in zip(starts, ends)]
    heapq.heapify(heap)
    marked_item, marked_doc, tiles = np.zeros(item_words, bool), set(), []
    while heap and not marked_item.all():
        length, i, d = heapq.heappop(heap)
        taken = marked_item[i:i - length] | np.fromiter((d + k in marked_doc for k in range(-length)), bool, -length)
        if not taken.any():
            marked_item[i:i - length] = True
            marked_doc.update(range(d, d - length))
            tiles.append((i, d, -length))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[True], taken, [True]])))
        for a, b in zip(edges[::2], edges[1::2]):
            if b - a >= size:
                heapq.heappush(heap, (-int(b - a), i + int(a), d + int(a)))
    return tiles


class Items:
    """Seeds of a block of test items."""

    def __init__(self, ids: pa.Array, text: pa.Array, shortest: int):
        numbers, first = tokens(text)
        self.ids, self.words = ids, np.diff(first)
        self.by_size = {}
        for size in range(1, shortest + 1):
            own = np.flatnonzero(self.words >= shortest if size == shortest else self.words == size)
            if not len(own):
                continue
            places = np.concatenate([np.arange(first[i], first[i + 1] - size + 1) for i in own])
            item = np.repeat(own, self.words[own] - size + 1)
            seed = rolled(numbers, size)[places]
            order = np.argsort(seed, kind="stable")
            seed = seed[order]
            bits = np.zeros(1 << 22, bool)
            bits[seed >> np.uint64(42)] = True
            self.by_size[size] = (bits, seed, item[order], (places - first[item])[order])

    def find(self, text: pa.Array, threshold: float) -> Iterator[tuple[int, int, list]]:
        """(row, item, tiles) of each item found in a text."""
        numbers, first = tokens(text)
        row = np.repeat(np.arange(len(text)), np.diff(first))
        for size, (bits, seed, item, place) in self.by_size.items():
            hashes = rolled(numbers, size)
            at = np.flatnonzero(bits[hashes >> np.uint64(42)])
            at = at[row[at] == row[at + size - 1]]
            low, high = np.searchsorted(seed, hashes[at]), np.searchsorted(seed, hashes[at], "right")
            many = high - low
            where = np.repeat(at, many)
            k = np.arange(len(where)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
            order = np.lexsort((item[k], row[where]))
            where, k = where[order], k[order]
            group = np.stack([row[where], item[k]], 1)
            cuts = np.flatnonzero((np.diff(group, axis=0) != 0).any(1)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(where)]) if len(where) else ():
                r, i = int(group[a, 0]), int(group[a, 1])
                places = np.unique(place[k[a:b]])
                covered = np.minimum(np.diff(places, append=places[-1] + size), size).sum()
                need = threshold * self.words[i]
                if covered < need:  # even if all seeds became tiles
                    continue
                tiles = tile(np.stack([place[k[a:b]], where[a:b] - first[r]], 1), size, int(self.words[i]))
                if sum(t[2] for t in tiles) >= need:
                    yield r, i, sorted(tiles)


def blocks(items: DataFrame, item: str, text: str, shortest: int = SHORTEST) -> Iterator[Items]:
    """The test set, block by block."""
    rows = items.select(F.col(item).alias("item"), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-size // BLOCK_BYTES))
    for block in range(n):
        own = rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == block).toArrow().combine_chunks()
        if own.num_rows:
            yield Items(own.column("item").combine_chunks(), own.column("text").combine_chunks(), shortest)


def contaminated(docs: DataFrame, key: str, text: str, items: DataFrame, item: str, item_text: str, *,
                 shortest: int = SHORTEST, threshold: float = THRESHOLD) -> DataFrame:
    """(key, item, item_words, covered, coverage, tiles) for each document and item found in it."""
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("item", items.schema[item].dataType),
                           T.StructField("item_words", T.LongType()), T.StructField("covered", T.LongType()),
                           T.StructField("coverage", T.DoubleType()),
                           T.StructField("tiles", T.ArrayType(T.ArrayType(T.LongType())))])
    rows = docs.select(F.col(key).alias("key"), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("text"))
    spark, out = docs.sparkSession, docs.sparkSession.createDataFrame([], schema)
    for block in blocks(items, item, item_text, shortest):
        shared = spark.sparkContext.broadcast(block)

        @tidy
        def scan(batches, shared=shared):
            own: Items = shared.value
            for batch in batches:
                for part in slices(batch, "text"):
                    found = list(own.find(part.column("text"), threshold))
                    n, covered = [int(own.words[i]) for _, i, _ in found], [sum(t[2] for t in tiles) for *_, tiles in found]
                    yield pa.RecordBatch.from_arrays([
                        part.column("key").take(pa.array([r for r, *_ in found], pa.int64())), own.ids.take(pa.array([i for _, i, _ in found], pa.int64())),
                        pa.array(n, pa.int64()), pa.array(covered, pa.int64()), pa.array([c / m for c, m in zip(covered, n)], pa.float64()),
                        pa.array([[list(t) for t in tiles] for *_, tiles in found], pa.list_(pa.list_(pa.int64())))], schema.names)

        out = out.unionByName(rows.mapInArrow(scan, schema))
    return out


def clean(docs: DataFrame, text: str, items: DataFrame, item: str, item_text: str, *,
          shortest: int = SHORTEST, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` in which no item is found; no row is moved for it."""
    for block in blocks(items, item, item_text, shortest):
        test = F.arrow_udf(_free(docs.sparkSession.sparkContext.broadcast(block), threshold), "boolean")
        docs = docs.filter(test(F.lower(F.coalesce(F.col(text), F.lit("")))))
    return docs


def _free(shared: Broadcast, threshold: float):
    def free(column: pa.Array) -> pa.Array:
        out, at = np.ones(len(column), bool), 0
        for part in slices(pa.RecordBatch.from_arrays([column], ["text"]), "text"):
            for r, *_ in shared.value.find(part.column("text"), threshold):
                out[at + r] = False
            at += part.num_rows
        release()
        return pa.array(out)

    return free
