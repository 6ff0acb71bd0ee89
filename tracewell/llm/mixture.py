"""Mixing overlapping sources to target weights by min-cost flow.

A document may belong to several sources. Documents are first summed up by the set of
sources they belong to (their pattern), so the flow network has a node for each pattern,
not for each document:

    start -> pattern   capacity: its words, once for every allowed repetition; the r-th
                       repetition costs r - 1 a word, so costs are convex
    pattern -> source  for each source of the pattern
    source -> end      capacity: the source's target

A cheapest largest flow says how many words of a pattern serve each source. Documents of
a pattern are then taken in a seeded order: the flow's words are counted off along it,
whole documents only, in a few rounds that each pass over what does not fit any more,
and one more document is added where that comes nearer. Taken words of a document never
exceed ``repeats`` times its size.

Targets: sources in code-point order, null last, weigh 3, 1, 2, 3, 1, 2 ... and share
``total`` of all sizes; a target stops at ``repeats`` times its source's words, and what
is over is shared again by weight among the others until none is above.

Documents without a source (an empty set) take nothing. Null texts have size 0. Equal
rows are taken alike. The seeded order is by hash, then key; it needs no global sort:
sizes are summed by the top bits of the hash, and only documents in the one bucket where
the count ends are put in order. Only sums by pattern and bucket come to the driver;
sources are a curated list, so both are small.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell.llm.shared import written

WEIGHTS = (3, 1, 2)
TOTAL = 1.5
REPEATS = 2
SEED = 20
#: Buckets of the seeded order.
BUCKET_BITS = 12
#: Times the order is gone through for documents that fit what is left of the flow.
ROUNDS = 3


def word_count(text: str) -> Column:
    """Number of runs of characters other than space and 0x09-0x0D."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: dict, weights: Sequence[int] = WEIGHTS, total: float = TOTAL, repeats: int = REPEATS) -> dict:
    """source -> words wanted, exactly (fractions)."""
    order = sorted(sizes, key=lambda s: (s is None, "" if s is None else s))
    weight = {s: Fraction(weights[i % len(weights)]) for i, s in enumerate(order)}
    left, open_, out = Fraction(total) * sum(sizes.values()), set(order), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > repeats * sizes[s]}
        if not over:
            return out | share
        for s in over:
            out[s] = Fraction(repeats * sizes[s])
            left -= out[s]
        open_ -= over
    return out


class Network:
    """Min-cost flow by shortest augmenting paths with potentials."""

    def __init__(self):
        self.edges: list[list] = []  # to, capacity left, cost
        self.at: dict[object, list[int]] = defaultdict(list)

    def edge(self, a, b, capacity: int, cost: int) -> int:
        self.at[a].append(len(self.edges))
        self.edges.append([b, capacity, cost])
        self.at[b].append(len(self.edges))
        self.edges.append([a, 0, -cost])
        return len(self.edges) - 2

    def run(self, start, end) -> None:
        potential: dict = defaultdict(int)
        while True:
            distance, came, heap, n = {start: 0}, {}, [(0, 0, start)], 0
            done = set()
            while heap:
                d, _, node = heapq.heappop(heap)
                if node in done:
                    continue
                done.add(node)
                for i in self.at[node]:
                    to, capacity, cost = self.edges[i]
                    reach = d + cost + potential[node] - potential[to]
                    if capacity > 0 and reach < distance.get(to, reach + 1):
                        distance[to], came[to], n = reach, i, n + 1
                        heapq.heappush(heap, (reach, n, to))
            if end not in distance:
                return
            for node, d in distance.items():
                potential[node] += min(d, distance[end])
            for node in set(self.at) - set(distance):
                potential[node] += distance[end]
            path, node = [], end
            while node != start:
                path.append(came[node])
                node = self.edges[came[node] ^ 1][0]
            amount = min(self.edges[i][1] for i in path)
            for i in path:
                self.edges[i][1] -= amount
                self.edges[i ^ 1][1] += amount


def route(patterns: dict[tuple, int], wanted: dict, repeats: int = REPEATS) -> dict[tuple, int]:
    """pattern -> words taken of it; patterns are tuples of sources with their words."""
    network, first = Network(), {}
    for p, words in sorted(patterns.items(), key=str):
        first[p] = [network.edge("start", ("p", p), words, r) for r in range(repeats)]
        for s in p:
            network.edge(("p", p), ("s", s), repeats * words, 0)
    for s, words in sorted(wanted.items(), key=str):
        network.edge(("s", s), "end", round(words), 0)
    network.run("start", "end")
    return {p: sum(network.edges[i ^ 1][1] for i in edges) for p, edges in first.items()}


def _count_off(rows: DataFrame, key: str, room: dict[tuple, int]) -> tuple[DataFrame, dict[tuple, int]]:
    """Counts off, along the seeded order, documents not marked yet and no larger than
    their pattern's room, until the next one would not fit: where each pattern's count
    ends (for ``_mark``), and the room that remains."""
    spark = rows.sparkSession
    schema = T.StructType([T.StructField("_p", T.ArrayType(T.StringType())), T.StructField("_room", T.LongType())])
    limits = spark.createDataFrame([(list(p), r) for p, r in room.items()], schema)
    able = rows.filter(~F.col("_extra")).join(F.broadcast(limits), (F.col("_sources") == F.col("_p")) & (F.col("_size") <= F.col("_room")))
    buckets: dict[tuple, dict[int, int]] = defaultdict(dict)
    for r in able.groupBy("_p", "_bucket").agg(F.sum("_size").alias("words")).collect():
        buckets[tuple(r["_p"])][r["_bucket"]] = r["words"]
    last = []
    for p, before in room.items():
        at, rest = -1, before
        for b in sorted(buckets[p]):
            at = b
            if buckets[p][b] > rest:
                break
            rest -= buckets[p][b]
        last.append((list(p), before, at, rest))
    schema.add("_last", T.LongType()).add("_rest", T.LongType())
    cut = spark.createDataFrame(last, schema)
    along = Window.partitionBy("_p").orderBy("_order", key)  # one bucket of each pattern; ties come together
    ends = able.drop("_p", "_room").join(F.broadcast(cut), (F.col("_sources") == F.col("_p")) & (F.col("_bucket") == F.col("_last"))) \
        .withColumn("_sum", F.sum("_size").over(along)).filter("_sum <= _rest").groupBy("_p").agg(
            F.max(F.struct("_order", F.col(key).alias("_key"), "_sum")).alias("_end"))
    found = {tuple(r["_p"]): r["_end"] for r in ends.collect()}  # a row for each pattern
    end = T.StructType([T.StructField("_order", T.LongType()), T.StructField("_key", rows.schema[key].dataType)])
    schema.add("_end", end)
    cut = spark.createDataFrame([(*c, found[tuple(c[0])][:2] if tuple(c[0]) in found else None) for c in last], schema)
    return cut, {tuple(p): rest - (found[tuple(p)]["_sum"] if tuple(p) in found else 0) for p, _, _, rest in last}


def _mark(rows: DataFrame, key: str, cut: DataFrame) -> DataFrame:
    """``rows`` with those that were counted off marked as ``_extra``."""
    upto = F.coalesce(F.col("_end").isNotNull() & (F.struct(F.col("_order"), F.col(key).alias("_key")) <= F.col("_end")), F.lit(False))
    inside = (F.col("_size") <= F.col("_room")) & ((F.col("_bucket") < F.col("_last")) | ((F.col("_bucket") == F.col("_last")) & upto))
    return rows.join(F.broadcast(cut), F.col("_sources") == F.col("_p"), "left") \
        .withColumn("_extra", F.col("_extra") | F.coalesce(inside, F.lit(False))).drop("_p", "_room", "_last", "_rest", "_end")


def mix(docs: DataFrame, key: str, size: Column, sources: Column, *, weights: Sequence[int] = WEIGHTS,
        total: float = TOTAL, repeats: int = REPEATS, seed: int = SEED) -> tuple[DataFrame, dict, dict]:
    """``docs`` with ``_size``, ``_sources`` and ``_taken`` (words, repeats counted), the
    words of every source, and the targets. ``sources`` is an array (null is a source)."""
    spark = docs.sparkSession  # the tables broadcast below have a row for each pattern, as the driver holds them

    def ordered(df: DataFrame) -> DataFrame:
        order = F.xxhash64(F.lit(seed), F.col(key))
        return df.withColumns({"_order": order, "_bucket": F.shiftrightunsigned(order, 64 - BUCKET_BITS), "_extra": F.lit(False)})

    sized = docs.withColumns({"_size": size, "_sources": F.array_sort(F.array_distinct(sources))})
    rows = ordered(written(sized.select(key, "_size", "_sources"), "sizes"))  # texts are not read again to count off
    sums = rows.groupBy("_sources").agg(F.sum("_size").alias("words")).collect()  # by pattern
    patterns: dict[tuple, int] = defaultdict(int)
    for r in sums:
        patterns[tuple(r["_sources"] or ())] += r["words"] or 0
    sizes: dict = defaultdict(int)
    for p, words in patterns.items():
        for s in p:
            sizes[s] += words
    wanted = targets(sizes, weights, total, repeats)
    flow = route(patterns, wanted, repeats)

    # How often a pattern is taken whole, and how many words of its flow are left over.
    plan = {p: divmod(flow[p], words) if words else (0, 0) for p, words in patterns.items()}
    left, cuts = {p: rest for p, (_, rest) in plan.items()}, []
    for _ in range(ROUNDS):
        cut, left = _count_off(rows, key, left)
        rows = _mark(rows, key, cut)
        cuts.append(cut)
    # One more document: the one that brings the words nearest to the flow.
    schema = T.StructType([T.StructField("_p", T.ArrayType(T.StringType())), T.StructField("_whole", T.LongType()),
                           T.StructField("_left", T.LongType())])
    ends = spark.createDataFrame([(list(p), whole, left[p]) for p, (whole, _) in plan.items()], schema)
    gap = F.abs(F.col("_size") - F.col("_left"))
    near = rows.join(F.broadcast(ends), F.col("_sources") == F.col("_p")) \
        .filter(~F.col("_extra") & (F.col("_whole") < repeats) & (gap < F.col("_left"))).groupBy("_p").agg(
            F.min(F.struct(gap.alias("_gap"), F.col("_order"), F.col(key).alias("_key"), F.col("_size").alias("_words"))).alias("_near"))
    found = {tuple(r["_p"]): r["_near"] for r in near.collect()}  # a row for each pattern
    schema.add("_near", near.schema["_near"].dataType)
    ends = spark.createDataFrame([(list(p), whole, left[p], found.get(p)) for p, (whole, _) in plan.items()], schema)

    out = ordered(sized)
    for cut in cuts:
        out = _mark(out, key, cut)
    out = out.join(F.broadcast(ends), F.col("_sources") == F.col("_p"), "left")
    chosen = F.coalesce((F.col("_order") == F.col("_near._order")) & F.col(key).eqNullSafe(F.col("_near._key"))
                        & (F.col("_size") == F.col("_near._words")) & ~F.col("_extra"), F.lit(False))
    times = F.coalesce(F.col("_whole") + (F.col("_extra") | chosen).cast("long"), F.lit(0))
    taken = F.least(times, F.lit(repeats)) * F.col("_size")
    return out.select(*docs.columns, "_size", "_sources", taken.alias("_taken")), dict(sizes), wanted
