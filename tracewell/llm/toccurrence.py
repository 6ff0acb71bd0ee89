"""N-gram Jaccard join by T-occurrence search with DivideSkip.

A document's set is its distinct word shingles. Two sets link when ``of`` times their
intersection reaches ``at_least`` times their union; then they differ in at most
D = (|a| + |b|) (of - at_least) / (of + at_least) shingles.

1. Shared shingles. Of a set that links with another, at most ``of - at_least`` of ``of`` shingles
   are in no other set. Partitions send the sorted hashes of shingles to owners, Golomb-coded,
   one entry for each hash and block; owners count for each set those that other blocks hold.
   Sets with more unshared shingles go no further: common phrases would only chain them. Twice
   as many shingles as may be unshared, those of the smallest hashes, are enough to see it.
2. Candidates. Shingles are dealt by hash into D + 1 parts, so linked sets agree on at
   least one whole part. The hashes of parts are sent to owners alike; these answer with an
   edge from the smallest to every other holder of a hash. Connected holders are a cluster: every link
   lies within one. D depends on sizes, so sizes are cut into bands, each with its own
   number of parts, and a set sends the parts of its band and of the next. A part with no
   shingles says nothing, so there are some parts more than D + 1, and as many whole
   parts more that linked sets agree on; the few sets with more empty parts than that also
   send their smallest shingles, of which linked sets share one.
3. Search. A cluster's distinct sets become inverted lists. For a query of n shingles and
   overlap T, the L longest of its lists are set aside; the others are merged with a heap,
   which leaves sets that occur T - L times; these are looked up in the long lists by
   binary search. Sets that are in one component already need no look-up. A larger
   cluster than ``UNIT`` sets is cut into blocks by size, and searched block against block
   where sizes are near enough to link.
4. Found links join sets into components.

Texts without words are linked with nothing. Rows with equal sets are one set. A null key
is never a component's name unless all its members are null. Nothing is capped: common
shingles are the long lists. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import heapq
from itertools import compress, groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell.llm.bitmaps import KeyBits, key_bits
from tracewell.llm.components import components
from tracewell.llm.fingerprints import decode, encode
from tracewell.llm.shared import release, slices, tidy, written
from tracewell.llm.words import mix, shingles_of, words_of

SIGNATURE_BITS = 60
SHINGLE_BITS = 40
BLOCK_ROWS = 1 << 16
BLOCK_SIGNATURES = 1 << 20
#: Sets of a cluster, and shingles in them, that are searched together at most, about.
UNIT = 2000
UNIT_SHINGLES = 1 << 20
#: Weight of a step in a long list against one in a short list.
MU = 0.01


class Rule:
    """When sets link, and how their sizes are banded."""

    def __init__(self, size: int, at_least: int, of: int, longest: int = 1 << 40):
        self.size, self.at_least, self.of = size, at_least, of
        edges = [1]
        while edges[-1] < longest:
            edges.append(max(edges[-1] + 1, edges[-1] * of // at_least))
        self.edges = np.array(edges, np.int64)

    def differ(self, total: np.ndarray | int):
        """Shingles that two linked sets of together ``total`` shingles may differ in."""
        return total * (self.of - self.at_least) // (self.of + self.at_least)

    def overlap(self, total):
        """Shingles that linked sets share at least."""
        return -(-total * self.at_least // (self.of + self.at_least))

    def band(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.edges, sizes, "right") - 1

    def parts(self, band: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parts for the sets of a band and the next smaller one, and how many of them may
        be empty. One part, where only equal sets link."""
        least = self.differ(2 * (self.edges[band + 1] - 1)) + 1
        empty = least * np.exp(-self.edges[band] * self.at_least / self.of / least)
        spare = np.where(least > 1, np.ceil(1.5 * empty).astype(np.int64) + 1, 0)
        return least + spare, spare


def sets_of(text: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of all texts, and where each text's begin."""
    numbers, first, *_ = words_of(text)
    shingles, owner = shingles_of(numbers, first, size)
    order = np.lexsort((shingles, owner))
    shingles, owner = shingles[order], owner[order]
    new = np.ones(len(shingles), bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    return shingles[new], np.searchsorted(owner[new], np.arange(len(text) + 1))


def names(shingles: np.ndarray, first: np.ndarray) -> list[bytes]:
    """16 bytes that stand for each set."""
    raw, at = memoryview(np.ascontiguousarray(shingles)).cast("B"), (first * 8).tolist()
    return [hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(at[:-1], at[1:])]


def signatures(shingles: np.ndarray, first: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Part hashes of all sets, and the set of each."""
    sizes = np.diff(first)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    spread_, inside = mix(shingles ^ np.uint64(0x5851F42D4C957F2D)), mix(shingles ^ np.uint64(0x14057B7EF767814F))
    low, high = (inside & np.uint64(0xFFFFFFFF)).astype(float), (inside >> np.uint64(32)).astype(float)
    out, of = [], []
    for step in (0, 1):
        level = rule.band(np.maximum(sizes, 1)) + step
        parts, spare = rule.parts(level)
        parts[(parts == 1) | (sizes == 0)] = 0  # equal sets only, which need no search
        base = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(parts, out=base[1:])
        own = parts[owner] > 0
        at = base[owner[own]] + (spread_[own] % parts[owner[own]].astype(np.uint64)).astype(np.int64)
        total = (np.bincount(at, high[own], base[-1]).astype(np.uint64) << np.uint64(32)) + \
            np.bincount(at, low[own], base[-1]).astype(np.uint64)
        count = np.bincount(at, minlength=base[-1])
        holder = np.repeat(np.arange(len(sizes)), parts)
        number = np.arange(base[-1]) - base[holder]
        tag = mix((level[holder].astype(np.uint64) << np.uint64(32)) + number.astype(np.uint64))
        out.append(mix(total + tag)[count > 0])
        of.append(holder[count > 0])
        empty = np.bincount(holder[count == 0], minlength=len(sizes))
        for s in np.flatnonzero(empty > spare).tolist():
            n = int(sizes[s])
            prefix = shingles[first[s]:first[s] + n - -(-n * rule.at_least // rule.of) + 1]
            out.append(mix(mix(prefix) + np.uint64(level[s]) + np.uint64(1)))
            of.append(np.full(len(prefix), s))
    return np.concatenate(out) >> np.uint64(64 - SIGNATURE_BITS), np.concatenate(of)


def name_bits(named: DataFrame) -> KeyBits:
    head = F.conv(F.hex(F.substring("name", 1, 7)), 16, 10).cast("long")
    return key_bits(named.select(F.shiftleft(head, 8).alias("hash")), "hash")


def named_in(own: list[bytes], bits: KeyBits) -> np.ndarray:
    """Which sets, told by their names, are probably in a bitmap of names."""
    return bits.hit(np.frombuffer(b"".join(x[:7] + b"\0" for x in own), ">u8").astype(np.uint64).view(np.int64)) if own else np.zeros(0, bool)


def often_shared(docs: DataFrame, key: str, text: str, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """Nodes (key, n, name) for all rows, and the names of sets of which so many shingles are in
    other sets that they may link. There may be more such names (equal sets of two blocks, small
    sets, hashes that meet by chance), never fewer."""
    owners = max(16, docs.rdd.getNumPartitions())
    universe = min(1 << SHINGLE_BITS, (2 * (rule.of - rule.at_least) << SHINGLE_BITS) // rule.of + 1)
    step = -(-universe // owners)
    schema = T.StructType([T.StructField("kind", T.StringType()), T.StructField("id", T.LongType()),
                           T.StructField("key", docs.schema[key].dataType), T.StructField("n", T.LongType()),
                           T.StructField("name", T.BinaryType()), T.StructField("unshared", T.LongType()),
                           T.StructField("owner", T.IntegerType()), T.StructField("width", T.IntegerType()),
                           T.StructField("quotients", T.BinaryType()), T.StructField("remainders", T.BinaryType()),
                           T.StructField("again", T.BinaryType()), T.StructField("members", T.BinaryType())])

    def send(rows: list, block: int):
        keys = pa.concat_arrays([r[0] for r in rows])
        kinds = {"kind": pa.string(), "id": pa.int64(), "key": keys.type, "n": pa.int64(), "name": pa.binary(), "unshared": pa.int64(), "owner": pa.int32(),
                 "width": pa.int32(), "quotients": pa.binary(), "remainders": pa.binary(), "again": pa.binary(), "members": pa.binary()}

        def batch_of(rows: int, /, **columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], kinds[f.name]) if f.name in columns else pa.nulls(rows, kinds[f.name]) for f in schema], schema.names)

        n, sizes, name = len(keys), np.concatenate([r[1] for r in rows]), [x for r in rows for x in r[2]]
        base = (TaskContext.get().partitionId() << 36) + block * BLOCK_ROWS * 2
        # Of equal sets the first is counted.
        first_of = {x: i for i, x in reversed(list(enumerate(name)))}
        hashes, of = np.concatenate([r[3] for r in rows]), np.repeat(np.arange(n), np.concatenate([r[4] for r in rows]))
        counts = np.array([first_of[x] == i for i, x in enumerate(name)], bool)[of]
        hashes, of = hashes[counts], of[counts]
        order = np.argsort(hashes, kind="stable")
        hashes, of = hashes[order], of[order]
        new = np.ones(len(hashes), bool)
        new[1:] = hashes[1:] != hashes[:-1]
        # What the block itself holds twice is counted here and asked by nobody.
        alone = new.copy()
        alone[:-1] &= new[1:]
        yield batch_of(n, kind=["node"] * n, id=base + np.arange(n), key=keys, n=sizes, name=name,
                       unshared=np.bincount(of[alone], minlength=n)[[first_of[x] for x in name]])
        hashes, of, again = hashes[new], of[new].astype(np.uint16 if n <= 1 << 16 else np.uint32), ~alone[new]
        first = np.searchsorted(hashes, np.array([min(o * step, universe) for o in range(owners + 1)], np.int64))
        parts = [(o, a, b) for o, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())) if b > a]
        m, coded = len(parts), [encode(hashes[a:b] - o * step, step) for o, a, b in parts]
        if m:
            yield batch_of(m, kind=["block"] * m, id=[base] * m, n=[b - a for _, a, b in parts], owner=[o for o, _, _ in parts],
                           width=[c[0] for c in coded], quotients=[c[1] for c in coded], remainders=[c[2] for c in coded],
                           again=[np.packbits(again[a:b]).tobytes() for _, a, b in parts],
                           members=[of[a:b][~again[a:b]].tobytes() for _, a, b in parts])

    @tidy
    def partition(batches):
        rows, n, total, block = [], 0, 0, 0
        for batch in batches:
            for part in slices(batch, "text"):
                shingles, first = sets_of(part.column("text"), rule.size)
                hashes = (shingles >> np.uint64(64 - SHINGLE_BITS)).astype(np.int64)
                small = hashes < universe
                before = np.concatenate([[0], np.cumsum(small)])
                rows.append((part.column("key"), np.diff(first), names(shingles, first), hashes[small], np.diff(before[first])))
                n, total = n + part.num_rows, total + len(rows[-1][3])
                if n >= BLOCK_ROWS // 2 or total >= BLOCK_SIGNATURES:
                    yield from send(rows, block)
                    rows, n, total, block = [], 0, 0, block + 1
        if rows:
            yield from send(rows, block)

    sent = written(docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(partition, schema), "shingles", "kind")

    def meet(table: pa.Table) -> pa.Table:
        hashes, ids = [], []
        for r in table.to_pylist():
            hashes.append(decode(r["n"], r["width"], r["quotients"], r["remainders"]))
            asked = np.unpackbits(np.frombuffer(r["again"], np.uint8))[:r["n"]] == 0
            of = np.full(r["n"], -1, np.int64)
            of[asked] = np.frombuffer(r["members"], np.uint16 if len(r["members"]) == 2 * asked.sum() else np.uint32) + np.int64(r["id"])
            ids.append(of)
        hashes, ids = np.concatenate(hashes), np.concatenate(ids)
        order = np.argsort(hashes, kind="stable")
        hashes, ids = hashes[order], ids[order]
        same = hashes[1:] == hashes[:-1]
        both = np.zeros(len(hashes), bool)
        both[1:] |= same
        both[:-1] |= same
        found, times = np.unique(ids[both & (ids >= 0)], return_counts=True)
        release()
        return pa.table({"id": found, "found": times.astype(np.int64)})

    found = sent.filter("kind = 'block'").select("owner", "id", "n", "width", "quotients", "remainders", "again", "members") \
        .groupBy("owner").applyInArrow(meet, "id long, found long").groupBy("id").agg(F.sum("found").alias("found"))
    nodes = sent.filter("kind = 'node'")
    unshared = F.col("unshared") - F.coalesce("found", F.lit(0))
    may_link = nodes.filter("n > 0").select("id", "n", "name", "unshared").join(found, "id", "left").filter(
        unshared * rule.of <= F.col("n") * (rule.of - rule.at_least))
    return nodes.select("key", "n", "name"), written(may_link.select("name").distinct(), "sharing")


def candidates(docs: DataFrame, key: str, text: str, rule: Rule, among: KeyBits | None = None) -> tuple[DataFrame, DataFrame]:
    """Nodes (id, key, n, name) for all rows whose set may be ``among`` these, and edges (a, b) of their ids."""
    owners = max(16, docs.rdd.getNumPartitions())
    shared = docs.sparkSession.sparkContext.broadcast(among)
    step = -(-(1 << SIGNATURE_BITS) // owners)
    schema = T.StructType([T.StructField("kind", T.StringType()), T.StructField("id", T.LongType()),
                           T.StructField("key", docs.schema[key].dataType), T.StructField("n", T.LongType()),
                           T.StructField("name", T.BinaryType()), T.StructField("other", T.LongType()),
                           T.StructField("owner", T.IntegerType()), T.StructField("width", T.IntegerType()),
                           T.StructField("quotients", T.BinaryType()), T.StructField("remainders", T.BinaryType()),
                           T.StructField("members", T.BinaryType())])

    def batch_of(rows: int, kinds: dict, /, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name], kinds[f.name]) if f.name in columns else pa.nulls(rows, kinds[f.name]) for f in schema], schema.names)

    def send(rows: list, block: int):
        keys = pa.concat_arrays([r[0] for r in rows])
        kinds = {"kind": pa.string(), "id": pa.int64(), "key": keys.type, "n": pa.int64(), "name": pa.binary(), "other": pa.int64(),
                 "owner": pa.int32(), "width": pa.int32(), "quotients": pa.binary(), "remainders": pa.binary(), "members": pa.binary()}
        n = len(keys)
        base = (TaskContext.get().partitionId() << 36) + block * BLOCK_ROWS * 2
        yield batch_of(n, kinds, kind=["node"] * n, id=base + np.arange(n), key=keys,
                       n=np.concatenate([r[1] for r in rows]), name=[x for r in rows for x in r[2]])
        offset, sig, of = 0, [], []
        for r in rows:
            sig.append(r[3])
            of.append(r[4] + offset)
            offset += len(r[0])
        sig, of = np.concatenate(sig), np.concatenate(of)
        order = np.lexsort((of, sig))
        sig, of = sig[order], of[order]
        new = np.ones(len(sig), bool)
        new[1:] = sig[1:] != sig[:-1]
        least = of[np.flatnonzero(new)]
        # Within the block: from the first holder of a hash to the others.
        lead = least[np.cumsum(new) - 1]
        pairs = np.unique((lead << 32 | of)[lead != of])
        yield batch_of(len(pairs), kinds, kind=["edge"] * len(pairs), id=base + (pairs >> 32), other=base + (pairs & 0xFFFFFFFF))
        sig = sig[new].astype(np.int64)
        first = np.searchsorted(sig, np.array([min(o * step, 1 << SIGNATURE_BITS) for o in range(owners + 1)], np.int64))
        parts = [(o, a, b) for o, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())) if b > a]
        coded = [encode(sig[a:b] - o * step, step) for o, a, b in parts]
        m = len(parts)
        if m:
            yield batch_of(m, kinds, kind=["block"] * m, id=[base] * m, n=[b - a for _, a, b in parts], owner=[o for o, _, _ in parts],
                           width=[c[0] for c in coded], quotients=[c[1] for c in coded], remainders=[c[2] for c in coded],
                           members=[least[a:b].astype(np.int32).tobytes() for _, a, b in parts])

    @tidy
    def partition(batches):
        rows, n, total, block = [], 0, 0, 0
        for batch in batches:
            for part in slices(batch, "text"):
                shingles, first = sets_of(part.column("text"), rule.size)
                keys, own = part.column("key"), names(shingles, first)
                if shared.value is not None:
                    hit, sizes = named_in(own, shared.value), np.diff(first)
                    keys, own = keys.filter(pa.array(hit)), list(compress(own, hit))
                    shingles, first = shingles[np.repeat(hit, sizes)], np.concatenate([[0], np.cumsum(sizes[hit])])
                if not own:
                    continue
                sig, of = signatures(shingles, first, rule)
                rows.append((keys, np.diff(first), own, sig, of))
                n, total = n + len(own), total + len(sig)
                if n >= BLOCK_ROWS or total >= BLOCK_SIGNATURES:
                    yield from send(rows, block)
                    rows, n, total, block = [], 0, 0, block + 1
        if rows:
            yield from send(rows, block)

    sent = written(docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(partition, schema), "parts", "kind")

    def meet(table: pa.Table) -> pa.Table:
        sig, ids = [], []
        for r in table.to_pylist():
            sig.append(decode(r["n"], r["width"], r["quotients"], r["remainders"]))
            ids.append(np.frombuffer(r["members"], np.int32).astype(np.int64) + r["id"])
        sig, ids = np.concatenate(sig), np.concatenate(ids)
        order = np.lexsort((ids, sig))
        sig, ids = sig[order], ids[order]
        new = np.ones(len(sig), bool)
        new[1:] = sig[1:] != sig[:-1]
        lead = ids[np.flatnonzero(new)][np.cumsum(new) - 1]
        pairs = np.unique(np.stack([lead, ids], 1)[lead != ids], axis=0)
        release()
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    far = sent.filter("kind = 'block'").select("owner", "id", "n", "width", "quotients", "remainders", "members") \
        .groupBy("owner").applyInArrow(meet, "a long, b long")
    near = sent.filter("kind = 'edge'").select(F.col("id").alias("a"), F.col("other").alias("b"))
    return sent.filter("kind = 'node'").select("id", "key", "n", "name"), near.unionByName(far)


def search(sets: list[np.ndarray], rule: Rule, from_: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that join the sets' components (a forest). ``from_``: block of each set, for
    links between blocks only; inside one block, links were or will be found elsewhere."""
    n = np.array([len(s) for s in sets], np.int64)
    member = np.repeat(np.arange(len(sets)), n)
    shingle = np.concatenate(sets)
    order = np.lexsort((member, shingle))
    member, shingle = member[order], shingle[order]
    new = np.ones(len(shingle), bool)
    new[1:] = shingle[1:] != shingle[:-1]
    number = np.cumsum(new) - 1  # of the inverted list
    start = np.append(np.flatnonzero(new), len(shingle))
    codes = number * len(sets) + member  # sorted: lists, and members within them
    of_set = np.empty(len(order), np.int64)
    of_set[order] = number  # lists of each set, by its own shingles
    first = np.concatenate([[0], np.cumsum(n)])
    parent, links, left = np.arange(len(sets)), [], len(sets)
    for q in np.argsort(-n, kind="stable").tolist():
        if left == 1:
            break
        # The query is the larger set, or of equal ones the first.
        able = (parent != parent[q]) & (n * rule.of >= n[q] * rule.at_least) & ((n < n[q]) | ((n == n[q]) & (np.arange(len(sets)) > q)))
        if from_ is not None:
            able &= from_ != from_[q]
        if not able.any():
            continue
        lists = of_set[first[q]:first[q + 1]]
        length = start[lists + 1] - start[lists]
        lists = lists[np.argsort(length, kind="stable")]
        least = -(-n[q] * rule.at_least // rule.of)  # overlap with the smallest set that may link
        longest = int(length.max())
        long_ = min(int(least) - 1, max(int(least / (MU * np.log2(longest + 1) + 1)), int((length > 64).sum())))
        short, tail = lists[:len(lists) - long_], lists[len(lists) - long_:]
        runs = [own.tolist() for a in short.tolist() if start[a + 1] - start[a] > 1
                and len(own := member[start[a]:start[a + 1]][able[member[start[a]:start[a + 1]]]])]
        for c, same in groupby(heapq.merge(*runs)):
            count, want = sum(1 for _ in same), int(rule.overlap(n[q] + n[c]))
            if count + long_ < want or parent[c] == parent[q]:
                continue
            if count < want:
                probe = tail * len(sets) + c
                at = np.minimum(np.searchsorted(codes, probe), len(codes) - 1)
                count += int((codes[at] == probe).sum())
            if count >= want:
                links.append((q, c))
                parent[parent == parent[c]] = parent[q]
                left -= 1
                if not (able & (parent != parent[q])).any():
                    break
    return links


def link_clusters(members: DataFrame, total: int, rule: Rule) -> DataFrame:
    """(a, b): names of sets linked, from rows (name, cluster, band, block, cuts, shingles)
    of sets with ``total`` shingles together."""
    def other(band):
        return F.sequence(F.lit(0), F.col("cuts")[band] - 1)

    def beside(band):
        return F.map_contains_key("cuts", band)

    b, block = F.col("band"), F.col("block")
    unit = lambda lo, i, hi, j: F.struct(lo.alias("lo"), i.alias("i"), hi.alias("hi"), j.alias("j"))
    none = F.array().cast("array<struct<lo:int,i:int,hi:int,j:int>>")
    own = F.transform(other(b), lambda c: unit(b, F.least(block, c), b, F.greatest(block, c)))
    above = F.when(beside(b + 1), F.transform(other(b + 1), lambda c: unit(b, block, b + 1, c)))
    below = F.when(beside(b - 1), F.transform(other(b - 1), lambda c: unit(b - 1, c, b, block)))
    units = members.withColumn("unit", F.explode(F.concat(own, F.coalesce(above, none), F.coalesce(below, none)))).select(
        "name", "shingles", "cluster", "band", "block", "unit.*")
    groups = max(int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // UNIT_SHINGLES)
    units = units.withColumn("task", F.pmod(F.xxhash64("cluster", "lo", "i", "hi", "j"), F.lit(groups)))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("cluster", "lo", "i", "hi", "j", "name")]).combine_chunks()
        where = np.stack([table.column(c).to_numpy() for c in ("cluster", "lo", "i", "hi", "j")], 1)
        block = table.column("band").to_numpy().astype(np.int64) << 32 | table.column("block").to_numpy()
        cuts = np.flatnonzero((where[1:] != where[:-1]).any(1)) + 1
        name, raw, links = table.column("name").to_pylist(), table.column("shingles").to_pylist(), []
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(name)]):
            rows = [x for x in range(a, b) if x == a or name[x] != name[x - 1]]  # a set read twice
            if len(rows) > 1:
                between = block[rows] if (where[a, 1:3] != where[a, 3:5]).any() else None
                found = search([np.frombuffer(raw[x], np.uint64) for x in rows], rule, between)
                links += [(name[rows[p]], name[rows[q]]) for p, q in found]
        release()
        return pa.table({"a": pa.array([x for x, _ in links], pa.binary()), "b": pa.array([x for _, x in links], pa.binary())})

    return units.groupBy("task").applyInArrow(run, "a binary, b binary")


def jaccard_components(docs: DataFrame, key: str, text: str, *, size: int = 5, at_least: int = 80, of: int = 100) -> DataFrame:
    """One row per row: key, n (shingles), name (of its set), component (smallest key) and
    root (a set of the component, which names it also where keys repeat)."""
    rule = Rule(size, at_least, of)
    nodes, sharing = often_shared(docs, key, text, rule)
    some, edges = candidates(docs, key, text, rule, name_bits(sharing))
    cluster = components(edges)
    near = some.join(cluster, "id").groupBy("name").agg(F.min("root").alias("cluster"), F.max("n").alias("n"))
    near = written(near, "near")  # a row for each set that shares a part with another
    # Large clusters are cut by size, so that blocks meet only those of sizes that may link.
    blocks = F.ceil(F.greatest(F.count("*") / UNIT, F.sum("n") / UNIT_SHINGLES)).cast("int")
    sizes = near.groupBy("cluster").agg(F.count("*").alias("sets"), blocks.alias("blocks")).filter("sets > 1")
    band = F.floor(F.log("n") / float(np.log(1.0001 * rule.of / rule.at_least))).cast("int")
    near = written(near.join(sizes, "cluster").select(
        "name", "cluster", "n", F.when(F.col("blocks") > 1, band).otherwise(0).alias("band")), "clusters")
    cuts = near.groupBy("cluster", "band").agg(blocks.alias("blocks")).groupBy("cluster").agg(
        F.map_from_entries(F.collect_list(F.struct("band", "blocks"))).alias("cuts"))  # one entry for each band
    near = near.join(cuts, "cluster").withColumn("block", F.pmod(F.xxhash64("name"), F.col("cuts")[F.col("band")]).cast("int"))
    shared = docs.sparkSession.sparkContext.broadcast(name_bits(near))

    @tidy
    def bodies(batches):
        seen: set[bytes] = set()
        for batch in batches:
            for part in slices(batch, "text"):
                shingles, first = sets_of(part.column("text"), rule.size)
                own = names(shingles, first)
                hit, rows = named_in(own, shared.value), []
                for i in np.flatnonzero(hit).tolist():
                    if own[i] not in seen:
                        seen.add(own[i])
                        rows.append(i)
                yield pa.RecordBatch.from_arrays([
                    pa.array([own[i] for i in rows], pa.binary()),
                    pa.array([shingles[first[i]:first[i + 1]].tobytes() for i in rows], pa.binary())], ["name", "shingles"])

    read = docs.select(F.col(text).alias("text")).mapInArrow(bodies, "name binary, shingles binary")
    total = near.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    links = link_clusters(near.drop("n").join(read, "name"), total, rule)
    linked = components(links).select(F.col("id").alias("name"), "root")
    # Every set's smallest key, then every component's.
    sets = nodes.filter("n > 0").groupBy("name").agg(F.min("key").alias("least"))
    named = sets.join(linked, "name", "left").withColumn("root", F.coalesce("root", "name"))
    roots = named.groupBy("root").agg(F.min("least").alias("component"))
    named = named.join(roots, "root").select("name", "component", "root")
    out = nodes.filter("n > 0").join(named, "name").select("key", "n", "name", F.coalesce("component", "key").alias("component"), "root")
    return out.unionByName(nodes.filter("n = 0").select("key", "n", "name", F.col("key").alias("component"), F.lit(None).cast("binary").alias("root")))


def one_of_each(docs: DataFrame, key: str, text: str, *, size: int = 5, at_least: int = 80, of: int = 100) -> DataFrame:
    """``docs``, all columns, with one row of each component: that with the smallest key.
    Where rows share key and set, the largest by its other columns stays. Documents
    without words, and those linked with nothing, stay as they are."""
    found = written(jaccard_components(docs, key, text, size=size, at_least=at_least, of=of), "components")
    # A key may have several rows with different sets: decide by key and set.
    linked = found.filter("n > 0")
    chosen = written(linked.groupBy("root").agg(F.min(F.struct("key", "name")).alias("stays"), F.count("*").alias("rows")).filter("rows > 1"), "chosen")
    decided = linked.join(chosen, "root").select("key", "name", ((F.col("key").eqNullSafe(F.col("stays.key"))) & (F.col("name") == F.col("stays.name"))).alias("stays"))
    decided = written(decided.groupBy("key", "name").agg(F.max("stays").alias("_stays"), F.count("*").alias("_times"))
                      .filter("not _stays or _times > 1").withColumnsRenamed({"key": "_k", "name": "_n"}), "dropped")
    bits = key_bits(decided.select(F.xxhash64("_k").alias("hash")), "hash")
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def named(column: pa.Array, keys: pa.Array) -> pa.Array:
        """The set's name where the key is in the bitmap, else null."""
        hit = shared.value.hit(keys.to_numpy(zero_copy_only=False).astype(np.int64)) if len(keys) else np.zeros(0, bool)
        found = iter([x for part in slices(pa.RecordBatch.from_arrays([column.filter(pa.array(hit))], ["t"]), "t")
                      for x in names(*sets_of(part.column("t"), size))])
        return pa.array([next(found) if h else None for h in hit.tolist()], pa.binary())

    marked = docs.withColumn("_name", F.arrow_udf(named, "binary")(F.col(text), F.xxhash64(key)))
    joined = marked.filter("_name is not null").join(decided, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_name") == F.col("_n")), "left")
    one = joined.filter("_stays").groupBy("_k", "_n").agg(F.max(F.struct(*docs.columns)).alias("_row")).select("_row.*")
    return marked.filter("_name is null").select(*docs.columns).unionByName(
        joined.filter("_stays is null").select(*docs.columns)).unionByName(one)
