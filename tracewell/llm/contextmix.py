"""Texts scored by online logistic mixing of hashed-context bit predictors.

A text (A-Z lowered, null as empty) is its UTF-8 bytes and one end byte. Each byte is a
few bits: those of a Huffman code of all 256 bytes, built on all training texts.

* Predictors. For each of three contexts (the last 2 and 3 bytes, and the word so far) a
  table of ``TABLE_BITS`` hashed slots counts how often the next bit was 0 and 1 over
  all training texts. Partitions count, Spark adds the counts slot by slot.
* Mixing. The predictors' log-odds and a constant are weighted and summed; the sum's
  logistic is the probability. The weights are picked by a gate: which bit of the byte's
  code it is (the eighth and later ones together), and whether the longest byte context is
  known.
* Online refinement. Every text starts with weights learned beforehand on all training
  texts (a slice of a partition shares them, moved by the mean of its texts' gradients; each slice from the same start, their ends
  averaged by bytes) and then follows its own errors: after each stretch of bytes (64, 128 ... 4096) its weights move along the
  gradient of that stretch's code length. What is learned
  within a text ends with it, so a score does not depend on other texts' order.

Besides, ``token_scores`` gives each text its add-one unigram score. Word counts come
from an exchange: partitions send owners the sorted hashes of their words with training
counts, and owners answer each with the sums; no vocabulary is broadcast, and a common
word is one entry a partition.

Texts that do not train are still scored. Without training texts all bits cost one bit.
Repeated rows are scored alike; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell.llm.shared import lower_ascii, release, slices, text_bytes, tidy, written
from tracewell.llm.words import _powers, number_spans, split_words

CONTEXTS = 3
TABLE_BITS = 20
SEGMENT = 1 << 14
GATES = 16
INPUTS = CONTEXTS + 1
STRETCHES = (64, 128, 256, 512, 1024, 2048, 4096)
RATE = 0.01
LIMIT = 8.0
SLICE = 1 << 20
#: Bytes whose bits are laid out together, bits that are mixed together and bytes whose words are hashed together.
GROUP = 1 << 17
RUN = 1 << 15
PIECE = 1 << 16
#: Words of one block of the exchange.
BLOCK_TOKENS = 1 << 20
END = np.uint64(0x9D39247E33776D41)
SPREAD = np.uint64(0xC2B2AE3D27D4EB4F)


def with_ends(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and starts of all texts, each followed by a zero byte."""
    data, starts = text_bytes(lower_ascii(text))
    n = len(starts) - 1
    out = np.zeros(len(data) + n, np.uint8)
    out[np.arange(len(data)) + np.repeat(np.arange(n), np.diff(starts))] = data
    return out, starts + np.arange(n + 1)


def preceding(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of texts that end in a zero byte: the 3 bytes before it within its
    text, with the byte itself on top, and a hash of the word so far."""
    n, wide = len(data), data.astype(np.uint32)
    last = wide << np.uint32(24)
    for k in (1, 2, 3):
        last[k:] |= wide[:-k] << np.uint32(8 * (k - 1))
    # Behind a text's first byte all are 0 but its own; so is the end of the text before.
    begin = starts[:-1]
    last[begin] &= np.uint32(0xFF000000)
    second = begin[begin + 1 < n] + 1
    last[second] &= np.uint32(0xFF00FFFF)
    # The word so far: running sums, restarted behind every byte of white space and text.
    gap = np.zeros(n, bool)
    gap[1:] = (data[:-1] == 32) | (data[:-1] - np.uint8(9) < 5)
    gap[begin] = True
    word, (up, down) = np.empty(n, np.uint64), _powers()
    held, power = 0, 1  # the hash of the word so far at a piece's start, and the base's power there
    for low in range(0, n, PIECE):
        high = min(n, low + PIECE)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((wide[low:high] + np.uint64(1)) * up[:high - low], out=sums[1:])
        cuts = np.flatnonzero(gap[low:high])
        first = cuts[0] if len(cuts) else high - low
        word[low:low + first] = sums[:first] * np.uint64(power) + np.uint64(held)
        times = np.diff(np.append(cuts, high - low))
        word[low + first:high] = (sums[first:-1] - sums[cuts].repeat(times)) * down[cuts].repeat(times)
        if len(cuts):
            held, power = (int(sums[-1]) - int(sums[cuts[-1]])) * int(down[cuts[-1]]) % (1 << 64), int(up[high - low - cuts[-1]])
        else:
            held, power = (held + int(sums[-1]) * power) % (1 << 64), power * int(up[high - low]) % (1 << 64)
    return last, word


def hashed(last: np.ndarray, word: np.ndarray) -> list[np.ndarray]:
    """For each predictor, a hash of its context."""
    three = (last & np.uint32(0xFFFFFF)).astype(np.uint64)
    out = [(three & np.uint64(0xFFFF)) + np.uint64(2 << 32), three + np.uint64(3 << 32), word ^ np.uint64(0xA5A5A5A5A5A5A5A5)]
    return [(c * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(8) for c in out]


def contexts(data: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """For each predictor, a hash of what precedes each byte within its text."""
    return hashed(*preceding(data, starts))


def one_of_each(key: np.ndarray) -> np.ndarray:
    """For each place one with the same key that stands for it, and for itself. A key may,
    rarely, have more than one such place; none stands for another key."""
    n = len(key)
    shift, own = np.uint64(64 - max(8, n.bit_length())), np.arange(n, dtype=np.int32 if n < 1 << 31 else np.int64)
    held = np.empty(1 << (64 - int(shift)), own.dtype)
    slot = key * SPREAD
    slot >>= shift
    held[slot.view(np.int64)] = own
    stands = held.take(slot.view(np.int64))
    # Those whose slot went to another key try once more among themselves.
    left = np.flatnonzero(key.take(stands) != key)
    lost = key.take(left)
    slot = ((lost ^ lost >> np.uint64(29)) * END >> shift).view(np.int64)
    held[slot] = left
    found = held.take(slot)
    stands[left] = np.where(key.take(found) == lost, found, left)
    return stands


class Code:
    """A Huffman code of bytes. ``length`` by byte; by depth and byte: ``node``, a hash of
    the tree's node where the bit is decided, and ``bit``."""

    def __init__(self, times: np.ndarray):
        heap = [(int(n) + 1, i, i) for i, n in enumerate(times)]
        heapq.heapify(heap)
        above, number = {}, 256
        while len(heap) > 1:
            (a, _, x), (b, _, y) = heapq.heappop(heap), heapq.heappop(heap)
            above[x], above[y] = (number, 0), (number, 1)
            heapq.heappush(heap, (a + b, number, number))
            number += 1
        paths = []
        for byte in range(256):
            path, at = [], byte
            while at in above:
                path.append(above[at])
                at = above[at][0]
            paths.append(path[::-1])
        self.length = np.array([len(p) for p in paths], np.uint8)
        self.node, self.bit = np.zeros((self.length.max(), 256), np.uint64), np.zeros((self.length.max(), 256), np.uint8)
        for byte, path in enumerate(paths):
            for d, (node, bit) in enumerate(path):
                self.node[d, byte], self.bit[d, byte] = node * 0x9E3779B97F4A7C15 % (1 << 64), bit


def slots(context: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Places in a predictor's table."""
    out = context + node
    out *= SPREAD
    out >>= np.uint64(64 - TABLE_BITS)
    return out.view(np.int64)


def pairs(data: np.ndarray, starts: np.ndarray, code: Code) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, list[int]]:
    """Distinct pairs of contexts and byte, those of the longest codes first: their bytes,
    their contexts by predictor, the pair of each place, and how many pairs reach a depth."""
    last, word = preceding(data, starts)
    stands = one_of_each(word + last * END)
    first = np.flatnonzero(stands == np.arange(len(stands), dtype=stands.dtype))
    length = code.length.take(data.take(first))
    first = first.take(np.argsort(np.uint8(255) - length, kind="stable"))
    rank = np.empty_like(stands)
    rank[first] = np.arange(len(first), dtype=stands.dtype)
    reach = len(first) - np.cumsum(np.bincount(length, minlength=len(code.node)))[:len(code.node)]
    return data.take(first), hashed(last.take(first), word.take(first)), rank.take(stands), [m for m in reach.tolist() if m]


def count_bits(text: pa.Array, into: np.ndarray, code: Code) -> None:
    """Adds a batch of texts to ``into``: predictors x slots x (zeros, ones)."""
    data, starts = with_ends(text)
    if not len(data):
        return
    # Each pair once, with its count; then their bits.
    byte, ctx, number, reach = pairs(data, starts, code)
    times = np.bincount(number, minlength=len(byte)).astype(into.dtype)
    for table, context in zip(into, ctx):
        for d, m in enumerate(reach):
            at = slots(context[:m], code.node[d].take(byte[:m])) << 1 | code.bit[d].take(byte[:m])
            np.add.at(table, at, times[:m])


def log_odds(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.clip(np.log((ones + 0.4) / (zeros + 0.4)), -LIMIT, LIMIT).astype(np.float32)


class Inputs:
    """Inputs of all bits of some texts; each distinct pair of contexts and byte is looked
    up once. ``number``: by byte, its pair's; ``size``: bytes of each text."""

    def __init__(self, text: pa.Array, tables: np.ndarray, code: Code):
        data, self.starts = with_ends(text)
        self.size, self.least = np.diff(self.starts), int(code.length.min())
        byte, ctx, self.number, self.reach = pairs(data, self.starts, code)
        # All pairs' first bits, then the second ones of those that have one, and so on.
        rows = np.empty((sum(self.reach), INPUTS), np.float32)
        self.rows, low = rows.view(np.complex128).ravel(), 0  # four numbers are moved at once
        # Slots are (context + node) * SPREAD: both factors are multiplied once, not for each bit.
        ctx, nodes, signs = [c * SPREAD for c in ctx], code.node * SPREAD, np.where(code.bit, 1, -1).astype(np.float32)
        for d, m in enumerate(self.reach):
            node, sign = nodes[d].take(byte[:m]), signs[d].take(byte[:m])
            for k, c in enumerate(ctx):
                slot = c[:m] + node
                slot >>= np.uint64(64 - TABLE_BITS)
                np.multiply(tables[k].take(slot.view(np.int64)), sign, out=rows[low:low + m, k])
            rows[low:low + m, CONTEXTS] = sign
            low += m

    def steps(self) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """For each stretch the texts that reach it, their bytes there and where it begins."""
        live, done, step = np.flatnonzero(self.size), 0, 0
        while len(live):
            most = STRETCHES[min(step, len(STRETCHES) - 1)]
            yield live, np.minimum(self.size[live] - done, most), done
            done, step = done + most, step + 1
            live = live[self.size[live] > done]

    def bytes_of(self, steps: list[tuple[np.ndarray, np.ndarray, int]]) -> np.ndarray:
        """The pairs' numbers of all bytes of these stretches, one text after the other."""
        times = np.concatenate([length for _, length, _ in steps])
        first = np.concatenate([self.starts[docs] + done for docs, _, done in steps])
        first -= np.cumsum(times) - times
        return self.number.take(first.repeat(times) + np.arange(times.sum()))

    def places(self, number: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each place in the code but the last, which holds all later ones: inputs x
        bits, with the sign of the bit that comes, and where in ``number`` each bit is from."""
        where, out, low = np.arange(len(number)), [], 0
        for d, m in enumerate(self.reach):
            if d >= self.least:
                on = np.flatnonzero(number < m)
                if not len(on):
                    break
                number, where = number.take(on), where.take(on)
            out.append((np.ascontiguousarray(self.rows[low:low + m].take(number).view(np.float32).reshape(-1, INPUTS).T), where))
            low += m
        last = out[GATES // 2 - 1:]
        if len(last) > 1:
            where = np.concatenate([w for _, w in last])
            order = np.argsort(where, kind="stable")
            out[GATES // 2 - 1:] = [(np.concatenate([x for x, _ in last], 1).take(order, 1), where.take(order))]
        return out


def laid_out(inputs: Inputs) -> Iterator[tuple[np.ndarray, ...]]:
    """For each stretch, all bits of the texts that reach it, side by side by place in the
    code and text: (texts, their lengths, and for each run of bits its text's place in
    these, its place in the code and where it starts, one more; inputs x bits)."""
    steps = []
    for step in inputs.steps():
        steps.append(step)
        if sum(int(length.sum()) for _, length, _ in steps) >= GROUP:  # short stretches are taken together
            yield from together(inputs, steps)
            steps = []
    if steps:
        yield from together(inputs, steps)


def together(inputs: Inputs, steps: list[tuple[np.ndarray, np.ndarray, int]]) -> Iterator[tuple[np.ndarray, ...]]:
    places, edges = inputs.places(inputs.bytes_of(steps)), np.append(0, np.cumsum(np.concatenate([length for _, length, _ in steps])))
    firsts, low = [np.searchsorted(where, edges) for _, where in places], 0
    for docs, length, _ in steps:
        high = low + len(docs)
        bits = np.concatenate([x[:, f[low]:f[high]] for (x, _), f in zip(places, firsts)], 1)
        times = np.concatenate([np.diff(f[low:high + 1]) for f in firsts])
        run = np.flatnonzero(times)
        yield docs, length, run % len(docs), run // len(docs), np.append(0, np.cumsum(times[run])), bits
        low = high


def errors(dot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The probability of the other bit, and one more than its odds, for bits of which
    the sum of weighted inputs speaks with ``dot``."""
    np.clip(dot, -15, 15, out=dot)
    away = np.exp(np.negative(dot, out=dot), out=dot)
    whole = away + np.float32(1)
    return np.divide(away, whole, out=away), whole


def bits_of(text: pa.Array, tables: np.ndarray, code: Code, weights: np.ndarray, rate: float = RATE) -> tuple[np.ndarray, np.ndarray]:
    """Code length in bits of each text, and the weights that each text ends with."""
    n = len(text)
    total, own = np.zeros(n), np.repeat(weights[None].astype(np.float32), n, 0)
    if not n:
        return total, own
    for docs, length, of, place, first, bits in laid_out(Inputs(text, tables, code)):
        begin, unknown = own[docs], np.flatnonzero(bits[1] == 0)
        known, other = np.ascontiguousarray(begin[of, 2 * place + 1].T), np.ascontiguousarray(begin[of, 2 * place].T)
        sums, moves, low_moves = np.empty(len(of)), np.empty((INPUTS, len(of))), np.zeros((INPUTS, len(of)))
        cuts = np.unique(np.append(np.searchsorted(first, np.arange(0, first[-1], RUN)), len(of))).tolist()
        for a, b in zip(cuts[:-1], cuts[1:]):
            low, high = int(first[a]), int(first[b])
            x, times, starts = bits[:, low:high], np.diff(first[a:b + 1]), first[a:b] - low
            few = unknown[np.searchsorted(unknown, low):np.searchsorted(unknown, high)]
            dot = known[CONTEXTS, a:b].repeat(times)
            dot *= x[CONTEXTS]
            for k in range(CONTEXTS):
                part = known[k, a:b].repeat(times)
                part *= x[k]
                dot += part
            which, few = np.searchsorted(first, few, "right") - 1, few - low
            dot[few] = (other[:, which] * x[:, few]).sum(0)
            error, whole = errors(dot)
            sums[a:b] = np.add.reduceat(np.log(whole, out=whole), starts)
            for k in range(INPUTS):
                np.multiply(error, x[k], out=whole)
                moves[k, a:b] = np.add.reduceat(whole, starts)
                if len(few):
                    low_moves[k] += np.bincount(which, whole[few], len(of))
        total[docs] += np.bincount(of, sums, len(docs)) / np.log(2)
        change = np.zeros((len(docs), GATES, INPUTS))
        change[of, 2 * place + 1], change[of, 2 * place] = (moves - low_moves).T, low_moves.T
        own[docs] = begin + (rate * change / np.sqrt(length)[:, None, None]).astype(np.float32)
    return total, own


def learned(text: pa.Array, tables: np.ndarray, code: Code, weights: np.ndarray, rate: float, rounds: int) -> np.ndarray:
    """The weights after ``rounds`` over texts that share them: after each stretch they
    move by the mean, by bytes, of what each text would move its own. Pairs that occur
    more than once in a stretch of all texts are mixed once."""
    inputs, weights = Inputs(text, tables, code), weights.astype(np.float32)
    share = inputs.size / inputs.size.sum()
    stretches = []
    for step in inputs.steps():
        docs, length, _ = step
        times = np.bincount(inputs.bytes_of([step]), (share[docs] / np.sqrt(length)).repeat(length), inputs.reach[0])
        number = np.flatnonzero(times > 0)
        stretches.append((number.astype(inputs.number.dtype), times.take(number).astype(np.float32)))
    for _ in range(rounds):
        for number, times in stretches:
            move = np.zeros((GATES, INPUTS))
            for place, (x, where) in enumerate(inputs.places(number)):
                few = np.flatnonzero(x[1] == 0)
                dot = np.einsum("k,kj->j", weights[2 * place + 1], x)
                dot[few] = np.einsum("k,kj->j", weights[2 * place], x[:, few])
                error, _ = errors(dot)
                error *= times.take(where)
                move[2 * place] = np.einsum("j,kj->k", error[few], x[:, few])
                move[2 * place + 1] = np.einsum("j,kj->k", error, x) - move[2 * place]
            weights = weights + (rate * move).astype(np.float32)
    return weights


def start_weights() -> np.ndarray:
    out = np.full((GATES, INPUTS), 0.35, np.float32)
    out[:, CONTEXTS] = 0
    return out


class Mixer:
    """Tables of log-odds, the code and first weights; of a size that does not depend on the corpus."""

    def __init__(self, tables: np.ndarray, code: Code, weights: np.ndarray):
        self.tables, self.code, self.weights = tables, code, weights


def train(docs: DataFrame, text: str) -> Mixer:
    """Code, counts and first weights from all rows of ``docs``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(text).alias("text"))

    @tidy
    def tally(batches):
        times = np.zeros(256)
        for batch in batches:
            for part in slices(batch, "text"):
                times += np.bincount(with_ends(part.column("text"))[0], minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(range(256)), pa.array(times)], ["byte", "n"])

    times = np.zeros(256)
    for r in rows.mapInArrow(tally, "byte long, n double").groupBy("byte").agg(F.sum("n").alias("n")).collect():
        times[r["byte"]] = r["n"]
    code, segments = Code(times), (1 << TABLE_BITS) // SEGMENT

    @tidy
    def count(batches):
        counts = np.zeros((CONTEXTS, 2 << TABLE_BITS), np.uint32)
        for batch in batches:
            for part in slices(batch, "text"):
                count_bits(part.column("text"), counts, code)
        for i in range(CONTEXTS):
            table = counts[i].reshape(segments, SEGMENT, 2)
            found = [(i * segments + s, at.astype(np.uint16).tobytes(), own[at].tobytes())
                     for s, own in enumerate(table) if len(at := np.flatnonzero(own.any(1)))]
            if found:
                name, at, n = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(name, pa.int32()), pa.array(at, pa.binary()), pa.array(n, pa.binary())],
                                                 ["segment", "at", "n"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros((SEGMENT, 2), np.int64)
        for at, n in zip(table.column("at").to_pylist(), table.column("n").to_pylist()):
            total[np.frombuffer(at, np.uint16)] += np.frombuffer(n, np.uint32).reshape(-1, 2)
        return pa.table({"segment": table.column("segment").slice(0, 1),
                         "odds": pa.array([log_odds(total[:, 0], total[:, 1]).tobytes()], pa.binary())})

    # A row for each segment of the tables, whatever the corpus.
    added = rows.mapInArrow(count, "segment int, at binary, n binary").groupBy("segment").applyInArrow(
        add, "segment int, odds binary").collect()
    tables = np.zeros((CONTEXTS * segments, SEGMENT), np.float32)
    for r in added:
        tables[r["segment"]] = np.frombuffer(r["odds"], np.float32)
    mixer = Mixer(tables.reshape(CONTEXTS, 1 << TABLE_BITS), code, start_weights())
    shared = spark.sparkContext.broadcast(mixer)

    @tidy
    def learn(batches):
        """The sum, weighed by bytes, of what a partition's slices end with after two rounds."""
        n, sums, own = 0.0, np.zeros((GATES, INPUTS)), shared.value
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                column = part.column("text")
                share = len(text_bytes(column)[0]) + part.num_rows
                n += share
                sums += share * learned(column, own.tables, own.code, own.weights, 2 * RATE, 2)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([sums.tobytes()], pa.binary())], ["n", "w"])

    ends = sorted(rows.mapInArrow(learn, "n double, w binary").collect())  # some 500 bytes for each partition
    if ends:
        mixer.weights = (sum(np.frombuffer(r["w"]).reshape(GATES, INPUTS) for r in ends) / sum(r["n"] for r in ends)).astype(np.float32)
    return mixer


def name_of(text: pa.Array) -> np.ndarray:
    """A 64-bit name for each text, to find a row's other half."""
    data, starts = text_bytes(text)
    raw = memoryview(np.ascontiguousarray(data))
    return np.array([int.from_bytes(hashlib.blake2b(raw[a:b], digest_size=8).digest(), "big", signed=True)
                     for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())], np.int64)


def mixed_scores(docs: DataFrame, key: str, text: str, mixer: Mixer) -> DataFrame:
    """(key, name, bits, bytes) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(mixer)
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("name", T.LongType()),
                           T.StructField("bits", T.DoubleType()), T.StructField("bytes", T.LongType())])

    @tidy
    def score(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                own = part.column("text")
                bits, _ = bits_of(own, shared.value.tables, shared.value.code, shared.value.weights)
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(name_of(own)), pa.array(bits),
                                                  pa.array(np.diff(text_bytes(own)[1]))], schema.names)

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(score, schema)


def token_scores(docs: DataFrame, key: str, text: str, trains: Column) -> DataFrame:
    """(key, name, n_tokens, n_known, train_tokens, base_score) of every row: tokens are
    its words and one end; base_score the sum of log10((c + 1) / (N + V + 1))."""
    spark = docs.sparkSession
    owners = max(16, docs.rdd.getNumPartitions())
    step = -(-(1 << 64) // owners)
    edges = np.array([min(o * step, (1 << 64) - 1) for o in range(owners)], np.uint64)
    key_type = docs.schema[key].dataType
    schema = T.StructType([T.StructField("kind", T.StringType()), T.StructField("block", T.StringType()), T.StructField("owner", T.IntegerType()),
                           T.StructField("words", T.BinaryType()), T.StructField("counts", T.BinaryType()),
                           T.StructField("keys", T.ArrayType(key_type)), T.StructField("names", T.BinaryType()),
                           T.StructField("sizes", T.BinaryType()), T.StructField("first", T.BinaryType()),
                           T.StructField("word", T.BinaryType()), T.StructField("times", T.BinaryType())])

    def send(keys, names, trained, numbers, doc, block: str):
        n = len(trained)
        # Sorted are only the tokens that stand for all of a kind.
        stands = one_of_each(numbers)
        first = np.flatnonzero(stands == np.arange(len(stands), dtype=stands.dtype))
        distinct, rank = np.unique(numbers.take(first), return_inverse=True)
        place = np.empty(len(numbers), np.int64)
        place[first] = rank
        word = place.take(stands)
        counts = np.bincount(word[trained[doc]], minlength=len(distinct)).astype(np.int64)
        cell, times = np.unique(doc.astype(np.int64) * len(distinct) + word, return_counts=True)
        first = np.searchsorted(cell, np.arange(n + 1) * len(distinct))
        cuts = np.append(np.searchsorted(distinct, edges), len(distinct))
        own = [(o, a, b) for o, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if b > a]
        kinds = {f.name: pa.binary() for f in schema} | {"kind": pa.string(), "block": pa.string(), "owner": pa.int32(), "keys": pa.list_(keys.type)}

        def batch(rows, /, **columns):
            return pa.RecordBatch.from_arrays([pa.array(columns[f.name], kinds[f.name]) if f.name in columns else pa.nulls(rows, kinds[f.name])
                                               for f in schema], schema.names)

        yield batch(len(own), kind=["words"] * len(own), block=[block] * len(own), owner=[o for o, *_ in own],
                    words=[distinct[a:b].tobytes() for _, a, b in own], counts=[counts[a:b].tobytes() for _, a, b in own])
        whole = pa.RecordBatch.from_arrays([
            pa.array(["docs"]), pa.array([block]), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
            pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), keys), pa.array([names.tobytes()], pa.binary()),
            pa.array([np.bincount(doc, minlength=n).astype(np.int64).tobytes()], pa.binary()), pa.array([first.astype(np.int64).tobytes()], pa.binary()),
            pa.array([(cell - np.repeat(np.arange(n), np.diff(first)) * len(distinct)).astype(np.uint32).tobytes()], pa.binary()),
            pa.array([times.astype(np.uint32).tobytes()], pa.binary())], schema.names)
        yield whole

    @tidy
    def partition(batches):
        held, n, tokens, block = [], 0, 0, 0
        for batch in batches:
            for part in slices(batch, "text"):
                data, starts = text_bytes(lower_ascii(part.column("text")))
                a, b = split_words(data, starts)
                rows = part.num_rows
                numbers = np.concatenate([number_spans(data, a, b), np.full(rows, END)])
                doc = np.concatenate([np.repeat(np.arange(rows), np.diff(np.searchsorted(a, starts))), np.arange(rows)])
                held.append((part.column("key"), name_of(part.column("text")),
                             part.column("trains").to_numpy(zero_copy_only=False).astype(bool), numbers, doc + n))
                n, tokens = n + rows, tokens + len(numbers)
                if tokens >= BLOCK_TOKENS:
                    yield from send(pa.concat_arrays([h[0] for h in held]), *(np.concatenate([h[i] for h in held]) for i in range(1, 5)),
                                    f"{TaskContext.get().partitionId()}-{block}")
                    held, n, tokens, block = [], 0, 0, block + 1
        if held:
            yield from send(pa.concat_arrays([h[0] for h in held]), *(np.concatenate([h[i] for h in held]) for i in range(1, 5)),
                            f"{TaskContext.get().partitionId()}-{block}")

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), trains.alias("trains"))
    sent = written(rows.mapInArrow(partition, schema), "words", "kind")

    def answer(table: pa.Table) -> pa.Table:
        words = [np.frombuffer(w, np.uint64) for w in table.column("words").to_pylist()]
        counts = np.concatenate([np.frombuffer(c, np.int64) for c in table.column("counts").to_pylist()])
        distinct, where = np.unique(np.concatenate(words), return_inverse=True)
        total = np.bincount(where, counts, len(distinct)).astype(np.int64)
        ends = np.cumsum([len(w) for w in words])
        back = [total[where[b - len(w):b]].tobytes() for w, b in zip(words, ends)]
        n = len(words)
        release()
        return pa.table({"block": table.column("block"), "owner": table.column("owner"), "counts": pa.array(back, pa.binary()),
                         "tokens": pa.array([int(total.sum())] + [0] * (n - 1), pa.int64()),
                         "known": pa.array([int((total > 0).sum())] + [0] * (n - 1), pa.int64())})

    answers = written(sent.filter("kind = 'words'").select("block", "owner", "words", "counts").groupBy("owner").applyInArrow(
        answer, "block string, owner int, counts binary, tokens long, known long"), "answers")
    n, v = answers.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("known"), F.lit(0))).first()
    out = T.StructType([T.StructField("key", key_type), T.StructField("name", T.LongType()), T.StructField("n_tokens", T.LongType()),
                        T.StructField("n_known", T.LongType()), T.StructField("base", T.DoubleType())])

    def total(docs: pa.Table, answers: pa.Table) -> pa.Table:
        docs, answers = docs.to_pylist()[0] if docs.num_rows == 1 else None, answers.sort_by("owner")
        c = np.concatenate([np.frombuffer(x, np.int64) for x in answers.column("counts").to_pylist()])
        first = np.frombuffer(docs["first"], np.int64)
        word, times = np.frombuffer(docs["word"], np.uint32), np.frombuffer(docs["times"], np.uint32).astype(float)
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        sums = np.bincount(doc, times * np.log10(c[word] + 1.0), len(first) - 1)
        known = np.bincount(doc, times * (c[word] > 0), len(first) - 1)
        release()
        return pa.table({"key": pa.array(docs["keys"]), "name": np.frombuffer(docs["names"], np.int64),
                         "n_tokens": np.frombuffer(docs["sizes"], np.int64), "n_known": known.astype(np.int64), "base": sums})

    whole = sent.filter("kind = 'docs'").select("block", "keys", "names", "sizes", "first", "word", "times")
    scored = whole.groupBy("block").cogroup(answers.select("block", "owner", "counts").groupBy("block")).applyInArrow(total, out)
    base = F.col("base") - F.col("n_tokens") * F.lit(float(np.log10(n + v + 1)))
    return scored.select("key", "name", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"))


def scores(docs: DataFrame, key: str, text: str, trains: Column) -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) of every row."""
    own = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), trains.alias("trains"))
    mixer = train(own.filter("trains"), "text")
    mixed = mixed_scores(own, "key", "text", mixer)
    base = token_scores(own, "key", "text", F.col("trains"))
    # A row's two halves meet by key and text; equal rows have equal halves.
    base = base.groupBy(F.col("key").alias("_key"), F.col("name").alias("_name")).agg(
        *(F.max(c).alias(c) for c in ("n_tokens", "n_known", "train_tokens", "base_score")))
    joined = mixed.join(base, F.col("key").eqNullSafe(F.col("_key")) & (F.col("name") == F.col("_name")))
    return joined.select("key", "n_tokens", "n_known", "train_tokens", "base_score", (-F.col("bits") * float(np.log10(2))).alias("score"),
                         (F.col("bits") / (F.col("bytes") + 1)).alias("bits_per_byte"))
