"""Language of texts by prediction by partial matching (PPM).

For every language a tree of byte contexts of length 0 to ``ORDER`` is counted over
labelled texts and then frozen. A byte is coded in the longest context that was seen,
with probability c / (n + d) (c: times the byte followed the context, n: all bytes
after it, d: distinct ones); the escape to the next shorter context has d / (n + d).
Bytes already ruled out by a longer context are left out of the shorter one's counts,
and after all contexts the remaining bytes are equally likely. The sum of -log2 over a
text is its exact code length in a language; the shortest one wins.

Because statistics are frozen, a byte's length depends only on the last ``ORDER``
bytes. So lengths are tabulated once per run of ORDER + 1 bytes that training saw in
any language, and texts are scored by table look-ups; other runs are computed from the
trees as they come.

Nulls, empty texts and texts without a letter give ``und`` and score 0. Equal code
lengths go to the first language in code-point order. Rows that repeat are scored
alike. With no labelled rows every text is ``und``. Input columns other than those
named are neither read nor changed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.llm.shared import SLICE_BYTES, release, slices, text_bytes, tidy

ORDER = 3
#: Labelled rows that a language's tree is counted over, about: each row of a language
#: with more is taken with probability SAMPLE_ROWS / rows, by a hash of its key.
SAMPLE_ROWS = 3000
#: What comes before a text.
START = "\n" * ORDER
UNDETERMINED = "und"


def padded(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and starts of all texts, each behind START."""
    filled = pc.fill_null(text, "")
    return text_bytes(pc.binary_join_element_wise(pa.scalar(START, filled.type), filled, pa.scalar("", filled.type)))


def runs(data: np.ndarray) -> np.ndarray:
    """Number of the ORDER + 1 bytes that start at each place."""
    pair = (data[:-1].astype(np.uint16) << np.uint16(8)) | data[1:]
    return (pair[:-2].astype(np.uint32) << np.uint32(16)) | pair[2:]


def places(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last (exclusive) place of each text's own bytes among the runs."""
    return starts[:-1], starts[1:] - ORDER


def count_runs(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, starts = padded(text)
    if len(data) <= ORDER:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    own = np.ones(len(data), bool)
    for back in range(1, ORDER + 1):
        own[starts[1:] - back] = False
    return np.unique(runs(data)[own[:-ORDER]], return_counts=True)


class Tree:
    """One language's contexts. ``keys[k]`` are context and byte of order k in one
    number; ``contexts[k]`` the contexts with (n, d) and, for the next shorter order,
    the (n, d) that remain after this context's bytes are left out."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        order = np.argsort(grams)
        grams, counts = grams[order].astype(np.int64), counts[order].astype(np.int64)
        self.keys, self.counts, self.contexts = [], [], []
        for k in range(ORDER + 1):
            key, at = np.unique(grams & ((1 << 8 * (k + 1)) - 1), return_inverse=True)
            count = np.bincount(at, counts, len(key)).astype(np.int64)
            context, own = np.unique(key >> 8, return_inverse=True)
            n, d = np.bincount(own, count, len(context)), np.bincount(own, minlength=len(context))
            rest = np.zeros((2, len(context)))
            if k:
                shorter = np.searchsorted(self.keys[k - 1], key & ((1 << 8 * k) - 1))
                parent = np.searchsorted(self.contexts[k - 1][0], context & ((1 << 8 * (k - 1)) - 1))
                rest[0] = self.contexts[k - 1][1][parent] - np.bincount(own, self.counts[k - 1][shorter], len(context))
                rest[1] = self.contexts[k - 1][2][parent] - d
            self.keys.append(key)
            self.counts.append(count)
            self.contexts.append((context, n.astype(float), d.astype(float), rest))

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """Code length of the last byte of each run after the bytes before it."""
        grams = grams.astype(np.int64)
        out, open_ = np.zeros(len(grams)), np.ones(len(grams), bool)
        total, distinct = np.zeros(len(grams)), np.zeros(len(grams))
        known = np.zeros(len(grams), bool)
        for k in range(ORDER, -1, -1):
            context, n, d, rest = self.contexts[k]
            key = grams & ((1 << 8 * (k + 1)) - 1)
            at = np.minimum(np.searchsorted(context, key >> 8), max(0, len(context) - 1))
            here = open_ & (context[at] == key >> 8) if len(context) else np.zeros(len(grams), bool)
            fresh = here & ~known
            total[fresh], distinct[fresh] = n[at[fresh]], d[at[fresh]]
            known |= here
            slot = np.minimum(np.searchsorted(self.keys[k], key), max(0, len(self.keys[k]) - 1))
            hit = here & (self.keys[k][slot] == key) if len(self.keys[k]) else here
            out[hit] -= np.log2(self.counts[k][slot[hit]] / (total[hit] + distinct[hit]))
            open_ &= ~hit
            escape = here & ~hit & (distinct > 0)
            out[escape] -= np.log2(distinct[escape] / (total[escape] + distinct[escape]))
            on = here & ~hit
            if k:
                total[on], distinct[on] = rest[0][at[on]], rest[1][at[on]]
        out[open_] += np.log2(256 - len(self.keys[0]))
        return out


@dataclass
class Model:
    """Frozen trees and the table of code lengths (runs x languages)."""

    languages: list[str]
    grams: np.ndarray  # uint32, sorted: runs that any tree saw
    trees: list[Tree]

    def __post_init__(self):
        self.table = np.stack([t.bits(self.grams) for t in self.trees], 1).astype(np.float32) if self.trees else None
        self.shift = np.uint32(32 - min(24, max(4, int(len(self.grams) * 8).bit_length())))
        self.slot_gram = np.zeros(1 << (32 - int(self.shift)), np.uint32)
        self.slot_row = np.full(len(self.slot_gram), -1, np.int32)
        slot = self._slot(self.grams)
        self.slot_gram[slot], self.slot_row[slot] = self.grams, np.arange(len(self.grams), dtype=np.int32)

    def _slot(self, grams: np.ndarray) -> np.ndarray:
        return (grams * np.uint32(0x9E3779B1)) >> self.shift

    def bits(self, text: pa.Array) -> np.ndarray:
        """Code length in bits of every text (rows) in every language (columns)."""
        data, starts = padded(text)
        first, last = places(starts)
        out = np.zeros((len(text), len(self.languages)))
        for low in range(0, max(0, len(data) - ORDER), SLICE_BYTES):  # pieces of long texts, with ORDER bytes of overlap
            part = runs(data[low:low + SLICE_BYTES + ORDER])
            slot = self._slot(part)
            row = np.where(self.slot_gram[slot] == part, self.slot_row[slot], -1)
            missed = np.flatnonzero(row < 0)
            if len(missed):
                at = np.minimum(np.searchsorted(self.grams, part[missed]), max(0, len(self.grams) - 1))
                found = self.grams[at] == part[missed] if len(self.grams) else np.zeros(len(missed), bool)
                row[missed[found]] = at[found]
                missed = missed[~found]
            new, where = np.unique(part[missed], return_inverse=True)
            a, b = np.clip(first - low, 0, len(part)), np.clip(last - low, 0, len(part))
            b = np.maximum(a, b)
            for i, tree in enumerate(self.trees):
                cost = self.table[:, i][row] if len(self.grams) else np.zeros(len(part), np.float32)
                if len(missed):
                    cost[missed] = tree.bits(new)[where]
                sums = np.zeros(len(part) + 1)
                np.cumsum(cost, dtype=np.float64, out=sums[1:])
                out[:, i] += sums[b] - sums[a]
        return out


def train(labelled: DataFrame, text: str, lang: str, key: Column, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Counts the trees over rows with a language and a text.

    The counts of rows per language decide the sample's rate; the sample's runs are
    counted by Spark, and only their sums come to the driver. ``key`` is hashed to
    choose the rows and is not seen by the model.
    """
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text"), key.alias("key")) \
        .filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    share = {r["lang"]: sample_rows / r["count"] for r in rows.groupBy("lang").count().collect()}
    if not share:
        return Model([], np.zeros(0, np.uint32), [])
    rate = F.create_map(*(F.lit(x) for pair in share.items() for x in pair))[F.col("lang")]
    drawn = F.shiftrightunsigned(F.xxhash64("key"), 11) / float(1 << 53) < rate

    @tidy
    def tally(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                for name in pc.unique(part.column("lang")).to_pylist():
                    grams, counts = count_runs(part.filter(pc.equal(part.column("lang"), name)).column("text"))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(grams), pa.string()), pa.array(grams.astype(np.int64)), pa.array(counts)],
                        ["lang", "gram", "n"])

    counted = rows.filter(drawn).mapInArrow(tally, "lang string, gram long, n long") \
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow().combine_chunks()
    languages = sorted(set(share) & set(pc.unique(counted.column("lang")).to_pylist()))
    trees = []
    for name in languages:
        own = counted.filter(pc.equal(counted.column("lang"), name))
        trees.append(Tree(own.column("gram").to_numpy(), own.column("n").to_numpy()))
    return Model(languages, np.unique(counted.column("gram").to_numpy()).astype(np.uint32), trees)


_letter = np.zeros(256, bool)
_letter[65:91] = _letter[97:123] = True


def has_letter(text: pa.Array) -> np.ndarray:
    data, starts = text_bytes(text)
    sums = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_letter[data], out=sums[1:])
    found = sums[starts[1:]] > sums[starts[:-1]]
    for i in np.flatnonzero(~found & (np.diff(starts) > 0)):  # other alphabets
        found[i] = any(c.isalpha() for c in text[int(i)].as_py())
    return found


def predict(df: DataFrame, model: Model, text: str, out: str = "language") -> DataFrame:
    """Adds the struct ``out``: ``lang`` (a trained language or ``und``), ``score`` (the
    winner's share of 2**-bits over all languages, 0 for ``und``), ``bits_per_byte``."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("bits_per_byte", pa.float64())])

    def languages(column: pa.Array) -> pa.Array:
        model, parts = shared.value, []
        for part in slices(pa.RecordBatch.from_arrays([column], ["text"]), "text"):
            own = part.column("text")
            known = has_letter(own) if model.languages else np.zeros(len(own), bool)
            if model.languages:
                bits = model.bits(own)
                best = bits.argmin(1)
                least = bits[np.arange(len(own)), best]
                score = 1 / np.exp2(least[:, None] - bits).sum(1)
                size = np.maximum(1, pc.binary_length(own).fill_null(0).to_numpy(zero_copy_only=False))
                names = np.array([*model.languages, UNDETERMINED], object)[np.where(known, best, len(model.languages))]
                parts.append((names, np.where(known, score, 0.0), least / size))
            else:
                parts.append((np.full(len(own), UNDETERMINED, object), np.zeros(len(own)), np.full(len(own), 8.0)))
        if not parts:
            return pa.array([], kind)
        names, score, rate = (np.concatenate(x) for x in zip(*parts))
        release()
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score), pa.array(rate)], fields=list(kind))

    scored = F.arrow_udf(languages, "lang string, score double, bits_per_byte double")
    return df.withColumn(out, scored(F.col(text)))
