"""Merkle manifest of a dataset: a root for all rows, and for every row the proof that it belongs.

Rows of a group, in order, are the leaves of a tree of fixed fanout; the groups' roots,
in order, are the leaves of the tree above. A block of ``fanout ** levels`` leaves is hashed
where it lies. Above blocks the trees are climbed by a butterfly exchange: in every round the
``fanout`` blocks that differ in one digit of their number swap the roots of the subtrees
they stand in and each hashes the parent for itself. After the last round every block knows
the root and all siblings on its way there, so nothing has to be handed down again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.llm.ranks import placed
from tracewell.llm.shared import release, written

#: Leaves of a block as a power of the fanout.
LEVELS = 11
#: Rounds between two writes, which bound the plan and what a lost executor repeats.
ROUNDS = 8

#: A step of a proof: the place among the run's nodes, and the digests of the others.
STEP = "struct<place:int,others:array<string>>"
_STEP = pa.struct([("place", pa.int32()), ("others", pa.list_(pa.string()))])


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    """Digest of a row, one to one with its values."""
    return F.sha2(F.concat(*(field(value) for value in values)), 256)


def fold(digest: Column, proof: Column) -> Column:
    """The root that ``digest`` leads to along ``proof``."""
    def up(node: Column, step: Column) -> Column:
        others, place = step["others"], step["place"]
        left, right = F.slice(others, 1, place), F.slice(others, place + 1, F.size(others))
        return F.sha2(F.concat(F.array_join(left, ""), node, F.array_join(right, "")), 256)

    return F.aggregate(proof, digest, up)


def proof_text(proof: Column) -> Column:
    """The proof's digests end to end, level by level, from left to right."""
    return F.array_join(F.flatten(F.transform(proof, lambda step: step["others"])), "")


def height(leaves: int, fanout: int) -> int:
    rounds = 0
    while leaves > 1:
        leaves, rounds = -(-leaves // fanout), rounds + 1
    return rounds


def _tree(nodes: list[str], fanout: int, levels: int) -> list[list[str]]:
    """The nodes of all levels up to ``levels`` above the given ones."""
    tree = [nodes]
    for _ in range(levels):
        nodes = [hashlib.sha256("".join(nodes[i:i + fanout]).encode()).hexdigest() for i in range(0, len(nodes), fanout)]
        tree.append(nodes)
    return tree


def _block(table: pa.Table, fanout: int, levels: int) -> tuple[pa.Table, list[list[str]]]:
    """The block's rows in order, and its tree."""
    table = table.sort_by("pos")
    height_ = height(table.column("total")[0].as_py(), fanout)
    return table, _tree(table.column("leaf").to_pylist(), fanout, min(levels, height_))


def _exchange(blocks: DataFrame, r: int, fanout: int) -> DataFrame:
    """One round. ``blocks``: tree, block, blocks (of the tree), digest (of the subtree of
    fanout ** r blocks around it), proof (up to there).

    Blocks with equal offsets in neighbouring subtrees swap. In the last, shorter subtree
    of a tree a block also stands in for the offsets that are missing there.
    """
    step = fanout ** r
    subtree = F.floor(F.col("block") / step)
    rows = blocks.withColumns({
        "offset": F.col("block") % step, "side": (subtree % fanout).cast("int"), "parent": F.floor(subtree / fanout),
        "present": F.least(F.lit(step), F.col("blocks") - subtree * step), "rising": F.col("blocks") > step})
    stands_in = F.col("rising") & (F.col("present") < step) & (F.col("side") > 0)
    sent = rows.withColumn("at", F.explode(
        F.when(stands_in, F.sequence(F.col("offset"), F.lit(step - 1).cast("long"), F.col("present"))).otherwise(F.array("offset"))))
    own = F.when(F.col("at") == F.col("offset"), F.struct("block", "blocks", "rising", "side", "digest", "proof"))
    met = sent.groupBy("tree", "parent", "at").agg(
        F.array_sort(F.collect_list(F.struct("side", "digest"))).alias("run"), F.collect_list(own).alias("members"))
    each = met.select("tree", "run", F.inline("members"))
    others = F.transform(F.filter("run", lambda node: node["side"] != F.col("side")), lambda node: node["digest"])
    parent = F.sha2(F.array_join(F.transform("run", lambda node: node["digest"]), ""), 256)
    # The place is the number of nodes to the left, which are all there: only the end of a run is missing.
    taken = F.concat("proof", F.array(F.struct(F.col("side").alias("place"), others.alias("others"))))
    return each.select("tree", "block", "blocks", F.when(F.col("rising"), parent).otherwise(F.col("digest")).alias("digest"),
                       F.when(F.col("rising"), taken).otherwise(F.col("proof")).alias("proof"))


def climbed(leaves: DataFrame, fanout: int, levels: int) -> DataFrame:
    """(tree, block, root, proof) for every block of ``leaves`` (tree, pos, total, leaf):
    its tree's root and the steps from the block's own root to it."""
    size = fanout ** levels

    def root(key: tuple, table: pa.Table) -> pa.Table:
        table, tree = _block(table, fanout, levels)
        total = table.column("total")[0].as_py()
        return pa.table({"tree": [key[0].as_py()], "block": [key[1].as_py()], "blocks": [-(-total // size)], "digest": tree[-1]})

    blocks = leaves.select("tree", "pos", "total", "leaf", F.floor(F.col("pos") / size).alias("block")).groupBy("tree", "block") \
        .applyInArrow(root, "tree string, block long, blocks long, digest string")
    blocks = written(blocks.withColumn("proof", F.array().cast(f"array<{STEP}>")), "blocks")
    most = blocks.agg(F.max("blocks")).first()[0] or 0
    for r in range(height(most, fanout)):
        blocks = _exchange(blocks, r, fanout)
        if r % ROUNDS == ROUNDS - 1:
            blocks = written(blocks, "blocks")
    return blocks.select("tree", "block", F.col("digest").alias("root"), "proof")


def proved(leaves: DataFrame, blocks: DataFrame, carried: Sequence[str], fanout: int, levels: int) -> DataFrame:
    """The ``carried`` columns of ``leaves``, their ``leaf`` and ``proof``, and every further
    column of ``blocks`` (tree, block, proof from the block's root on, ...)."""
    size, carried = fanout ** levels, list(carried)
    further = [c for c in blocks.columns if c not in ("tree", "block", "proof")]
    types = dict(leaves.dtypes)

    def prove(table: pa.Table, above: pa.Table) -> pa.Table:
        table, tree = _block(table, fanout, levels)
        upper = above.column("proof")[0].as_py()
        proofs = []
        for i in range(table.num_rows):
            steps, at = [], i
            for nodes in tree[:-1]:
                start, place = at - at % fanout, at % fanout
                steps.append({"place": place, "others": nodes[start:at] + nodes[at + 1:start + fanout]})
                at //= fanout
            proofs.append(steps + upper)
        out = table.select([*carried, "leaf"]).append_column("proof", pa.array(proofs, pa.list_(_STEP)))
        for name in further:
            out = out.append_column(name, pa.repeat(above.column(name)[0], table.num_rows))
        release()
        return out

    schema = ", ".join([*(f"`{c}` {types[c]}" for c in carried), "leaf string", f"proof array<{STEP}>",
                        *(f"`{c}` string" for c in further)])
    at = leaves.select("tree", *carried, "pos", "total", "leaf", F.floor(F.col("pos") / size).alias("block"))
    return at.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(prove, schema)


def manifest(docs: DataFrame, key: str, group: str, values: Sequence[Column], probe: Column | None = None,
             fanout: int = 2, levels: int = LEVELS) -> DataFrame:
    """One row for every row of ``docs``: ``key``, ``leaf``, ``probe``, ``subroot`` (the
    root of its group), ``root`` (of all), ``proof`` (steps from leaf to root).

    ``values`` go into the leaf. ``probe`` is any digest to be carried along (null where
    there is none), say of the row as it is found elsewhere; ``fold`` tells whether it leads
    to the root. Leaves ascend by ``key``, null first, then by digest, so that repeated keys
    have a place and equal rows are interchangeable. Groups ascend by their UTF-8 bytes,
    null first, which is not the empty text. A lone leaf is its group's root; an empty
    table has no rows and no root. Texts are read once and not shuffled: only keys and
    digests move. Other columns of ``docs``, whatever their names, are not touched.
    """
    tree = F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0"))
    rows = docs.select(tree.alias("tree"), F.col(key).alias("key"), leaf(values).alias("leaf"),
                       (F.lit(None).cast("string") if probe is None else probe).alias("probe"))
    leaves = placed(written(rows, "leaves"), [F.col("key").asc_nulls_first(), F.col("leaf")], "tree")
    blocks = written(climbed(leaves, fanout, levels), "climbed")
    # The groups' roots are the leaves of one tree, climbed in the same way.
    tops = written(blocks.filter("block = 0").select(F.lit("").alias("tree"), F.col("tree").alias("member"),
                                                     F.col("root").alias("leaf")), "subroots")
    tops = placed(tops, [F.col("member")], "tree")
    above = proved(tops, climbed(tops, fanout, levels).drop("root"), ["member"], fanout, levels).select(
        F.col("member").alias("tree"), fold(F.col("leaf"), F.col("proof")).alias("root"), F.col("proof").alias("upper"))
    paths = blocks.withColumnRenamed("root", "subroot").join(above, "tree").select(
        "tree", "block", "subroot", "root", F.concat("proof", "upper").alias("proof"))
    return proved(leaves, paths, ["key", "probe"], fanout, levels).select("key", "leaf", "probe", "subroot", "root", "proof")
