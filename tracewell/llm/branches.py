"""Fingerprints of documents: Merkle trees over paragraphs and sections, in DataFrame functions only.

Paragraphs are lines. A section ends after a paragraph whose own digest says so (one in
four), so that sections find each other again behind an insertion. The root is the
digest of the sections' digests, these of the paragraphs' digests, these of the paragraphs'
texts: roots are equal where texts are. Below a paragraph hang its sentences (cut at 64
characters), which tell how much of a changed paragraph is left.

A fingerprint is text: the root, ``/``, the sections with ``;`` between them. A section is
16 digits of its digest, its size, ``=`` and its paragraphs with ``,`` between them; a
paragraph 16 digits, its size, ``-`` and its pieces with ``.`` between them; a piece 8 digits
and its size. Sizes are code points, each line's end counted as one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.functions.lets import let
from tracewell.llm.ranks import placed
from tracewell.llm.shared import written

#: Sentences, and parts of long ones; every character belongs to a piece.
PIECE = r"[^.!?\n]{1,64}[.!?\n]{0,16}|[.!?\n]{1,16}"
#: First digits of a paragraph's digest that end a section: 4 of 16.
ENDS = "[0-3]%"


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text; null counts as empty. An empty text has one empty paragraph."""
    def paragraph(line: Column) -> Column:
        ended = F.concat(line, F.lit("\n"))
        pieces = F.transform(F.regexp_extract_all(ended, F.lit(PIECE), F.lit(0)),
                             lambda piece: F.concat(F.substring(F.md5(piece), 1, 8), F.length(piece)))
        return let(F.sha2(line, 256), lambda digest: F.struct(
            digest.alias("digest"), (F.length(line) + 1).alias("size"),
            F.concat(F.substring(digest, 1, 16), F.length(line) + 1, F.lit("-"), F.array_join(pieces, ".")).alias("token")))

    def section(run: Column) -> Column:
        size = F.aggregate(run, F.lit(0), lambda total, p: total + p["size"])
        digest = F.sha2(F.array_join(F.transform(run, lambda p: p["digest"]), ""), 256)
        return let(digest, lambda d: F.struct(d.alias("digest"), F.concat(
            F.substring(d, 1, 16), size, F.lit("="), F.array_join(F.transform(run, lambda p: p["token"]), ",")).alias("token")))

    def sections(paragraphs: Column) -> Column:
        last = F.size(paragraphs) - 1
        ends = F.filter(F.transform(paragraphs, lambda p, i: F.when((i == last) | (F.substring(p["digest"], 64, 1) < "4"), i)),
                        lambda i: i.isNotNull())
        return let(ends, lambda at: F.transform(at, lambda end, j: let(
            F.when(j == 0, F.lit(0)).otherwise(F.get(at, j - 1) + 1),
            lambda start: section(F.slice(paragraphs, start + 1, end - start + 1)))))

    def whole(found: Column) -> Column:
        root = F.sha2(F.array_join(F.transform(found, lambda s: s["digest"]), ""), 256)
        return F.concat(root, F.lit("/"), F.array_join(F.transform(found, lambda s: s["token"]), ";"))

    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), paragraph)
    return let(let(lines, sections), whole)


def root(print_: Column) -> Column:
    """The root of a fingerprint."""
    return F.substring_index(print_, "/", 1)


def _sections(print_: Column) -> Column:
    return F.split(F.substring_index(print_, "/", -1), ";")


def _inner(tokens: Column, mark: str, between: str) -> Column:
    """The children of all tokens, whose own repeat number is cut off."""
    return F.flatten(F.transform(tokens, lambda t: F.split(
        F.substring_index(F.substring_index(t, "#", 1), mark, -1), "[.]" if between == "." else between)))


def _numbered(tokens: Column) -> Column:
    """The tokens, of which equal ones get numbers, so that a set of them keeps repeats."""
    def of(s: Column) -> Column:
        starts = F.filter(F.transform(s, lambda t, i: F.when((i == 0) | (F.get(s, i - 1) != t), i)), lambda i: i.isNotNull())
        return let(starts, lambda at: F.flatten(F.transform(at, lambda start, j: F.transform(
            F.sequence(F.lit(1), F.coalesce(F.get(at, j + 1), F.size(s)) - start),
            lambda k: F.when(k == 1, F.get(s, start)).otherwise(F.concat(F.get(s, start), F.lit("#"), k))))))

    return let(F.array_sort(tokens), of)


def _size(tokens: Column, digits: int, mark: str) -> Column:
    return F.aggregate(tokens, F.lit(0).cast("long"), lambda total, t: total + F.substring_index(
        F.substring(t, digits + 1, 1 << 30), mark, 1).cast("long"))


#: Digits of a token's digest, what ends its size, and what stands between its children.
_LEVELS = ((16, "=", ","), (16, "-", "."), (8, "#", None))


def likeness(one: Column, other: Column) -> Column:
    """How much two fingerprints share, 0 to 1: twice the size of what they have in common,
    repeats counted, by the size of both. Equal roots are not looked into. Of sections that
    both have, only the size counts; the others' paragraphs are compared, and of those that
    differ the pieces."""
    def descend(a: Column, b: Column, levels) -> Column:
        (digits, mark, between), deeper = levels[0], levels[1:]

        def shared(pair: Column) -> Column:
            x, y = pair["x"], pair["y"]
            same = _size(F.array_intersect(x, y), digits, mark)
            if not deeper:
                return same
            return same + descend(_inner(F.array_except(x, y), mark, between), _inner(F.array_except(y, x), mark, between), deeper)

        return let(F.struct(_numbered(a).alias("x"), _numbered(b).alias("y")), shared)

    def compared(pair: Column) -> Column:
        sizes = _size(pair["a"], 16, "=") + _size(pair["b"], 16, "=")
        return 2.0 * descend(pair["a"], pair["b"], _LEVELS) / sizes

    return F.when(root(one) == root(other), 1.0).otherwise(
        let(F.struct(_sections(one).alias("a"), _sections(other).alias("b")), compared))


def edits(old: Column, new: Column) -> Column:
    """Where ``new`` differs: array of (start, end) code points of the paragraphs in its
    differing branches, line ends included, neighbours joined. Empty for equal texts, and
    where paragraphs were only taken away."""
    spans = F.array().cast("array<struct<start:bigint,stop:bigint>>")

    def within(tokens: Column, known: Column, mark: str, at: Column, deeper) -> Column:
        """Walks over the tokens, from code point ``at``; (at, spans) in the end."""
        def step(state: Column, token: Column) -> Column:
            size = F.substring_index(F.substring(token, 17, 1 << 30), mark, 1).cast("long")
            end = state["at"] + size
            found = F.when(F.array_contains(known, token), spans).otherwise(
                deeper(token, state["at"]) if deeper else F.array(F.struct(state["at"].alias("start"), end.alias("stop"))))
            return F.struct(end.alias("at"), F.concat(state["spans"], found).alias("spans"))

        begin = F.struct(at.cast("long").alias("at"), spans.alias("spans"))
        return F.aggregate(tokens, begin, step, lambda state: state["spans"])

    def joined(found: Column) -> Column:
        def add(out: Column, span: Column) -> Column:
            last = F.get(out, F.size(out) - 1)
            grown = F.struct(last["start"].alias("start"), span["stop"].alias("stop"))
            return F.when((F.size(out) > 0) & (last["stop"] == span["start"]),
                          F.concat(F.slice(out, 1, F.size(out) - 1), F.array(grown))).otherwise(F.concat(out, F.array(span)))

        return F.aggregate(found, spans, add)

    def compared(pair: Column) -> Column:
        paragraphs = _inner(F.array_except(pair["a"], pair["b"]), "=", ",")
        return let(paragraphs, lambda known: joined(within(pair["b"], pair["a"], "=", F.lit(0), lambda token, at: within(
            _inner(F.array(token), "=", ","), known, "-", at, None))))

    return let(F.struct(_sections(old).alias("a"), _sections(new).alias("b")), compared)


def edited(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Every row's text, and the same with its end replaced by the next document's beginning.

    Returns for every row ``key``, ``text``, ``next_key``, ``edited`` (the last third, rounded
    down, of the code points replaced by as many first ones of the next document) and
    ``next_print`` (the next document's fingerprint). The next document has the next smaller
    key, null last; after the last comes the first. Rows of one key are ordered by their digest,
    equal rows are one document; a document alone is its own next one. Null texts
    count as empty. Further columns of ``docs`` are not read.

    Texts are shuffled once, by the digest of key and text: both sides of the exchange
    of prefixes read the same shuffle. Besides, only prefixes and fingerprints move.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("key"), body.alias("text"), F.unhex(F.sha2(F.concat(
        F.coalesce(F.col(key).cast("string"), F.lit("-")), F.lit(":"), body), 256)).alias("id"))
    heads = written(rows.select("key", "id", F.length("text").alias("n")).distinct(), "heads")
    order = placed(heads, [F.col("key").desc_nulls_last(), F.col("id")])
    before = order.select(F.col("id").alias("to"), F.expr("n div 3").alias("take"), ((F.col("pos") + 1) % F.col("total")).alias("pos"))
    links = order.select("pos", F.col("id").alias("id")).join(before, "pos").select("id", "to", "take")
    sent = rows.join(links, "id").select(
        "to", F.col("key").alias("next_key"), F.left("text", F.col("take").cast("int")).alias("prefix"), fingerprint(F.col("text")).alias("next_print")) \
        .dropDuplicates(["to"])
    met = rows.join(sent.withColumnRenamed("to", "id"), "id")
    kept = F.left("text", F.length("text") - F.expr("length(text) div 3").cast("int"))
    return met.select("key", "text", "next_key", F.concat(kept, F.col("prefix")).alias("edited"), "next_print")


def compared(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``edited`` with the fingerprints of both texts and their likeness, and the spans of
    the edited text that lie in differing branches."""
    prints = edited(docs, key, text).withColumns({
        "fingerprint": fingerprint(F.col("text")), "edited_print": fingerprint(F.col("edited"))})
    own = F.col("fingerprint")
    return prints.withColumns({"near_edited": likeness(own, F.col("edited_print")), "near_next": likeness(own, F.col("next_print")),
                               "edits": edits(own, F.col("edited_print"))})
