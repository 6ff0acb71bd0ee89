"""Main text of web pages by markup and by suffix arrays over hosts.

1. Markup. A page is cut into blocks. Blocks in menus, headers, footers, sidebars, notices,
   adverts, forms, comments, scripts and the like, told by element, role, class or id, are
   dropped. A class or id counts as a whole: ``ad-box`` is an advert, ``has-sidebar`` and
   ``post-header`` rule out nothing. It does not rule out an article, what is around one,
   or the headings and header in one; comments and sidebars may hold articles of their own,
   which are not the page's. Where a page marks its article (``article``, ``main``, ``role=main``), the
   blocks in it are the text and the others are dropped.
2. Host. Every page leaves its blocks as a token stream: streams of marked articles and
   streams of other pages are two kinds, each with arrays of its own, so that menus of other
   pages do not rule out an article's text. The streams of a host are put end to end and
   their suffixes sorted (prefix doubling, up to ``LEAST`` tokens); neighbours with a common
   beginning of ``LEAST`` tokens are one repeated string, and the distinct streams it occurs
   in are counted. Strings in ``PAGES`` streams and at least ``SHARE`` of the host's of their
   kind are boilerplate: the tokens that they cover are removed, unique runs stay, in page
   order. A marked article that would lose more than ``REVISION`` of its tokens is another
   revision of what the host repeats and stays whole.

   A host of more than ``SHARD`` tokens is dealt by hash into shards. What is boilerplate
   of the whole host is so in one shard at least. Shards tell the counts of all strings in
   half of SHARE of their streams; a string that a shard does not tell is in fewer there. Only where
   these bounds leave a string open are the host's pages read again to count it.

Pages with the same stream count as one page, so copies of a page do not erase it.
Character references are decoded after the cut; white space becomes one space; blocks are
joined by one space. Null or empty html gives an empty text; null URLs are one host.
Repeated rows are each returned. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tracewell.llm.shared import slices, tidy, written

#: Shortest repeated string that can be boilerplate, in tokens; a power of two.
LEAST = 8
PAGES = 3
SHARE = 0.1
#: An article of which repeated strings cover more than this is not taken apart.
REVISION = 0.5
#: Tokens of a shard, about, and characters of a page for each.
SHARD = 500_000
TOKEN_CHARS = 6
#: Characters of text that a task packs at once, compressed, for the shards they go to.
PACK = 8 << 20

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup, up to their end or that of the page.
RAW = frozenset("script style textarea title xmp noembed noframes".split())
#: Elements left out with what is in them; where the end is missing, only the tag is.
SKIPPED = frozenset("noscript template iframe svg math canvas object select audio video".split())
BLOCKS = frozenset("""address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table
tbody td tfoot th thead title tr ul""".split())
CHROME = frozenset("head nav header footer aside form menu dialog search button".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
#: Words of a class or id.
CHROME_WORDS = frozenset("""ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion banner cookie cookies
consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup sidebar menu nav navbar navigation
breadcrumb breadcrumbs pagination pager footer header masthead topbar toolbar comment comments disqus respond replies reply share sharing
social related recommended widget widgets login search skip""".split())
#: Of these, the ones whose elements may hold articles that are not the page's.
ASIDE_WORDS = frozenset("""ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion sidebar comment comments
disqus respond replies reply related recommended widget widgets""".split())
HEADER_WORDS = frozenset("header masthead banner".split())
#: Words that may stand beside these in one class or id: everywhere, and but for headers.
BESIDE = frozenset("""area bar block bottom box button buttons container form global icon icons inner item items left link links list main outer
page panel posts primary right secondary site slot thread toggle top unit wrap wrapper""".split())
BESIDE_OTHERS = frozenset("article blog entry post reader story user".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup header".split())
MAIN_WORDS = frozenset("articlebody".split())

_markup = re.compile(r"""<!--(?:.*?-->|.*\Z)|<!\[CDATA\[.*?\]\]>|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>"']|"[^"]*"|'[^']*')*)/?>|<[!?][^>]*>""", re.S)
_attribute = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_words = re.compile(r"[a-z]+")
_camel = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


def named(attributes: dict[str, str]) -> set[str]:
    """The words that say, as a whole class or id, that an element is chrome."""
    out = set()
    for token in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = set(_words.findall(_camel.sub(" ", token).lower()))
        own = words & CHROME_WORDS
        if own and words - own <= (BESIDE if own & HEADER_WORDS else BESIDE | BESIDE_OTHERS):
            out |= own
    return out


def attributes_of(raw: str) -> dict[str, str]:
    return {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in _attribute.finditer(raw)}


def marks(name: str, attributes: dict[str, str]) -> bool:
    """Whether an element is marked as the page's article."""
    return name in ("article", "main") or attributes.get("role", "").lower() == "main" or attributes.get("itemprop", "").lower() in MAIN_WORDS


def role_of(name: str, raw: str, inside: bool, nested: bool = False) -> str | None:
    """'chrome', 'main', 'around' (chrome unless an article is in it) or None for an opening
    tag. ``inside`` an article, its own header is kept; ``nested`` in one, an article whose
    class says so is a comment."""
    if name in CHROME and not (name == "header" and inside):
        return "chrome"
    if not raw.strip():
        return "main" if name in ("article", "main") else None
    attributes = attributes_of(raw)
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", ""):
        return "chrome"
    if attributes.get("role", "").lower() in CHROME_ROLES:
        return "chrome"
    if marks(name, attributes):
        return "chrome" if nested and not named(attributes).isdisjoint(("comment", "reply")) else "main"
    if name in ("html", "body") or inside and name in HEADINGS:
        return None
    words = named(attributes)
    if inside:
        return "chrome" if words - HEADER_WORDS else None
    return None if not words else "chrome" if words & ASIDE_WORDS else "around"


def ends(page: str, name: str) -> dict[int, int]:
    """Where elements ``name`` end, by the end of their opening tag. Those that are not
    closed, or close themselves, are missing."""
    out, open_ = {}, []
    tags = re.compile(rf"""<!--.*?-->|<(?:script|style)\b.*?</(?:script|style)\s*>|<(/?){name}(?=[\s/>])(?:[^<>"']|"[^"]*"|'[^']*')*>""", re.S | re.I)
    for m in tags.finditer(page):
        if m[1] is None or not m[1] and name in ("svg", "math") and m[0].endswith("/>"):
            continue
        if not m[1]:
            open_.append(m.end())
        elif open_:
            out[open_.pop()] = m.end()
    return out


def end_of(page: str, name: str, at: int, closed: dict[str, dict[int, int]]) -> int:
    if name not in closed:
        closed[name] = ends(page, name)
    return closed[name].get(at, at)


def holds_article(page: str, at: int, name: str, closed: dict[str, dict[int, int]]) -> bool:
    """Whether the element ``name``, open before ``at``, has a marked article in it."""
    depth = 1
    while depth:
        m = _markup.search(page, at)
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        found = m[2].lower()
        if m[1]:
            depth -= found == name
        elif found in RAW:
            end = re.compile(rf"</{re.escape(found)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif found in SKIPPED:
            at = end_of(page, found, at, closed)
        elif marks(found, attributes_of(m[3])):
            return True
        else:
            depth += found == name
    return False


def blocks(page: str) -> tuple[list[str], bool]:
    """The page's text blocks in order, without what markup rules out, and whether they
    are those of a marked article."""
    every, article, current = [], [], []
    stack: list[tuple[str, str | None]] = []
    chrome = main = 0
    marked = False
    at, n, closed = 0, len(page), {}

    def close_block():
        if current:
            text = " ".join(entities.unescape("".join(current)).split())
            current.clear()
            if text:
                (article if main else every).append(text)

    while at < n:
        m = _markup.search(page, at)
        if not chrome:
            text = page[at:m.start() if m else n]
            if text:
                current.append(text)
        if not m:
            break
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA[") and not chrome:
                current.append(entities.escape(m[0][9:-3]))
            continue
        name = m[2].lower()
        if name in BLOCKS or name in RAW or name in SKIPPED and name not in ("svg", "math", "canvas", "select"):
            close_block()
        if m[1]:
            if any(name == x for x, _ in stack):
                while stack:
                    top, kind = stack.pop()
                    chrome -= kind == "chrome"
                    main -= kind == "main"
                    if top == name:
                        break
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if name in SKIPPED:
            at = end_of(page, name, at, closed)
            continue
        if name in VOID or m[0].endswith("/>") and name not in BLOCKS:
            continue
        if name in BLOCKS or name in CHROME or m[3].strip():
            kind = role_of(name, m[3], main > 0, ("article", "main") in stack)
            if kind == "around":
                kind = "chrome" if chrome or not holds_article(page, at, name, closed) else None
            if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and kind is None:
                continue  # may stay open; nothing depends on its end
            if kind == "chrome" and name == "body":
                kind = None
            stack.append((name, kind))
            chrome += kind == "chrome"
            main += kind == "main" and not chrome
            if kind == "main" and chrome:
                stack[-1] = (name, None)  # an article of a sidebar or a comment
            marked |= main > 0
    close_block()
    return (article, True) if marked else (every, False)


def host_of(url: Column) -> Column:
    """Column: the URL's host, lower-cased, without port."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def ranks(tokens: np.ndarray, stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, group of each suffix in it): suffixes in order of their first LEAST
    tokens, equal ones in one group; suffixes that end sooner are groups of their own."""
    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    length = 1
    while length < LEAST:
        after = np.full(n, -1, np.int64)
        after[:-length] = np.where(stream[:-length] == stream[length:], rank[length:], -1)
        # One number for each pair, in the order of the pairs: numbers sort much faster than pairs.
        rank = np.unique(rank * (n + 1) + after + 1, return_inverse=True)[1].astype(np.int64)
        length *= 2
    order = np.argsort(rank, kind="stable")
    return order, rank[order]


def whole_suffixes(stream: np.ndarray) -> np.ndarray:
    """Which places have LEAST tokens of their stream ahead."""
    out = np.zeros(len(stream), bool)
    out[:max(0, len(stream) - LEAST + 1)] = stream[:max(0, len(stream) - LEAST + 1)] == stream[LEAST - 1:]
    return out


class Hashes(dict):
    """Hashes of words, each computed once. To be kept no longer than for one shard or host."""

    def __missing__(self, word: str) -> int:
        self[word] = found = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "big")
        return found


def numbered(words: list[str], hashes: Hashes) -> np.ndarray:
    return np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))


def string_hashes(tokens: np.ndarray) -> np.ndarray:
    """Hash of the LEAST tokens from each place."""
    out = np.zeros(max(0, len(tokens) - LEAST + 1), np.uint64)
    for i in range(LEAST):
        out = out * np.uint64(0x9E3779B97F4A7C15) + tokens[i:len(tokens) - LEAST + 1 + i]
    return (out >> np.uint64(1)).astype(np.int64)


def among(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of the hashes are among the known ones, which are in order."""
    if not len(known):
        return np.zeros(len(hashes), bool)
    return known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes


def shard_streams(texts: list[str], hashes: Hashes) -> tuple[list[list[str]], np.ndarray, np.ndarray]:
    words = [t.split(" ") if t else [] for t in texts]
    flat = [w for x in words for w in x]
    return words, numbered(flat, hashes), np.repeat(np.arange(len(words)), [len(x) for x in words])


def counted(texts: list[str], hashes: Hashes) -> tuple[np.ndarray, np.ndarray, int]:
    """(strings of LEAST tokens, streams each is in, number of streams) over distinct texts."""
    texts = sorted({t for t in texts if t})
    _, tokens, stream = shard_streams(texts, hashes)
    if len(tokens) < LEAST:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), len(texts)
    order, group = ranks(tokens, stream)
    keep = whole_suffixes(stream)[order]
    order, group = order[keep], group[keep]
    if not len(group):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), len(texts)
    pairs = np.sort(group * len(texts) + stream[order])
    pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])] // len(texts)
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    times = np.diff(np.append(np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])), len(pairs)))
    return string_hashes(tokens)[order[first]], times, len(texts)


def cleaned(own: pa.Table, boilerplate: np.ndarray, hashes: Hashes) -> pa.Table:
    """Rows of one host and kind without its boilerplate."""
    marked = own.num_rows and own.column("marked")[0].as_py()
    return pa.table({"key": own.column("key"), "url": own.column("url"),
                     "text": pa.array([strip(t, boilerplate, marked, hashes) for t in own.column("text").to_pylist()], pa.string())})


def whole_host(own: pa.Table) -> pa.Table:
    """Host of one shard: counted and cleaned at once."""
    hashes = Hashes()
    name, times, total = counted(own.column("text").to_pylist(), hashes)
    return cleaned(own, np.sort(name[(times >= PAGES) & (times >= total * SHARE)]), hashes)


def pack(held: dict[tuple, list[tuple]], key_type: pa.DataType) -> pa.RecordBatch:
    """Rows (key, url, text) of each cell (host, marked, shard) as one compressed binary."""
    size, packed = [], []
    for rows in held.values():
        key, url, text = zip(*rows)
        table = pa.table({"key": pa.array(key, key_type), "url": pa.array(url, pa.string()), "text": pa.array(text, pa.string())})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as stream:
            stream.write_table(table)
        raw = sink.getvalue()
        size.append(raw.size)
        packed.append(pa.compress(raw, codec="zstd", asbytes=True))
    host, marked, shard = zip(*held)
    return pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(marked, pa.bool_()), pa.array(shard, pa.int32()),
                                       pa.array(size, pa.int64()), pa.array(packed, pa.binary())], ["host", "marked", "shard", "size", "rows"])


def unpack(own: pa.Table, key_type: pa.DataType) -> pa.Table:
    """The rows of one cell."""
    none = pa.schema([("key", key_type), ("url", pa.string()), ("text", pa.string())]).empty_table()
    tables = [pa.ipc.open_stream(pa.decompress(raw, decompressed_size=size, codec="zstd")).read_all()
              for size, raw in zip(own.column("size").to_pylist(), own.column("rows").to_pylist())]
    out = pa.concat_tables([none, *tables])
    return out.append_column("marked", pa.array([own.column("marked")[0].as_py()] * len(out) if len(out) else [], pa.bool_()))


def candidates(own: pa.Table, texts: list[str]) -> pa.Table:
    """One shard of a large host: its strings in at least half of SHARE of its streams, with their
    counts; the row without a string has the number of distinct streams. ``most``: streams
    that a string not told is in at most."""
    name, times, total = counted(texts, Hashes())
    told = times >= total * SHARE / 2
    n, most = int(told.sum()) + 1, max(0, int(np.ceil(total * SHARE / 2)) - 1)
    return pa.table({"host": pa.array([own.column("host")[0].as_py()] * n, pa.string()), "marked": pa.array([own.column("marked")[0].as_py()] * n),
                     "string": pa.array([None, *name[told].tolist()], pa.int64()), "streams": pa.array([total, *times[told].tolist()], pa.int64()),
                     "most": pa.array([most] * n, pa.int64())})


def judged(named: DataFrame) -> DataFrame:
    """(host, marked, string, total, sure) of strings that are boilerplate of their host, or, not ``sure``, may be."""
    total = named.filter("string is null").groupBy("host", "marked").agg(F.sum("streams").alias("total"), F.sum("most").alias("rest")).select(
        F.col("host").alias("_own"), F.col("marked").alias("_marked"), "total", "rest")
    known = named.filter("string is not null").groupBy("host", "marked", "string").agg(F.sum("streams").alias("known"), F.sum("most").alias("told"))
    both = known.join(total, (F.col("host") == F.col("_own")) & (F.col("marked") == F.col("_marked")))
    often = lambda n: (n >= PAGES) & (n >= F.col("total") * SHARE)
    return both.filter(often(F.col("known") + F.col("rest") - F.col("told"))).select(
        "host", "marked", "string", "total", often(F.col("known")).alias("sure"))


def recounted(head: pa.Table, texts: list[str], strings: pa.Table) -> pa.Table:
    """One shard of a large host: in how many of its streams the strings asked for are."""
    hashes = Hashes()
    asked = np.sort(strings.column("string").to_numpy())
    found = [np.zeros(0, np.int64)]
    for text in sorted(set(texts) - {""}):
        own_strings = string_hashes(numbered(text.split(" "), hashes))
        found.append(np.unique(own_strings[among(own_strings, asked)]))
    name, times = np.unique(np.concatenate(found), return_counts=True)
    return pa.table({"host": pa.array([head.column("host")[0].as_py()] * len(name), pa.string()),
                     "marked": pa.array([head.column("marked")[0].as_py()] * len(name), pa.bool_()),
                     "string": pa.array(name, pa.int64()), "streams": pa.array(times, pa.int64())})


def strip(text: str, boilerplate: np.ndarray, marked: bool, hashes: Hashes) -> str:
    """A stream without the tokens that boilerplate strings, in order of their hashes, cover."""
    words = text.split(" ") if text else []
    if len(words) < LEAST or not len(boilerplate):
        return text
    at = np.flatnonzero(among(string_hashes(numbered(words, hashes)), boilerplate))
    if not len(at):
        return text
    gone = np.zeros(len(words) + 1, np.int64)
    np.add.at(gone, at, 1)
    np.add.at(gone, at + LEAST, -1)
    gone = np.cumsum(gone)[:-1] > 0
    if marked and gone.sum() > REVISION * len(words):
        return text
    return " ".join(compress(words, (~gone).tolist()))


def main_text(pages: DataFrame, key: str, url: str, page: str) -> DataFrame:
    """(key, url, text) of every row."""
    columns = T.StructType([T.StructField("key", pages.schema[key].dataType), T.StructField("url", T.StringType()),
                            T.StructField("host", T.StringType()), T.StructField("text", T.StringType()), T.StructField("marked", T.BooleanType())])

    key_type = to_arrow_type(pages.schema[key].dataType)

    @tidy
    def parse(batches):
        for batch in batches:
            for part in slices(batch, "html"):
                found = [blocks(h or "") for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    part.column("key"), part.column("url"), part.column("host"), pa.array([" ".join(b) for b, _ in found], pa.string()),
                    pa.array([m for _, m in found], pa.bool_())], columns.names)

    def parse_large(once: bool):
        @tidy
        def run(batches):
            seen, held, size = set(), {}, 0
            for batch in batches:
                for part in slices(batch, "html"):
                    for key, url, host, shards, page in zip(*(part.column(c).to_pylist() for c in ("key", "url", "host", "shards", "html"))):
                        found, marked = blocks(page)
                        text = " ".join(found)
                        if once:  # copies are counted once, and leave a task once
                            name = hashlib.blake2b(f"{host} {marked} {text}".encode(), digest_size=16).digest()
                            if not text or name in seen:
                                continue
                            seen.add(name)
                            key = url = None
                        else:  # copies of a page are dealt over the shards here
                            name = hashlib.blake2b(f"{key} {url} {text}".encode(), digest_size=16).digest()
                        held.setdefault((host, marked, int.from_bytes(name[:8], "big") % shards), []).append((key, url, text))
                        size += len(text)
                        if size >= PACK:
                            yield pack(held, key_type)
                            held, size = {}, 0
            if held:
                yield pack(held, key_type)

        return run

    every = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), host_of(F.col(url)).alias("host"), F.col(page).alias("html"))
    empty = F.coalesce(F.col("html"), F.lit("")) == ""
    out = T.StructType([columns["key"], columns["url"], columns["text"]])
    rows = every.filter(~empty)
    # Large hosts, one row for SHARD tokens of pages at most.
    shards = F.ceil(F.sum(F.length("html")) / float(SHARD * TOKEN_CHARS)).cast("int")
    large = written(rows.groupBy("host").agg(shards.alias("shards")).filter("shards > 1"), "large").withColumnRenamed("host", "_host")
    large = F.broadcast(large)
    on = F.col("host") == F.col("_host")
    small = rows.join(large, on, "left_anti").mapInArrow(parse, columns)
    done = small.groupBy("host", "marked").applyInArrow(whole_host, out)

    def dealt(own: DataFrame, once: bool) -> DataFrame:
        return own.join(large, on).select("key", "url", "host", "shards", "html").mapInArrow(
            parse_large(once), "host string, marked boolean, shard int, size long, rows binary")

    def name_candidates(own: pa.Table) -> pa.Table:
        return candidates(own, unpack(own, key_type).column("text").to_pylist())

    def recount(own: pa.Table, strings: pa.Table) -> pa.Table:
        return recounted(own if own.num_rows else strings, unpack(own, key_type).column("text").to_pylist(), strings)

    kind, cells = ["host", "marked"], ["host", "marked", "shard"]
    named = written(dealt(rows, True).groupBy(*cells).applyInArrow(
        name_candidates, "host string, marked boolean, string long, streams long, most long"), "candidates")
    found = written(judged(named), "judged")

    def to_shards(df: DataFrame) -> DataFrame:
        return df.join(large, on).withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).select(*cells, "string")

    often, open_ = found.filter("sure").select(*kind, "string"), found.filter("not sure")
    if not open_.isEmpty():
        some = rows.join(open_.select(F.col("host").alias("_open")).distinct(), F.col("host") == F.col("_open"), "left_semi")
        again = dealt(some, True).groupBy(*cells).cogroup(to_shards(open_.select(*kind, "string")).groupBy(*cells)).applyInArrow(
            recount, "host string, marked boolean, string long, streams long")
        again = again.groupBy(*kind, "string").agg(F.sum("streams").alias("streams")).join(open_, [*kind, "string"])
        often = often.unionByName(again.filter((F.col("streams") >= PAGES) & (F.col("streams") >= F.col("total") * SHARE)).select(*kind, "string"))
    # Each shard of a host gets the host's strings: at most 1 / SHARE of a page's tokens.
    often = to_shards(written(often, "strings"))

    def clean(own: pa.Table, strings: pa.Table) -> pa.Table:
        return cleaned(unpack(own, key_type), np.sort(strings.column("string").to_numpy()), Hashes())

    rest = dealt(rows, False).groupBy(*cells).cogroup(often.groupBy(*cells)).applyInArrow(clean, out)
    return every.filter(empty).select("key", "url", F.lit("").alias("text")).unionByName(done).unionByName(rest)
