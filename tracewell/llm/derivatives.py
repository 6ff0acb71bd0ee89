"""WARC derivatives: a metadata and a conversion record for each response record.

``metadata`` (application/warc-fields) lists the source's HTTP status and headers, its
digests, the page's title and its links; ``conversion`` (text/plain) is the page's text.
Both name the response in WARC-Refers-To, take over its target URI and date, and carry a
digest of their own block. Record ids follow from the source's id, so reruns agree.

Digests are ``sha1:`` and base32, as usual in WARC. A null or empty payload gives a
metadata record without title and links and an empty conversion; null headers count as
none; a null URI or date is left out of the record's header. Repeated responses are each
converted. Extra columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell.llm.shared import slices, tidy

VERSION = "WARC/1.1"
END = "\r\n\r\n"

RESPONSE = "source string, record_id string, target_uri string, date string, status string, headers map<string,string>, payload string"
DERIVATIVE = T.StructType([T.StructField(n, T.LongType() if n == "content_length" else T.StringType()) for n in (
    "source", "record_type", "record_id", "refers_to", "target_uri", "date", "content_type", "content_length", "block_digest",
    "source_payload_digest", "header", "content")])

_hidden = re.compile(r"<!--.*?-->|<(script|style|noscript|template)\b[^>]*>.*?</\1\s*>|<head\b[^>]*>.*?</head\s*>", re.S | re.I)
_block = re.compile(r"</?(p|div|br|li|ul|ol|h[1-6]|tr|table|article|section|nav|header|footer|aside|main|blockquote|pre|form)\b[^>]*>", re.I)
_tag = re.compile(r"<[!/?a-zA-Z][^>]*>")
_title = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
_link = re.compile(r"""<(a|link|img|script|iframe)\b[^>]*?\b(href|src)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def plain_text(page: str) -> str:
    """The page's visible text, a line for each block."""
    text = _tag.sub("", _block.sub("\n", _hidden.sub("\n", page)))
    lines = (" ".join(line.split()) for line in html.unescape(text).split("\n"))
    return "\n".join(line for line in lines if line)


def links(page: str) -> list[str]:
    return [f"{html.unescape(m[3] or m[4] or m[5] or '')} {m[1].lower()}/@{m[2].lower()}" for m in _link.finditer(page)]


def one_line(text: str) -> str:
    return " ".join(text.split())


def record(kind: str, source: dict, content_type: str, content: str) -> dict:
    name = f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind} of {source["record_id"]}').urn}>"
    block = content.encode()
    fields = [("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Refers-To", source["record_id"]),
              ("WARC-Target-URI", source["target_uri"]), ("WARC-Date", source["date"]), ("Content-Type", content_type),
              ("WARC-Block-Digest", digest(block)), ("Content-Length", str(len(block)))]
    return {"source": source["source"], "record_type": kind, "record_id": name, "refers_to": source["record_id"],
            "target_uri": source["target_uri"], "date": source["date"], "content_type": content_type, "content_length": len(block),
            "block_digest": digest(block), "source_payload_digest": digest((source["payload"] or "").encode()),
            "header": "\r\n".join([VERSION, *(f"{k}: {one_line(v)}" for k, v in fields if v is not None)]), "content": content}


def derive(source: dict) -> list[dict]:
    """Both records of one response."""
    page = source["payload"] or ""
    headers = sorted((source["headers"] or {}).items() if isinstance(source["headers"], dict) else source["headers"] or [])
    title = _title.search(page)
    fields = [("http-status", source["status"])] + [(f"http-header-{k.lower()}", v) for k, v in headers]
    fields += [("source-payload-digest", digest(page.encode())), ("source-payload-length", str(len(page.encode())))]
    fields += [("title", html.unescape(title[1]))] if title else []
    fields += [("outlink", x) for x in links(page)]
    meta = "".join(f"{k}: {one_line(v)}\r\n" for k, v in fields if v is not None)
    return [record("metadata", source, "application/warc-fields", meta),
            record("conversion", source, "text/plain; charset=UTF-8", plain_text(page))]


def build(responses: DataFrame) -> DataFrame:
    """Two rows (see DERIVATIVE) for each row of ``responses`` (see RESPONSE)."""
    columns = ["source", "record_id", "target_uri", "date", "status", "headers", "payload"]

    @tidy
    def run(batches):
        for batch in batches:
            for part in slices(batch, "payload"):
                out = [r for source in part.to_pylist() for r in derive(source)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[f.name] for r in out], pa.int64() if f.name == "content_length" else pa.string()) for f in DERIVATIVE],
                    DERIVATIVE.names)

    return responses.select(*columns).mapInArrow(run, DERIVATIVE)


def responses_from_pages(pages: DataFrame, key: str, url: str, page: str, date: str) -> DataFrame:
    """Response records of pages that were stored without their headers."""
    hexed = F.sha2(F.concat_ws("\n", F.coalesce(F.col(key).cast("string"), F.lit("")), F.coalesce(F.col(url), F.lit(""))), 256)
    parts = [F.substring(hexed, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return pages.select(
        F.col(key).cast("string").alias("source"), F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">")).alias("record_id"),
        F.col(url).alias("target_uri"), F.lit(date).alias("date"), F.lit("200").alias("status"),
        F.create_map(F.lit("Content-Type"), F.lit("text/html; charset=utf-8"), F.lit("Content-Length"),
                     F.coalesce(F.octet_length(F.col(page)), F.lit(0)).cast("string")).alias("headers"), F.col(page).alias("payload"))


def write_warc(records: DataFrame, path: str) -> None:
    """Uncompressed WARC files, one for each partition."""
    records.select(F.concat("header", F.lit(END), "content").alias("value")).write.option("lineSep", END).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(header map, content, intact) of the records that ``write_warc`` wrote. A record
    is not intact when its block does not have the length or digest that it states."""
    rows = spark.read.option("lineSep", VERSION + "\r\n").text(path).filter(F.trim("value") != "")
    at = F.locate(END, F.col("value"))
    lines = F.split(F.substring(F.col("value"), F.lit(1), at - 1), "\r\n")
    header = F.map_from_entries(F.transform(lines, lambda x: F.struct(
        F.substring_index(x, ": ", 1).alias("key"), F.regexp_replace(x, r"^[^:]*: ", "").alias("value"))))
    rows = rows.select(header.alias("header"), F.substring(F.col("value"), at + len(END), F.length("value") - at - 2 * len(END) + 1).alias("content"))
    sound = F.arrow_udf(lambda c: pa.array([digest((x or "").encode()) for x in c.to_pylist()], pa.string()), "string")
    return rows.withColumn("intact", (F.octet_length("content") == F.col("header")["Content-Length"].cast("long"))
                           & (sound("content") == F.col("header")["WARC-Block-Digest"]))
