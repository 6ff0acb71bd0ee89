import glob

from tracewell.llm import derivatives as dv
from tracewell.llm.queries import op9_warc_derivatives

PAGE = """<!DOCTYPE html><html><head><title>A &amp; B</title><style>p{}</style></head><body><script>var x="<p>no</p>";</script>
<!-- hidden --><p>One  <b>two</b><br>three &lt; 4</p><a href="/x?a=1&amp;b=2">link</a><img src='i.png'><p>é</p></body></html>"""
ROWS = [("1", "<urn:uuid:a>", "http://h/", "2024-01-01T00:00:00Z", "200", {"Content-Type": "text/html", "X-A": "b"}, PAGE),
        ("2", "<urn:uuid:b>", None, None, None, None, None), ("3", "<urn:uuid:c>", "http://h/3", "2024-01-01T00:00:00Z", "404", {}, ""),
        ("1", "<urn:uuid:a>", "http://h/", "2024-01-01T00:00:00Z", "200", {"Content-Type": "text/html", "X-A": "b"}, PAGE),
        (None, "<urn:uuid:d>", "http://h/4", "2024-01-01T00:00:00Z", "200", {}, "<p>" + "long " * 100_000)]


def test_records(rows):
    df = rows(ROWS, dv.RESPONSE).selectExpr("*", "1 AS header", "2 AS content")
    got = dv.build(df).collect()
    assert len(got) == 2 * len(ROWS)
    by = {(r["refers_to"], r["record_type"]): r for r in got}
    text, meta = by["<urn:uuid:a>", "conversion"], by["<urn:uuid:a>", "metadata"]
    assert text["content"] == "One two\nthree < 4\nlink\né"
    assert meta["content"].split("\r\n") == [
        "http-status: 200", "http-header-content-type: text/html", "http-header-x-a: b", f"source-payload-digest: {dv.digest(PAGE.encode())}",
        f"source-payload-length: {len(PAGE.encode())}", "title: A & B", "outlink: /x?a=1&b=2 a/@href", "outlink: i.png img/@src", ""]
    assert len({r["record_id"] for r in got}) == 8  # the repeated response gives the same two
    assert by["<urn:uuid:b>", "conversion"]["content"] == "" and "WARC-Target-URI" not in by["<urn:uuid:b>", "metadata"]["header"]
    assert all(r["content_length"] == len(r["content"].encode()) and r["block_digest"] == dv.digest(r["content"].encode()) for r in got)
    assert dv.build(df.limit(0)).count() == 0


def parse(raw: bytes):
    """WARC records by their stated lengths."""
    while raw:
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        assert lines[0] == "WARC/1.1"
        fields = dict(x.split(": ", 1) for x in lines[1:])
        n = int(fields["Content-Length"])
        yield fields, rest[:n].decode()
        assert rest[n:n + 4] == b"\r\n\r\n"
        raw = rest[n + 4:]


def test_round_trip(spark, rows, tmp_path):
    records = dv.build(rows(ROWS, dv.RESPONSE))
    path = str(tmp_path / "warc")
    dv.write_warc(records, path)
    parsed = sorted((f["WARC-Record-ID"], f["WARC-Refers-To"], c) for p in glob.glob(f"{path}/part-*") for f, c in parse(open(p, "rb").read()))
    assert parsed == sorted((r["record_id"], r["refers_to"], r["content"]) for r in records.collect())
    back = dv.read_warc(spark, path).collect()
    assert all(r["intact"] for r in back)
    assert sorted((r["header"]["WARC-Record-ID"], r["content"]) for r in back) == sorted((a, c) for a, _, c in parsed)


def test_query(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = op9_warc_derivatives(spark, sf_dir)
    assert got.count() == 2 * pages.count()
    assert got.select("refers_to").distinct().count() == pages.count()
