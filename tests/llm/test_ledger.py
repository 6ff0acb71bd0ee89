import re

import pytest

from tracewell.llm import ledger

KEY = "AKIA" + "ABCD1234EFGH5678"
HEX = "0123456789abcdef01234567"


def by_contract(text):
    """The base kinds, written out from their definitions."""
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        out += [(m.start(), 0, m.end(), "assign")] * (len(m[2]) >= 6)
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        out += [(m.start(), 1, m.end(), "access")] * (len(m[0]) >= 20)
    for m in re.finditer("[0-9a-f]+", text):
        out += [(m.start(), 2, m.end(), "hex")] * (len(m[0]) >= 24)
    return sorted(out)


TEXTS = [
    'api_key = "abcdef123"', "é💥 Password:short", "token=token=abcdef", "secret=token:abcdefg", "PASSWD : 'x.y/z+='", KEY, "AKIA" + KEY,
    HEX, HEX.upper(), "x" + HEX + "g" + HEX, "toKen=abcdefg", "paſſword=abcdefg", "", None, "no secrets here", "token\t=abcdefgh",
    "-----BEGIN RSA PRIVATE KEY-----", "Bearer abcdefghijklmnop", "https://me:pw@host/", f"secret={HEX} {KEY}", "word " * 20000 + KEY]


def test_against_definitions(rows, tmp_path):
    data = list(enumerate(TEXTS)) + [(None, TEXTS[0]), (3, TEXTS[0])]
    df = rows(data, "doc_id long, text string").selectExpr("*", "1 AS path", "2 AS blob")
    got = ledger.scan_history(df, "doc_id", "text", str(tmp_path / "l")).collect()
    assert len(got) == len(data)
    expected = sorted((str(k), by_contract(t or "")) for k, t in data)
    base = sorted((str(r["path"]), [tuple(f) for f in r["findings"] if f["kind"] in ledger.BASE]) for r in got)
    assert base == expected
    more = {f["kind"] for r in got for f in r["findings"]} - set(ledger.BASE)
    assert more == {"pem", "bearer", "link"}


def test_only_unseen_blobs_are_scanned(spark, rows, tmp_path):
    folder = str(tmp_path / "l")
    first = rows([("a", "token=abcdefg"), ("b", "token=abcdefg"), ("c", "x")], "path string, text string")
    assert sorted(len(r["findings"]) for r in ledger.scan_history(first, "path", "text", folder).collect()) == [0, 1, 1]
    scans = lambda: spark.read.schema(ledger.SCANS).parquet(f"{folder}/scans").count()
    assert scans() == 2
    second = rows([("d", "token=abcdefg"), ("e", KEY)], "path string, text string")
    got = {r["path"]: [f["kind"] for f in r["findings"]] for r in ledger.scan_history(second, "path", "text", folder).collect()}
    assert got == {"d": ["assign"], "e": ["access"]} and scans() == 3
    ledger.scan_history(second, "path", "text", folder, version="2")
    assert scans() == 5  # new rules: both blobs again


def test_no_rows(rows, tmp_path):
    assert ledger.scan_history(rows([], "doc_id long, text string"), "doc_id", "text", str(tmp_path / "l")).count() == 0


@pytest.mark.parametrize("text", ["token=abécdefgh", "secret: secret: secretsecret", "api_key='a' apikey=aaaaaa"])
def test_code_points(text):
    assert [(s, r, e, k) for k, r, s, e in ledger.spans(text)] == by_contract(text)
