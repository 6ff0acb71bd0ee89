"""Client addresses: canonical form, forwarded hops, ports.

IPv6 text is put into its compressed lower-case form without a Python UDF, with
IPv4-mapped addresses written in hexadecimal groups. Text that is no address
passes through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewell.functions.lets import let

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IPV4 = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
_GROUP = r"[0-9a-f]{1,4}"


def _hex_tail(address: Column) -> Column:
    """Rewrite a dotted tail (``::ffff:1.2.3.4``) as two hexadecimal groups."""
    octets = F.split(F.regexp_extract(address, rf":({_IPV4})$", 1), r"\.")

    def pair(high: int, low: int) -> Column:
        number = F.get(octets, F.lit(high)).cast("int") * 256 + F.get(octets, F.lit(low)).cast("int")
        return F.lower(F.hex(number))

    return F.when(
        address.rlike(rf":{_IPV4}$"),
        F.concat(F.regexp_replace(address, rf"{_IPV4}$", ""), pair(0, 1), F.lit(":"), pair(2, 3)),
    ).otherwise(address)


def _groups(address: Column) -> Column:
    """The eight groups of a well-formed IPv6 text, else null."""

    def parts(text: Column) -> Column:
        return F.filter(F.split(text, ":"), lambda g: g != "")

    halves = F.split(address, "::")
    left, right = parts(F.get(halves, F.lit(0))), parts(F.get(halves, F.lit(1)))
    missing = 8 - F.size(left) - F.size(right)
    filled = F.concat(
        left, F.array_repeat(F.lit("0"), F.greatest(missing, F.lit(0)).cast("int")), right
    )
    one_gap = (
        address.rlike(rf"^(?:{_GROUP}(?::{_GROUP})*)?::(?:{_GROUP}(?::{_GROUP})*)?$") & (missing >= 1)
    )
    return F.when(one_gap, filled).when(
        address.rlike(rf"^{_GROUP}(?::{_GROUP}){{7}}$"), F.split(address, ":")
    )


def _compress(groups: Column) -> Column:
    short = F.transform(groups, lambda g: F.regexp_replace(g, "^0+(?=.)", ""))
    padded = F.concat(F.lit(":"), F.array_join(short, ":"), F.lit(":"))

    def longest_gap(text: Column) -> Column:
        plain = F.trim(text, F.lit(":"))
        result = None
        for run in range(8, 1, -1):
            zeros = ":" + "0:" * run
            at = F.instr(text, zeros)
            before = F.trim(F.left(text, at - 1), F.lit(":"))
            after = F.trim(F.substring(text, at + len(zeros), F.length(text)), F.lit(":"))
            joined = F.concat(before, F.lit("::"), after)
            result = F.when(at > 0, joined) if result is None else result.when(at > 0, joined)
        return result.otherwise(plain)

    return let(padded, longest_gap)


def normalize_ip(value: Column) -> Column:
    """Canonical address text; zone ids dropped, non-addresses unchanged."""
    bare = F.trim(F.get(F.split(value, "%"), F.lit(0)))

    def canonical(address: Column) -> Column:
        v6 = let(_groups(_hex_tail(F.lower(address))), lambda g: F.when(g.isNotNull(), _compress(g)))
        return F.when(address.rlike(rf"^{_IPV4}$"), address).when(address.contains(":"), v6)

    return F.coalesce(let(bare, canonical), value)


def strip_port(value: Column) -> Column:
    """``host:port`` and ``[v6]:port`` without the port; bare IPv6 untouched."""
    text = F.trim(value)
    return (
        F.when(text.rlike(r"^\[[^\]]*\]"), F.regexp_extract(text, r"^\[([^\]]*)\]", 1))
        .when(text.rlike(r"^[^:]*:[^:]*$"), F.get(F.split(text, ":"), F.lit(0)))
        .otherwise(text)
    )


def forwarded_ip(header: Column, connection: Column | None = None, mode: str = "gateway") -> Column:
    """Client address from a forwarded-for header.

    ``gateway``: the first hop without its port; when that hop is empty the
    connection address. ``span``: the left-most non-empty hop, ports kept.
    """
    hops = F.transform(F.split(header, ","), lambda h: F.trim(h))
    if mode == "span":
        return F.get(F.filter(hops, lambda h: h != ""), F.lit(0))
    if mode != "gateway":
        raise ValueError("mode must be 'gateway' or 'span'")
    first = F.get(hops, F.lit(0))
    found = F.when(first != "", strip_port(first))
    return found if connection is None else F.coalesce(found, strip_port(connection))
