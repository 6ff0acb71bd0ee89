"""Keyed pseudonyms (HMAC-SHA256) as column expressions.

The key only enters the plan as two padded literals, so it is visible to anyone
who can read the plan (``explain``, the UI); treat both as sensitive.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewell.constants import REDACTED

_BLOCK = 64


def hmac_hex(value: Column, key: str | bytes) -> Column:
    """Lower-case hex HMAC-SHA256 of a string or binary column; null stays null."""
    raw = key.encode("utf-8") if isinstance(key, str) else key
    if len(raw) > _BLOCK:
        raw = hashlib.sha256(raw).digest()
    raw = raw.ljust(_BLOCK, b"\0")
    inner = F.lit(bytes(b ^ 0x36 for b in raw))
    outer = F.lit(bytes(b ^ 0x5C for b in raw))
    first = F.unhex(F.sha2(F.concat(inner, value.cast("binary")), 256))
    return F.sha2(F.concat(outer, first), 256)


def pseudonym(value: Column, key: str | None, on_missing_key: str = "redact") -> Column:
    """Pseudonym of ``value``; without a key either ``"redact"`` or ``"pass"``.

    A present value is never passed through raw unless the caller asks for it.
    """
    if on_missing_key not in ("redact", "pass"):
        raise ValueError("on_missing_key must be 'redact' or 'pass'")
    if key:
        return hmac_hex(value, key)
    if on_missing_key == "pass":
        return value
    return F.when(value.isNotNull(), F.lit(REDACTED))
