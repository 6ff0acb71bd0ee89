"""The one place where JSON of unknown depth is rewritten.

Catalyst has no recursion, so values that may need a rewrite go through an Arrow
batch UDF. A cheap JVM-side test decides per value; all others never leave the
JVM (the UDF receives null for them).
"""

from __future__ import annotations

import hashlib
import hmac
import json
import math
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewell.constants import (
    MAX_ATTRIBUTE_DEPTH,
    MAX_REDACT_DEPTH,
    REDACTED,
    SENSITIVE_KEYS,
    TRUNCATION_MARK,
)
from tracewell.functions.lets import any_of
from tracewell.functions.names import SENSITIVE_NAME
from tracewell.operators.rules import Rule

_UNREADABLE = ""


@dataclass(frozen=True)
class Walk:
    """What to do with each key and each string leaf."""

    extra_keys: Iterable[str] = ()
    rules: Sequence[Rule] = ()
    secret: str | None = None
    limit: int | None = None
    word_runs: bool = False
    start_depth: int = 0
    redact: bool = True
    keys: frozenset[str] = field(init=False)

    def __post_init__(self) -> None:
        added = {key.strip().lower() for key in self.extra_keys} - {""}
        object.__setattr__(self, "keys", frozenset(SENSITIVE_KEYS) | added if self.redact else frozenset())

    @property
    def always(self) -> bool:
        """Whether every text is rewritten, so that nothing of it is needed beside the result."""
        return bool(self.rules or self.word_runs)

    def needed(self, text: Column) -> Column:
        """False only where the rewrite would change nothing."""
        if self.always:
            return text.isNotNull()
        if not self.redact:
            return F.length(text) > (self.limit or 0)
        names = "|".join(re.escape(key) for key in sorted(self.keys))
        openers = F.length(F.regexp_replace(text, r"[^\[{]+", ""))
        tests = [
            text.rlike(rf'(?iu)"(?:{names})"\s*:'),
            text.contains("\\u"),
            openers > MAX_REDACT_DEPTH - self.start_depth,
        ]
        if self.limit is not None:
            tests.append(F.length(text) > self.limit)
        return any_of(tests)

    def leaf(self, text: str) -> str:
        for rule in self.rules:
            if rule.on_values:
                text = rule.compiled.sub(lambda m, r=rule: self.replacement(r, m.group()), text)
        if self.limit is not None and len(text) > self.limit:
            text = text[: self.limit] + TRUNCATION_MARK
        return text

    def replacement(self, rule: Rule, text: object) -> str:
        if rule.action == "hash" and self.secret and isinstance(text, str):
            return hmac.new(self.secret.encode(), text.encode(), hashlib.sha256).hexdigest()
        return REDACTED

    def member(self, name: str, value: object, depth: int) -> object:
        if name.lower() in self.keys or (self.word_runs and re.search(SENSITIVE_NAME, name)):
            return REDACTED
        for rule in self.rules:
            if rule.on_keys and rule.compiled.search(name):
                return self.replacement(rule, value)
        return self.value(value, depth + 1)

    def value(self, node: object, depth: int) -> object:
        if isinstance(node, str):
            return self.leaf(node)
        if not isinstance(node, (dict, list)):
            return node
        if self.redact and depth > MAX_REDACT_DEPTH:
            return REDACTED
        if isinstance(node, dict):
            return {name: self.member(name, item, depth) for name, item in node.items()}
        return [self.value(item, depth + 1) for item in node]

    def text(self, text: str | None) -> str | None:
        if text is None:
            return None
        try:
            return json.dumps(self.value(json.loads(text), self.start_depth), ensure_ascii=False)
        except (ValueError, RecursionError):
            return _UNREADABLE


def _once(function):
    """Keeps the optimizer from copying a batch function (and all it reads) into
    every later use of its result, which it does for chained ones."""
    return function.asNondeterministic()


def rewrite(text: Column, walk: Walk) -> Column:
    """JSON text -> VARIANT with ``walk`` applied; unreadable text -> null."""

    @F.pandas_udf("string")
    def walked(texts: pd.Series) -> pd.Series:
        return texts.map(walk.text, na_action="ignore").astype(object)

    if walk.always:
        return F.try_parse_json(_once(walked)(text))
    done = F.coalesce(_once(walked)(F.when(walk.needed(text), text)), text)
    return F.try_parse_json(done)


def _typed(node: dict, kind: str) -> object:
    """A typed value's content in either spelling of its kind; null when absent."""
    found = node.get(kind + "Value")
    return node.get(kind + "_value") if found is None else found


def _plain(node: object, depth: int) -> object:
    """Plain JSON value of a typed attribute value; null past the depth limit and for
    what its type cannot hold. Null entries are skipped."""
    if depth >= MAX_ATTRIBUTE_DEPTH or not isinstance(node, dict):
        return None
    for kind in ("array", "kvlist"):
        held = _typed(node, kind)
        if isinstance(held, dict):
            items = [item for item in held.get("values") or [] if item is not None]
            if kind == "array":
                return [_plain(item, depth + 1) for item in items]
            return {pair.get("key") or "": _plain(pair.get("value"), depth + 1) for pair in items if isinstance(pair, dict)}
    try:
        if _typed(node, "int") is not None:
            return int(_typed(node, "int"))
        if _typed(node, "double") is not None:
            number = float(_typed(node, "double"))
            # JSON has no such numbers: their text, as protobuf writes them.
            return number if math.isfinite(number) else "NaN" if math.isnan(number) else "Infinity" if number > 0 else "-Infinity"
    except (TypeError, ValueError):
        return None
    if _typed(node, "bytes") is not None:
        return bytes_text(_typed(node, "bytes"))
    text = _typed(node, "string")
    return _typed(node, "bool") if text is None else text


def bytes_text(encoded: str) -> str:
    """Text of a base64 value when it is UTF-8, else the base64 form, marked."""
    import base64

    try:
        return base64.urlsafe_b64decode(encoded.replace("+", "-").replace("/", "_") + "=" * (-len(encoded) % 4)).decode("utf-8")
    except ValueError:
        return "base64:" + encoded


def plain_attributes(entries_json: Column) -> Column:
    """``[{key, value}]`` text of nested attribute values -> JSON object text."""

    @F.pandas_udf("string")
    def unwrapped(texts: pd.Series) -> pd.Series:
        def one(text: str) -> str:
            return json.dumps({e.get("key") or "": _plain(e.get("value"), 0) for e in json.loads(text) if e}, ensure_ascii=False)

        return texts.map(one, na_action="ignore").astype(object)

    return _once(unwrapped)(entries_json)
