"""User-defined scrub rules and their plan-time checks."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

_ACTIONS = ("redact", "hash")
_SCOPES = ("values", "keys", "both")


@dataclass(frozen=True)
class Rule:
    """A pattern over text (``values``), over key names (``keys``) or ``both``.

    Patterns ignore case unless they begin with ``(?-i)``. They must be readable
    by both Java and Python; digits, blanks and word characters are ASCII.
    """

    pattern: str
    label: str | None = None
    action: str | None = None
    scope: str | None = None
    java: str = field(init=False, repr=False, compare=False)
    compiled: re.Pattern = field(init=False, repr=False, compare=False)

    def __post_init__(self) -> None:
        name = repr(self.label.strip()) if self.label and self.label.strip() else repr(self.pattern)
        if not self.pattern.strip():
            raise ValueError(f"rule {name}: pattern is empty")
        for attr, default, allowed in (("action", "redact", _ACTIONS), ("scope", "values", _SCOPES)):
            chosen = (getattr(self, attr) or "").strip().lower() or default
            if chosen not in allowed:
                raise ValueError(f"rule {name}: unknown {attr} {chosen!r} (one of {', '.join(allowed)})")
            object.__setattr__(self, attr, chosen)
        exact = self.pattern.startswith("(?-i)")
        body = self.pattern[len("(?-i)"):] if exact else self.pattern
        try:
            compiled = re.compile(body, re.ASCII if exact else re.ASCII | re.IGNORECASE)
        except re.error as error:
            raise ValueError(f"rule {name}: invalid pattern: {error}") from error
        object.__setattr__(self, "compiled", compiled)
        object.__setattr__(self, "java", body if exact else "(?i)" + body)

    @property
    def name(self) -> str:
        return self.label or self.pattern

    @property
    def on_values(self) -> bool:
        return self.scope in ("values", "both")

    @property
    def on_keys(self) -> bool:
        return self.scope in ("keys", "both")


_readable: set[str] = set()


def check_rules(spark: SparkSession, rules: Sequence[Rule]) -> list[Rule]:
    """Raise ValueError, naming the rule, unless the JVM can read every pattern; returns
    ``rules``. A pattern is tried once in a process."""
    for rule in rules:
        if rule.java in _readable:
            continue
        try:
            spark.range(1).select(F.lit("").rlike(rule.java)).collect()
        except Exception as error:
            raise ValueError(f"rule {rule.name!r}: invalid pattern") from error
        _readable.add(rule.java)
    return list(rules)
