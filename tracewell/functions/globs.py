"""Path globs as one anchored Java regular expression.

``?`` and ``*`` stay inside a segment, ``**`` spans segments, ``[...]`` is a
character class and ``{a,b}`` alternatives.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column

# Checked in this order at each position.
_TOKENS = re.compile(
    r"(?P<lead>^\*\*/)|(?P<tail>/\*\*$)|(?P<mid>/\*\*/)|(?P<all>^\*\*$)|(?P<star>\*+)|(?P<one>\?)"
    r"|(?P<cls>\[(?P<neg>[!^]?)(?P<set>\]?[^\]]*)\])|(?P<alt>\{(?P<list>[^{}]*)\})"
    r"|\\(?P<esc>.)|(?P<bad>[\[\]{}\\])|(?P<lit>.)",
    re.S,
)
_FIXED = {
    "lead": "(?:/?|.*/)", "tail": "/.*", "mid": "(?:/|/.*/)", "all": ".*",
    "star": "[^/]*", "one": "[^/]",
}


def glob_regex(glob: str) -> str:
    """Java regular expression (unanchored) for one glob; ValueError if invalid."""
    out = []
    for token in _TOKENS.finditer(glob):
        kind = next(k for k in ("lead", "tail", "mid", "all", "star", "one", "cls", "alt", "esc", "bad", "lit")
                    if token.group(k) is not None)
        if kind in _FIXED:
            out.append(_FIXED[kind])
        elif kind == "cls":
            members = re.sub(r"([\\\[\]&^])", r"\\\1", token["set"])
            out.append(f"[{'^' if token['neg'] else ''}{members}]")
        elif kind == "alt":
            out.append("(?:" + "|".join(glob_regex(part) for part in token["list"].split(",")) + ")")
        elif kind == "bad":
            raise ValueError(f"invalid glob {glob!r}")
        else:
            out.append(re.escape(token[kind]))
    return "".join(out)


def matches_any(path: Column, globs: Sequence[str]) -> Column:
    """Whether the whole path matches one of the globs."""
    return path.rlike(r"\A(?s:" + "|".join(f"(?:{glob_regex(g)})" for g in globs) + r")\z")
