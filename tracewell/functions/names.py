"""Attribute names: word split, derived column key, sensitivity test."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewell.constants import SENSITIVE_KEYS

# Where a word begins inside letters and digits: at a capital behind a small letter or
# digit, and at the last of several capitals before a small letter.
_TURN = r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])"


def _spelled(word: str) -> str:
    """A word in the spellings that have no turn inside: small, Capital and CAPITALS."""
    return f"(?:[{word[0].upper()}{word[0]}]{word[1:]}|{word.upper()})"


#: Finds a sensitive key among the words of a name; one pattern for Java and Python.
SENSITIVE_NAME = (
    rf"(?:(?<![A-Za-z0-9])|{_TURN})(?:"
    + "|".join(rf"(?:[^A-Za-z0-9]+|{_TURN})".join(map(_spelled, key.split("_"))) for key in SENSITIVE_KEYS)
    + rf")(?:(?![A-Za-z0-9])|{_TURN})"
)


def name_key(name: Column) -> Column:
    """The lower-case words of an attribute name, joined by ``_``."""
    parted = F.regexp_replace(name, rf"(?:{_TURN})|[^A-Za-z0-9]+", "_")
    return F.lower(F.regexp_replace(parted, "^_+|_+$|(?<=_)_+", ""))


def is_sensitive_name(name: Column) -> Column:
    """Whether words of the name that follow each other spell a sensitive key."""
    return name.rlike(SENSITIVE_NAME)
