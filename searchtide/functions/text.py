"""Column expressions on text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: every Unicode space as a regular-expression class
SPACE = r"[\t-\r\x1c-\x20\x85\p{Z}]"
#: the same characters listed, for trim
SPACE_CHARS = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
#: a character that is part of a word
WORD = r"[\p{L}\p{N}_]"


def strip(text: Column) -> Column:
    """Remove every kind of space from both ends (plain ``trim`` removes blanks only)."""
    return F.trim(text, F.lit(SPACE_CHARS))


def normalize_keyword(text: Column) -> Column:
    return F.lower(F.trim(text))


def dictionary(entries: Mapping[str, str]) -> Column:
    """A constant map."""
    texts = (part.replace("\\", "\\\\").replace("'", "\\'") for pair in entries.items() for part in pair)
    return F.expr("map(" + ", ".join(f"'{text}'" for text in texts) + ")")


def grouped(text: Column, groups: Mapping[str, str], default: str) -> Column:
    """Value of ``groups`` for the lower-cased text; ``default`` for null and for other texts."""
    return F.coalesce(dictionary(groups)[F.lower(text)], F.lit(default))


def whole_words(pattern: str) -> str:
    """Regular expression that finds ``pattern`` between word boundaries.

    Boundaries are spelled out so that accented letters count as letters, and in a form
    that both Java and RE2 accept.
    """
    return rf"(?i)(^|[^\p{{L}}\p{{N}}_])({pattern})($|[^\p{{L}}\p{{N}}_])"


def keyword_present(column: str = "keyword_norm") -> Column:
    """A non-empty keyword; null keywords fail as well."""
    return F.col(column) != ""
