"""String functions with the exact semantics of the JVM calls they replace.

All of them are plain Catalyst expressions (no Python per row), so they stay
inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The agent-keyword tokenizer splits on these characters and
# drops any token that contains a digit, '.', '_' or '-' (unanchored match).
KEYWORD_DELIMITERS = "[ /,;()]"
KEYWORD_REJECT = "[0-9._-]+"

# Characters with a meaning in a JVM regex; any other single character is
# split on by String.split without compiling a pattern per row.
_REGEX_META = set(".$|()[{^?*+\\")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_split(value, sep: str = " ") -> Column:
    """``String.split(sep)`` of the JVM for a single-character separator.

    Leading and inner empty tokens are kept, trailing ones dropped; ``""``
    gives ``[""]`` and a string made only of separators gives ``[]``.
    Spark's ``split`` keeps trailing empties, so trailing separators are
    trimmed first.
    """
    v = _col(value)
    trimmed = F.rtrim(v) if sep == " " else F.regexp_replace(v, f"(?:\\Q{sep}\\E)+\\z", "")
    pattern = sep if len(sep) == 1 and sep not in _REGEX_META else f"\\Q{sep}\\E"
    return (F.when((v != F.lit("")) & (trimmed == F.lit("")),
                   F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, pattern, -1)))


def utf16_len(value) -> Column:
    """``String.length`` of the JVM: UTF-16 code units, not code points."""
    return (F.octet_length(F.encode(_col(value), "UTF-16BE")) / F.lit(2)).cast("bigint")


def full_match(value, regex: str) -> Column:
    """``String.matches(regex)``: the whole string must match.

    ``^...$`` is not enough (``$`` also matches before a final newline),
    so the pattern is wrapped in ``\\A(?:...)\\z``.
    """
    return _col(value).rlike(r"\A(?:" + regex + r")\z")


def keyword_split(value) -> Column:
    """Split an agent string on the keyword delimiters (empty tokens kept).

    A regex split: its pattern is compiled once per row, which is small
    next to scanning a long agent string (mapping the delimiters to spaces
    with ``translate`` first measured slower on long texts).
    """
    return F.split(_col(value), KEYWORD_DELIMITERS, -1)
