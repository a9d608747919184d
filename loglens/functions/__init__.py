"""Column helpers that reproduce JVM string semantics with built-in expressions."""

from loglens.functions.text import (
    java_split, utf16_len, full_match, keyword_split, KEYWORD_DELIMITERS, KEYWORD_REJECT,
)
from loglens.functions.logline import (
    LOG_TS_PATTERN, format_seen, try_parse_seen, seen_key, seen_text, access_line,
)

__all__ = [
    "java_split", "utf16_len", "full_match", "keyword_split",
    "KEYWORD_DELIMITERS", "KEYWORD_REJECT",
    "LOG_TS_PATTERN", "format_seen", "try_parse_seen", "seen_key", "seen_text",
    "access_line",
]
