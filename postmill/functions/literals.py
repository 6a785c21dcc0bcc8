"""Python list and dict literals held in text, parsed without Python.

A literal is accepted only if the whole text fits the grammar below; it is then
rewritten to JSON and parsed by from_json. Everything else gives null, and
`unparsable` tells such rows from empty ones.

The patterns are possessive throughout, so matching is linear in the text and
needs no stack, however long the text is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postmill.fixed import EMPTY_TOKENS
from postmill.functions.text import strip

STRING = r"""(?:'[^'\\\n]*+(?:\\.[^'\\\n]*+)*+'|"[^"\\\n]*+(?:\\.[^"\\\n]*+)*+")"""


def _sequence(item: str) -> str:
    return rf"\s*+(?:{item}(?:\s*+,\s*+{item})*+\s*+,?+\s*+)?+"


LIST_LITERAL = rf"^\[{_sequence(rf'(?:{STRING}|None|null)')}\]\z"
GROUP = rf"{STRING}\s*+:\s*+(?:None|\[{_sequence(rf'(?:{STRING}|None)')}\])"
DICT_LITERAL = rf"^\{{{_sequence(GROUP)}\}}\z"

# Literals that are JSON as they stand, but for their quotes: no escapes, no None, no dangling comma.
PLAIN = r"""(?:'[^'\\\n]*+'|"[^"\\\n]*+")"""


def _plain_sequence(item: str) -> str:
    return rf"\s*+(?:{item}(?:\s*+,\s*+{item})*+\s*+)?+"


PLAIN_LIST = rf"^\[{_plain_sequence(PLAIN)}\]\z"
PLAIN_DICT = rf"^\{{{_plain_sequence(rf'{PLAIN}\s*+:\s*+\[{_plain_sequence(PLAIN)}\]')}\}}\z"

# Text before the next bare None or dangling comma; quoted text is stepped over whole.
BARE_NONE = rf"""\G((?:{STRING}|[^'"N])*+)None"""
DANGLING_COMMA = rf"""\G((?:{STRING}|[^'",]|,(?!\s*+[\]}}]))*+),(?=\s*+[\]}}])"""

# A backslash escape that JSON lacks, behind an even number of backslashes.
QUOTE_ESCAPE = r"((?<!\\)(?:\\\\)*+)\\'"
HEX_ESCAPE = r"((?<!\\)(?:\\\\)*+)\\x([0-9a-fA-F]{2})"

# Whatever one of the four rewrites could touch.
REWRITTEN = r"\\|None|,\s*+[\]}]"

JSON_OPTIONS = {"allowUnquotedControlChars": "true"}


def _as_json(literal: Column, plain: str, accepted: str) -> Column:
    """JSON text of an accepted literal, null for others; rewritten only where it holds anything to rewrite.

    `plain` accepts part of what `accepted` does, so that most texts are matched once.
    """
    escaped = F.regexp_replace(literal, QUOTE_ESCAPE, r"$1\\u0027")
    escaped = F.regexp_replace(escaped, HEX_ESCAPE, r"$1\\u00$2")
    text = F.when(literal.contains("\\"), escaped).otherwise(literal)
    text = F.regexp_replace(text, BARE_NONE, "$1null")
    text = F.regexp_replace(text, DANGLING_COMMA, "$1")
    rewritten = F.when(literal.rlike(REWRITTEN), text).otherwise(literal)
    return F.when(literal.rlike(plain), literal).when(literal.rlike(accepted), rewritten)


def list_literal(text: Column) -> Column:
    """array<string> of a list literal, null if the text is not one."""
    return F.from_json(_as_json(strip(text), PLAIN_LIST, LIST_LITERAL), "array<string>", JSON_OPTIONS)


def dict_literal(text: Column) -> Column:
    """map<string, array<string>> of a dict literal, null if the text is not one.

    Keys that occur twice stay twice: see `last_entries`.
    """
    return F.from_json(_as_json(strip(text), PLAIN_DICT, DICT_LITERAL), "map<string,array<string>>", JSON_OPTIONS)


def last_entries(groups: Column) -> Column:
    """Entries of a parsed dict literal; of a key that occurs twice, the last one."""
    entries = F.map_entries(groups)
    last_only = F.filter(
        entries,
        lambda entry, at: ~F.exists(
            F.slice(entries, at + 2, F.size(entries)), lambda later: later["key"] == entry["key"]
        ),
    )
    keys = F.map_keys(groups)
    return F.when(F.size(F.array_distinct(keys)) < F.size(keys), last_only).otherwise(entries)


def unparsable(text: Column, parsed: Column) -> Column:
    """True where text was given, is not an empty token, and did not parse."""
    return text.isNotNull() & ~strip(text).isin(EMPTY_TOKENS) & parsed.isNull()
