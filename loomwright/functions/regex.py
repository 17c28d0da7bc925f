"""POSIX-style patterns, as rules write them, in the dialect of ``rlike``."""

from __future__ import annotations

import re

# POSIX character classes as Java writes them inside brackets.
POSIX_CLASSES = {
    "alnum": r"\p{Alnum}",
    "alpha": r"\p{Alpha}",
    "blank": r"\p{Blank}",
    "cntrl": r"\p{Cntrl}",
    "digit": r"0-9",
    "graph": r"\p{Graph}",
    "lower": r"\p{Lower}",
    "print": r"\p{Print}",
    "punct": r"\p{Punct}",
    "space": r"\s",
    "upper": r"\p{Upper}",
    "xdigit": r"0-9A-Fa-f",
}

_BRACKET = r"\[\^?\]?(?:\[:\w+:\]|\\.|[^\]\\])*\]"
_TOKENS = re.compile(rf"(?P<bracket>{_BRACKET})|(?P<escape>\\.)|(?P<dollar>\$)|(?P<other>.)", re.DOTALL)
_IN_BRACKET = re.compile(r"\[:(?P<posix>\w+):\]|(?P<escape>\\.)|(?P<special>[\[\]&])|(?P<other>.)", re.DOTALL)
_UNSUPPORTED = re.compile(r"\[[.=]|\[\[:[<>]:\]\]|^\*\*\*|^\(\?[a-z]+\)")


def _bracket(text: str) -> str:
    head = "[^" if text.startswith("[^") else "["

    def member(m: re.Match[str]) -> str:
        if m["posix"]:
            if m["posix"] not in POSIX_CLASSES:
                raise ValueError(f"unknown character class [:{m['posix']}:]")
            return POSIX_CLASSES[m["posix"]]
        if m["escape"] == r"\d":
            return POSIX_CLASSES["digit"]
        # A literal here, but nesting or intersection in Java.
        return "\\" + m["special"] if m["special"] else m[0]

    return head + _IN_BRACKET.sub(member, text[len(head) : -1]) + "]"


def to_java(pattern: str) -> str:
    """Same matches under ``rlike``: ``.`` covers newlines, ``$`` is the very end,
    letter classes are Unicode, and brackets hold plain characters only."""
    if _UNSUPPORTED.search(pattern):
        raise ValueError(f"pattern {pattern!r} uses POSIX syntax that has no counterpart")
    unicode_classes = re.search(r"\[:(?!x?digit:)|\\[wWsS]", pattern) is not None

    def token(m: re.Match[str]) -> str:
        if m["bracket"]:
            return _bracket(m["bracket"])
        if m["dollar"]:
            return r"\z"
        if m["escape"]:
            letter = m["escape"][1]
            if letter in "mMyY":
                raise ValueError(f"pattern {pattern!r}: word boundary \\{letter} has no counterpart")
            # Digits are ASCII in either dialect, \Z is the very end.
            return {"d": "[0-9]", "D": "[^0-9]", "Z": r"\z"}.get(letter, m["escape"])
        return m[0]

    return ("(?sU)" if unicode_classes else "(?s)") + _TOKENS.sub(token, pattern)
