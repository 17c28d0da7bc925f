"""Column names as the warehouse sees them."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable


def normalise(name: str) -> str:
    """Trimmed and lower-cased, with every character that is neither
    alphanumeric (in Unicode) nor ``_`` turned into ``_``."""
    cleaned = re.sub(r"\W", "_", name.strip().lower()) or "col"
    return "c_" + cleaned if cleaned[0].isdigit() else cleaned


def normalise_all(names: Iterable[str]) -> list[str]:
    """Normalise a header or a list of declarations; names that meet are an error."""
    names = list(names)
    result = [normalise(n) for n in names]
    clashes = sorted(n for n, times in Counter(result).items() if times > 1)
    if clashes:
        raise ValueError(f"column names {names} normalise to the same name: {', '.join(clashes)}")
    return result


def literal(text: str) -> str:
    """A string of an SQL statement."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
