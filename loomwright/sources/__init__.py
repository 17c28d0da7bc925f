"""Where tables are loaded from: a reader per source type."""

from __future__ import annotations

from collections.abc import Callable

from .csv import MALFORMED, RawTable, read_csv

# Add a reader here to load from another kind of source.
SOURCES: dict[str, Callable[..., RawTable]] = {"s3_csv": read_csv}


def source_reader(kind: str) -> Callable[..., RawTable]:
    if kind not in SOURCES:
        raise ValueError(f"unsupported source type {kind!r}; expected one of {', '.join(SOURCES)}")
    return SOURCES[kind]


__all__ = ["MALFORMED", "SOURCES", "RawTable", "read_csv", "source_reader"]
