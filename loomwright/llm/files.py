"""Binary files that tasks write to, and read from, folders that all executors share."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow.fs as fs


def _resolve(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), os.path.abspath(path))


@contextmanager
def written(path: str) -> Iterator:
    """A stream to ``path``, which appears whole when all went well. A task that runs again
    writes under another name first and then puts the same content in the same place."""
    system, target = _resolve(path)
    system.create_dir(target.rpartition("/")[0], recursive=True)
    partial = f"{target}.{uuid.uuid4().hex}.partial"
    try:
        with system.open_output_stream(partial, buffer_size=1 << 20) as stream:
            yield stream
        system.move(partial, target)
    except BaseException:
        if system.get_file_info(partial).type != fs.FileType.NotFound:
            system.delete_file(partial)
        raise


def opened(path: str):
    """A file that can be read from any place."""
    system, source = _resolve(path)
    return system.open_input_file(source)
