"""Files of the operators' own formats in the shared folder.

A file is written under a temporary name and renamed when it is whole. Its
content and name depend on the task's rows only, so a task that runs again
replaces a file by the same one; readers take only files that a manifest names.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyarrow import fs


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder such as ``file:///shared/x``, ``hdfs://...`` or ``s3://...``."""
    return fs.FileSystem.from_uri(uri)


@contextmanager
def whole_file(uri: str, name: str):
    """A stream whose content appears as ``uri/name`` only when the block ends well."""
    system, folder = open_folder(uri)
    system.create_dir(folder, recursive=True)
    part = f"{folder}/.{name}.{uuid.uuid4().hex}.tmp"
    out = system.open_output_stream(part)
    try:
        yield out
    except BaseException:
        out.close()
        system.delete_file(part)
        raise
    out.close()
    system.move(part, f"{folder}/{name}")


def open_file(uri: str, name: str):
    system, folder = open_folder(uri)
    return system.open_input_file(f"{folder}/{name}")
