"""Binary files of this package in the shared folder, written and read by tasks.

A task writes under a name of its own attempt and reports it in its result row. Readers open only
the names in those rows, so files left by a lost or repeated attempt are never read.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def open_output(folder: str, stem: str, suffix: str):
    """(path, stream) of a new file in ``folder`` (a local path or a URI that pyarrow knows)."""
    uri = f"{folder}/{stem}-{uuid.uuid4().hex}{suffix}"
    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return uri, store.open_output_stream(path, compression=None)


def open_input(uri: str):
    store, path = fs.FileSystem.from_uri(uri)
    return store.open_input_file(path)
