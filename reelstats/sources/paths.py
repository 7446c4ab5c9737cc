"""Files beside Spark's own readers and writers: manifests and pointers, in any store that pyarrow knows."""

from __future__ import annotations

import re


def file_system(path: str):
    """(pyarrow file system, path in it) of a local path or URI."""
    from pyarrow import fs

    if ":/" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


def put(path: str, data: bytes) -> None:
    """Writes a small file and puts it in place in one step."""
    system, file = file_system(path)
    system.create_dir(file.rsplit("/", 1)[0])
    with system.open_output_stream(f"{file}.new") as f:
        f.write(data)
    system.move(f"{file}.new", file)


def get(path: str) -> bytes | None:
    """The bytes of a small file, None where it doesn't exist."""
    system, file = file_system(path)
    if not system.get_file_info(file).is_file:
        return None
    with system.open_input_file(file) as f:
        return f.read()
