"""Whole files in the shared folder, written and read by tasks."""

from __future__ import annotations

import re
import uuid

from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a URI; Hadoop's names of object stores are accepted."""
    uri = re.sub(r"^s3[an]://", "s3://", uri)
    uri = re.sub(r"^wasbs?://", "abfss://", uri)
    return fs.FileSystem.from_uri(uri)


def write_file(uri: str, content: bytes) -> None:
    """Appears under its name only when complete; a repeated task replaces it by equal content."""
    system, path = opened(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    draft = f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        out.write(content)
    system.move(draft, path)


def read_file(uri: str) -> bytes:
    system, path = opened(uri)
    with system.open_input_file(path) as source:
        return source.read()
