"""File systems that tasks write to.

Tasks are Python, so they write with ``pyarrow``'s file systems.  URIs are spelled as Hadoop spells them; a scheme that
neither knows is opened by what ``register_filesystem`` was given for it.  Tasks get the registered openers with the job.
"""

from __future__ import annotations

import posixpath
from collections.abc import Callable

import pyarrow.fs as pafs

Opener = Callable[[str], tuple[pafs.FileSystem, str]]

# Hadoop's names of schemes that pyarrow knows by another.
SPELLED = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}
_OPENERS: dict[str, Opener] = {}


def register_filesystem(scheme: str, opener: Opener | None) -> None:
    """Open URIs of ``scheme`` with ``opener``, which gives a file system and the path on it; None forgets it."""
    if opener is None:
        _OPENERS.pop(scheme, None)
    else:
        _OPENERS[scheme] = opener


def openers() -> dict[str, Opener]:
    """What is registered, to be handed to tasks."""
    return dict(_OPENERS)


def open_target(uri: str, known: dict[str, Opener] | None = None) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI or local path, and the path on it."""
    scheme, colon, rest = uri.partition(":")
    known = _OPENERS if known is None else known
    if scheme in known:
        return known[scheme](uri)
    if colon and rest.startswith("//"):
        return pafs.FileSystem.from_uri(f"{SPELLED.get(scheme, scheme)}:{rest}")
    if uri.startswith("file:"):
        return pafs.FileSystem.from_uri("file://" + rest)
    return pafs.LocalFileSystem(), posixpath.abspath(uri)


def within(root: str, path: str) -> str:
    """Final name of a member; paths may not leave the target."""
    final = posixpath.normpath(f"{root}/{path}")
    if not final.startswith(root.rstrip("/") + "/"):
        raise ValueError(f"path leaves the output folder: {path}")
    return final
