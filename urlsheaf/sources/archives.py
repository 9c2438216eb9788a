"""Members of tar archives as rows.

An archive is a partition.  Of a plain archive only the headers are read, from one to the next, and the content of the
members that are asked for; a compressed one has to be unpacked up to its end, but nothing of it is kept.  Filters on
member names are pushed down, so content is read for the members they leave only.  Headers are followed rather than
searched for, as content may look like a header: a plain archive inside an archive is one member.
"""

from __future__ import annotations

import fnmatch
import tarfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    StringContains,
    StringEndsWith,
    StringStartsWith,
)

from urlsheaf.sinks.filesystems import Opener, open_target, openers

SUFFIXES = (".tar", ".tar.gz", ".tgz")
#: Rows, and bytes of their content, that are handed on at a time.
ROWS, BYTES = 1024, 32 << 20
SCHEMA = "path string, member string, size long, content binary"

_BROKEN = (OSError, tarfile.TarError, EOFError, ValueError)


def listed(path: str, known: dict[str, Opener] | None = None) -> list[str]:
    """The files a path, a folder or a pattern stands for, as URIs of the same kind."""
    fs, local = open_target(path, known)
    head = path[: -len(local.lstrip("/"))] if local.strip("/") and path.endswith(local.lstrip("/")) else ""
    spelled = (lambda p: head + p.lstrip("/")) if head else (lambda p: p)
    parts = local.split("/")
    wild = next((k for k, p in enumerate(parts) if any(c in p for c in "*?[")), None)
    if wild is None:
        found = fs.get_file_info(local)
        if found.type == pafs.FileType.File:
            return [spelled(found.path)]
        below = fs.get_file_info(pafs.FileSelector(local))
        return sorted(spelled(f.path) for f in below if f.type == pafs.FileType.File)
    root = "/".join(parts[:wild]) or "/"
    below = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True, recursive=wild < len(parts) - 1))

    def fits(at: str) -> bool:
        own = at.rstrip("/").split("/")
        return len(own) == len(parts) and all(map(fnmatch.fnmatchcase, own, parts))

    return sorted(spelled(f.path) for f in below if f.type == pafs.FileType.File and fits(f.path))


def archive_members(
    open_file: Callable[[bool], object], path: str, wanted: Callable[[str], bool], content: bool
) -> Iterator[tuple[str, int, bytes | None]]:
    """Name, size and content of the files in an archive that are ``wanted``.

    ``open_file`` opens it, to be read in any order or (False) from the start.  What cannot be read is left out: a
    member that is cut off, and an archive from where it is damaged on.
    """
    packed = not path.endswith(".tar")
    try:
        with open_file(not packed) as f, tarfile.open(fileobj=f, mode="r|*" if packed else "r:") as tar:
            for member in tar:
                tar.members.clear()  # a long archive's headers need not be kept
                if not member.isfile() or not wanted(member.name):
                    continue
                body = None
                if content:
                    held = tar.extractfile(member)
                    body = held.read() if held is not None else b""
                    if len(body) != member.size:
                        continue
                yield member.name, member.size, body
    except _BROKEN:
        return


class _Archive(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options: dict, known: dict[str, Opener]) -> None:
        self.path = options["path"]
        self.known = known
        self.content = options.get("content", "false") == "true"
        self.pattern = options.get("member")
        self.tests: list[tuple[str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        kinds = {EqualTo: "is", In: "in", StringEndsWith: "ends", StringStartsWith: "starts", StringContains: "has"}
        for own in filters:
            if type(own) in kinds and own.attribute == ("member",):
                self.tests.append((kinds[type(own)], own.value))
            else:
                yield own

    def wanted(self, name: str) -> bool:
        if self.pattern is not None and not fnmatch.fnmatchcase(name, self.pattern):
            return False
        told = {
            "is": lambda v: name == v,
            "in": lambda v: name in v,
            "ends": name.endswith,
            "starts": name.startswith,
            "has": lambda v: v in name,
        }
        return all(told[kind](value) for kind, value in self.tests)

    def partitions(self) -> list[InputPartition]:
        return [_Archive(p) for p in listed(self.path, self.known) if p.endswith(SUFFIXES)]

    def read(self, partition: _Archive | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # there are no archives
            return
        fs, local = open_target(partition.path, self.known)

        def opened(seekable: bool):
            return fs.open_input_file(local) if seekable else fs.open_input_stream(local, compression=None)

        held, size = [], 0

        def batch() -> pa.RecordBatch:
            names, sizes, bodies = zip(*held)
            columns = [pa.array([partition.path] * len(held)), pa.array(names), pa.array(sizes, pa.int64()), pa.array(bodies, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["path", "member", "size", "content"])

        for row in archive_members(opened, local, self.wanted, self.content):
            held.append(row)
            size += len(row[2] or b"")
            if len(held) >= ROWS or size >= BYTES:
                yield batch()
                held, size = [], 0
        if held:
            yield batch()


def _source(known: dict[str, Opener]) -> type[DataSource]:
    class ArchiveMembers(DataSource):
        @classmethod
        def name(cls) -> str:
            return "archivemembers"

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema) -> DataSourceReader:
            return _Reader(dict(self.options), known)

    return ArchiveMembers


def read_members(spark: SparkSession, path: str, member: str | None = None, content: bool = False) -> DataFrame:
    """``(path, member, size, content)``: the files inside the archives of a path, folder or pattern.

    ``member`` is a pattern of their names.  Without ``content`` that column is null and no content is read.  Members
    and archives that cannot be read are left out.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(_source(openers()))
    reader = spark.read.format("archivemembers").option("content", str(content).lower())
    if member is not None:
        reader = reader.option("member", member)
    return reader.load(path)
