"""Payload goes from the answer into its file or archive, and only once.

``store`` is a step of a plan: rows with ``content`` go in, the same rows without it come out, with the name of the file
or archive that holds them.  Nothing is shuffled or sorted.  Files are written under their final names.  What was written
is told by the rows that come out, and Spark commits those as it commits any table, on any file system it knows: a job
is committed when its table is, and the table is the manifest.  Files of tasks that were lost are in no manifest; names
do not depend on the attempt, so most are written over, and ``sweep`` removes the others.
"""

from __future__ import annotations

import gzip
import io
import json
import posixpath
import tarfile
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urlsheaf.sinks.filesystems import open_target, openers, within

#: Bytes of content after which an archive is closed and the next one opened.
SHARD_BYTES = 1 << 30
#: Bytes of content that the JVM hands to a task at a time.
BATCH_BYTES = 32 << 20
#: Columns of the rows that say where a row's content is.
PLACE = T.StructType(
    [
        T.StructField("stored_in", T.StringType()),
        T.StructField("member", T.StringType()),
        T.StructField("crc32", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Store:
    """Where content goes: files, or tar archives of about ``shard_bytes`` each.

    ``inputs`` are told by the overview that ends every archive; None: no overviews.
    """

    root: str
    tar: bool = False
    compress: bool = True
    shard_bytes: int = SHARD_BYTES
    inputs: dict | None = field(default=None, hash=False)

    @property
    def suffix(self) -> str:
        return ".tar.gz" if self.compress else ".tar"


class _Tally:
    """What an overview says of the rows of an archive."""

    def __init__(self) -> None:
        self.rows = self.good = self.size = 0
        self.began = self.ended = None
        self.errors: Counter = Counter()

    def add(self, row: dict) -> None:
        self.rows += 1
        if row["success"]:
            self.good += 1
            self.size += row["bytes_downloaded"] or 0
        else:
            self.errors[row["status_code"], row["error"]] += 1
        if row.get("ts") is not None:
            began = row["ts"].timestamp()
            ended = began + (row.get("ttfb") or 0.0)
            self.began = began if self.began is None else min(began, self.began)
            self.ended = ended if self.ended is None else max(ended, self.ended)

    def document(self, inputs: dict, name: str) -> dict:
        seconds = self.ended - self.began if self.began is not None else 0.0
        mb = self.size / 1e6
        ranked = sorted(self.errors.items(), key=lambda e: (-e[1], e[0][0] is not None, e[0][0] or 0, e[0][1] or ""))
        return {
            "script_inputs": inputs,
            "summary": {
                "total_urls": self.rows,
                "successful_downloads": self.good,
                "failed_downloads": self.rows - self.good,
                "success_rate_percent": round(100.0 * self.good / self.rows, 2) if self.rows else 0.0,
                "downloaded_mb": round(mb, 3),
                "elapsed_sec": round(seconds, 3),
                "avg_speed_MBps": round(mb / seconds, 3) if seconds > 0 else 0.0,
                "shutdown_requested": False,
                "tar_path": name,
            },
            "error_breakdown": [{"status_code": s, "error": e, "count": n} for (s, e), n in ranked],
            "timestamp_local": datetime.now().strftime("%Y-%m-%d %H:%M:%S"),
        }


class _Archive:
    """One open archive; content is written through to the target as it comes."""

    def __init__(self, fs: pafs.FileSystem, root: str, name: str, suffix: str) -> None:
        self.name, self.file, self.size = name, name + suffix, 0
        self.sink = fs.open_output_stream(within(root, self.file), compression=None)
        # a fixed time stamp makes equal rows equal bytes
        self.zipped = gzip.GzipFile(fileobj=self.sink, mode="wb", mtime=0) if suffix.endswith("gz") else None
        self.tar = tarfile.open(fileobj=self.zipped or self.sink, mode="w|", format=tarfile.PAX_FORMAT)
        self.tally = _Tally()

    def add(self, path: str, content: bytes) -> None:
        info = tarfile.TarInfo(f"{self.name}/{path}")
        info.size = len(content)
        self.tar.addfile(info, io.BytesIO(content))
        self.size += len(content)

    def close(self, inputs: dict | None) -> None:
        if inputs is not None:
            self.add("overview.json", json.dumps(self.tally.document(inputs, self.file)).encode())
        self.tar.close()
        if self.zipped is not None:
            self.zipped.close()
        self.sink.close()


def _writer(target: Store, names: list[str]):
    """For mapInArrow over rows with ``path``, ``content``, ``side`` and, for archives, ``shard``."""
    known = openers()
    kept = [n for n in names if n not in ("path", "content", "side")]
    told = [n for n in ("success", "bytes_downloaded", "status_code", "error", "ts", "ttfb") if n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_target(target.root, known)
        folders: set[str] = set()
        open_archives: dict[str, _Archive] = {}
        parts: Counter = Counter()

        def folder(path: str) -> None:
            if path not in folders:
                fs.create_dir(path, recursive=True)
                folders.add(path)

        def archive(shard: str) -> _Archive:
            held = open_archives.get(shard)
            if held is not None and held.size >= target.shard_bytes:
                held.close(target.inputs)
                held = None
            if held is None:
                folder(root)
                parts[shard] += 1
                held = open_archives[shard] = _Archive(fs, root, f"{shard}_{parts[shard]:04d}", target.suffix)
            return held

        def file(path: str, content: bytes) -> None:
            final = within(root, path)
            folder(posixpath.dirname(final))
            with fs.open_output_stream(final, compression=None) as out:
                out.write(content)

        for batch in batches:
            paths = batch.column("path").to_pylist()
            sides = batch.column("side").to_pylist()
            shards = batch.column("shard").to_pylist() if target.tar else [None] * len(paths)
            rows = batch.select(told).to_pylist() if target.inputs is not None else [None] * len(paths)
            column, places = batch.column("content"), []
            for i, (path, side, shard, row) in enumerate(zip(paths, sides, shards, rows)):
                wanted = shard is not None and (path is not None or row is not None)
                holder = archive(shard) if wanted else None
                if holder is not None and row is not None:
                    holder.tally.add(row)
                if path is None:
                    places.append((holder.file if holder is not None else None, None, None))
                    continue
                content = column[i].as_py() or b""
                put = holder.add if holder is not None else file
                put(path, content)
                if side is not None:
                    put(posixpath.splitext(path)[0] + ".json", side)
                member = f"{holder.name}/{path}" if holder is not None else path
                places.append((holder.file if holder is not None else path, member, zlib.crc32(content)))
            columns = list(zip(*places)) or [()] * 3
            made = [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *made], [*kept, *PLACE.names])
        for held in open_archives.values():
            held.close(target.inputs)

    return run


def store(rows: DataFrame, target: Store) -> DataFrame:
    """Write ``content`` of every row with a ``path``; the rows without ``path, content, side`` and with ``stored_in``,
    ``member`` and ``crc32``.

    ``side`` (bytes or null) goes beside it as ``<stem>.json``.  For archives, ``shard`` names a row's archive, of which
    there are numbered parts; a row with a null ``shard`` is in none, one without ``path`` counts in its overview only.
    The result is lazy: write it once, and read what was written.
    """
    spark = rows.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    fields = [f for f in rows.schema.fields if f.name not in ("path", "content", "side")]
    return rows.mapInArrow(_writer(target, rows.columns), T.StructType([*fields, *PLACE.fields]))


def sweep(target: Store, manifest: DataFrame) -> int:
    """Remove archives below the target that no row of ``manifest (stored_in)`` names; gives their number."""
    spark = manifest.sparkSession
    fs, root = open_target(target.root)
    found = [f.path for f in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)) if f.path.endswith(target.suffix)]
    if not found:
        return 0
    names = manifest.select("stored_in").distinct()
    there = spark.createDataFrame([(posixpath.basename(p), p) for p in found], "stored_in string, _path string")
    lost = [r["_path"] for r in there.join(names, "stored_in", "left_anti").collect()]
    for path in lost:
        fs.delete_file(path)
    return len(lost)
