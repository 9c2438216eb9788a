"""Many logs, a file each."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlsheaf.sinks.filesystems import open_target, openers

# Folders that the files are dealt to, so that they are listed by many tasks.
FOLDERS = 256
# Fixed value: Spark's name of a null in paths.
NULL = "__HIVE_DEFAULT_PARTITION__"


def write_logs(lines: DataFrame, key: str, order: str, target: str) -> None:
    """Write the ``value`` of the rows of each ``key``, by ``order``, as lines of ``target/<folder>/<key>=<its value>``.

    A task writes the files of its keys one after the other under their final names, and a repeated one the same again:
    no file is renamed, and none has a folder of its own.
    """
    known = openers()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root, made, path, stream, n = None, set(), None, None, 0
        try:
            for batch in batches:
                names = batch.column("name")
                if root is None:
                    fs, root = open_target(target, known)
                starts = np.flatnonzero(pc.not_equal(names[1:], names[:-1]).to_numpy(zero_copy_only=False)) + 1
                starts = np.concatenate([[0], starts, [len(names)]])[0 if len(names) else 2 :]
                values = pc.fill_null(batch.column("value"), "").cast(pa.string())
                texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), values), "\n")
                for at, text in zip(starts.tolist(), texts):
                    if names[at].as_py() != path:
                        if stream:
                            stream.close()
                        path, folder = names[at].as_py(), f"{root}/{batch.column('folder')[at].as_py()}"
                        if folder not in made:
                            fs.create_dir(folder)
                            made.add(folder)
                        stream, n = fs.open_output_stream(f"{folder}/{path}"), n + 1
                    stream.write(text.as_buffer())
                    stream.write(b"\n")
        finally:
            if stream:
                stream.close()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    name = F.concat(F.lit(f"{key}="), F.coalesce(F.col(key).cast("string"), F.lit(NULL)))
    laid = lines.select(F.pmod(F.xxhash64(key), F.lit(FOLDERS)).alias("folder"), name.alias("name"), key, order, "value")
    laid = laid.repartition(key).sortWithinPartitions(key, order)
    laid.select("folder", "name", "value").mapInArrow(run, "n long").agg(F.sum("n")).collect()
