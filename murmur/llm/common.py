"""Helpers shared by the training-data operators.

``ship`` makes the package importable on the executors, ``staged`` cuts lineage
through a Parquet table in the shared checkpoint folder, ``text_bytes`` hands
Arrow strings to Python as UTF-8 bytes without decoding them.
"""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

import murmur
from murmur.session import ensure_checkpoint_dir

_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file, the same on this machine and on the executors."""
    import public_tokenizers
    return public_tokenizers.path(name)


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    root = os.path.dirname(os.path.abspath(murmur.__file__))
    if not os.path.isdir(root):          # the package already came as an archive
        return
    out = os.path.join(tempfile.mkdtemp(prefix="murmur-ship-"), "murmur_pkg.zip")
    with zipfile.ZipFile(out, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    p = os.path.join(folder, n)
                    z.write(p, os.path.join("murmur", os.path.relpath(p, root)))
    sc.addPyFile(out)


#: While a step is written: Spark removes the shuffle files of an execution as it ends, instead of when the
#: driver collects garbage; batches for Python are bounded in bytes, as rows may hold whole texts.
_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
            "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    The shuffles below it are not needed any more then, and go at once: the next steps read the table.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/murmur-{name}-{uuid.uuid4().hex}"
    before = {k: spark.conf.get(k, None) for k in _WRITING}
    for k, v in _WRITING.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores added until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def give_back() -> None:
    """Hand free memory of this Python worker back to the system: Spark keeps the worker for later
    stages, whose own memory comes on top otherwise."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):      # another C library
        pass


def text_bytes(col: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without a detour through ``str``."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()).to_pylist()


class Labels:
    """Union-find over 0..n-1 fed with arrays of links; the root is the smallest index."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        root = self.root
        while True:
            a, b = root[i], root[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = root[root]
                if np.array_equal(up, root):
                    break
                root[:] = up

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """(index, root) of every index that is not its own root: a spanning star forest."""
        child = np.flatnonzero(self.root != np.arange(len(self.root)))
        return child, self.root[child]


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ranges start..start+length of every (start, length)."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


def dense(column: pa.Array) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """(rows that are vectors, [(row numbers, float64 matrix)] per length) of a list column.

    A row is no vector if it is NULL or holds a NULL or non-finite component.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.asarray(pc.fill_null(pc.list_value_length(column), 0), np.int64)
    values = np.asarray(pc.fill_null(column.flatten().cast(pa.float64()), float("nan")))
    valid = np.asarray(column.is_valid())
    starts = np.cumsum(lengths) - lengths
    valid = valid & (np.bincount(np.repeat(np.arange(len(lengths)), lengths), ~np.isfinite(values), len(lengths)) == 0)
    parts = []
    for size in np.unique(lengths[valid]):
        rows = np.flatnonzero(valid & (lengths == size))
        parts.append((rows, values[starts[rows][:, None] + np.arange(size)]))
    return valid, parts
