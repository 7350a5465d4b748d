"""What the operators share: picking columns, shipping code, shared storage, Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import os
import sys
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.shared import keep, shared_dir  # noqa: F401

#: A word, in every operator: a run of anything but space, tab, newline, vertical tab, form feed and return.
WORD = r"[^\x20\x09-\x0D]+"
#: The columns of documents, with their types.
DOCUMENT = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}

_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Exactly these columns, cast to these types. Other columns go, whatever their names.

    A name is looked up as spelt, then without regard to case, and the first match counts, so columns that
    clash in spelling do no harm. A missing column is null.
    """
    have = df.columns
    flat = df.toDF(*[f"c{i}" for i in range(len(have))])

    def find(name: str) -> int | None:
        for test in (lambda x: x == name, lambda x: x.lower() == name.lower()):
            for i, x in enumerate(have):
                if test(x):
                    return i
        return None

    out = []
    for name, kind in columns.items():
        i = find(name)
        out.append((F.lit(None) if i is None else F.col(f"c{i}")).cast(kind).alias(name))
    return flat.select(*out)


def ship(spark: SparkSession) -> None:
    """Let executors import this package even where it is not installed; once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    at = os.path.join(os.path.realpath(tempfile.mkdtemp()), f"{root.name}.zip")
    with zipfile.ZipFile(at, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    context.addPyFile(at)
    _shipped.add(context.applicationId)


def estimated_bytes(df: DataFrame) -> int:
    """The size of the tables that df reads, each once; what the optimizer doesn't know the size of counts as none.

    (Its estimate for df itself multiplies the sizes of what is joined.)
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(x for x in sizes if x < 1 << 60)


def settle(spark: SparkSession) -> None:
    """Let Spark's cleaner take the shuffle files of finished steps; it looks only when the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def store(uri: str):
    """The file system of a path in the shared folder, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def cut(df: DataFrame) -> DataFrame:
    """df, computed now and kept in the shared folder; what follows doesn't depend on its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def small_batches(batches, rows: int = 512, size: int = 16 << 20):
    """Slices of at most so many rows and, beyond one row, about so many bytes."""
    for batch in batches:
        step = max(1, min(rows, batch.num_rows * size // max(1, batch.nbytes)))
        for i in range(0, batch.num_rows, step):
            yield batch.slice(i, step)


def give_back() -> None:
    """Return freed memory to the system: a Python worker outlives its tasks, next to the executor's heap."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        libc = ctypes.CDLL(None)
        if hasattr(libc, "malloc_trim"):
            libc.malloc_trim(0)


def made(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
