"""Session plumbing shared by the operators of this package."""

from __future__ import annotations

import ctypes
import functools
import gc
import inspect
import os
import re
import sys
import tempfile
import uuid
import zipfile

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import checkpoint_dir

#: Bytes of text handled at once inside a task, and of a batch of rows on its way to or from a worker.
SLICE_BYTES = 1 << 20
BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Rows go to the Python workers in batches of bounded bytes (a single longer row by itself):
    executor and worker hold a few of them at a time. A smaller bound of the session stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    # a number, as the engine gives back its default, or a size as a session may have set it
    now = re.fullmatch(r"(\d+)b?", spark.conf.get(key).strip())
    if now is None or int(now[1]) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application."""
    bound_batches(spark)
    sc = spark.sparkContext
    if getattr(sc, "_strata_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="strata-ship-"), "strata_package.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("strata", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._strata_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it back.

    Cuts lineage: a stage recomputed after a lost executor rereads the table.
    The folder is ``spark.checkpoint.dir`` (see ``strata.session``).
    """
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete tables made by ``stored`` that nothing reads any more."""
    for df in tables:
        for f in {os.path.dirname(x) for x in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(f)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared one as a plain path workers can map.

    ``spark.checkpoint.dir`` must name a mounted file system for this.
    """
    base = checkpoint_dir(spark)
    if base.startswith("file:"):
        base = "/" + base[len("file:"):].lstrip("/")
    elif "://" in base:
        raise ValueError(f"memory-mapped files need a mounted shared folder in spark.checkpoint.dir, not {base}")
    path = os.path.join(base, f"{name}-{uuid.uuid4().hex}")
    os.makedirs(path, exist_ok=True)
    return path


def text_digest(col):
    """First 16 bytes of the SHA-256 of a text, null as empty."""
    return F.substring(F.unhex(F.sha2(F.coalesce(col, F.lit("")).cast("binary"), 256)), 1, 16)


def utf8(array: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    if pa.types.is_null(array.type):
        return [b""] * len(array)
    if not pa.types.is_binary(array.type) and not pa.types.is_large_binary(array.type):
        array = array.cast(pa.large_binary() if pa.types.is_large_string(array.type) else pa.binary())
    return [x or b"" for x in array.to_pylist()]


def released(task):
    """A task function that hands freed memory back to the system when it ends:
    Python workers live on and run the tasks of other operators."""
    def give_back() -> None:
        gc.collect()
        pa.default_memory_pool().release_unused()
        if sys.platform == "linux":
            ctypes.CDLL(None).malloc_trim(0)

    if inspect.isgeneratorfunction(task):
        @functools.wraps(task)
        def run(batches):
            try:
                yield from task(batches)
            finally:
                give_back()
    else:
        @functools.wraps(task)
        def run(group):
            try:
                return task(group)
            finally:
                give_back()
    return run


def text_slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES):
    """(first row, end row, UTF-8 texts) of parts of a batch of about ``limit`` bytes."""
    texts = batch.column(column)
    if pa.types.is_null(texts.type):
        texts = texts.cast(pa.string())
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    for lo, hi in slices(sizes, limit):
        yield lo, hi, utf8(texts.slice(lo, hi - lo))


def slices(sizes: list[int], limit: int = SLICE_BYTES):
    """(first, end) row ranges of about ``limit`` bytes each, one row at least."""
    first, total = 0, 0
    for i, n in enumerate(sizes):
        if i > first and total + n > limit:
            yield first, i
            first, total = i, 0
        total += n
    if first < len(sizes):
        yield first, len(sizes)
