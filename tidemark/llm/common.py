"""What several operators share: tables, word patterns, hashes and folds."""

from __future__ import annotations

import ctypes
import gc
import os
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are runs of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
WORDS = re.compile(WORD)
# Settings of the C library and Arrow for Python workers, which take effect where those are in use.
MEMORY = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "2", "MALLOC_TRIM_THRESHOLD_": "1048576",
          "MALLOC_MMAP_THRESHOLD_": "1048576"}


def importable(spark: SparkSession, batch: str = "16m") -> SparkSession:
    """Let Python workers find this package where it is not installed but only on the driver's path.

    That reaches workers on machines that have the folder; elsewhere install the package or pass it as --py-files.
    ``batch`` bounds the bytes of an Arrow batch, of which a task holds several copies on both sides.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, paths] if paths else [root])
    # Workers are reused for the whole application: what a task frees goes back to the system, not into pools.
    for name, value in MEMORY.items():
        spark.sparkContext.environment.setdefault(name, value)
    # Texts differ in length by orders of magnitude, so batches are bounded by bytes and not by rows alone.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", batch)
    return spark


def blocks(batch: pa.RecordBatch, column: int | str, rows: int = 2000, size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in slices of at most ``rows`` rows whose texts in ``column`` have at most ``size`` bytes, or one row."""
    values = batch.column(column)
    length = np.asarray(pa.compute.fill_null(pa.compute.binary_length(values), 0)).astype(np.int64)
    ends = np.cumsum(length)
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        end = max(at + 1, min(at + rows, int(np.searchsorted(ends, before + size, "right"))))
        yield batch.slice(at, end - at)
        at = end


def release() -> None:
    """Give back what earlier operators keep in this Python worker: Spark reuses workers, and their caches stay."""
    encoders = sys.modules.get(f"{__package__}.encoder")
    if encoders:
        encoders._OPEN.clear()
    trim()


def trim() -> None:
    """Give what is free in this Python worker back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library; its memory is reused, not returned


def unused(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have in any case, made from ``name``."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, k: int) -> Column:
    """crc32 of the id as text, modulo ``k``; an id that is null counts as the text ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % k


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for a null."""
    cut = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    return (F.size(cut) - F.when(F.element_at(cut, 1) == "", 1).otherwise(0)
            - F.when((F.size(cut) > 1) & (F.element_at(cut, -1) == ""), 1).otherwise(0)).cast("long")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
