"""Helpers shared by the operators: shared-folder tables, Arrow output, words."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame

from ..session import checkpoint_dir

# A-Z become a-z; ASCII bytes that are no letter or digit become a blank;
# bytes from 0x80 up stay: so ``split`` yields [^\x00-\x2F\x3A-\x60\x7B-\x7F]+.
_WORD_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256))


def words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) ASCII-alphanumeric or non-ASCII words as UTF-8."""
    return (text or "").encode().translate(_WORD_TABLE).split()


def shared_folder(spark) -> str:
    """The folder of ``spark.checkpoint.dir`` (a local master without it gets its own)."""
    root = checkpoint_dir(spark)
    if root is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="txrisk-"))
        root = spark.sparkContext.getCheckpointDir()
    return root


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage: later jobs, and tasks redone after a lost executor, read
    the files instead of recomputing what came before.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spare(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def batches(columns: dict[str, list], schema: pa.Schema, rows: int = 50_000):
    """Yield Arrow record batches of at most ``rows`` rows from column lists."""
    n = len(next(iter(columns.values())))
    for i in range(0, n, rows):
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name][i:i + rows], type=f.type) for f in schema], schema=schema)


def frugal(run):
    """A ``mapInArrow`` function whose worker gives its memory back at the end
    of a partition: workers are kept for later tasks, of other operators too,
    and the C library would else hold their largest use."""
    def kept_small(it):
        try:
            yield from run(it)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):       # another C library
                pass
    return kept_small
