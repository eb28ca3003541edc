"""Arrow batches of bounded size."""

from __future__ import annotations

import ctypes
import re

import pyarrow as pa
from pyspark.sql import DataFrame

PIECE_BYTES = 4 << 20
_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(df: DataFrame, most: int = PIECE_BYTES) -> DataFrame:
    """``df``, after its session's limit of bytes in an Arrow batch is lowered to ``most``.

    Spark's own limits (10,000 rows, 64 MB) let the executor and the worker each hold tens of
    MB a task; a lower limit that the session already has stays.
    """
    conf = df.sparkSession.conf
    size = re.fullmatch(r"(-?\d+)([kmgtp]?)b?", conf.get(_LIMIT).strip().lower())
    now = int(size[1]) << 10 * " kmgtp".index(size[2] or " ") if size else -1
    if now <= 0 or now > most:
        conf.set(_LIMIT, str(most))
    return df


def give_back() -> None:
    """Return freed memory to the system: a worker lives on between tasks, beside others."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def pieces(batch: pa.RecordBatch, column: int, most: int = PIECE_BYTES):
    """Slices of ``batch`` whose strings in ``column`` are about ``most`` bytes, one row at least."""
    col = batch.column(column)
    if batch.num_rows == 0 or col.nbytes <= most:
        yield batch
        give_back()
        return
    import pyarrow.compute as pc

    size = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(size):
        if held and held + n > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    yield batch.slice(start)
    give_back()
