"""Arrow batches for Python operators."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Bytes of a batch between Spark and Python, and what Spark sets where nobody sets it.
BATCH_SETTING, BATCH_BYTES, UNSET = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20, 64 << 20
#: Bytes of text that an operator holds at once, unless one row is longer.
SLICE_BYTES = 4 << 20


def to_python(rows: DataFrame) -> DataFrame:
    """The same rows, for ``mapInArrow``: batches have ``BATCH_BYTES`` at most, or one row, unless the session sets another bound."""
    conf = rows.sparkSession.conf
    if int(str(conf.get(BATCH_SETTING, str(UNSET))).removesuffix("b")) == UNSET:
        conf.set(BATCH_SETTING, BATCH_BYTES)
    return rows


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of ``column``, so long texts don't add up in memory."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, n in enumerate(lengths):
            if held and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        if start < len(lengths):
            yield batch.slice(start)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; empty for null."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def give_back() -> None:
    """Return memory that a task has freed to the system, so that an idle worker holds little of it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library has no such call
        pass
