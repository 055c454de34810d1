"""Arrow helpers shared by the operators: text columns as bytes, pass-through maps, own columns."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: The white space that separates words: space, tab, newline, VT, FF, CR (fixed by the contracts).
WHITE = " \t\n\v\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def texts(column: pa.Array) -> list[str]:
    """The texts of an Arrow column; a null counts as an empty text."""
    return [text or "" for text in column.to_pylist()]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string column one after the other, and the texts' offsets in them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):  # no chunk at all
        column = pa.array([], pa.large_string())
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) \
        if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def appended(docs: DataFrame, fields: str, compute: Callable[[pa.RecordBatch], Iterable],
             drop: tuple[str, ...] = ()) -> DataFrame:
    """The rows with further columns that ``compute`` makes from each Arrow batch.

    ``compute`` returns one Arrow array for each of the ``fields`` (DDL text).
    """
    more = T._parse_datatype_string(fields)
    kept = [field for field in docs.schema.fields if field.name not in drop]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            arrays = [batch.column(field.name) for field in kept] + list(compute(batch))
            yield pa.RecordBatch.from_arrays(arrays, [f.name for f in kept] + more.fieldNames())

    return docs.mapInArrow(batches, T.StructType(kept + more.fields))


def slices(batch: pa.RecordBatch, column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts hold about ``most_bytes`` (one row at least)."""
    sizes = np.diff(text_bytes(batch.column(column))[1])
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > most_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(size)
    yield batch.slice(start)


def give_back() -> None:
    """Give free memory back to the system.

    A worker serves the tasks of all stages, one after the other; what one of them has freed is
    otherwise held beside what the next one needs.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)
