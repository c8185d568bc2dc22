"""Helpers that the document operators share: byte-wise words and slices of Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

# Text that one step inside a task holds as Python objects, unless a single text is longer.
SLICE_BYTES = 4 << 20

ROW = "_row"


def slices(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each slice holds about ``SLICE_BYTES`` of text and at least one row."""
    for batch in batches:
        start = 0
        ends = np.cumsum(text_lengths(batch.column(column)))
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_lengths(column: pa.Array) -> np.ndarray:
    """Bytes of each text, nulls as 0."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The UTF-8 bytes of each text; null is empty."""
    return [value or b"" for value in batch.column(column).cast(pa.binary()).to_pylist()]


def ascii_words(text: bytes) -> list[bytes]:
    r"""Lower-cased (A-Z) runs of ``[^\x20\x09-\x0D]``."""
    return text.lower().split()


def map_texts(
    docs: DataFrame,
    each: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: StructType | str,
) -> DataFrame:
    """Apply ``each`` to slices of ``docs`` inside the tasks, without a shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield each(part)

    return docs.mapInArrow(run, schema)


def with_columns(docs: DataFrame, **types) -> StructType:
    """The schema of ``docs`` with the given columns last; input columns of the same name go."""
    kept = [field for field in docs.schema.fields if field.name not in types]
    return StructType(kept + [StructField(name, kind) for name, kind in types.items()])


def only(docs: DataFrame, *columns: str) -> DataFrame:
    """Just the columns an operator reads; ``text`` as a string."""
    return docs.select(*[F.col(c).cast("string") if c == "text" else F.col(c) for c in columns])
