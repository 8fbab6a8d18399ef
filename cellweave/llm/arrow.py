"""Document columns through Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def release_memory() -> None:
    """Gives freed memory back to the system, as a reused worker would hold it beside the next stage's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def text_slices(texts: pa.Array, chars: int) -> Iterator[list[str]]:
    """The texts of a column in order, in lists of about so many characters (one text at least)."""
    out: list[str] = []
    size = 0
    for k in range(0, len(texts), 256):
        for text in texts.slice(k, 256).to_pylist():
            out.append(text)
            size += len(text)
            if size >= chars:
                yield out
                out, size = [], 0
    if out:
        yield out


def map_documents(docs: DataFrame, columns: Callable[[list, list], list], schema: StructType, id_col: str = "doc_id", text_col: str = "text", chars: int = 1 << 21) -> DataFrame:
    """columns(ids, texts) gives the columns of schema; null text comes as an empty string.

    A call has the rows of about ``chars`` characters, so that a worker's memory doesn't grow with a batch.
    """
    arrow = to_arrow_schema(schema)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for texts in text_slices(b.column(1), chars):
                made = columns(b.column(0).slice(at, len(texts)).to_pylist(), texts)
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(made, arrow, strict=True)], schema=arrow)
                at += len(texts)
        release_memory()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(each, schema)
