"""What several operators of this package need: table scans, staging, Arrow texts, word hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeway.sources.stage import staged

__all__ = ["Shared", "bounded_slices", "fresh", "held_out", "raw_bytes", "read", "staged", "texts_as_bytes"]

#: Bytes of text that one step of a vectorised function works on.
SLICE_BYTES = 1 << 21


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Shared:
    """A value of bounded size that every executor holds once: ``value`` inside a task.

    It is sent as bytes that executors can read without having its class's package.
    """

    def __init__(self, spark: SparkSession, value: object) -> None:
        self._sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self) -> object:
        return cloudpickle.loads(self._sent.value)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether labels of this document are kept from training; a null id counts as empty text."""
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(key.cast("binary")) % 4 == 2


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in one array, and the offsets of each text (nulls are empty)."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    bounds = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)
    bounds = bounds[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    if data is None or not len(bounds):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def texts_as_bytes(texts: pa.Array) -> list[bytes]:
    """Each text as UTF-8 bytes; null is empty."""
    return [t or b"" for t in texts.cast(pa.large_binary()).to_pylist()]


def bounded_slices(
    batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of at most ``most`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, bounds = raw_bytes(batch.column(batch.schema.get_field_index(text)))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(bounds, bounds[start] + most, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end
