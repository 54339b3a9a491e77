"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from epidw.llm.bytehash import SPACE
from epidw.session import shared_folder

#: rows of one Arrow batch are worked on in slices of about this many bytes, which bounds a task's memory
WORKED_BYTES = 1 << 18
#: the same where texts are measured, as each byte takes some hundred bytes of features
SLICE_BYTES = 1 << 16
#: bytes of one Arrow batch, of which a task holds several copies, in the JVM and in Python
BATCH_BYTES = 1 << 21
#: bytes of labelled texts that a classifier is fitted on, at most
SAMPLE_BYTES = 16 << 20


def small_batches(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches of the session in bytes; by default they hold 10,000 texts or 64 MB."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder that all executors share."""
    return f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and carry on from the files, so that a lost executor costs a re-read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(column: str, parts: int) -> Column:
    """Remainder that decides which rows a classifier may learn from."""
    return F.crc32(F.col(column).cast("string")) % parts


def bounded_sample(labelled: DataFrame, rows: int) -> DataFrame:
    """The ``rows`` rows whose hashed ``doc_id`` is smallest: a fixed, source-blind sample of bounded size."""
    return labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def sampled_texts(docs: DataFrame, chosen: DataFrame, value: str, rows: int, most_bytes: int = SAMPLE_BYTES) -> list[tuple[str, object]]:
    """(text, value) of documents of a bounded sample (``doc_id`` and ``value``), in doc_id order.

    ``rows`` and ``most_bytes`` bound what the driver receives: documents are taken in the order of the sample until their
    texts make up ``most_bytes``; one that does not fit any more is passed over, and so are all behind it.
    """
    sized = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("__bytes"))
    sized = sized.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.sum("__bytes").alias("__bytes"))
    so_far = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)  # at most ``rows`` numbers
    fitting = sized.withColumn("__upto", F.sum("__bytes").over(so_far)).filter(F.col("__upto") <= most_bytes).select("doc_id")
    found = docs.select("doc_id", "text").join(F.broadcast(chosen.join(fitting, "doc_id")), "doc_id")
    return [(r["text"] or "", r[value]) for r in found.orderBy("doc_id", "text").limit(rows).collect()]


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> list[tuple[str, int]]:
    """(text, label) of a bounded sample of labelled documents, in doc_id order.

    A document labelled twice counts once, with the larger label; null labels and labels without
    a document teach nothing.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("__label"))
    return sampled_texts(docs, bounded_sample(known, rows), "__label", rows)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offset of each row in them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = pc.fill_null(column, "")
    _, offsets, data = column.buffers()
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    starts = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)), starts


def slices(starts: np.ndarray, most: int = WORKED_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``most`` bytes together, or of one longer row."""
    row, rows = 0, len(starts) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(starts, starts[row] + most, side="right")) - 1)
        yield row, min(end, rows)
        row = min(end, rows)


Measure = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def block_end(data: np.ndarray, low: int, most: int) -> int:
    """End of a block of about ``most`` bytes from ``low`` on, behind white space; a longer word stays whole."""
    if low + most >= len(data):
        return len(data)
    blanks = np.flatnonzero(SPACE[data[low : low + most]])
    if len(blanks):
        return low + int(blanks[-1]) + 1
    at = low + most
    while at < len(data):
        blanks = np.flatnonzero(SPACE[data[at : at + most]])
        if len(blanks):
            return at + int(blanks[0]) + 1
        at += most
    return len(data)


def reach(data: np.ndarray, at: int, step: int, enough: Callable[[np.ndarray], bool]) -> int:
    """How far from ``at``, backward or forward, ``enough`` is found; the text's edge if it is not."""
    size = 256
    while True:
        a, b = (max(0, at - size), at) if step < 0 else (at, min(len(data), at + size))
        if (a == 0 if step < 0 else b == len(data)) or enough(data[a:b]):
            return a if step < 0 else b
        size *= 2


def row_sums(column: pa.Array, measure: Measure, width: int, enough: Callable[[np.ndarray], bool] | None = None) -> np.ndarray:
    """Whole-number sums that ``measure(bytes, starts, ends, bounds)`` gives for the texts of a column, slice by slice.

    A text longer than a slice is measured in blocks that end at white space, and its sums are added. ``bounds`` are the
    ends of what may be looked at: beside a block lie so many bytes of the text as ``enough`` asks for, which are not
    counted. So the sums do not depend on the size of the slices.
    """
    data, starts = utf8(column)
    out = np.zeros((len(starts) - 1, width), np.int64)
    for a, b in slices(starts, SLICE_BYTES):
        low, high = int(starts[a]), int(starts[b])
        if high - low <= SLICE_BYTES:
            ends = starts[a + 1 : b + 1] - low
            out[a:b] = measure(data[low:high], starts[a:b] - low, ends, ends)
            continue
        text, at = data[low:high], 0
        while at < len(text):
            end = block_end(text, at, SLICE_BYTES)
            left = reach(text, at, -1, enough) if enough else at
            right = reach(text, end, 1, enough) if enough else end
            out[a] += measure(text[left:right], np.array([at - left]), np.array([end - left]), np.array([right - left]))[0]
            at = end
    return out
