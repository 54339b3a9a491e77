"""Best-fit packing of documents into token sequences by hierarchical residual packing.

1. A task cuts its documents into pieces of at most ``capacity`` ids and packs the pieces, longest
   first, each into the open sequence with the least room that still takes it.
2. Sequences that are nearly full stay as they are. Each other sequence becomes one item of its load.
3. Neighbouring tasks' items meet, ``fan_in`` tasks in one group, and are packed again; this repeats up
   the tree until one group is left. The rounds move underfull sequences only: a few per task.

Only lengths are packed; texts and ids never leave the task that read them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from epidw.llm.common import written
from epidw.llm.tokens import encoder

CAPACITY = 2048
END_ID = 0
FAN_IN = 16
#: sequences with no more room than this are emitted at once
NEARLY_FULL = 8
PIECES = 50_000  # pieces that a task packs together

PIECE_SCHEMA = "piece int, start long, length long, ids_crc32 long, bin long, place long, load long"


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pack items, largest first, into the fullest bin that takes them: bin and place of each item, load of each bin."""
    bins, places = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    loads: list[int] = []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by room left
    rooms = 0  # bit r is set while a bin with r ids of room is open
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = open_bins[room].pop()
            if not open_bins[room]:
                rooms &= ~(1 << room)
        else:
            room, chosen = capacity, len(loads)
            loads.append(0)
        bins[item], places[item] = chosen, loads[chosen]
        loads[chosen] += size
        open_bins[room - size].append(chosen)
        rooms |= 1 << (room - size)
    return bins, places, np.array(loads, np.int64)


def cut(ids: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; all but the first are full, so only the first can be shorter."""
    first = ids % capacity or capacity
    bounds = [0, *range(first, ids + 1, capacity)]
    return [(a, b - a) for a, b in zip(bounds, bounds[1:])]


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, fan_in: int = FAN_IN
) -> DataFrame:
    """Pack every document (columns ``doc_id``, ``text``) into sequences of at most ``capacity`` token ids.

    One row per piece: ``doc_id``, ``piece`` (from 0), ``start`` (ids of the document before the piece),
    ``length``, ``ids_crc32`` (of the ids as little-endian unsigned 32-bit integers), ``sequence_id`` and
    ``offset`` (place in the sequence; no gaps). A document is its ids and then ``end_id``; a null or empty text
    is ``end_id`` alone. Repeated rows are packed as often as they occur, and a null ``doc_id`` stays null.
    A very long document becomes many full pieces. Further columns are ignored; an empty table gives no rows.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def pack_batch(rows: list[tuple], task: int, chunk: int) -> pa.RecordBatch:
        lengths = np.array([r[3] for r in rows], np.int64)
        bins, places, loads = best_fit(lengths, capacity)
        ids, piece, start, _, crc = zip(*rows)
        names = ["doc_id", *(c.split()[0] for c in PIECE_SCHEMA.split(", "))]
        numbered = (np.int64(task) << 40) + (np.int64(chunk) << 24) + bins
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, arrow_type[0]), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(lengths),
             pa.array(crc, pa.int64()), pa.array(numbered), pa.array(places), pa.array(loads[bins])], names)

    arrow_type: list[pa.DataType] = [pa.int64()]

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, chunk, rows = TaskContext.get().partitionId(), 0, []
        for batch in batches:
            arrow_type[0] = batch.column("doc_id").type
            names = batch.column("doc_id").to_pylist()
            for a, b, found, upto in encoder(tokenizer).encode_slices(batch.column("text")):
                ids = np.insert(found.astype("<u4"), upto[1:], end_id)
                ends = upto[1:] + np.arange(1, b - a + 1)
                for doc_id, first, last in zip(names[a:b], (ends - np.diff(upto) - 1).tolist(), ends.tolist()):
                    for piece, (start, length) in enumerate(cut(last - first, capacity)):
                        rows.append((doc_id, piece, start, length, zlib.crc32(ids[first + start : first + start + length])))
            while len(rows) >= PIECES:
                yield pack_batch(rows[:PIECES], task, chunk)
                rows, chunk = rows[PIECES:], chunk + 1
        if rows:
            yield pack_batch(rows, task, chunk)

    local = written(docs.select("doc_id", "text").mapInArrow(tokenise, f"doc_id {id_type}, {PIECE_SCHEMA}"), "pieces")
    moves = merge_underfull(local.select("bin", "load"), capacity, fan_in)
    placed = local.join(moves, "bin", "left")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.coalesce("to", "bin").alias("sequence_id"), (F.col("place") + F.coalesce("shift", F.lit(0))).alias("offset"),
    )


def merge_underfull(bins: DataFrame, capacity: int, fan_in: int) -> DataFrame:
    """Join underfull bins of neighbouring tasks, level by level: ``bin``, the bin it went ``to``, and its ``shift`` there."""
    room_left = F.col("load") < capacity - NEARLY_FULL
    underfull = bins.filter(room_left).distinct()
    moves = written(underfull.select("bin", F.col("bin").alias("to"), F.lit(0).cast("long").alias("shift"), "load"), "level")
    tasks = (moves.agg(F.max(F.shiftright("bin", 40))).first()[0] or 0) + 1
    width, most = fan_in, None
    while True:
        group = F.floor(F.shiftright("bin", 40) / width).alias("group")
        items = moves.filter(room_left).groupBy("to", "load").agg(F.min("bin").alias("bin")).select(group, "to", "load")
        if most is None:
            halves = items.filter(F.col("load") * 2 <= capacity).groupBy("group").count()
            most = max(halves.agg(F.max("count")).first()[0] or 0, 1)
        # two bins that are more than half full never go together, and a bin takes as well as another of the same load: so
        # of each load no more bins can be used than there are bins up to half full
        alike = F.row_number().over(Window.partitionBy("group", "load").orderBy("to"))
        usable = items.withColumn("place", alike).filter((F.col("place") <= most) | (F.col("load") * 2 <= capacity)).drop("place")
        step = usable.groupBy("group").applyInPandas(_repack(capacity), "bin long, next long, by long, total long")
        after = moves.join(step, moves["to"] == step["bin"], "left").select(
            moves["bin"], F.coalesce("next", "to").alias("to"),
            (F.col("shift") + F.coalesce("by", F.lit(0))).alias("shift"), F.coalesce("total", "load").alias("load"),
        )
        moves = written(after, "level")
        if width >= tasks:
            return moves.select("bin", "to", "shift")
        width, most = width * fan_in, fan_in  # a group that has been packed has one bin up to half full at most


def _repack(capacity: int):
    def repack(items):
        import pandas as pd

        items = items.sort_values(["load", "to"])
        items = items[items["load"] < capacity - NEARLY_FULL]
        ids, sizes = items["to"].to_numpy(), items["load"].to_numpy()
        bins, places, loads = best_fit(sizes, capacity)
        named = np.zeros(len(loads), np.int64)
        named[bins[::-1]] = ids[::-1]  # a bin keeps the name of one of its items
        return pd.DataFrame({"bin": ids, "next": named[bins], "by": places, "total": loads[bins]})

    return repack
