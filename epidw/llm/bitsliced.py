"""Exact top-k search by integer inner product in a bit-sliced index.

*Index.* Vectors are quantised to integers and dealt out in blocks. In a block every dimension is stored as bitmaps over
the rows, one for each bit of the component above the block's smallest one: slice i of a dimension marks the rows whose
component has bit i. The slices hold the components whole, so a row can be read back from them.

*Adding.* A query's weights are written in digits -1, 0 and 1 of powers of two, no two neighbours of which are both set.
Each digit adds one attribute, shifted, to all rows of the block at once: the bitmaps that fall on one place of the sum
are reduced three to two by bitwise full adders until one is left, whose carries go to the next place. A negative digit
adds the complement and takes a constant off. The slices of the sum are then the exact scores of all rows.

*Selecting.* From the most significant slice of the sum downward, the rows still tied with the k-th best are split by
each slice, until the rows above the boundary and those on it are known. Of those on it the first by ``vec_id`` fill up
the k; only the chosen rows' scores are read back.

*Dealing.* Queries are cut into chunks. A cell is one block with one chunk; both sides are copied once for each cell of
theirs and meet by the cell's key, so the work spreads evenly whatever the data, and nothing is broadcast.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from epidw.llm.common import written

#: rows of a block, a multiple of 64; a block of 64 dimensions of 9 bits takes about a megabyte
BLOCK_ROWS = 1 << 14
#: queries that meet a block in one cell
CHUNK_QUERIES = 128
#: cells to a task
CELLS = 4
#: components beyond this are not summed exactly in 64 bits; vectors that hold one take no part
LARGEST = 1 << 26

ONE = np.uint64(1)


def quantised(vectors: DataFrame, scale: float, column: str = "embedding") -> DataFrame:
    """``vec_id`` and ``q``, each component times ``scale`` rounded down; vectors that take no part are left out."""
    value = F.col(column)
    usable = lambda x: x.isNotNull() & (F.abs(x.cast("double")) * scale <= float(LARGEST))  # noqa: E731  not so for NaN, which is larger
    q = F.transform(value, lambda x: F.floor(x.cast("double") * scale))
    return vectors.filter(value.isNotNull() & F.forall(value, usable)).select("vec_id", q.alias("q"))


def slices_of(q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smallest value and number of slices of each column, and the slices as 64-bit words over the rows."""
    low = q.min(axis=0) if len(q) else np.zeros(q.shape[1], np.int64)
    above = (q - low).astype(np.uint64)
    widths = np.array([int(top).bit_length() for top in above.max(axis=0, initial=0)], np.int64)
    words = -(-len(q) // 64)
    out = np.zeros((int(widths.sum()), words * 64), np.uint8)
    at = 0
    for d, width in enumerate(widths):
        for bit in range(width):
            out[at, : len(q)] = (above[:, d] >> np.uint64(bit)) & ONE
            at += 1
    return low, widths, np.packbits(out, axis=1, bitorder="little").view(np.uint64).reshape(len(out), words)


def signed_digits(weight: int) -> list[tuple[int, int]]:
    """(place, digit) of the non-adjacent form of ``weight``."""
    digits, place = [], 0
    while weight:
        if weight & 1:
            digit = 2 - (weight & 3)
            digits.append((place, digit))
            weight -= digit
        weight >>= 1
        place += 1
    return digits


def added(bitmaps: np.ndarray, places: dict[int, list[int]]) -> np.ndarray:
    """Slices of the sum of the ``bitmaps`` whose numbers stand at each place, the least significant first."""
    words, slices, carries, place = bitmaps.shape[1], [], [], 0
    last = max(places, default=-1)
    while place <= last or carries:
        held = [bitmaps[places[place]]] if place in places else []
        column = np.concatenate([*held, *carries]) if held or carries else np.zeros((0, words), np.uint64)
        carries = []
        while len(column) > 2:
            third = len(column) // 3
            a, b, c = column[:third], column[third : 2 * third], column[2 * third : 3 * third]
            either = a ^ b
            carries.append((a & b) | (either & c))
            column = np.concatenate([either ^ c, column[3 * third :]])
        if len(column) == 2:
            carries.append((column[0] & column[1])[None])
            column = (column[0] ^ column[1])[None]
        slices.append(column[0] if len(column) else np.zeros(words, np.uint64))
        place += 1
    return np.array(slices, np.uint64).reshape(len(slices), words)


def places_of(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def best_rows(total: np.ndarray, among: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` rows of the bitmap ``among`` with the largest ``total``; of equal ones the first rows."""
    above, tied = np.zeros_like(among), among
    for part in total[::-1]:
        hit = tied & part
        count = int(np.bitwise_count(above | hit).sum())
        if count > k:
            tied = hit
        else:
            above, tied = above | hit, tied & ~part
            if count == k:
                return places_of(above)
    chosen = places_of(above)
    return np.concatenate([chosen, places_of(tied)[: k - len(chosen)]])


class Block:
    """Rows of an index in ``vec_id`` order."""

    def __init__(self, rows: int, low: np.ndarray, widths: np.ndarray, slices: np.ndarray) -> None:
        self.rows, self.low, self.widths = rows, low, widths
        self.words = -(-rows // 64)
        slices = slices.reshape(int(widths.sum()), self.words)
        self._bitmaps = np.concatenate([slices, ~slices])  # complements behind the slices
        self._first = np.concatenate([[0], np.cumsum(widths)]).astype(np.int64)
        every = np.zeros(self.words * 64, np.uint8)
        every[:rows] = 1
        self._all = np.packbits(every, bitorder="little").view(np.uint64)

    def top(self, query: np.ndarray, k: int, without: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the ``k`` best rows, ``without`` some rows."""
        dims = min(len(query), len(self.widths))
        constant = int(np.dot(query[:dims], self.low[:dims]))
        places: dict[int, list[int]] = {}
        half = len(self._bitmaps) // 2
        for d, weight in enumerate(query[:dims].tolist()):
            first, width = int(self._first[d]), int(self.widths[d])
            for place, digit in signed_digits(weight):
                if digit < 0:
                    constant -= ((1 << width) - 1) << place
                start = first + (half if digit < 0 else 0)
                for bit in range(width):
                    places.setdefault(place + bit, []).append(start + bit)
        total = added(self._bitmaps, places)
        among = self._all
        if len(without):
            among = among.copy()
            np.bitwise_and.at(among, without >> 6, ~(ONE << (without & 63).astype(np.uint64)))
        rows = best_rows(total, among, k)
        bits = (total[:, rows >> 6] >> (rows & 63).astype(np.uint64)) & ONE
        scores = (bits << np.arange(len(total), dtype=np.uint64)[:, None]).sum(axis=0).astype(np.int64)
        return rows, scores + constant


def build_index(vectors: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The bit-sliced index of quantised vectors (``vec_id``, ``q``), one row per block, written to the shared folder.

    Vectors shorter than the longest of their block are as if zeros followed. Repeated rows are held as often.
    """
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    names = ["block", "vec_ids", "low", "widths", "slices"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held = [b for b in batches if b.num_rows]
        if held:
            rows = pa.Table.from_batches(held).combine_chunks().sort_by("vec_id")
            ids, vectors = rows.column("vec_id").combine_chunks(), rows.column("q").combine_chunks()
            lengths = pc.list_value_length(vectors).to_numpy()
            q = np.zeros((len(rows), int(lengths.max(initial=0))), np.int64)
            q[np.arange(q.shape[1]) < lengths[:, None]] = vectors.flatten().to_numpy()
            low, widths, bitmaps = slices_of(q)
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([ids.to_pylist()], pa.list_(ids.type)),
                 pa.array([low], pa.list_(pa.int64())), pa.array([widths], pa.list_(pa.int64())), pa.array([bitmaps.tobytes()], pa.binary())], names)

    dealt = vectors.select("vec_id", "q").repartition(-(-vectors.count() // block_rows) or 1)  # evenly, whatever the data
    return written(
        dealt.mapInArrow(build, f"block long, vec_ids array<{id_type}>, low array<long>, widths array<long>, slices binary"), "blocks")


def top_k(index: DataFrame, queries: DataFrame, k: int, chunk_queries: int = CHUNK_QUERIES) -> DataFrame:
    """The ``k`` best rows of the index for each query (``vec_id``, ``q``): ``query_id``, ``rank``, ``vec_id``, ``score``.

    The score is the integer inner product over the components both have. Rows with the query's own ``vec_id`` are left
    out; equal scores go to the smaller ``vec_id``. A query with fewer candidates gets all of them, and an empty table
    gives no rows. Fully repeated queries are asked once. A null ``vec_id`` is an id like another, the last in order.
    """
    id_type = queries.schema["vec_id"].dataType.simpleString()
    asked = queries.select("vec_id", "q").distinct().withColumn("query", F.xxhash64("vec_id", "q"))
    chunks, groups = max(1, -(-asked.count() // chunk_queries)), max(1, index.count())
    chunk = F.pmod("query", F.lit(chunks)).cast("int").alias("chunk")
    listed = asked.groupBy(chunk).agg(F.collect_list(F.struct("query", "vec_id", "q")).alias("asked"))
    cells = max(1, -(-groups * chunks // CELLS))
    each = lambda count, name: F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)
    rows = index.select("*", F.pmod("block", F.lit(groups)).cast("int").alias("group"), each(chunks, "chunk"))
    met = rows.repartition(cells, "group", "chunk").join(
        listed.select("*", each(groups, "group")).repartition(cells, "group", "chunk"), ["group", "chunk"])
    names = ["query", "query_id", "vec_id", "score"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                at = {name: batch.column(name)[row] for name in ("vec_ids", "low", "widths", "slices", "asked")}
                ids = at["vec_ids"].values
                block = Block(len(ids), *(at[n].values.to_numpy() for n in ("low", "widths")), np.frombuffer(at["slices"].as_py(), np.uint64))
                own, found = defaultdict(list), []
                for i, vec_id in enumerate(ids.to_pylist()):
                    own[vec_id].append(i)
                for query in at["asked"].values:
                    name = query["vec_id"].as_py()
                    without = np.array(own.get(name, ()), np.int64)
                    found.append((query["query"].as_py(), name, *block.top(query["q"].values.to_numpy(), k, without)))
                sizes = [len(f[2]) for f in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.array([f[0] for f in found], np.int64), sizes)),
                     pa.array([f[1] for f, n in zip(found, sizes) for _ in range(n)], ids.type),
                     ids.take(pa.array(np.concatenate([f[2] for f in found]))), pa.array(np.concatenate([f[3] for f in found]))], names)

    scored = met.select("vec_ids", "low", "widths", "slices", "asked").mapInArrow(
        search, f"query long, query_id {id_type}, vec_id {id_type}, score long")
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, queries: Column, k: int, scale: float) -> DataFrame:
    """:func:`top_k` of the rows for which ``queries`` holds, among all rows of ``vectors`` (``vec_id``, ``embedding``).

    A null vector, or one with a null, non-finite or too large component, takes no part; an empty one scores 0.
    Further columns are ignored.
    """
    whole = written(quantised(vectors, scale), "quantised")
    return top_k(build_index(whole), whole.filter(queries), k)
