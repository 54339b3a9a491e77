"""Token files of directly addressable codes.

An id is split into chunks of ``CHUNK_BITS`` bits, lowest first. Level 0 holds the first chunk of every id,
level 1 the second chunk of those ids that need one, and so on. A bitmap beside each level marks the ids that
go on in the next level; a rank directory counts the marks before each block of bits. Any id is then read
without its neighbours: its place in the next level is the number of marks before its place in this one.

A file is a Parquet table of segments, written and committed by Spark in the order of the documents:
``part`` (range of document ids), ``segment``, ``first`` (ids of the part before it), ``ids``, ``doc_ids`` and
``lengths`` of its documents, and the ``code`` as bytes. ``offsets`` beside it has the ids before each part.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from epidw.llm.tokens import encoder

CHUNK_BITS = 8
BLOCK_BITS = 512
SEGMENT_IDS = 1 << 18
END_ID = 1


def encode_codes(ids: np.ndarray) -> bytes:
    """A segment: level count, then for each level its count, chunks, continuation bitmap and rank directory."""
    rest, levels = ids.astype(np.uint32), []
    while True:
        chunks, rest = (rest & ((1 << CHUNK_BITS) - 1)).astype(np.uint8), rest >> CHUNK_BITS
        more = rest > 0
        bits = np.packbits(more, bitorder="little")
        counts = np.add.reduceat(more, np.arange(0, len(more), BLOCK_BITS), dtype=np.uint32) if len(more) else np.zeros(0, np.uint32)
        ranks = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype("<u4") if len(counts) else counts.astype("<u4")
        levels.append(struct.pack("<I", len(chunks)) + chunks.tobytes() + bits.tobytes() + ranks.tobytes())
        if not more.any():
            return struct.pack("<I", len(levels)) + b"".join(levels)
        rest = rest[more]


class Codes:
    """Reads a segment: ``get(i)`` one id, ``ids(a, b)`` a range, both without decoding what lies before."""

    def __init__(self, code: bytes) -> None:
        count, at = struct.unpack_from("<I", code)[0], 4
        self._levels = []
        for _ in range(count):
            size = struct.unpack_from("<I", code, at)[0]
            chunks = np.frombuffer(code, np.uint8, size, at + 4)
            at += 4 + size
            bits = np.frombuffer(code, np.uint8, -(-size // 8), at)
            at += len(bits)
            ranks = np.frombuffer(code, "<u4", -(-size // BLOCK_BITS), at)
            at += ranks.nbytes
            self._levels.append((chunks, bits, ranks))

    def __len__(self) -> int:
        return len(self._levels[0][0])

    @staticmethod
    def _rank(bits: np.ndarray, ranks: np.ndarray, place: int) -> int:
        """Marks before ``place``: the directory's count for its block, and the bits of that block before it."""
        block = place // BLOCK_BITS * BLOCK_BITS
        inside = np.unpackbits(bits[block // 8 : (place + 7) // 8], bitorder="little")[: place - block]
        return int(ranks[place // BLOCK_BITS]) + int(inside.sum())

    @staticmethod
    def _bit(bits: np.ndarray, place: int) -> int:
        return int(bits[place >> 3] >> (place & 7)) & 1

    def get(self, place: int) -> int:
        value = 0
        for level, (chunks, bits, ranks) in enumerate(self._levels):
            value |= int(chunks[place]) << (CHUNK_BITS * level)
            if not self._bit(bits, place):
                break
            place = self._rank(bits, ranks, place)
        return value

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids of the range; each level is entered at the rank of the range's first mark."""
        value, places, first = np.zeros(end - start, np.uint32), np.arange(end - start), start
        for level, (chunks, bits, ranks) in enumerate(self._levels):
            last = first + len(places)
            value[places] |= chunks[first:last].astype(np.uint32) << np.uint32(CHUNK_BITS * level)
            marks = np.unpackbits(bits[first // 8 : (last + 7) // 8], bitorder="little")[first % 8 :][: len(places)].astype(bool)
            if not marks.any():
                break
            places, first = places[marks], self._rank(bits, ranks, first)
        return value


def write_token_files(
    docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, parts: int | None = None
) -> None:
    """Encode every document (columns ``doc_id``, ``text``) and write token files in ascending ``doc_id`` order.

    Null or empty texts are ``end_id`` alone; rows that share a ``doc_id`` follow each other in the order of their
    texts; null ids come first. Further columns are ignored, and an empty table gives an empty, readable folder.
    Documents are dealt out by ranges of ``doc_id``, so one text shuffle is all that moves; a segment is closed
    at ``SEGMENT_IDS`` ids, and only a single longer document makes it larger.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    chosen = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    spread = chosen.repartitionByRange(parts, "doc_id") if parts else chosen.repartitionByRange("doc_id")
    arranged = spread.sortWithinPartitions("doc_id", "text")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, first = TaskContext.get().partitionId(), 0, 0
        doc_ids, held, size, kind = [], [], 0, pa.int64()

        def segment() -> pa.RecordBatch:
            code = encode_codes(np.concatenate(held))
            lengths = [len(h) for h in held]
            names = ["part", "segment", "first", "ids", "doc_ids", "lengths", "code"]
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([first], pa.int64()),
                 pa.array([size], pa.int64()), pa.array([doc_ids], pa.list_(kind)),
                 pa.array([lengths], pa.list_(pa.int64())), pa.array([code], pa.binary())], names)

        for batch in batches:
            kind = batch.column("doc_id").type
            names = batch.column("doc_id").to_pylist()
            for a, b, found, upto in encoder(tokenizer).encode_slices(batch.column("text")):
                whole = np.insert(found, upto[1:], np.uint32(end_id))
                ends = upto[1:] + np.arange(1, b - a + 1)
                for doc_id, ids in zip(names[a:b], np.split(whole, ends[:-1])):
                    if held and size + len(ids) > SEGMENT_IDS:
                        yield segment()
                        number, first, doc_ids, held, size = number + 1, first + size, [], [], 0
                    doc_ids.append(doc_id)
                    held.append(ids)
                    size += len(ids)
        if held:
            yield segment()

    schema = f"part int, segment int, first long, ids long, doc_ids array<{id_type}>, lengths array<bigint>, code binary"
    arranged.mapInArrow(segments, schema).write.option("compression", "none").parquet(f"{path}/segments")
    spark = docs.sparkSession
    totals = spark.read.schema(schema).parquet(f"{path}/segments").groupBy("part").agg(F.sum("ids").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part: a few numbers
    totals.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before")).write.parquet(f"{path}/offsets")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document in the files: ``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32``, from the stored codes."""
    found = spark.read.parquet(f"{path}/segments")
    id_type = found.schema["doc_ids"].dataType.elementType.simpleString()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                at = {name: batch.column(name)[row] for name in batch.schema.names}
                codes, lengths = Codes(at["code"].as_py()), np.array(at["lengths"].as_py(), np.int64)
                ends = np.cumsum(lengths)
                crcs = [zlib.crc32(codes.ids(int(e - n), int(e)).astype("<u4")) for e, n in zip(ends, lengths)]
                yield pa.RecordBatch.from_arrays(
                    [at["doc_ids"].values, pa.array(np.full(len(ends), at["part"].as_py(), np.int32)),
                     pa.array(at["first"].as_py() + ends - lengths), pa.array(lengths), pa.array(crcs, pa.int64())],
                    ["doc_id", "part", "inside", "n_tokens", "ids_crc32"])

    rows = found.select("part", "first", "doc_ids", "lengths", "code").mapInArrow(
        digests, f"doc_id {id_type}, part int, inside long, n_tokens long, ids_crc32 long"
    )
    parts = spark.read.parquet(f"{path}/offsets")  # one row per task of the writer
    return rows.join(parts, "part").select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def read_ids(spark: SparkSession, path: str, position: int) -> DataFrame:
    """The id at one position of the whole corpus: file statistics find the segment, the directories find the id."""
    found = spark.read.parquet(f"{path}/segments").join(spark.read.parquet(f"{path}/offsets"), "part")
    inside = F.lit(position) - F.col("before") - F.col("first")
    hit = found.filter((inside >= 0) & (inside < F.col("ids"))).select(inside.alias("inside"), "code")
    read = F.udf(lambda code, place: Codes(bytes(code)).get(place), "long")
    return hit.select(read("code", "inside").alias("id"))
