"""Document fingerprints: content-defined chunks by a gear hash with normalised cut points.

A gear hash of the last ``WINDOW`` characters is kept for every position of a text. A chunk ends where the
hash has enough zero bits: more than usual before the chunk has its normal length, fewer beyond it. Cut points
thus depend on nearby characters only, and chunks behind an insertion are found again. A fingerprint is the
set of the chunks' digests with the characters they stand for; likeness is the weight two sets share, against
the lighter one (containment) or against both together.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from epidw.llm.bytehash import mix

WINDOW = 8
SHORTEST, NORMAL, LONGEST = 6, 24, 96
EARLY_MASK, LATE_MASK = np.uint32(0x3F << 26), np.uint32(0x07 << 29)
DIGEST_HEX = 8
GEAR = mix(np.arange(1 << 16, dtype=np.uint64)).astype(np.uint32)


def gear(points: np.ndarray) -> np.ndarray:
    """Hash of the ``WINDOW`` code points that end at each position, summed by doubling."""
    hashes, span = GEAR[points & 0xFFFF], 1
    while span < WINDOW:
        shifted = np.zeros_like(hashes)
        shifted[span:] = hashes[:-span] << np.uint32(4 * span) if span < len(hashes) else 0
        hashes, span = hashes + shifted, span * 2
    return hashes


def cuts(points: np.ndarray) -> list[int]:
    """End of each chunk of a text, given as code points."""
    hashes = gear(points)
    early = (np.flatnonzero((hashes & EARLY_MASK) == 0) + 1).tolist()
    late = (np.flatnonzero((hashes & LATE_MASK) == 0) + 1).tolist()
    early.append(1 << 62)
    late.append(1 << 62)
    ends, at, total, i, j = [], 0, len(points), 0, 0
    while at < total:
        while early[i] < at + SHORTEST:
            i += 1
        end = early[i]
        if end >= at + NORMAL:
            while late[j] < at + NORMAL:
                j += 1
            end = late[j]
        at = min(end, at + LONGEST, total)
        ends.append(at)
    return ends


def fingerprint(text: str) -> dict[str, int]:
    """Digest of each distinct chunk and the characters it covers in the text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    found: dict[str, int] = {}
    start = 0
    for end in cuts(points):
        digest = hashlib.blake2b(text[start:end].encode("utf-8", "surrogatepass"), digest_size=DIGEST_HEX // 2).hexdigest()
        found[digest] = found.get(digest, 0) + end - start
        start = end
    return found


def as_text(found: dict[str, int]) -> str:
    """Sorted ``digest:characters`` entries; equal sets give equal texts, and the empty text gives ''."""
    return " ".join(f"{d}:{n}" for d, n in sorted(found.items()))


def from_text(written: str) -> dict[str, int]:
    return {d: int(n) for d, n in (entry.split(":") for entry in written.split())}


def containment(one: dict[str, int], other: dict[str, int]) -> float:
    """Part of the lighter fingerprint that the other one holds too; two empty ones are alike."""
    lighter = min(sum(one.values()), sum(other.values()))
    if not lighter:
        return float(not one and not other)
    return _shared(one, other) / lighter


def resemblance(one: dict[str, int], other: dict[str, int]) -> float:
    """Shared weight against the weight of both together; two empty fingerprints are alike."""
    shared = _shared(one, other)
    both = sum(one.values()) + sum(other.values()) - shared
    return shared / both if both else 1.0


def _shared(one: dict[str, int], other: dict[str, int]) -> int:
    if len(one) > len(other):
        one, other = other, one
    return sum(min(n, other[d]) for d, n in one.items() if d in other)


def edit(text: str, following: str) -> str:
    """The last third of ``text`` replaced by as much of the start of ``following``."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def range_of(value: Column, bounds: Sequence) -> Column:
    """How many of the sorted ``bounds`` are below ``value``: blocks of bounds first, then the bounds of one block."""
    width = math.isqrt(len(bounds)) + 1
    blocks = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    if not blocks:
        return F.lit(0)
    passed = F.size(F.filter(F.array(*(F.lit(block[-1]) for block in blocks)), lambda last: last < value))
    block = F.get(F.array(*(F.array(*map(F.lit, block)) for block in blocks)), passed)
    below = F.coalesce(F.size(F.filter(block, lambda bound: bound < value)), F.lit(0))
    return F.least(passed * width + below, F.lit(len(bounds)))  # the last block may be shorter


def with_predecessors(docs: DataFrame, parts: int) -> DataFrame:
    """Documents dealt out by ranges of ``doc_id``, each range headed by the last document before it (``own`` false).

    Spark cuts the ids, without the texts, into at most ``parts`` ranges; the driver gets the last id of each.
    """
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ids = docs.select("doc_id").filter("doc_id IS NOT NULL").repartitionByRange(parts, "doc_id")
    lasts = ids.withColumn("part", F.spark_partition_id()).groupBy("part").agg(F.max("doc_id").alias("last"))
    ends = sorted(row["last"] for row in lasts.collect())
    bucket = F.when(F.col("doc_id").isNull(), -1).otherwise(range_of(F.col("doc_id"), ends[:-1]))
    placed = keyed.withColumn("bucket", bucket).withColumn("own", F.lit(True))
    if ends:
        # a range is headed by the last row of the one before it, the first by the very last row
        kind = docs.schema["doc_id"].dataType.simpleString()
        heads = docs.sparkSession.createDataFrame([(last, (i + 1) % len(ends)) for i, last in enumerate(ends)], f"last {kind}, bucket int")
        before = keyed.join(F.broadcast(heads), F.col("doc_id") == F.col("last"))
        placed = placed.unionByName(before.select("doc_id", "text", "bucket", F.lit(False).alias("own")))
    return placed.repartitionById(max(1, len(ends)), F.greatest("bucket", F.lit(0)))


def fingerprints(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprint every document (columns ``doc_id``, ``text``) and its edited text.

    The edited text takes its last third from the next document in descending ``doc_id``; after the last comes
    the first. Returns ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited`` and ``near_next`` (containment of the edited text's and of the next
    document's fingerprint).
    ``doc_id`` may be of any type with an order. A task holds two texts with their fingerprints, however long they are.
    Null texts are empty; rows of one ``doc_id`` follow each other in the order of their texts; a single document
    follows itself. Rows with a null ``doc_id`` form an order of their own. Further columns are ignored.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    parts = parts or max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    chosen = with_predecessors(docs, parts).sortWithinPartitions("bucket", "own", "doc_id", "text")
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_bucket, previous, previous_print, waiting = None, "", {}, None
        for batch in batches:
            rows, ids = [], []
            for doc_id, text, bucket, own in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "bucket", "own"))):
                own_print = fingerprint(text)
                if bucket != held_bucket and own:  # only a null id has no row before it
                    previous, previous_print = text, own_print
                if own:
                    edited = edit(text, previous)
                    edited_print = fingerprint(edited)
                    ids.append(doc_id)
                    rows.append((
                        len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), as_text(own_print),
                        as_text(edited_print), containment(own_print, edited_print), containment(own_print, previous_print),
                    ))
                held_bucket, previous, previous_print = bucket, text, own_print
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            columns = [pa.array(column, kind) for column, kind in zip(zip(*rows) if rows else [()] * 6, kinds)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.column("doc_id").type), *columns], names)

    schema = f"doc_id {id_type}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return chosen.select("doc_id", "text", "bucket", "own").mapInArrow(describe, schema)
