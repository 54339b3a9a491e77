"""Ranked lexical search: an inverted index in segments, and a hybrid of term-at-a-time and document-at-a-time.

*Index.* Each task turns its documents into segments: for every term the documents that hold it, in order, with the
number of its occurrences. A segment is one row of the written index, so no posting is ever shuffled.

*Hybrid.* For an item and a segment, the shortest lists are added up term by term into an accumulator per document, as
long as their postings together stay below a share of the segment. The accumulators then act as one iterator, whose
bound is the largest of them. Together with the long lists it is traversed in document order: iterators whose bounds
together cannot reach the k-th best score so far are not walked, only looked up for documents that the others name, and
only while what is still missing could lift the document over that score. Documents are taken in blocks, which changes
the steps and not the result. The k-th best score is carried from segment to segment of a task.

Scores are integers; the weight of a term comes from statistics over all documents of the index.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from epidw.llm.bytehash import LOWER, run_bounds, span_hashes
from epidw.llm.common import slices, utf8, written

#: bytes of text from which on a segment is closed
SEGMENT_BYTES = 1 << 24
#: postings of the short lists together, as a share of the segment's documents
SHORT_SHARE = 0.25
#: documents taken at once
BLOCK = 1024
#: terms of the items that are searched for together; what is sent to every task grows with it
CHUNK_TERMS = 200_000

#: fixed values of the score: tf * SCALE div (tf * 1000 + 12 * (75 + 25 * length / mean length))
SCALE, TF, K, FLAT, SLOPE = 1_000_000_000, 1000, 12, 75, 25

TERM = np.zeros(256, bool)
TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms_of(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Range of rows, hashes of their terms in order, and the number of terms up to each row, slice by slice.

    Terms are the longest stretches of ASCII letters, digits and characters beyond ASCII, with A-Z lowered.
    """
    data, starts = utf8(column)
    for a, b in slices(starts):
        part, cuts = data[starts[a] : starts[b]], starts[a : b + 1] - starts[a]
        begin, stop = run_bounds(TERM[part], cuts[1:])
        yield a, b, span_hashes(LOWER[part], begin, stop), np.searchsorted(begin, cuts)


def build_index(docs: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """The inverted index of ``docs`` (columns ``doc_id``, ``text``), written to the shared folder, one row per segment.

    A null text, or one without terms, is held with length 0 and found by nothing. Repeated rows are documents of their
    own; null ids stay null. Further columns are ignored. One text lies in one segment, so a very long one makes a large segment.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["documents", "words", "doc_ids", "lengths", "terms", "starts", "slots", "counts"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lengths, hashes, size = [], [], [], 0

        def segment() -> pa.RecordBatch:
            words = np.concatenate(lengths)
            terms = np.concatenate(hashes)
            slots = np.repeat(np.arange(len(words), dtype=np.uint32), words)
            order = np.argsort(terms, kind="stable")
            terms, slots = terms[order], slots[order]
            new = np.flatnonzero(np.concatenate([[True], (terms[1:] != terms[:-1]) | (slots[1:] != slots[:-1])])) if len(terms) else np.zeros(0, np.int64)
            counts = np.diff(np.append(new, len(terms))).astype(np.uint32)
            terms, slots = terms[new], slots[new]
            first = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]])) if len(terms) else np.zeros(0, np.int64)
            starts = np.append(first, len(terms)).astype(np.uint32)
            named = pa.concat_arrays(ids)
            return pa.RecordBatch.from_arrays(
                [pa.array([int((words > 0).sum())]), pa.array([int(words.sum())]), pa.ListArray.from_arrays(pa.array([0, len(named)], pa.int32()), named),
                 *(pa.array([x.tobytes()], pa.binary()) for x in (words.astype(np.uint32), terms[first], starts, slots, counts))], names)

        for batch in batches:
            for a, b, found, upto in terms_of(batch.column("text")):
                ids.append(batch.column("doc_id").slice(a, b - a))
                lengths.append(np.diff(upto))
                hashes.append(found)
                size += 16 * len(found) + (b - a)
                if size >= segment_bytes:
                    yield segment()
                    ids, lengths, hashes, size = [], [], [], 0
        if ids:
            yield segment()

    schema = f"documents long, words long, doc_ids array<{kind}>, " + ", ".join(f"{n} binary" for n in names[3:])
    return written(docs.select("doc_id", "text").mapInArrow(build, schema), "segments")


@dataclass
class Item:
    """Places of an item's terms among the chunk's terms, and how often it holds each; its best documents so far."""

    key: int
    terms: np.ndarray
    repeats: np.ndarray
    best: list[tuple[int, object]] = field(default_factory=list)


class Segment:
    """One segment, with the contribution of each posting of the terms that a chunk of items asks for."""

    def __init__(self, row: dict, terms: np.ndarray, weights: np.ndarray, documents: int, words: int) -> None:
        self.doc_ids = row["doc_ids"]
        length = np.frombuffer(row["lengths"], np.uint32).astype(np.int64)
        self.size = len(length)
        stored = np.frombuffer(row["terms"], np.uint64)
        starts = np.frombuffer(row["starts"], np.uint32).astype(np.int64)
        at = np.searchsorted(stored, terms)
        there = (at < len(stored)) & (stored[np.minimum(at, len(stored) - 1)] == terms) if len(stored) else np.zeros(len(terms), bool)
        there &= weights > 0
        first = np.where(there, starts[np.where(there, at, 0)], 0)
        self.sizes = np.where(there, starts[np.where(there, at + 1, 0)] - first, 0)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        picked = np.repeat(first - self.starts[:-1], self.sizes) + np.arange(self.starts[-1])
        self.slots = np.frombuffer(row["slots"], np.uint32)[picked].astype(np.int64)
        tf = np.frombuffer(row["counts"], np.uint32)[picked].astype(np.int64)
        norm = FLAT + (SLOPE * length * documents) // max(1, words)
        self.parts = np.repeat(weights, self.sizes) * ((SCALE * tf) // (TF * tf + K * norm[self.slots]))
        held = np.flatnonzero(self.sizes)
        self.bounds = np.zeros(len(terms), np.int64)
        if len(held):
            self.bounds[held] = np.maximum.reduceat(self.parts, self.starts[held])

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.starts[term], self.starts[term + 1]
        return self.slots[a:b], self.parts[a:b]


def iterators(segment: Segment, item: Item) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(bound, documents, contributions) of the accumulators of the short lists and of each long list, by bound."""
    sizes = segment.sizes[item.terms]
    order = [i for i in np.argsort(sizes, kind="stable").tolist() if sizes[i]]
    short = int(np.searchsorted(np.cumsum(sizes[order]), SHORT_SHARE * segment.size, side="right"))
    found = []
    if short:
        sums = np.zeros(segment.size, np.int64)
        for i in order[:short]:
            slots, parts = segment.postings(int(item.terms[i]))
            sums[slots] += parts * item.repeats[i]
        at = np.flatnonzero(sums)
        if len(at):
            found.append((int(sums[at].max()), at, sums[at]))
    for i in order[short:]:
        slots, parts = segment.postings(int(item.terms[i]))
        found.append((int(segment.bounds[item.terms[i]] * item.repeats[i]), slots, parts * item.repeats[i]))
    return sorted(found, key=lambda x: x[0])


def rank_key(entry: tuple[int, object]) -> tuple:
    """Highest score first, then the smallest id, null last."""
    score, doc_id = entry
    return -score, doc_id is None, 0 if doc_id is None else doc_id


def search_segment(segment: Segment, item: Item, k: int) -> None:
    """Bring the documents of a segment into the item's ``k`` best."""
    lists = iterators(segment, item)
    sums = np.cumsum([bound for bound, _, _ in lists])
    document = 0
    while document < segment.size:
        least = max(1, item.best[-1][0]) if len(item.best) == k else 1
        spared = int(np.searchsorted(sums, least))  # these together stay below the least score that counts
        walked = lists[spared:]
        if not walked:
            return
        places = [int(np.searchsorted(slots, document)) for _, slots, _ in walked]
        end = segment.size
        for (_, slots, _), at in zip(walked, places):
            if at + BLOCK < len(slots):
                end = min(end, int(slots[at + BLOCK]))
        window = np.zeros(end - document, np.int64)
        for (_, slots, parts), at in zip(walked, places):
            to = int(np.searchsorted(slots, end))
            window[slots[at:to] - document] += parts[at:to]
        found = np.flatnonzero(window)
        scores = window[found]
        found += document
        for i in range(spared - 1, -1, -1):
            able = scores + sums[i] >= least
            found, scores = found[able], scores[able]
            if not len(found):
                break
            _, slots, parts = lists[i]
            at = np.minimum(np.searchsorted(slots, found), len(slots) - 1)
            scores = scores + np.where(slots[at] == found, parts[at], 0)
        able = scores >= least
        found, scores = found[able], scores[able]
        if len(found) > k:
            kth = np.partition(scores, len(scores) - k)[len(scores) - k]
            found, scores = found[scores >= kth], scores[scores >= kth]
        if len(found):
            named = segment.doc_ids.take(pa.array(found)).to_pylist()
            item.best = sorted([*item.best, *zip(scores.tolist(), named)], key=rank_key)[:k]
        document = end


def item_terms(items: DataFrame) -> DataFrame:
    """``item`` (hash of id and text), ``term`` and ``repeats`` of every distinct (``item_id``, ``text``)."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, hashes, upto in terms_of(batch.column("text")):
                owner = np.repeat(batch.column("item").slice(a, b - a).to_numpy(), np.diff(upto))
                yield pa.RecordBatch.from_arrays([pa.array(owner), pa.array(hashes.view(np.int64))], ["item", "term"])

    asked = items.select(F.xxhash64("item_id", "text").alias("item"), "text").distinct()
    return asked.mapInArrow(split, "item long, term long").groupBy("item", "term").agg(F.count("*").alias("repeats"))


def search(index: DataFrame, items: DataFrame, k: int, chunk_terms: int = CHUNK_TERMS) -> DataFrame:
    """The ``k`` highest-scoring documents for each item (``item_id``, ``text``): ``item_id``, ``rank``, ``doc_id``, ``score``.

    Only scores above 0 count; equal scores go to the smaller ``doc_id``, null last. Items are searched for in chunks of
    about ``chunk_terms`` terms, each a pass over the index. An item without terms or text finds nothing; fully repeated
    items are asked once, and two texts under one id are ranked apart. Empty tables give no rows.
    """
    spark = index.sparkSession
    kind = index.schema["doc_ids"].dataType.elementType.simpleString()
    asked = written(item_terms(items), "terms")
    documents, words, entries = (x or 0 for x in (*index.agg(F.sum("documents"), F.sum("words")).first(), asked.count()))
    chunks = -(-entries // chunk_terms)
    found = spark.createDataFrame([], f"item long, doc_id {kind}, score long")
    for chunk in range(chunks):
        rows = asked.filter(F.pmod(F.xxhash64("item"), F.lit(chunks)) == chunk).toArrow()
        found = found.unionByName(_search_chunk(index, rows, documents, words, k, kind))
    named = items.select("item_id", F.xxhash64("item_id", "text").alias("item")).distinct()
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.join(named, "item").select("item_id", "rank", "doc_id", "score")


def _search_chunk(index: DataFrame, rows: pa.Table, documents: int, words: int, k: int, kind: str) -> DataFrame:
    terms, place = np.unique(rows.column("term").to_numpy().view(np.uint64), return_inverse=True)
    item, repeats = rows.column("item").to_numpy(), rows.column("repeats").to_numpy()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(terms), np.int64)
        for batch in batches:
            for stored, starts in zip(batch.column("terms"), batch.column("starts")):
                stored, starts = np.frombuffer(stored.as_py(), np.uint64), np.frombuffer(starts.as_py(), np.uint32)
                shared, mine, theirs = np.intersect1d(terms, stored, assume_unique=True, return_indices=True)
                sums[mine] += np.diff(starts.astype(np.int64))[theirs]
        held = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(sums[held])], ["place", "df"])

    frequency = np.zeros(len(terms), np.int64)
    counted = index.select("terms", "starts").mapInArrow(count, "place long, df long").groupBy("place").agg(F.sum("df").alias("df")).toArrow()
    frequency[counted.column("place").to_numpy()] = counted.column("df").to_numpy()
    weights = np.floor(1000 * np.log((2 * documents + 2) / (2 * frequency + 1))).astype(np.int64)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.argsort(item, kind="stable")
        groups = np.split(order, np.flatnonzero(np.diff(item[order])) + 1)
        items = [Item(int(item[g[0]]), place[g], repeats[g]) for g in groups if len(g)]
        named = None
        for batch in batches:
            named = batch.column("doc_ids").type.value_type
            for at in range(batch.num_rows):
                row = {n: batch.column(n)[at].as_py() for n in ("lengths", "terms", "starts", "slots", "counts")}
                segment = Segment(row | {"doc_ids": batch.column("doc_ids")[at].values}, terms, weights, documents, words)
                for one in items:
                    search_segment(segment, one, k)
        best = [(one.key, score, doc_id) for one in items for score, doc_id in one.best]
        if best:
            keys, scores, ids = zip(*best)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(ids, named), pa.array(scores, pa.int64())], ["item", "doc_id", "score"])

    return index.mapInArrow(find, f"item long, doc_id {kind}, score long")
