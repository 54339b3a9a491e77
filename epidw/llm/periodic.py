"""Maximal periodic runs of words, by union-find over suffixes in descending order of their common prefixes.

A run is a stretch of words with smallest period q and at least two periods long, that neither neighbour extends.

1. Words become numbers. Texts in which no six successive words occur twice hold no run of ``LEAST`` words and are left
   alone. The suffixes of the others are sorted by prefix doubling: a round orders those that are still tied by the rank
   of what follows. The ranks of all rounds give the common prefix (LCP) of any two suffixes.
2. *Kruskal.* The LCPs of neighbours in suffix order are edges. By decreasing LCP each unites the classes of its two
   suffixes; a class keeps its positions in order, and the smaller class is put into the larger one.
3. Two positions that become neighbours within a class, at a distance of no more than the LCP, seed a run: the distance
   is its period, and it ends where the common prefix of the later position does. The first two positions of a run are
   neighbours when their classes meet, for one between them would give a shorter period; so the smallest position
   seeded for an end and a period is the start of the run. Of runs that a shorter period covers nothing is kept.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from epidw.llm.bytehash import RADIX, SPACE, mix, run_bounds, shingle_hashes, span_hashes
from epidw.llm.common import slices, utf8

#: shortest run
LEAST = 12


def sorted_suffixes(numbers: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes in order, and the rank of each by its first 1, 2, 4, .. words.

    ``ends`` is the end of each position's text; a suffix goes no further. Numbers of different texts must differ, or
    the texts' suffixes share classes.
    """
    count = len(numbers)
    rank = np.unique(numbers, return_inverse=True)[1].astype(np.int32)
    order = np.argsort(rank, kind="stable").astype(np.int64)
    levels, width, places = [rank], 1, np.arange(count)
    while True:
        by = rank[order]
        starts = np.flatnonzero(np.concatenate([[True], by[1:] != by[:-1]])) if count else np.zeros(0, np.int64)
        sizes = np.diff(np.append(starts, count))
        tied = np.repeat(sizes > 1, sizes)
        if not tied.any():
            return order, levels
        at = np.flatnonzero(tied)
        who = order[at]
        behind = who + width
        inside = behind < ends[who]
        following = np.where(inside, rank[np.minimum(behind, count - 1)].astype(np.int64) + 1, 0)
        first = np.repeat(starts, sizes)[at]
        key = first * (count + 1) + following
        chosen = np.argsort(key, kind="stable")
        order[at] = who[chosen]
        # a rank is the place of the first of its class, so untied suffixes keep theirs
        key = key[chosen]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        fresh = np.empty(count, np.int32)
        fresh[order] = np.repeat(starts, sizes)
        fresh[order[at]] = at[np.maximum.accumulate(np.where(new, places[: len(at)], 0))]
        rank, width = fresh, width * 2
        levels.append(rank)


def common_prefixes(one: np.ndarray, other: np.ndarray, ends: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Words that the suffixes at ``one`` and ``other`` share, pair by pair."""
    shared = np.zeros(len(one), np.int64)
    last = len(ends) - 1
    for level in range(len(levels) - 1, -1, -1):
        width, rank = 1 << level, levels[level]
        a, b = one + shared, other + shared
        # equal ranks of two suffixes, one of which is shorter than the width, would make them one suffix
        fits = np.maximum(a, b) + width <= np.where(a > b, ends[one], ends[other])
        fits &= np.minimum(a, b) + width <= np.where(a > b, ends[other], ends[one])
        same = fits & (rank[np.minimum(a, last)] == rank[np.minimum(b, last)])
        shared += np.where(same, width, 0)
    return shared


def seeds(one: list[int], other: list[int], shared: list[int]) -> dict[tuple[int, int], int]:
    """(end, period) -> smallest position seeded, from edges by decreasing number of ``shared`` words."""
    found: dict[tuple[int, int], int] = {}
    classes: dict[int, list[int]] = {}  # position -> its class, the list of its positions in order

    def met(left: int, right: int, lcp: int) -> None:
        period = right - left
        if period <= lcp:
            key = (right + lcp, period)
            if left < found.get(key, right):
                found[key] = left

    for a, b, lcp in zip(one, other, shared):
        small, large = classes.setdefault(a, [a]), classes.setdefault(b, [b])
        if len(small) > len(large):
            small, large = large, small
        if small[0] > large[-1]:
            met(large[-1], small[0], lcp)
            large.extend(small)
        elif len(small) > 1 and small[-1] < large[0]:
            met(small[-1], large[0], lcp)
            large[:0] = small
        else:
            gaps = [bisect_left(large, position) for position in small]
            for i, (position, gap) in enumerate(zip(small, gaps)):  # only neighbours of both classes are new ones
                if gap and (not i or gaps[i - 1] < gap):
                    met(large[gap - 1], position, lcp)
                if gap < len(large) and (i + 1 == len(small) or gaps[i + 1] > gap):
                    met(position, large[gap], lcp)
            if len(small) > 4:
                large.extend(small)
                large.sort()  # two sorted stretches are merged
            else:
                for position, gap in zip(reversed(small), reversed(gaps)):
                    large.insert(gap, position)
        for position in small:
            classes[position] = large
    return found


def maximal(found: dict[tuple[int, int], int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs, by start, then period."""
    runs, end_before, first = [], None, 0
    for (end, period), start in sorted(found.items()):
        if end != end_before:
            end_before, first = end, None
        # a stretch within one of the same end and a shorter period has that period itself
        if first is None or start < first:
            first = start
            if end - start >= max(least, 2 * period):
                runs.append((start, end - start, period))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def word_runs(numbers: np.ndarray, bounds: np.ndarray, least: int = LEAST) -> dict[int, list[tuple[int, int, int]]]:
    """Runs of each sequence of word numbers that has some; sequence i is ``numbers[bounds[i]:bounds[i + 1]]``."""
    window = -(-least // 2)  # a run's first two positions share at least half of its length
    sizes = np.diff(bounds)
    text = np.repeat(np.arange(len(sizes)), sizes)
    ends = bounds[1:][text]
    apart = mix(numbers + text.astype(np.uint64) * np.uint64(RADIX))
    whole = np.flatnonzero(np.arange(len(numbers)) + window <= ends)
    if not len(whole):
        return {}
    hashes = shingle_hashes(apart, window)[whole]
    order = np.argsort(hashes, kind="stable")
    equal = hashes[order][1:] == hashes[order][:-1]
    again = np.unique(text[whole[order[1:][equal]]])
    if not len(again):
        return {}
    keep = np.isin(text, again)
    text, numbers = text[keep], apart[keep]
    ends = np.searchsorted(text, text, side="right")
    first = np.searchsorted(text, np.arange(len(sizes)))
    order, levels = sorted_suffixes(numbers, ends)
    one, other = order[:-1], order[1:]
    near = levels[min(len(levels), window.bit_length()) - 1]  # neighbours that do not share the first words are no edge
    likely = near[one] == near[other]
    one, other = one[likely], other[likely]
    shared = common_prefixes(one, other, ends, levels)
    kept = np.flatnonzero(shared >= window)
    kept = kept[np.argsort(-shared[kept], kind="stable")]
    grouped: dict[int, dict[tuple[int, int], int]] = {}
    for (end, period), start in seeds(one[kept].tolist(), other[kept].tolist(), shared[kept].tolist()).items():
        of = int(text[start])
        grouped.setdefault(of, {})[(end - int(first[of]), period)] = start - int(first[of])
    runs = {of: maximal(found, least) for of, found in grouped.items()}
    return {of: r for of, r in runs.items() if r}


def repeated_words(count: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``count`` words some run contains behind its first period."""
    change = np.zeros(count + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) > 0


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run repeats."""
    dropped = repeated_words(len(words), runs)
    return [w for w, d in zip(words, dropped.tolist()) if not d] if runs else words


Reorder = Callable[[object, int], np.ndarray | None]


def find_runs(docs: DataFrame, reorder: Reorder | None = None, least: int = LEAST) -> DataFrame:
    """The runs of every text (columns ``doc_id``, ``text``) in its words ``[^\\x20\\x09-\\x0D]+``, numbered from 0.

    One row per row of ``docs``: ``doc_id``, ``n_words``, ``runs`` (array of ``start``, ``length``, ``period`` by start, then
    period) and ``collapsed``, the words joined by one blank without those that lie in some run behind its first period.
    ``reorder(doc_id, n_words)`` may give the numbers of the words to be read in place of the text's own, or None.

    A null text, or one without words, has no runs and collapses to an empty text. Repeated rows are read each; null ids
    stay null and further columns are ignored. A text is held by one task, with about 150 bytes for each word of those texts that
    repeat some words. Words are told apart by 64-bit hashes: two of n different words share one with a probability of n * n / 2**65.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    run_type = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            data, starts = utf8(batch.column("text"))
            for a, b in slices(starts):
                part, cuts = data[starts[a] : starts[b]], starts[a : b + 1] - starts[a]
                begin, stop = run_bounds(~SPACE[part], cuts[1:])
                numbers, bounds = span_hashes(part, begin, stop), np.searchsorted(begin, cuts)
                names = ids.slice(a, b - a)
                orders: dict[int, np.ndarray] = {}
                for i, name in enumerate(names.to_pylist() if reorder else ()):
                    order = reorder(name, int(bounds[i + 1] - bounds[i]))
                    if order is not None:
                        orders[i] = order
                if orders:
                    pieces = [numbers[x:y] for x, y in zip(bounds, bounds[1:])]
                    pieces = [p[orders[i]] if i in orders else p for i, p in enumerate(pieces)]
                    numbers, bounds = np.concatenate(pieces), np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
                runs, texts = word_runs(numbers, bounds, least), []
                raw = part.tobytes()
                for i, (x, y) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())):
                    words = raw[x:y].split()
                    if i in orders:
                        words = [words[j] for j in orders[i].tolist()]
                    texts.append(b" ".join(collapsed(words, runs.get(i, []))))
                listed = [[dict(zip(("start", "length", "period"), r)) for r in runs.get(i, ())] for i in range(b - a)]
                yield pa.RecordBatch.from_arrays(
                    [names, pa.array(np.diff(bounds)), pa.array(listed, pa.list_(run_type)), pa.array(texts, pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"])

    runs = "array<struct<start: bigint, length: bigint, period: bigint>>"
    return docs.select("doc_id", "text").mapInArrow(read, f"doc_id {id_type}, n_words long, runs {runs}, collapsed string")
