"""Supervised subword embeddings: a document is the mean of learned vectors of its hashed words and their character n-grams.

A softmax over a linear map of that mean gives class probabilities. Vectors and map are trained together by
stochastic gradient descent on a bounded sample. As the mean is linear, a trained model keeps one logit per bucket
and class; a text is then scored by sums over its features, for a whole slice of texts at once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

from epidw.llm.bytehash import LOWER, SPACE, run_bounds, span_hashes
from epidw.llm.common import row_sums

BUCKET_BITS = 17
DIMENSIONS = 8
EPOCHS = 12
RATE = 0.6
#: most labelled documents that a model is fitted on
SAMPLE = 6000
GRAMS = (3, 4)
MARK = 0x20
#: logits are summed as whole numbers of this size, so that sums do not depend on their order
UNIT = 1 << 16


def spread(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words with A-Z lowered, one mark before, between and behind them; start and end of each word in ``data``.

    ``bounds`` are places where a text ends, and a word with it.
    """
    starts, ends = run_bounds(~SPACE[data], bounds)
    lengths = ends - starts
    inside = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    marked = np.full(len(inside) + len(starts) + 1, MARK, np.uint8)
    marked[np.arange(len(inside)) + np.repeat(np.arange(len(starts)), lengths) + 1] = LOWER[data[inside]]
    return marked, starts, ends


def feature_buckets(data: np.ndarray, bounds: np.ndarray = np.zeros(0, np.int64)) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Start of each word in ``data``, all buckets, and for each kind of feature the number of the word of each.

    Kinds are the word and its n-grams of 3 and 4 characters, not bytes, where a mark at either end counts as a character
    and no n-gram goes beyond it.
    """
    marked, starts, ends = spread(data, bounds)
    lead = np.flatnonzero((marked & 0xC0) != 0x80)
    edge = marked[lead] == MARK
    word = np.cumsum(edge) - 1  # of a character: the number of marks before it
    stops = np.append(lead[1:], len(marked))
    marks = lead[edge]
    begins, finishes, owners = [marks[:-1] + 1], [marks[1:]], [np.arange(len(starts))]
    for size in GRAMS:
        first = np.arange(max(0, len(lead) - size + 1))
        whole = np.logical_and.reduce([~edge[first + i] for i in range(1, size - 1)]) if len(first) else np.zeros(0, bool)
        first = first[whole]
        begins.append(lead[first])
        finishes.append(stops[first + size - 1])
        owners.append(word[first + 1])
    hashed = span_hashes(marked, np.concatenate(begins), np.concatenate(finishes))
    return starts, (hashed >> np.uint64(64 - BUCKET_BITS)).astype(np.int32), owners


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and the share of its features that each one has."""
    found = feature_buckets(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8))[1]
    buckets, counts = np.unique(found, return_counts=True)
    return buckets, (counts / max(1, len(found))).astype(np.float32)


@dataclass
class SubwordModel:
    """Logits per bucket and class, and the bias of each class."""

    classes: list
    logits: np.ndarray
    bias: np.ndarray
    _units: np.ndarray | None = field(default=None, repr=False)

    @staticmethod
    def fit(rows: list[tuple[str, object]], seed: int = 7) -> SubwordModel:
        """Train on (text, class) rows; without rows there is one class, None."""
        classes = sorted({c for _, c in rows}) or [None]
        place = {c: i for i, c in enumerate(classes)}
        random = np.random.default_rng(seed)
        vectors = random.uniform(-1, 1, (1 << BUCKET_BITS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
        output, bias = np.zeros((DIMENSIONS, len(classes)), np.float32), np.zeros(len(classes), np.float32)
        known = [(*features(text), place[c]) for text, c in rows]
        step, steps = 0, max(1, EPOCHS * len(known))
        for _ in range(EPOCHS):
            for i in random.permutation(len(known)):
                buckets, shares, truth = known[i]
                rate, step = RATE * (1 - step / steps), step + 1
                chosen = vectors[buckets]
                mean = shares @ chosen
                error = softmax(mean @ output + bias)
                error[truth] -= 1
                # features share the document's step as they share its mean, scaled up so that rare ones learn too
                vectors[buckets] = chosen - rate * 50 * shares[:, None] * (output @ error)
                output -= rate * np.outer(mean, error)
                bias -= rate * 0.1 * error
        return SubwordModel(classes, vectors @ output, bias)

    def _measure(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Sums of the logits and number of the features of each text."""
        width = len(self.classes)
        out = np.zeros((len(starts), width + 1), np.int64)
        words, buckets, owners = feature_buckets(data, bounds)
        low, high = np.searchsorted(words, starts), np.searchsorted(words, ends)
        table, at = self._table(), 0
        for owner in owners:
            first, last = np.searchsorted(owner, low) + at, np.searchsorted(owner, high) + at
            held = np.flatnonzero(last > first)
            if len(held):
                # texts follow each other, so each sum ends where the next begins; one gather serves all classes
                rows = table[buckets[first[held[0]] : last[held[-1]]]]
                out[held, :width] += np.add.reduceat(rows, first[held] - first[held[0]], axis=0, dtype=np.int64)
            out[:, width] += last - first
            at += len(owner)
        return out

    def _table(self) -> np.ndarray:
        if self._units is None:
            self._units = np.rint(np.clip(self.logits * UNIT, -(1 << 30), 1 << 30)).astype(np.int32)
        return self._units

    def probabilities(self, texts: pa.Array) -> np.ndarray:
        """Class probabilities of each text; a null or empty text gets those of no features at all."""
        sums = row_sums(texts, self._measure, len(self.classes) + 1)
        return softmax(sums[:, :-1] / UNIT / np.maximum(sums[:, -1:], 1) + self.bias)


def softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return raised / raised.sum(axis=-1, keepdims=True)
