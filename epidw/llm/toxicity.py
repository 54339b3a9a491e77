"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: densities of learned lexicons (whole words, and word stems of several lengths), their nearness to
a second-person pronoun, capitals, punctuation and obfuscated spellings. All are sums over the text divided by its
words or letters, so a text of any length is read in slices. Lexicons, trees and calibration are learned from a bounded
sample of labelled documents.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from epidw.llm.bytehash import LOWER, SPACE, run_bounds, span_hashes
from epidw.llm.common import fold, labelled_texts, row_sums

THRESHOLD = 0.7
FOLDS, HELD_OUT = 3, 1
SAMPLE = 6000  # most labelled documents that a model is fitted on
STEMS = (4, 5, 6)  # bytes
SUPPORT, ODDS = 6, 12.0  # documents with the word, and how much likelier toxic documents have it
NEAR = 4  # words between a pronoun and a lexicon word
TREES, DEPTH, BINS, RATE, LEAF = 80, 3, 32, 0.15, 15
# fixed values: second-person words of the four languages
SECOND_PERSON = ("you", "your", "yours", "yourself", "u", "ur", "tu", "toi", "vous", "ton", "votre", "du", "dich", "dir", "dein",
                 "ihr", "euch", "te", "ti", "usted", "ustedes", "vosotros")

WORD = np.zeros(256, bool)
WORD[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("0"), ord("9") + 1), *range(0x80, 0x100)]] = True
UPPER = np.zeros(256, bool)
UPPER[ord("A") : ord("Z") + 1] = True
LETTER = np.zeros(256, bool)
LETTER[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(0x80, 0x100)]] = True
DIGIT = np.zeros(256, bool)
DIGIT[ord("0") : ord("9") + 1] = True
SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "*@$#%&"]] = True
LOUD = np.zeros(256, bool)
LOUD[[ord(c) for c in "!?"]] = True


def hash_set(hashes) -> tuple[np.ndarray, np.ndarray]:
    """Sorted members, and which leading 16 bits occur among them."""
    members = np.unique(np.array(list(hashes), np.uint64))
    leading = np.zeros(1 << 16, bool)
    leading[(members >> np.uint64(48)).astype(np.int64)] = True
    return members, leading


def contained(hashes: np.ndarray, lookup: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    members, leading = lookup
    hit = leading[(hashes >> np.uint64(48)).astype(np.int64)]
    maybe = np.flatnonzero(hit)
    if len(maybe):
        place = np.minimum(np.searchsorted(members, hashes[maybe]), len(members) - 1)
        hit[maybe] = members[place] == hashes[maybe]
    return hit


def word_forms(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Start and end of each word, and the hashes of its whole form and of its stems (0 if it is shorter)."""
    starts, ends = run_bounds(WORD[data], bounds)
    lowered = LOWER[data]
    forms = [span_hashes(lowered, starts, ends)]
    for size in STEMS:
        stems = span_hashes(lowered, starts, np.minimum(ends, starts + size))
        forms.append(np.where(ends - starts >= size, stems, np.uint64(0)))
    return starts, ends, forms


@dataclass
class ToxicityModel:
    lexicons: list[tuple[np.ndarray, np.ndarray]]
    edges: np.ndarray
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    base: float
    steps: tuple[np.ndarray, np.ndarray]

    @staticmethod
    def fit(rows: list[tuple[str, int]]) -> ToxicityModel:
        """Learn from (text, label); three of four rows grow the trees, the others calibrate. Without rows scores are 0."""
        texts = pa.array([t for t, _ in rows], pa.string())
        labels = np.array([y for _, y in rows], float)
        held = np.array([zlib.crc32(t.encode("utf-8", "surrogatepass")) % 4 == 0 for t, _ in rows], bool)
        # the calibrating rows choose no words, or their own labels would be in the features that calibrate
        growing = [row for row, h in zip(rows, held) if not h]
        model = ToxicityModel(_lexicons(growing), np.zeros((0, 0)), [], -20.0, (np.zeros(1), np.zeros(1)))
        if len(rows) < 8 or not growing:
            return model
        known = model.features(texts)
        model._grow(known[~held], labels[~held])
        raw = model._raw(known)
        chosen = held if held.sum() >= 200 else np.ones(len(rows), bool)
        model.steps = isotonic(raw[chosen], labels[chosen])
        return model

    def features(self, texts: pa.Array) -> np.ndarray:
        """Dense features, a row for each text."""
        s = row_sums(texts, self._measure, 9 + len(self.lexicons), enough=lambda part: len(run_bounds(WORD[part])[0]) > NEAR)
        words, letters = np.maximum(s[:, 0], 1), np.maximum(s[:, 1], 1)
        lexical = s[:, 9:]
        return np.column_stack([
            lexical / words[:, None], np.minimum(lexical, 5), s[:, 2] / words, s[:, 3] / letters, s[:, 4] / words,
            s[:, 5] / words, s[:, 6] / words, s[:, 7] / words, s[:, 8] / words, np.log1p(s[:, 0])])

    def _measure(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        out = np.zeros((len(starts), 9 + len(self.lexicons)), np.int64)
        begin, stop, forms = word_forms(data, bounds)
        low, high = np.searchsorted(begin, starts), np.searchsorted(begin, ends)

        def by_text(values: np.ndarray, first: np.ndarray = low, last: np.ndarray = high) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
            return sums[last] - sums[first]

        hits = [contained(f, lexicon) for f, lexicon in zip(forms, self.lexicons)]
        pronoun = contained(forms[0], PRONOUNS)
        any_hit = np.logical_or.reduce(hits) if hits else np.zeros(len(begin), bool)
        near, owner = np.zeros(len(begin), bool), np.searchsorted(bounds, begin, side="right")
        for gap in range(1, NEAR + 1):
            same = owner[gap:] == owner[:-gap]
            near[gap:] |= any_hit[gap:] & pronoun[:-gap] & same
            near[:-gap] |= any_hit[:-gap] & pronoun[gap:] & same
        upper = np.concatenate([[0], np.cumsum(UPPER[data], dtype=np.int64)])
        digits = np.concatenate([[0], np.cumsum(DIGIT[data], dtype=np.int64)])
        capitals, numbers = upper[stop] - upper[begin], digits[stop] - digits[begin]
        length = stop - begin
        out[:, 0] = high - low
        out[:, 1] = by_text(LETTER[data], starts, ends)
        out[:, 2] = by_text(near)
        out[:, 3] = by_text(UPPER[data], starts, ends)
        out[:, 4] = by_text((capitals == length) & (length > 2))
        out[:, 5] = by_text(LOUD[data], starts, ends)
        out[:, 6] = by_text(SYMBOL[data], starts, ends)
        out[:, 7] = by_text((numbers > 0) & (numbers < length))
        out[:, 8] = by_text(pronoun)
        for at, hit in enumerate(hits):
            out[:, 9 + at] = by_text(hit)
        return out

    def _grow(self, known: np.ndarray, labels: np.ndarray) -> None:
        """Trees of fixed depth on binned features, each fitted to the gradient of the logistic loss."""
        cuts = np.quantile(known, np.linspace(0, 1, BINS + 1)[1:-1], axis=0)
        top = known.max(axis=0)
        self.edges = np.vstack([np.zeros(known.shape[1]), cuts, top * 0.999])  # "more than none" is always a choice
        self.edges.sort(axis=0)
        binned = np.stack([np.searchsorted(self.edges[:, f], known[:, f]) for f in range(known.shape[1])], axis=1)
        rate = np.clip(labels.mean(), 0.01, 0.99)
        self.base, score = float(np.log(rate / (1 - rate))), np.full(len(labels), np.log(rate / (1 - rate)))
        for _ in range(TREES):
            chance = 1 / (1 + np.exp(-score))
            tree, node = _tree(binned, labels - chance, chance * (1 - chance), len(self.edges) + 1)
            self.trees.append(tree)
            score += tree[2][node]

    def _raw(self, known: np.ndarray) -> np.ndarray:
        score = np.full(len(known), self.base)
        if not self.trees:
            return score
        binned = np.stack([np.searchsorted(self.edges[:, f], known[:, f]) for f in range(known.shape[1])], axis=1)
        rows = np.arange(len(known))
        for feature, cut, value in self.trees:
            node = np.zeros(len(known), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (binned[rows, feature[node]] > cut[node])
            score += value[node]
        return score

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Calibrated probabilities; a small part of the raw score keeps the order within a calibration step."""
        raw = self._raw(self.features(texts))
        if not self.trees:
            return np.zeros(len(raw))
        return 0.98 * np.interp(raw, *self.steps) + 0.02 / (1 + np.exp(-raw))


def _tree(binned: np.ndarray, gradient: np.ndarray, weight: np.ndarray, bins: int):
    """One tree in heap order: feature and cut of each node, value of each leaf; and the leaf of each row."""
    nodes = 2 ** (DEPTH + 1) - 1
    feature, cut, value = np.zeros(nodes, np.int64), np.full(nodes, bins, np.int64), np.zeros(nodes)
    node = np.zeros(len(binned), np.int64)
    for depth in range(DEPTH):
        first = 2**depth - 1
        best = np.full(2**depth, 1e-9)
        for f in range(binned.shape[1]):
            cell = (node - first) * bins + binned[:, f]
            g = np.bincount(cell, gradient, 2**depth * bins).reshape(-1, bins).cumsum(axis=1)
            h = np.bincount(cell, weight, 2**depth * bins).reshape(-1, bins).cumsum(axis=1)
            n = np.bincount(cell, minlength=2**depth * bins).reshape(-1, bins).cumsum(axis=1)
            gain = g**2 / (h + 1) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + 1) - g[:, -1:] ** 2 / (h[:, -1:] + 1)
            gain[(n < LEAF) | (n[:, -1:] - n < LEAF)] = 0
            at = gain.argmax(axis=1)
            better = gain[np.arange(len(at)), at] > best
            best[better] = gain[np.arange(len(at)), at][better]
            feature[first : first + len(at)][better] = f
            cut[first : first + len(at)][better] = at[better]
        node = 2 * node + 1 + (binned[np.arange(len(binned)), feature[node]] > cut[node])
    leaves = np.bincount(node, gradient, nodes) / (np.bincount(node, weight, nodes) + 1)
    value[:] = RATE * np.clip(leaves, -4, 4)
    return (feature, cut, value), node


def isotonic(raw: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: raw scores and the non-decreasing share of label 1 at each."""
    points, place = np.unique(raw, return_inverse=True)
    weights = np.bincount(place).astype(float)
    means = np.bincount(place, labels) / weights
    blocks: list[list[float]] = []
    for point, mean, weight in zip(points, means, weights):
        blocks.append([mean, weight, point, point])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m, w, _, last = blocks.pop()
            b = blocks[-1]
            blocks[-1] = [(b[0] * b[1] + m * w) / (b[1] + w), b[1] + w, b[2], last]
    xs = [x for b in blocks for x in (b[2], b[3])]
    ys = [y for b in blocks for y in (b[0], b[0])]
    return np.array(xs), np.array(ys)


def _lexicons(rows: list[tuple[str, int]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For whole words and each stem length: the hashes that toxic documents have far more often."""
    counts = [[Counter(), Counter()] for _ in range(1 + len(STEMS))]
    documents = Counter(y for _, y in rows)
    for text, label in rows:
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        for counter, form in zip(counts, word_forms(data, np.zeros(0, np.int64))[2]):
            counter[label == 1].update(np.unique(form[form != 0]).tolist())
    positive, negative = max(1, documents[1]), max(1, len(rows) - documents[1])
    return [hash_set(h for h, n in yes.items() if n >= SUPPORT and (n / positive) / ((no[h] + 0.5) / negative) >= ODDS)
            for no, yes in counts]


_words = [np.frombuffer(w.encode(), np.uint8) for w in SECOND_PERSON]
PRONOUNS = hash_set(span_hashes(w, np.zeros(1, np.int64), np.array([len(w)]))[0] for w in _words)


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> ToxicityModel:
    """Learn ``labels.toxic`` from at most ``rows`` labelled documents outside the held-out fold."""
    return ToxicityModel.fit(labelled_texts(docs, labels.filter(fold("doc_id", FOLDS) != HELD_OUT), "toxic", rows))


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``score`` and ``predicted`` (1 from ``threshold`` on) of every text (columns ``doc_id``, ``text``).

    Null and empty texts have no words and get the score of that; repeated rows are scored each; further columns are
    ignored. A model without enough labelled rows scores 0.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.clip(model.scores(batch.column("text")), 0, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {id_type}, score double, predicted int")


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document."""
    scored = score_toxicity(docs, fit_toxicity(docs, labels))
    return scored.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score", "predicted")
