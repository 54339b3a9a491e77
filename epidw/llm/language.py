"""Language of a text by a convolutional network over its bytes.

A text is read in windows of ``WINDOW`` bytes. Each byte has a learned vector; filters of several widths run over
them, the largest response of each filter in the window is kept, and a softmax over these gives the window's
language. A text's posterior is the mean over its windows, weighted by their bytes. Training is plain numpy with
analytic gradients, on a bounded sample of labelled texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from epidw.llm.common import bounded_sample, fold, utf8
from epidw.llm.subwords import softmax

WINDOW = 128
BATCH = 256  # windows that a task holds at once
WIDTHS = (2, 3, 4)
FILTERS = 16
VECTOR = 8
STEPS = 1500
TRAIN_BATCH = 64
SAMPLE = 3000  # most labelled documents that a model is fitted on
FOLDS, HELD_OUT = 5, 0
UNDETERMINED = "und"
LETTER = regex.compile(r"\p{L}")


@dataclass
class ByteNet:
    classes: list[str]
    weights: dict[str, np.ndarray]

    @staticmethod
    def fit(rows: list[tuple[str, str]], seed: int = 11) -> ByteNet:
        """Train on (text, language) rows, every language as often as the others."""
        classes = sorted({lang for _, lang in rows})
        random = np.random.default_rng(seed)
        weights = {"vectors": random.normal(0, 0.5, (256, VECTOR)), "bias": np.zeros(len(classes)),
                   "out": random.normal(0, 0.2, (len(WIDTHS) * FILTERS, len(classes)))}
        for width in WIDTHS:
            weights[f"filter{width}"] = random.normal(0, 1 / np.sqrt(width * VECTOR), (width * VECTOR, FILTERS))
            weights[f"shift{width}"] = np.zeros(FILTERS)
        net = ByteNet(classes, {k: v.astype(np.float32) for k, v in weights.items()})
        if not classes:
            return net
        by_class = [[w for text, lang in rows if lang == c for w in windows(text.encode("utf-8", "surrogatepass"))] for c in classes]
        by_class = [np.stack(w) if w else np.zeros((1, WINDOW), np.uint8) for w in by_class]
        moment = {k: np.zeros_like(v) for k, v in net.weights.items()}
        spread = {k: np.zeros_like(v) for k, v in net.weights.items()}
        for step in range(1, STEPS + 1):
            truth = random.integers(0, len(classes), TRAIN_BATCH)
            codes = np.stack([by_class[c][random.integers(0, len(by_class[c]))] for c in truth])
            for name, slope in net._slopes(codes, truth).items():  # Adam
                moment[name] += 0.1 * (slope - moment[name])
                spread[name] += 0.01 * (slope * slope - spread[name])
                scale = np.sqrt(spread[name] / (1 - 0.99**step)) + 1e-6
                net.weights[name] -= 0.01 * (1 - step / (STEPS + 1)) * moment[name] / (1 - 0.9**step) / scale
        return net

    def _responses(self, codes: np.ndarray):
        """For each width: the patches, the place of each filter's largest response and the responses there."""
        inputs = self.weights["vectors"][codes]
        for width in WIDTHS:
            count = codes.shape[1] - width + 1
            patches = np.concatenate([inputs[:, j : j + count] for j in range(width)], axis=2)
            found = patches.reshape(-1, width * VECTOR) @ self.weights[f"filter{width}"]
            found = found.reshape(len(codes), count, FILTERS)
            yield width, patches, found

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        """Class probabilities of windows of byte codes."""
        pooled = [np.maximum(f.max(axis=1) + self.weights[f"shift{w}"], 0) for w, _, f in self._responses(codes)]
        return softmax(np.concatenate(pooled, axis=1) @ self.weights["out"] + self.weights["bias"])

    def _slopes(self, codes: np.ndarray, truth: np.ndarray) -> dict[str, np.ndarray]:
        rows, kept, pooled = np.arange(len(codes))[:, None], [], []
        for width, patches, found in self._responses(codes):
            best = found.argmax(axis=1)
            value = found[rows, best, np.arange(FILTERS)] + self.weights[f"shift{width}"]
            kept.append((width, patches, best, value > 0))
            pooled.append(np.maximum(value, 0))
        hidden = np.concatenate(pooled, axis=1)
        error = softmax(hidden @ self.weights["out"] + self.weights["bias"])
        error[np.arange(len(codes)), truth] -= 1
        error /= len(codes)
        slopes = {"out": hidden.T @ error, "bias": error.sum(axis=0), "vectors": np.zeros_like(self.weights["vectors"])}
        back = error @ self.weights["out"].T
        for at, (width, patches, best, active) in enumerate(kept):
            part = back[:, at * FILTERS : (at + 1) * FILTERS] * active
            slopes[f"shift{width}"] = part.sum(axis=0)
            chosen = patches[rows, best]  # windows x filters x (width * vector)
            slopes[f"filter{width}"] = np.einsum("nf,nfk->kf", part, chosen)
            into = (part[:, :, None] * self.weights[f"filter{width}"].T[None]).reshape(*part.shape, width, VECTOR)
            for j in range(width):
                np.add.at(slopes["vectors"], codes[rows, best + j], into[:, :, j])
        return slopes


def windows(data: bytes | np.ndarray) -> np.ndarray:
    """The bytes as rows of ``WINDOW``, the last one filled up with zeros; none if there are no bytes."""
    codes = np.frombuffer(data, np.uint8) if isinstance(data, bytes) else data
    rows = -(-len(codes) // WINDOW)
    out = np.zeros(rows * WINDOW, np.uint8)
    out[: len(codes)] = codes
    return out.reshape(rows, WINDOW)


def fit_language(docs: DataFrame, rows: int = SAMPLE) -> ByteNet:
    """Learn from the text and non-null ``lang`` of at most ``rows`` documents outside the held-out fold."""
    known = docs.filter((fold("doc_id", FOLDS) != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    ids = bounded_sample(known.select("doc_id").distinct(), rows)
    found = known.select("doc_id", "lang", "text").join(F.broadcast(ids), "doc_id").orderBy("doc_id", "lang", "text").limit(rows)
    return ByteNet.fit([(r["text"], r["lang"]) for r in found.collect()])


def predict_language(docs: DataFrame, net: ByteNet) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (its posterior) of every text (columns ``doc_id``, ``text``).

    All windows of a text count, in batches of bounded size. A null text, or one without a letter, is ``und`` with
    score 0, and so is every text if no labelled text was there to learn from. Ties go to the first language in
    alphabetical order. Repeated rows are scored each; further columns are ignored.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = utf8(batch.column("text"))
            lengths = np.diff(starts)
            counts = -(-lengths // WINDOW)
            owner = np.repeat(np.arange(len(lengths)), counts)
            first = np.repeat(starts[:-1] - WINDOW * (np.cumsum(counts) - counts), counts) + WINDOW * np.arange(len(owner))
            sizes = np.minimum(WINDOW, starts[1:][owner] - first)
            sums = np.zeros((len(lengths), max(1, len(net.classes))))
            padded = np.concatenate([data, np.zeros(WINDOW, np.uint8)])
            places = np.arange(WINDOW)
            for at in range(0, len(owner) if net.classes else 0, BATCH):
                chosen = slice(at, at + BATCH)
                codes = padded[first[chosen, None] + places] * (places < sizes[chosen, None])
                np.add.at(sums, owner[chosen], net.probabilities(codes) * sizes[chosen, None])
            total = sums.sum(axis=1)
            lettered = np.array([bool(t) and LETTER.search(t) is not None for t in batch.column("text").to_pylist()], bool)
            known = (lettered & (total > 0)) if net.classes else np.zeros(len(lengths), bool)
            best = sums.argmax(axis=1)
            score = np.where(known, sums.max(axis=1) / np.maximum(total, 1e-9), 0.0)
            named = [net.classes[b] if k else UNDETERMINED for b, k in zip(best, known)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(named, pa.string()), pa.array(np.clip(score, 0, 1))], ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(predict, f"doc_id {id_type}, lang_pred string, score double")


def languages(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every document."""
    found = predict_language(docs, fit_language(docs))
    return found.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
