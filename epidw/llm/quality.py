"""Document quality by supervised subword embeddings (see ``subwords``)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from epidw.llm.common import fold, labelled_texts
from epidw.llm.subwords import SAMPLE, SubwordModel

THRESHOLD = 0.7
FOLDS, HELD_OUT = 4, 2


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> SubwordModel:
    """Learn ``labels.quality`` from at most ``rows`` labelled documents outside the held-out fold."""
    return SubwordModel.fit(labelled_texts(docs, labels.filter(fold("doc_id", FOLDS) != HELD_OUT), "quality", rows))


def score_quality(docs: DataFrame, model: SubwordModel, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (probability of label 1) and ``predicted`` (1 from ``threshold`` on) behind their columns.

    Whole texts are read in bounded slices. A null or empty text has the score of no features, that is of the class
    biases; a model without a label 1 scores 0. Columns of ``docs`` named ``score`` or ``predicted`` are replaced.
    """
    one = model.classes.index(1) if 1 in model.classes else None
    kept = [c for c in docs.columns if c not in ("score", "predicted")]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = model.probabilities(batch.column("text"))
            scores = known[:, one] if one is not None else np.zeros(len(known))
            columns = [batch.column(c) for c in kept]
            predicted = pa.array((scores >= threshold).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores), predicted], [*kept, "score", "predicted"])

    schema = docs.select(*kept).schema.add("score", "double").add("predicted", "integer")
    return docs.select(*kept).mapInArrow(score, schema)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document."""
    scored = score_quality(docs.select("doc_id", "text"), fit_quality(docs, labels))
    return scored.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score", "predicted")
