"""Mixing to target weights with soft domain membership.

A classifier learned from a table of labelled documents gives each document a posterior over domains. Its expected
tokens of a domain are its tokens times that posterior. Document rates, none below ``least``, are then fitted so that
the expected tokens of every domain, summed over rate times tokens, meet the targets: least squares by projected
gradient. While no rate is at its bound a step changes the sums by what the domains have in common, the sums of tokens
times products of shares. So the driver adds up gradient steps on those until the targets would be met, and Spark applies
them to the rates in one pass, projects, and sums again what is reached; that is repeated while bounds keep it from the
targets. A document's rate follows from its last written rate and the few passes since, so the driver holds one number
per domain and pass, and one per pair of domains.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from epidw.llm.common import bounded_sample, sampled_texts, small_batches, written
from epidw.llm.subwords import SAMPLE, SubwordModel
from epidw.llm.tokens import encoder

STEPS = 200  # passes over the rates, and gradient steps before each; the result says whether the fit has converged by then
REPLAYED = 8  # passes after which the rates are written, so that one replays fewer than these
TOLERANCE = 1e-4  # largest miss of a target, as a share of all tokens
TEMPERATURE = 0.7  # exponent on a domain's share where no weights are given


def fit_domains(docs: DataFrame, labelled: DataFrame, rows: int = SAMPLE) -> SubwordModel:
    """Learn domains from ``labelled`` (columns ``doc_id``, ``domain``), at most ``rows`` documents of it.

    A document with several labels counts with the first in order; null ids and domains teach nothing.
    """
    known = labelled.filter("doc_id IS NOT NULL AND domain IS NOT NULL").groupBy("doc_id").agg(F.min("domain").alias("__domain"))
    return SubwordModel.fit(sampled_texts(docs, bounded_sample(known, rows), "__domain", rows))


def with_membership(docs: DataFrame, model: SubwordModel, tokenizer: str) -> DataFrame:
    """``doc_id``, ``text_hash``, ``tokens`` (ids and an end id) and ``posterior`` (a share for each domain of the model)."""
    small_batches(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "text_hash", "tokens", "posterior"]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            known = model.probabilities(texts)
            tokens = np.concatenate([np.zeros(0, np.int64), *(np.diff(upto) + 1 for *_, upto in encoder(tokenizer).encode_slices(texts))])
            posterior = pa.FixedSizeListArray.from_arrays(pa.array(known.ravel()), known.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(tokens), posterior], names)

    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return hashed.mapInArrow(describe, f"doc_id {id_type}, text_hash long, tokens long, posterior array<double>")


def domain_tokens(members: DataFrame, domains: int, rate: Column | None = None) -> np.ndarray:
    """Expected tokens of each domain, every document weighted with its rate."""
    share = F.col("tokens") * (rate if rate is not None else F.lit(1.0))
    sums = members.agg(*(F.sum(share * F.col("posterior")[d]).alias(f"d{d}") for d in range(domains))).first()
    return np.array([x or 0.0 for x in sums])


def domain_products(members: DataFrame, domains: int) -> np.ndarray:
    """For each pair of domains the sum over all documents of tokens times both shares."""
    share = [F.col("posterior")[d] for d in range(domains)]
    pairs = [(d, e) for d in range(domains) for e in range(d, domains)]
    sums = members.agg(*(F.sum(F.col("tokens") * share[d] * share[e]).alias(f"d{d}_{e}") for d, e in pairs)).first()
    found = np.zeros((domains, domains))
    for (d, e), value in zip(pairs, sums):
        found[d, e] = found[e, d] = value or 0.0
    return found


def descent(miss: np.ndarray, products: np.ndarray, scale: float) -> np.ndarray:
    """Sum of the gradient steps after which, with no rate at its bound, the targets are met; :data:`STEPS` at most.

    The curvature of a domain is at most its tokens, the sum of its products with all domains.
    """
    slope, step = np.zeros(len(miss)), 1 / np.maximum(products.sum(axis=1), scale * 1e-6)
    for _ in range(STEPS):
        if np.abs(miss).max(initial=0) <= TOLERANCE * scale:
            break
        slope += miss * step
        miss = miss - products @ (miss * step)
    return slope


def rate_after(slopes: list[np.ndarray], least: float) -> Column:
    """``rate`` of a document after further gradient steps, kept at ``least`` or more after each."""
    if not slopes:
        return F.col("rate")
    steps = F.array(*(F.array(*(F.lit(float(x)) for x in s)) for s in slopes))
    along = lambda step: F.aggregate(
        F.zip_with("posterior", step, lambda p, g: p * g), F.lit(0.0), lambda total, x: total + x
    )
    return F.aggregate(steps, F.col("rate"), lambda rate, step: F.greatest(F.lit(float(least)), rate - along(step)))


def tempered_targets(available: np.ndarray, temperature: float = TEMPERATURE) -> np.ndarray:
    """Domain totals in the proportion of tempered shares, such that no domain gets less than it has."""
    shares = available / max(available.sum(), 1e-12)
    weights = np.where(shares > 0, shares, 0) ** temperature
    present = weights > 1e-9
    return weights * (available[present] / weights[present]).max() if present.any() else available


def mixing_rates(
    docs: DataFrame, labelled: DataFrame, tokenizer: str, weights: Mapping[str, float] | None = None, total: float | None = None,
    least: float = 0.0, steps: int = STEPS,
) -> DataFrame:
    """Rates that bring the expected tokens of each domain to its target.

    ``weights`` are shares of ``total`` tokens (by default all tokens there are) for the domains of ``labelled``; without
    weights the targets are tempered shares that raise scarce domains and lower none. Returns a row for each document:
    ``doc_id``, ``text_hash``, ``tokens``, ``posterior``, ``domain`` (most likely one), ``rate``, ``copies`` (the rate
    rounded up or down by a hash of ``doc_id``, so that copies add up to rates) and ``target`` and ``reached``, arrays
    over the domains in alphabetical order. ``miss`` is the largest miss of a target as a share of all tokens, and
    ``converged`` tells whether it is within :data:`TOLERANCE`; after ``steps`` passes the fit ends in any case.
    Tokens are ids of ``tokenizer`` and an end id, so a null or empty text has one token. A
    target that no document can serve, or without labelled rows every target, is missed by what is lacking. Repeated
    rows have the same rate; further columns are ignored.
    """
    model = fit_domains(docs, labelled)
    members = written(with_membership(docs, model, tokenizer).withColumn("rate", F.lit(1.0)), "members")
    count = len(model.classes)
    available = domain_tokens(members, count)
    if weights is None:
        targets = tempered_targets(available)
    else:
        given = np.array([float(weights.get(c, 0.0)) for c in model.classes])
        targets = given / max(given.sum(), 1e-12) * (available.sum() if total is None else total)
    scale = max(available.sum(), 1.0)
    slopes: list[np.ndarray] = []
    products, reached = domain_products(members, count), available
    for _ in range(steps):
        miss = reached - targets
        if np.abs(miss).max(initial=0) <= TOLERANCE * scale:
            break
        slopes.append(descent(miss, products, scale))
        if len(slopes) == REPLAYED:
            members = written(members.withColumn("rate", rate_after(slopes, least)), "members")
            slopes = []
        reached = domain_tokens(members, count, rate_after(slopes, least))
    missed = float(np.abs(reached - targets).max(initial=0) / scale)
    fitted = members.withColumn("rate", rate_after(slopes, least))
    drawn = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(1 << 30)) / float(1 << 30)
    likeliest = F.array_position("posterior", F.array_max("posterior")).cast("int")
    return fitted.select(
        "doc_id", "text_hash", "tokens", "posterior",
        F.element_at(F.array(*(F.lit(c).cast("string") for c in model.classes)), likeliest).alias("domain"),
        "rate", F.floor(F.col("rate") + drawn).cast("int").alias("copies"),
        F.array(*(F.lit(float(t)) for t in targets)).alias("target"), F.array(*(F.lit(float(t)) for t in reached)).alias("reached"),
        F.lit(missed).alias("miss"), F.lit(missed <= TOLERANCE).alias("converged"),
    )


def mix(docs: DataFrame, labelled: DataFrame, tokenizer: str, least: float = 1.0) -> DataFrame:
    """``docs`` with each row as often as its fitted rate says; by default no row goes and scarce domains repeat."""
    rates = mixing_rates(docs, labelled, tokenizer, least=least).select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("copies").alias("__copies")
    ).distinct()
    found = docs.withColumn("__text", F.xxhash64("text")).join(
        rates, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__hash"))
    )
    return found.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), F.col("__copies")))).select(*docs.columns)
