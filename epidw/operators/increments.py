"""Differences of two snapshots of rows without an identity, and what follows from them for keys, facts and the mart.

Raw rows have no key and repeat, so a snapshot is a bag: a change is a row with a signed multiplicity. Cleaning, key
lookup and sums all act row by row, so each works on the changes alone, and their signed result is added to what is stored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from epidw import domain as d, schemas
from epidw.functions.dates import all_of
from epidw.operators import scd2
from epidw.operators.dimensions import with_region
from epidw.operators.facts import build_notification_fact
from epidw.operators.keys import contiguous_ids
from epidw.operators.lookup import fits_broadcast
from epidw.operators.mart import MEASURES, refresh_mart
from epidw.operators.staging import build_staging
from epidw.session import cut_lineage

CHANGE = "variacao"  # signed multiplicity of a row

#: the filter of changed digests: bits for each, marks of each, words of 64 bits in a block, blocks at most
BITS_PER_DIGEST, PROBES, BLOCK_WORDS, FILTER_BLOCKS = 16, 4, 64, 1 << 17
_MARKS = [f"cast(shiftrightunsigned(_digest2, {12 * i}) & 4095 as int)" for i in range(PROBES)]


def row_digest(columns: Sequence[str]) -> list[Column]:
    """128 bits that tell rows apart by all their values, missing ones included."""
    missing = F.concat(*(F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in columns))
    values = [F.col(f"`{c}`") for c in columns]  # the hash passes over missing values, hence their pattern beside them
    return [F.xxhash64(missing, *values).alias("_digest"), F.xxhash64(F.lit("2"), *reversed(values), missing).alias("_digest2")]


def digest_filter(digests: DataFrame, largest: int = FILTER_BLOCKS) -> DataFrame:
    """Blocks of bits that stand for a set of row digests, for :func:`may_hold`.

    A digest belongs to one block and marks :data:`PROBES` of its bits. The blocks grow with the digests to ``largest`` of
    them, 64 MB in all; beyond that more other digests pass as well, and none of the set is ever missed.
    """
    blocks = 1
    wanted = digests.count() * BITS_PER_DIGEST / (64 * BLOCK_WORDS)
    while blocks < min(wanted, largest):
        blocks *= 2
    block = F.pmod("_digest", F.lit(blocks)).alias("_block")
    marks = digests.select(block, "_digest2").repartition("_block").select("_block", F.explode(F.array(*map(F.expr, _MARKS))).alias("_mark"))
    words = marks.groupBy("_block", F.expr("_mark div 64").cast("int").alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, _mark % 64)")).alias("_bits"))
    held = words.groupBy("_block").agg(F.map_from_entries(F.collect_list(F.struct("_word", "_bits"))).alias("_held"))
    none = F.lit(0).cast("long")
    every = F.transform(F.sequence(F.lit(0), F.lit(BLOCK_WORDS - 1)), lambda word: F.coalesce(F.try_element_at("_held", word), none))
    return cut_lineage(held.select("_block", F.lit(blocks).alias("_blocks"), every.alias("_words")))


def may_hold(rows: DataFrame, marked: DataFrame) -> DataFrame:
    """The ``rows``, with their digests, whose digest is in the set of a :func:`digest_filter`, and a few others; they do not move."""
    blocks = marked.agg(F.coalesce(F.max("_blocks"), F.lit(1))).first()[0]
    bits = [F.expr(f"bit_get(get(_words, cast({mark} div 64 as int)), {mark} % 64) = 1") for mark in _MARKS]
    side = F.broadcast(marked.select("_block", "_words"))  # bounded by the filter
    return rows.join(side, all_of([F.pmod("_digest", F.lit(blocks)) == F.col("_block"), *bits]), "left_semi")


def snapshot_delta(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that ``new`` has more or less often than ``old``, with :data:`CHANGE`; each such row once.

    Only digests are shuffled for all rows, counted before the shuffle, so copies cost one row a task. Whole rows are
    read again and, where their digest changed, counted by their values. Digests too many for a broadcast are told by a
    filter of bounded size, so a whole row moves only if it changed or is one of the few that pass with them; these count
    to nothing. Missing values equal each other.
    """
    columns = old.columns
    keys = ["_digest", "_digest2"]
    signed = old.select(*row_digest(columns), F.lit(-1).alias("_sign")).unionByName(
        new.select(*row_digest(columns), F.lit(1).alias("_sign")))
    changed = cut_lineage(signed.groupBy(*keys).agg(F.sum("_sign").alias(CHANGE)).filter(F.col(CHANGE) != 0))
    small = fits_broadcast(changed)
    marked = None if small else digest_filter(changed)

    def rows(table: DataFrame, sign: int) -> DataFrame:
        told = table.select(*(f"`{c}`" for c in columns), *row_digest(columns))
        met = told.join(F.broadcast(changed.select(*keys)), keys, "left_semi") if small else may_hold(told, marked)
        return met.select(*(f"`{c}`" for c in columns), F.lit(sign).alias("_sign"))

    counted = rows(old, -1).unionByName(rows(new, 1)).groupBy(*(f"`{c}`" for c in columns)).agg(F.sum("_sign").alias(CHANGE))
    return counted.filter(F.col(CHANGE) != 0)


def staged_delta(delta: DataFrame) -> DataFrame:
    """The changes cleaned and typed; only they are."""
    return build_staging(delta, carry=(d.HOSPITALISED, CHANGE))


def extend_members(existing: DataFrame, tuples: DataFrame, key: str) -> DataFrame:
    """A dimension with the ``tuples`` it lacks: old members keep their keys, new ones go on after the highest.

    ``tuples`` are attributes only and may repeat. Keys stay contiguous, in the order of the attributes within a load.
    """
    names = tuples.columns
    new = tuples.distinct().join(existing.select(*names), names, "left_anti")
    highest = max(0, existing.agg(F.max(key)).first()[0] or 0)
    return existing.unionByName(contiguous_ids(new, names, key, highest + 1).select(*existing.columns))


def extend_junk_dimension(existing: DataFrame, staging: DataFrame, dimension: d.JunkDimension) -> DataFrame:
    return extend_members(existing, staging.select(*(F.col(c).alias(a) for c, a in dimension.staged().items())), dimension.key)


def extend_locality(
    existing: DataFrame, staging: DataFrame, populations: Mapping[str, int] = d.POPULATION_CHANGES, since=d.POPULATION_CHANGE_DATE
) -> DataFrame:
    """The locality dimension with the places it lacks, each with the versions a full load would give it; old rows stay."""
    names = ["municipio", "bairro"]
    pairs = staging.select(*(F.col(d.clean_name(raw)).alias(name) for raw, name in d.PLACE.items())).distinct()
    new = with_region(pairs.join(existing.select(*names), names, "left_anti")).withColumn("nk_municipio_bairro", F.concat_ws("|", *names))
    changed = F.create_map(*(F.lit(x) for item in populations.items() for x in item))[F.col("municipio")]
    first = new.withColumns(scd2.open_version(d.CALENDAR_START)).withColumn(
        scd2.END, F.when(changed.isNotNull(), F.date_sub(F.lit(since), 1))).withColumn(scd2.CURRENT, changed.isNull())
    second = new.filter(changed.isNotNull()).withColumn("populacao_municipio", changed).withColumns(scd2.open_version(since))
    highest = max(0, existing.agg(F.max("sk_local")).first()[0] or 0)
    numbered = contiguous_ids(first.unionByName(second), [*names, scd2.START], "sk_local", highest + 1)
    declared = schemas.TABLES["dw.dim_localidade"]
    return existing.unionByName(numbered.select(*(F.col(f.name).cast(f.dataType) for f in declared)))


def fact_delta(staged: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """The changes as fact rows with their signed multiplicity; raw rows that differ only in what the fact leaves out cancel."""
    rows = build_notification_fact(staged, dimensions, carry=(CHANGE,))
    columns = [c for c in rows.columns if c != CHANGE]
    return rows.groupBy(*columns).agg(F.sum(CHANGE).alias(CHANGE)).filter(F.col(CHANGE) != 0)


def apply_to_fact(fact: DataFrame, delta: DataFrame) -> DataFrame:
    """The fact after the changes."""
    columns = fact.columns
    times = lambda sign: F.explode(F.array_repeat(F.lit(1), (F.col(CHANGE) * sign).cast("int"))).alias("_copy")
    gone = delta.filter(F.col(CHANGE) < 0).select(*columns, times(-1)).drop("_copy")
    come = delta.filter(F.col(CHANGE) > 0).select(*columns, times(1)).drop("_copy")
    return fact.exceptAll(gone).unionByName(come)


def mart_delta(delta: DataFrame, locality: DataFrame) -> DataFrame:
    """What the changed fact rows add to each group of the mart; sums may be negative."""
    return refresh_mart(delta.withColumns({c: F.col(c) * F.col(CHANGE) for c in MEASURES.values()}), locality)


def merge_mart(mart: DataFrame, delta: DataFrame) -> DataFrame:
    """The mart after a delta: touched groups are added up, a group without rows goes, the others are left as they are."""
    groups = ["municipio", "ano_mes"]
    delta = cut_lineage(delta)
    untouched = mart.join(delta.select(*groups), groups, "left_anti")
    touched = mart.join(delta.select(*groups), groups, "left_semi").unionByName(delta)
    sums = touched.groupBy(*groups).agg(*(F.sum(m).alias(m) for m in MEASURES))
    return untouched.unionByName(sums.filter("notificacoes <> 0")).select(*mart.columns)
