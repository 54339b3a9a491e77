"""Exact dedup by content-defined chunk recipes, on built-in functions only.

A text without white space is cut where its own characters say so, so equal texts have equal chunks. Its
recipe is the ordered list of its chunks' identifiers. Texts whose recipe occurs once are done. The chunks of
the others are moved once, each distinct chunk counted once before the shuffle, to verify the identifiers: one
that stands for two contents gets a number besides. Ordered identifier lists then decide, so no long text is
moved again, and a group of copies is folded into one row per task before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from epidw.llm.common import written

SHORTEST, LONGEST = 512, 4096


def _runs(first: int, end: int, step: int, start: int, width: int) -> str:
    """Of every ``step`` code points the ``width`` from ``start`` on, as part of a character class."""
    return "".join(f"\\x{{{low:X}}}-\\x{{{low + width - 1:X}}}" for low in range(first + start, end, step))


def _beyond_ascii(low: int, high: int) -> str:
    """About one character in eight of every script beyond ASCII: runs from ``low`` in alphabets, from ``high`` in large ones."""
    alphabets = _runs(0x80, 0x3400, 32, low, 4) + _runs(0xF900, 0x10000, 32, low, 4)
    return alphabets + _runs(0x3400, 0xD800, 512, high, 64) + _runs(0x10000, 0x30000, 1024, 2 * high, 128)


#: a chunk ends behind the first of these pairs past SHORTEST characters: two letters, two digits, or two such characters
#: (about one place in sixty); only a text without any of them is cut at LONGEST characters
BOUNDARY = f"[aeiou][bdgmp]|0[27]|(?![\\x00-\\x7F])[{_beyond_ascii(0x15, 0x40)}][{_beyond_ascii(0x02, 0x100)}]"
CHUNK = f"(?s).{{{SHORTEST},{LONGEST - 2}}}?(?:{BOUNDARY})|.{{1,{LONGEST}}}"
#: recipes that repeat are broadcast up to this count, and joined by a shuffle beyond it
BROADCAST_ROWS = 1_000_000
BLANKS = (" ", "\t", "\n", "\u000b", "\f", "\r")


def without_blanks(text: Column) -> Column:
    """The text without the characters of ``[\\x20\\x09-\\x0D]``."""
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def chunks(normal: Column) -> Column:
    """The successive chunks of a normalised text; none if it is empty."""
    return F.regexp_extract_all(normal, F.lit(CHUNK), F.lit(0))


def identifier(chunk: Column) -> Column:
    return F.xxhash64(chunk, F.length(chunk))


def recipe(pieces: Column) -> Column:
    """Ordered identifiers of the chunks, as one text."""
    return F.concat_ws(",", F.transform(pieces, lambda c: F.hex(identifier(c))))


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per document (columns ``doc_id``, ``text``) with its group of equal texts.

    Texts are equal if identical without ``[\\x20\\x09-\\x0D]``; null counts as empty, and all empty texts are
    one group. ``doc_id`` may be of any type with an order. Returns ``doc_id``, ``keep_id`` (most characters in the original text, then smallest ``doc_id``),
    ``group_size``, ``kept`` and ``text_sha256``. A null ``doc_id`` stays only if the group has no other; rows that
    repeat a ``doc_id`` in a group are each returned, all with the same ``kept``. Further columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    plain = docs.select("doc_id", F.length(text).alias("chars"), without_blanks(text).alias("normal"))
    cut = plain.select("doc_id", "chars", chunks(F.col("normal")).alias("pieces"), F.sha2("normal", 256).alias("text_sha256"))
    listed = written(cut.select("doc_id", "chars", recipe(F.col("pieces")).alias("recipe"), "text_sha256"), "recipes")
    apart = _told_apart(plain, listed)
    verified = listed.withColumn("apart", F.lit(""))
    if apart is not None:
        verified = listed.join(apart, ["recipe", "text_sha256"], "left").fillna("", ["apart"])
    rank = F.struct((-F.col("chars")).alias("short"), F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").alias("first"))
    groups = verified.groupBy("recipe", "apart").agg(F.min(rank).alias("best"), F.count("*").alias("group_size"))
    found = verified.join(groups, ["recipe", "apart"])
    keep_id = F.col("best.first")
    return found.select(
        "doc_id", keep_id.alias("keep_id"), "group_size",
        (F.col("doc_id").eqNullSafe(keep_id) & (F.col("chars") == -F.col("best.short"))).alias("kept"), "text_sha256",
    )


def _told_apart(plain: DataFrame, listed: DataFrame) -> DataFrame | None:
    """``apart`` for texts with a chunk whose identifier stands for several contents; None if there are none.

    Only chunks of documents whose recipe repeats are read. Grouping compares whole contents; a distinct
    content is one row per task before the shuffle, however many copies there are.
    """
    repeated = listed.groupBy("recipe").agg(F.count("*").alias("times")).filter("times > 1 and recipe <> ''").select("recipe")
    if repeated.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        repeated = F.broadcast(repeated.select(F.xxhash64("recipe").alias("key")))
    else:
        repeated = repeated.select(F.xxhash64("recipe").alias("key"))
    cut = plain.select(chunks(F.col("normal")).alias("pieces"), "normal").withColumn("recipe", recipe(F.col("pieces")))
    suspects = cut.withColumn("key", F.xxhash64("recipe")).join(repeated, "key", "left_semi")
    pieces = suspects.select(
        "recipe", F.sha2("normal", 256).alias("text_sha256"), F.posexplode("pieces").alias("place", "chunk")
    ).withColumn("id", identifier(F.col("chunk")))
    contents = pieces.groupBy("id", "chunk").agg(F.lit(1).alias("one"))
    several = contents.groupBy("id").agg(F.count("*").alias("contents")).filter("contents > 1").select("id")
    numbered = contents.join(several, "id").select(
        "id", "chunk", F.row_number().over(Window.partitionBy("id").orderBy("chunk")).alias("number")
    )
    clashes = written(numbered, "clashes")
    if clashes.isEmpty():  # as good as always: each identifier stands for one content
        return None
    return pieces.join(clashes, ["id", "chunk"]).distinct().groupBy("recipe", "text_sha256").agg(
        F.array_sort(F.collect_list(F.struct("place", "number"))).cast("string").alias("apart")
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group of equal texts, with all their columns.

    Only ids meet in the join; of rows that also agree in ``doc_id`` and text one stays.
    """
    kept = exact_groups(docs).filter("kept").select(F.col("doc_id").alias("__kept_id"), F.col("text_sha256").alias("__kept_text")).distinct()
    text = F.sha2(without_blanks(F.coalesce("text", F.lit(""))), 256)
    found = docs.withColumn("__text", text).join(
        kept, F.col("doc_id").eqNullSafe(F.col("__kept_id")) & (F.col("__text") == F.col("__kept_text")), "left_semi"
    )
    return found.withColumn(
        "__row", F.row_number().over(Window.partitionBy("doc_id", "__text").orderBy(F.length("text").desc_nulls_last(), "text"))
    ).filter("__row = 1").drop("__row", "__text")
