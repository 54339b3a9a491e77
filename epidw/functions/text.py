"""Text clean-up as column expressions (no Python at run time)."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column, functions as F

from epidw import domain as d

# every Unicode space separator (general category Zs); tabs and line breaks are not part of it
NO_BREAK_SPACE = "\u00a0"
SPACES = "".join(ch for ch in map(chr, range(0x3001)) if unicodedata.category(ch) == "Zs")


def _has_special_spaces(text: Column) -> Column:
    """Whether a value can hold a space separator other than the blank.

    Such a separator is either the two-byte no-break space or three bytes long, so
    only values with that space, or with two or more extra bytes, can have one.
    """
    extra_bytes = F.octet_length(text) - F.char_length(text)
    return (extra_bytes >= 2) | ((extra_bytes == 1) & text.contains(NO_BREAK_SPACE))


def trim_spaces(text: Column) -> Column:
    """Strip leading and trailing Unicode space separators.

    Almost every value takes the cheap single-byte trim; see :func:`_has_special_spaces`.
    """
    return F.when(_has_special_spaces(text), F.btrim(text, F.lit(SPACES))).otherwise(F.trim(text))


def clean_text(text: Column, default: str = d.UNKNOWN) -> Column:
    """Trim; a missing or blank value becomes ``default``.

    A value that sorts after the blank is not blank, so almost all are trimmed once and compared no more. All of
    it is one expression, where ``nullif`` would add a projection that copies the wide rows once more.
    """
    plain = (text >= "!") & ~_has_special_spaces(text)
    trimmed = trim_spaces(text)
    return F.when(plain, F.trim(text)).when(text.isNull() | (trimmed == ""), F.lit(default)).otherwise(trimmed)


def clean_upper(text: Column, default: str = d.UNKNOWN_UPPER) -> Column:
    """:func:`clean_text` in upper case; accents are kept."""
    return F.upper(clean_text(text, default))


@cache
def _decompositions() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Accent table for the Latin blocks, derived from Unicode's compatibility decomposition.

    Returns characters to map, their one-character images (combining marks have
    none and are deleted by ``translate``), and the characters that expand to several.
    """
    sources, images, expanding, deleted = [], [], [], []
    for code in (*range(0x00A0, 0x0250), *range(0x0300, 0x0370), *range(0x1E00, 0x1F00)):
        ch = chr(code)
        image = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        if image == ch:
            continue
        if len(image) == 1:
            sources.append(ch)
            images.append(image)
        elif image:
            expanding.append((ch, image))
        else:
            deleted.append(ch)
    return "".join(sources + deleted), "".join(images), tuple(expanding)


def remove_accents(text: Column) -> Column:
    """Drop diacritics (compatibility decomposition of Latin text); NULL becomes ''."""
    sources, images, expanding = _decompositions()
    plain = F.translate(F.coalesce(text, F.lit("")), sources, images)
    for ch, image in expanding:
        plain = F.replace(plain, F.lit(ch), F.lit(image))
    return plain
