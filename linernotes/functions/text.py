"""Scalar text and typing expressions. All are built-in, so they stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from linernotes import fixed_values as fv


def norm_text(c: Column) -> Column:
    """Form under which names and titles are compared; null stays null.

    Trimmed, lower case, accents folded, every run of anything but letters, digits and "_" one
    blank. One pattern does the last step: punctuation and white space both end up as that blank.
    """
    low = F.lower(F.trim(c))
    # Only text with multi-byte letters can hold an accent; the others skip the lookup.
    accented = F.octet_length(low) > F.length(low)
    folded = F.when(accented, F.translate(low, fv.FOLD_FROM, fv.FOLD_TO)).otherwise(low)
    return F.trim(F.regexp_replace(folded, fv.NON_WORDS, " "))


def _without_takes(c: Column) -> Column:
    # Most titles have no parenthesis at all; looking for one is far cheaper than the pattern.
    bare = F.regexp_replace(c, fv.TAKE_PARENTHETICAL, "")
    return F.when(F.contains(c, F.lit("(")), bare).otherwise(c)


def strip_takes(c: Column) -> Column:
    """Title without its "(… take …)" parentheticals."""
    return F.trim(F.regexp_replace(_without_takes(c), fv.SPACES, " "))


def norm_title(c: Column) -> Column:
    """``norm_text(strip_takes(c))``; the normaliser tidies the blanks by itself."""
    return norm_text(_without_takes(c))


def content_id(c: Column) -> Column:
    """Stable id of an already normalised string."""
    return F.sha2(c, 256)


def label_key(name: Column) -> Column:
    """Label id: hashes only the lower-cased trimmed name, not the normalised form."""
    return content_id(F.lower(F.trim(name)))


def has_text(c: Column) -> Column:
    """True for non-empty text; null is rejected by a filter."""
    return F.length(c) > 0


def year_number(c: Column) -> Column:
    """Year text as int: a fraction is cut off, anything else unreadable is null."""
    digits = F.regexp_extract(F.trim(c), r"^([+-]?[0-9]+)(\.[0-9]*)?$", 1)
    return digits.try_cast("int")


def table_name(name: str) -> str:
    """Catalog-safe form of a table title."""
    return name.strip().lower().replace(" ", "_")


def contains_text(c: Column, q: str) -> Column:
    """Case-insensitive literal containment; an empty search text matches all."""
    if not q:
        return F.lit(True)
    return F.contains(F.lower(c), F.lower(F.lit(q)))


def prefix_rank(c: Column, q: str) -> Column:
    """0 for names that begin with a non-empty search text, else 1."""
    if not q:
        return F.lit(1)
    return F.when(F.startswith(F.lower(c), F.lower(F.lit(q))), 0).otherwise(1)
