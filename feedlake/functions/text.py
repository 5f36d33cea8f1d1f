"""Text expressions used by ingest, cleaning, marts and prompts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake.schema import BLANKS, NON_WORD_PATTERN, SPACE_PATTERN, TAG_PATTERN


def strip(text: Column) -> Column:
    """Cut Unicode blanks at both ends.

    `btrim` walks the text once from each end; a `\\s+$` pattern would try
    again at every inner blank.
    """
    return F.btrim(text, F.lit(BLANKS))


def first_filled(*candidates: Column) -> Column:
    """The first candidate that is neither null nor empty, else ''."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates], F.lit(""))


def without_tags(text: Column) -> Column:
    """Markup removed (not replaced by a space); null becomes ''.

    A byte search spares the pattern the many texts that hold no tag.
    """
    present = F.coalesce(text, F.lit(""))
    return F.when(F.contains(present, F.lit("<")), F.regexp_replace(present, TAG_PATTERN, "")).otherwise(present)


def squeezed(text: Column) -> Column:
    """ASCII white space runs as one space, then spaces cut at the ends."""
    return F.trim(F.regexp_replace(text, SPACE_PATTERN, " "))


def plain_body(text: Column) -> Column:
    return squeezed(without_tags(text))


def title_words(title: Column) -> Column:
    """The white-space separated pieces of a title as an array, each reduced to
    Hangul syllables, Latin letters and digits (and possibly empty).

    White space is left alone by the pattern, so the title can be reduced as a
    whole before it is split: one replacement per title, not one per piece.
    """
    return F.split(F.regexp_replace(title, NON_WORD_PATTERN, ""), SPACE_PATTERN)


def embed_text(title: Column, body: Column) -> Column:
    return strip(F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), F.coalesce(body, F.lit(""))))


def head(text: Column, chars: int) -> Column:
    return F.substring(text, 1, chars)
