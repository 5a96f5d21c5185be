"""Text assembled for embedding and display."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters of a description that are embedded, and that a search hit shows.
EMBED_CHARS = 2000
PREVIEW_CHARS = 300


def non_blank(text: Column) -> Column:
    """True for text that holds something other than spaces."""
    return text.isNotNull() & (F.trim(text) != "")


def joined_names(names: Column, separator: str = ", ") -> Column:
    """The distinct non-null names of an array in order, as one string (``''`` if none)."""
    return F.array_join(F.array_sort(F.array_distinct(F.filter(names, lambda n: n.isNotNull()))), separator)


def embed_text(name: Column, genres: Column, description: Column, max_chars: int | None = EMBED_CHARS) -> Column:
    """``name | genres | description``, leaving out blank parts. The description is cut at
    ``max_chars`` as the model's input contract says; None embeds all of it."""
    body = description if max_chars is None else F.substring(description, 1, max_chars)
    return F.concat_ws(" | ", name, F.nullif(genres, F.lit("")), F.nullif(body, F.lit("")))


def preview(text: Column, chars: int = PREVIEW_CHARS) -> Column:
    return F.left(text, F.lit(chars))
