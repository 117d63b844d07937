"""String helpers for item metadata: year, article, genre lists, search."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for equal results:
# a trailing four-digit year in brackets ends a raw title; a raw title ending in
# ", <article>" for one of these eleven articles moves the article to the front.
YEAR_PATTERN = r"\s*\((\d{4})\)\s*$"
ARTICLES = ("The", "A", "An", "La", "Le", "Les", "Il", "El", "Das", "Der", "Die")
NO_GENRE = "(no genres listed)"
GENRE_SEPARATOR = "|"

_ARTICLE_PATTERN = r"^(.*),\s+(" + "|".join(ARTICLES) + r")$"


def title_year(raw: Column) -> Column:
    """The year at the end of a raw title, or null."""
    y = F.regexp_extract(raw, YEAR_PATTERN, 1)
    return F.when(y != "", y.cast("int"))


def clean_title(raw: Column) -> Column:
    """Strip the year, trim, move a trailing article to the front: 'ring, The (1961)'
    becomes 'The ring'."""
    # strip surrounding whitespace of any kind (tabs, newlines), not only spaces
    no_year = F.regexp_replace(F.regexp_replace(raw, YEAR_PATTERN, ""), r"^\s+|\s+$", "")
    return F.regexp_replace(no_year, _ARTICLE_PATTERN, "$2 $1")


def genre_array(genres: Column, drop_sentinel: bool = True) -> Column:
    """Split on the literal bar; drop empty names and (by default) the sentinel."""
    parts = F.split(genres, r"[|]")
    if drop_sentinel:
        return F.filter(parts, lambda g: (g != "") & (g != F.lit(NO_GENRE)))
    return F.filter(parts, lambda g: g != "")


def contains_ci(text: Column, needle: str) -> Column:
    """Case-insensitive substring test of a trimmed needle; an empty needle matches."""
    q = needle.strip().lower()
    if not q:
        return F.lit(True)
    return F.contains(F.lower(text), F.lit(q))
