"""Free-text comment normalisation and its quality score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
DEFAULT_COMMENT = "No comment provided"
STRIPPED_CHARACTERS = r"[^\w\s.,!?-]"
SCORE_WITH_DEFAULT = 0.8
SCORE_WITH_COMMENT = 1.0


def only_blanks(text: Column, strict_blank: bool = False) -> Column:
    """True for a text of spaces only, or with ``strict_blank`` of any white space; null for null."""
    return ~text.rlike(r"\S") if strict_blank else F.trim(text) == ""


def normalize_comment(comment, strict_blank: bool = False, unicode_words: bool = False) -> Column:
    """Null or blank becomes the default text, anything else loses unusual characters.

    By default "blank" means spaces only, a tab or newline is a comment, and letters outside ASCII
    are stripped. ``strict_blank`` counts every kind of white space as blank and also replaces
    comments of which nothing is left; ``unicode_words`` keeps letters of all scripts.
    """
    text = F.col(comment) if isinstance(comment, str) else comment
    pattern = ("(?U)" if unicode_words else "") + STRIPPED_CHARACTERS
    kept = F.trim(F.regexp_replace(text, pattern, ""))
    if strict_blank:
        blank = text.isNull() | only_blanks(kept, strict_blank)
    else:
        blank = text.isNull() | only_blanks(text)
    return F.when(blank, F.lit(DEFAULT_COMMENT)).otherwise(kept)


def quality_score(comment) -> Column:
    text = F.col(comment) if isinstance(comment, str) else comment
    return F.when(text == DEFAULT_COMMENT, F.lit(SCORE_WITH_DEFAULT)).otherwise(
        F.lit(SCORE_WITH_COMMENT)
    )
