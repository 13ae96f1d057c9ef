"""Text expressions. All are built-in functions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Results depend on these exact patterns and tokens.
WHITESPACE = r"\s+"
# The same runs but single spaces, which stay as they are: most of a text's runs cost no replacement.
UNEVEN_SPACE = r"[\t\n\x0B\f\r]\s*| \s+"
CONTROL_CHARS = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"
PLACEHOLDERS = ["[removed]", "[deleted]", "", "n/a"]


def clean_text(text: Column, strip_controls_first: bool = False) -> Column:
    """Whitespace runs become one space, control characters go, ends are trimmed.

    By default controls go last, so a control between two spaces leaves both
    spaces. ``strip_controls_first`` avoids that; vertical tab and form feed are
    controls and white space alike, so they are made spaces before the strip.
    """
    if strip_controls_first:
        spaced = F.translate(text, "\x0b\x0c", "  ")
        return F.trim(F.regexp_replace(F.regexp_replace(spaced, CONTROL_CHARS, ""), UNEVEN_SPACE, " "))
    return F.trim(F.regexp_replace(F.regexp_replace(text, UNEVEN_SPACE, " "), CONTROL_CHARS, ""))


def is_placeholder(text: Column) -> Column:
    """True for null and for the tokens that stand for removed content."""
    trimmed = F.trim(text)
    # The length test spares lower-casing long texts.
    short = F.length(trimmed) <= max(len(p) for p in PLACEHOLDERS)
    return text.isNull() | (short & F.lower(trimmed).isin(PLACEHOLDERS))


def joined_text(title: Column, body: Column) -> Column:
    """Title and body as one text; missing parts count as empty."""
    return F.trim(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(body, F.lit(""))))


def word_count(text: Column) -> Column:
    """Words of an already cleaned text; the empty text has none."""
    spaces = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))
    # Cleaned text has single spaces, unless a control character stood between two: then words are split.
    runs = F.when(F.contains(text, F.lit("  ")), F.size(F.split(text, WHITESPACE))).otherwise(spaces + 1)
    return F.when(text == "", F.lit(0)).otherwise(runs).cast("long")


def tokens(text: Column, min_length: int = 3) -> Column:
    """Lower-case runs of ASCII letters, the SQL form of the tokenizer stage."""
    return F.filter(F.split(F.lower(text), "[^a-z]+"), lambda t: F.length(t) >= min_length)
