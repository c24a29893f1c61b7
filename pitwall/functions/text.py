"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

__all__ = [
    "clean_text", "clean_token_text", "hex_colour", "hex_colour_stripped", "full_name", "strict_concat_ws",
    "category", "int_or_default",
]


def clean_text(c: Column, tokens: tuple[str, ...] = ()) -> Column:
    """Trimmed text; empty text and the given tokens become NULL."""
    out = F.nullif(F.trim(c.cast("string")), F.lit(""))
    for token in tokens:
        out = F.nullif(out, F.lit(token))
    return out


def clean_token_text(c: Column) -> Column:
    return clean_text(c, ("None", "null"))


def hex_colour(c: Column) -> Column:
    """`abc123` and `#abc123` → `#ABC123`; empty → NULL."""
    text = F.upper(clean_text(c))
    return F.when(text.startswith("#"), text).otherwise(F.concat(F.lit("#"), text))


def hex_colour_stripped(c: Column) -> Column:
    """As `hex_colour`, with every `#` inside the text removed first."""
    return F.concat(F.lit("#"), F.replace(F.upper(clean_text(c)), F.lit("#"), F.lit("")))


def full_name(full: Column, first: Column, last: Column) -> Column:
    blank = F.lit("")
    return F.coalesce(full, F.trim(F.concat(F.coalesce(first, blank), F.lit(" "), F.coalesce(last, blank))))


def strict_concat_ws(sep: str, *cols: Column) -> Column:
    """Join with a separator; NULL when any part is NULL (Spark's concat_ws would skip it)."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        parts += [c.cast("string")] if i == 0 else [F.lit(sep), c.cast("string")]
    return F.concat(*parts)


def category(c: Column) -> Column:
    """Upper-case category with NULL and blank as UNKNOWN."""
    return F.coalesce(F.upper(clean_text(c)), F.lit("UNKNOWN"))


def int_or_default(c: Column, default: int = 0) -> Column:
    """Integer from text or number; NULL, empty and unreadable text become the default."""
    return F.coalesce(F.nullif(F.trim(c.cast("string")), F.lit("")).try_cast("int"), F.lit(default))
