"""Text helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word is a run of anything but blanks and control white space.
NOT_BLANK = r"[^\x20\x09-\x0D]+"
#: A word is a run of ASCII letters and digits or of any character beyond ASCII.
WORD_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, all else untouched."""
    return F.translate(c, UPPER, LOWER)


def blank_words(c: Column) -> Column:
    """Number of blank-separated words as a long; zero for null."""
    return F.coalesce(F.regexp_count(c, F.lit(NOT_BLANK)), F.lit(0)).cast("long")


def plain_words(c: Column) -> Column:
    """Lower-cased words of a text as an array; empty for null."""
    return F.filter(F.split(F.coalesce(ascii_lower(c), F.lit("")), WORD_GAP), lambda w: w != "")


def crc_bucket(c: Column, parts: int) -> Column:
    """crc32 of a value's text modulo `parts`; null for null."""
    return F.crc32(c.cast("string").cast("binary")) % parts


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that `df` doesn't have, whatever the case."""
    taken, name = {c.lower() for c in df.columns}, stem
    while name.lower() in taken:
        name = f"_{name}"
    return name


def word_runs(text: bytes, overlap: int, size: int = 1 << 20) -> Iterator[tuple[list[bytes], bool]]:
    """Blank-separated words of a UTF-8 text in runs of about `size` bytes, so that the word list of a huge text is never whole in memory.

    Each run after the first begins with the last `overlap` words of the one before. Yields (words, is first).
    """
    if len(text) <= 2 * size:
        yield text.split(), True
        return
    start, carry, first = 0, [], True
    while start < len(text):
        end = min(start + size, len(text))
        while end < len(text) and text[end] not in b" \t\n\v\f\r":
            end += 1
        words = carry + text[start:end].split()
        if len(words) > overlap or end == len(text):
            yield words, first
            carry, first = words[len(words) - overlap:] if overlap else [], False
        else:
            carry = words
        start = end
