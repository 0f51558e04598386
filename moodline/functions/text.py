"""Text columns: cleaning, mention flags, text composition, tokens, trigrams."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from moodline.functions.columns import as_column

# Whitespace in Unicode terms, with the four separator control characters.
WHITESPACE = r"\s\x1c-\x1f"
WORD_CHARS = r"\p{L}\p{N}_"

# What cleaning removes, in this order, with marks that every match has.
CLEANING_PATTERNS = (
    (rf"(?U)(?:http|www)[^{WHITESPACE}]+", ("http", "www")),  # links, case-sensitive
    (rf"@[{WORD_CHARS}]+|#", ("@", "#")),  # handles whole, hashtags only their sign
    (rf"(?U)[^a-zA-Z0-9{WHITESPACE}]+", ()),  # all but ASCII letters, digits, whitespace
)
# Whitespace as a string, for trimming.
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: text and aspect in the layout a sentence-pair classifier reads.
PROMPT = "[CLS] %s [SEP] %s [SEP]"

# Runs of anything but word characters and apostrophes.
TOKEN_BREAK = rf"[^{WORD_CHARS}']+"

# Any three characters, overlapping; the class keeps a match from starting
# inside a surrogate pair.
TRIGRAM_PATTERN = r"(?s)(?=(\P{Cs}{3}))"


def clean_text(text: Column | str) -> Column:
    """Drop links, handles, hash signs and special characters; lowercase; strip.

    A plain search for the marks is far cheaper than a pattern, and most texts have none.
    """
    out = as_column(text)
    for pattern, marks in CLEANING_PATTERNS:
        cleaned = F.regexp_replace(out, pattern, "")
        if marks:
            marked = reduce(lambda a, b: a | b, [F.contains(out, F.lit(m)) for m in marks])
            cleaned = F.when(marked, cleaned).otherwise(out)
        out = cleaned
    return F.btrim(F.lower(out), F.lit(WHITESPACE_CHARS))


def mention_pattern(entity: str) -> str:
    """Whole-word pattern of one entity name (a word, or words with blanks between)."""
    if not re.fullmatch(r"\w(?:[\w ]*\w)?", entity):
        raise ValueError(f"entity must be words: {entity!r}")
    return rf"(^|[^{WORD_CHARS}]){entity.lower()}($|[^{WORD_CHARS}])"


def mention_flag(text: Column | str, entity: str) -> Column:
    """1 if the lowercased text has the entity as a whole word, else 0; null gives 0."""
    lowered = F.lower(as_column(text))
    pattern = mention_pattern(entity)
    # the plain search spares most texts the pattern
    hit = F.contains(lowered, F.lit(entity.lower())) & lowered.rlike(pattern)
    return F.coalesce(hit, F.lit(False)).cast("int")


def contains_any(text: Column | str, needles: Sequence[str]) -> Column:
    """True if the lowercased text contains any needle as a substring; null gives false."""
    lowered = F.lower(as_column(text))
    hit = F.lit(False)
    for needle in needles:
        hit = hit | F.coalesce(F.contains(lowered, F.lit(needle.lower())), F.lit(False))
    return hit


def compose_text(title: Column | str, description: Column | str, entities: Sequence[str]) -> Column:
    """``title . description`` where the description names an entity, else the title.

    A blank or null description names nothing, so it needs no test of its own.
    """
    title, description = as_column(title), as_column(description)
    return F.when(
        contains_any(description, entities), F.concat(title, F.lit(" . "), description)
    ).otherwise(title)


def aspect_prompt(text: Column | str, aspect: str) -> Column:
    """The prompt of a text and an aspect; null for a null text."""
    return F.when(as_column(text).isNotNull(), F.format_string(PROMPT, as_column(text), F.lit(aspect)))


def tokens(text: Column | str) -> Column:
    """Lowercased runs of word characters and apostrophes.

    Text that starts or ends with other characters gives an empty token there.
    """
    return F.split(F.lower(as_column(text)), TOKEN_BREAK)


def bare_word(token: Column | str) -> Column:
    """A token without quoting apostrophes at its ends."""
    return F.btrim(as_column(token), F.lit("'"))


def letters_only(text: Column | str) -> Column:
    """Lowercased letters, every other run one blank, one blank at either end."""
    spaced = F.regexp_replace(F.lower(as_column(text)), r"[^\p{L}]+", " ")
    return F.concat(F.lit(" "), F.trim(spaced), F.lit(" "))


def trigrams(text: Column | str) -> Column:
    """All overlapping character trigrams of the letters of a text."""
    return F.regexp_extract_all(letters_only(text), F.lit(TRIGRAM_PATTERN), F.lit(1))
