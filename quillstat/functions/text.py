"""Cleaning, normalising and rounding expressions over string columns."""

import unicodedata
from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import chars
from .constants import (
    CONFUSABLES, MAX_BYTES, MAX_CHARACTERS, MAX_SENTENCES, MIN_CHARACTERS,
)


#: Bytes of a batch that Python functions hold as strings at a time, to which one text may add. A plan
#: of many such functions has a Python process for each, so a whole batch of strings would count often.
HELD = 1 << 20


def held_parts(texts: pa.Array) -> Iterator[pa.Array]:
    """Runs of texts of about ``HELD`` bytes, in order."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    bounds = [0, *np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // HELD)) + 1, len(texts)]
    return (texts.slice(a, b - a) for a, b in zip(bounds, bounds[1:]) if a < b)


@F.arrow_udf(StringType())
def _normalised_batch(text: pa.Array) -> pa.Array:
    # Arrow's own utf8_normalize leaves NFKC decomposed, so each text goes through Python.
    done = [pa.array([None if t is None else unicodedata.normalize("NFKC", t) for t in part.to_pylist()], pa.string())
            for part in held_parts(text)]
    return pa.concat_arrays(done) if done else pa.array([], pa.string())


# Spark copies deterministic expressions into filters on their result, here the whole
# cleaning chain. Marked otherwise, a cleaned text is computed once and filtered after.
_nfkc_batch = _normalised_batch.asNondeterministic()


def computed_once(value: Column) -> Column:
    """The same value, kept out of pushed-down filters.

    A filter on a costly column is otherwise rewritten to compute the column again below
    its projection, with every shared step written out. The partition number is never
    negative; Spark only has to take it for something that might change.
    """
    return F.when(F.spark_partition_id() >= 0, value)


def nfkc(text: Column, wanted: Column | None = None) -> Column:
    """Unicode NFKC. Only texts that may change are shipped to Python, as Arrow batches.

    Spark evaluates a Python function for every row, even inside ``CASE``; rows outside
    ``wanted`` or already in NFKC are therefore sent as nulls.
    """
    suspect = text.rlike(chars.maybe_unnormalised())
    if wanted is not None:
        suspect = wanted & suspect
    return F.coalesce(_nfkc_batch(F.when(suspect, text)), text)


def collapse(text: Column) -> Column:
    """Whitespace runs become one space; the ends are stripped."""
    return F.trim(F.regexp_replace(text, chars.UNCOLLAPSED, " "))


def strip(text: Column) -> Column:
    """Remove Unicode whitespace from both ends (``trim`` only knows U+0020)."""
    return F.regexp_replace(text, rf"\A{chars.WS}+|{chars.WS}+\z", "")


def clean_text(text: Column) -> Column:
    return collapse(nfkc(text))


def replace_urls(text: Column) -> Column:
    return F.regexp_replace(text, chars.URL, "<URL>")


def strip_blobs(text: Column) -> Column:
    return strip(F.regexp_replace(text, chars.BLOB, ""))


def strip_stutter(text: Column) -> Column:
    return F.regexp_replace(text, chars.STUTTER, "")


def strip_dash_runs(text: Column) -> Column:
    return collapse(F.regexp_replace(text, chars.DASH_RUN, ""))


def clean_chain(text: Column) -> Column:
    """The corpus cleaning chain, in its fixed order."""
    return strip_dash_runs(strip_stutter(strip_blobs(replace_urls(clean_text(text)))))


def count_class(text: Column, char_class: str) -> Column:
    """How many characters of ``text`` belong to a regex class."""
    return F.length(text) - F.length(F.regexp_replace(text, char_class + "+", ""))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(chars.WORDS), F.lit(0))


def has_word(text: Column) -> Column:
    return text.rlike(chars.WORD)


def invalid_entry(text: Column, min_chars: int = 20, min_words: int = 5,
                  min_letter_share: float = 0.40) -> Column:
    """Too short, too few words, or dominated by non-letters; cheapest test first."""
    body = strip(text)
    return (
        (F.length(body) < min_chars)
        | (F.size(words(body)) < min_words)
        | (F.try_divide(count_class(body, r"\p{L}"), F.length(body)) < min_letter_share)
    )


def security_normalise(text: Column) -> Column:
    """Fold Unicode tampering: NFKC, zero-width removal, look-alikes, control characters."""
    folded = F.translate(
        F.regexp_replace(nfkc(text), chars.ZERO_WIDTH, ""),
        "".join(CONFUSABLES), "".join(CONFUSABLES.values()),
    )
    return collapse(F.regexp_replace(folded, chars.CONTROL_EXCEPT_NEWLINE_TAB, ""))


def split_gaps(text: Column) -> Column:
    """Split after ``.``, ``!`` or ``?`` followed by whitespace."""
    return F.split(text, chars.SENTENCE_GAP)


def sentences(stripped: Column) -> Column:
    """Sentences holding at least one word, in order. The text's own ends are stripped,
    so no part can have whitespace at an end."""
    return F.filter(split_gaps(stripped), has_word)


def admission_code(
    text: Column, *, min_characters: int = MIN_CHARACTERS,
    max_characters: int = MAX_CHARACTERS, max_bytes: int = MAX_BYTES,
    max_sentences: int = MAX_SENTENCES,
) -> Column:
    """First failing admission rule, or null for an admissible text."""
    empty = text.isNull() | ~text.rlike(chars.NOT_WS)
    large = (F.length(text) > max_characters) | (F.octet_length(text) > max_bytes)
    short = F.length(strip(text)) < min_characters
    unsafe = text.rlike(chars.CONTROL_EXCEPT_NEWLINE_RETURN_TAB)
    # Only texts that pass the cheap rules reach the normaliser.
    parts = sentences(collapse(nfkc(text, ~(empty | large))))
    return (
        F.when(empty, "EMPTY_TEXT")
        .when(large, "TEXT_TOO_LARGE")
        .when(short, "TEXT_TOO_SHORT")
        .when(unsafe, "UNSAFE_CONTROL_CHARACTER")
        .when(F.size(parts) == 0, "NO_WORDS")
        .when(F.size(parts) > max_sentences, "TOO_MANY_SENTENCES")
    )


@lru_cache
def _sides(scale: int) -> list[int]:
    """For each tie of the places: whether its nearest double lies below (0), above (1) or on it (2)."""
    ties = [((2 * k + 1) / (2 * scale), Fraction(2 * k + 1, 2 * scale)) for k in range(scale)]
    return [2 if Fraction(near) == exact else int(near > exact) for near, exact in ties]


def python_round(value: Column, places: int) -> Column:
    """Round a non-negative double exactly as Python's ``round`` does.

    Spark rounds the shortest decimal form. That differs only where this form ends in a
    tie, e.g. 2.675, whose binary value lies below the tie: there the fraction, which is exact,
    is compared with the tie's nearest double, and if it is that double, its known side counts.
    """
    scale = 10 ** places
    whole = F.floor(value)
    share = value - whole
    doubled = share * (2 * scale)
    tie = F.floor(doubled + 0.5)
    near = tie / F.lit(2.0 * scale)
    below = whole * scale + F.floor(tie / 2)
    side = F.get(F.lit(_sides(scale)), F.floor(tie / 2).cast("int"))
    up = F.when(share > near, 1).when(share < near, 0).when(side == 2, below % 2).otherwise(side)
    looks_tied = (tie % 2 == 1) & (F.abs(doubled - tie) < 1e-9)
    # Away from ties a division of whole numbers is the nearest double; ``round`` would go through decimals.
    plain = F.when(value < 1e9, (whole * scale + F.floor((doubled + 1) / 2)) / F.lit(float(scale))).otherwise(
        F.round(value, places))
    return F.when(looks_tied, (below + up) / F.lit(float(scale))).otherwise(plain)


def hash_unit_key(*parts, seed: int | str = 42) -> Column:
    """Seeded 32-bit order key from md5; any engine that has md5 gives the same order."""
    joined = F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, 8), 16, 10).cast("long")
