"""Text and key expressions (SC-04, SC-05, SC-06, SC-12, SC-13, SC-26, PRJ-10)."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference for equal results):
# text values read as "true" by the flag cleaner, compared after trim + upper.
TRUTHY_VALUES = ["S", "SI", "Y", "YES", "1", "A"]

# Fixed value: label given to null or empty descriptive text.
UNKNOWN_LABEL = "unknown"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def hex_key(c) -> Column:
    """SC-04: ``0x`` + upper-case hex of the value; null stays null."""
    return F.concat(F.lit("0x"), F.hex(_c(c)))


def truthy_flag(c, truthy: Iterable[str] = TRUTHY_VALUES) -> Column:
    """SC-05: 1 when the trimmed upper-cased text is in the truthy list, else 0."""
    return F.when(F.upper(F.trim(_c(c).cast("string"))).isin(*list(truthy)), 1) \
        .otherwise(0).cast("int")


def one_hot(c, value, then=1, cast: str = "int") -> Column:
    """SC-06: ``then`` where the column equals ``value``, else 0."""
    return F.when(_c(c) == F.lit(value), F.lit(then)).otherwise(F.lit(0)).cast(cast)


def left_pad_keep_right(c, width: int, fill: str = "0") -> Column:
    """SC-12: left pad to ``width`` keeping the rightmost characters
    (unlike ``lpad``, which cuts on the right)."""
    padded = F.concat(F.lit(fill * width), _c(c).cast("string"))
    return F.substring(padded, -width, width)


def slug(c) -> Column:
    """SC-13: anything but Unicode letters/digits/space -> space, trim,
    collapse runs of spaces, spaces -> ``_``."""
    s = F.regexp_replace(_c(c), r"[^\p{L}\p{N} ]+", " ")
    # only letters, digits and spaces are left: trimming spaces and turning
    # each run of spaces into one "_" is the same as trim, collapse, replace
    return F.regexp_replace(F.trim(s), " +", "_")


def squeeze_text(c) -> Column:
    """Trim and collapse whitespace runs to one space."""
    return F.regexp_replace(F.trim(_c(c)), r"\s+", " ")


def label_missing(c, label: str = UNKNOWN_LABEL) -> Column:
    """PRJ-10 for one column: squeezed text, null or empty -> ``label``."""
    s = squeeze_text(c)
    return F.when(s.isNull() | (s == ""), F.lit(label)).otherwise(s)


def word_pattern(words: Iterable[str]) -> str:
    """Alternation of whole words (``\\bw\\b``) for ``rlike``."""
    return "|".join(rf"\b{w}\b" for w in words)


def any_has_word(cols: Iterable, words: Iterable[str], extra: Column | None = None) -> Column:
    """SC-26: 1 when any of the trimmed texts holds a listed whole word."""
    pat = word_pattern(words)
    cond = None
    for c in cols:
        hit = F.coalesce(F.trim(_c(c)).rlike(pat), F.lit(False))
        cond = hit if cond is None else (cond | hit)
    if extra is not None:
        cond = cond | F.coalesce(extra, F.lit(False))
    return F.when(cond, 1).otherwise(0).cast("int")
