"""Text helpers: accent folding (I2) and word tokenising.

Word characters follow Python's Unicode ``\\w``: letters, digits, ``_``.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = r"[\p{L}\p{N}_]"
NON_WORD = r"[^\p{L}\p{N}_]+"


def _make_nfkd_ascii():
    """Build the Arrow UDF from nested functions: they are pickled by value, so
    Python workers need only the standard library and pandas, not this package."""

    def fold(value):
        if value is None or (isinstance(value, float) and value != value):
            return None
        return unicodedata.normalize("NFKD", value).encode("ascii", "ignore").decode("ascii")

    def nfkd_ascii(s: pd.Series) -> pd.Series:
        return s.map(fold)

    return F.pandas_udf(nfkd_ascii, T.StringType())


# NFKD decomposition, then drop every non-ASCII code point (Arrow batches).
nfkd_ascii = _make_nfkd_ascii()


def strip_space(c: Column) -> Column:
    """Surrounding white space (Unicode) removed."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def normalize_review_text(col) -> Column:
    """NULL -> '', strip surrounding white space, lower case."""
    c = F.col(col) if isinstance(col, str) else col
    return F.lower(strip_space(F.coalesce(c.cast("string"), F.lit(""))))


def tokens(col) -> Column:
    """Array of word tokens (empty strings removed)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.array_remove(F.split(c, NON_WORD), "")


def whole_word_count(text: Column, keyword: str) -> Column:
    """Occurrences of ``keyword`` (any characters, spaces too) between word boundaries, left to right without overlap.

    Equals ``len(re.findall(rf"\\b{re.escape(keyword)}\\b", text))``.  Only texts
    that contain the keyword at all meet the expression.
    """
    if not keyword:
        raise ValueError("a keyword needs a character")

    def is_word(c: str) -> bool:
        return c.isalnum() or c == "_"

    # a boundary has a word character on exactly one side
    before = f"(?<!{WORD})" if is_word(keyword[0]) else f"(?<={WORD})"
    after = f"(?!{WORD})" if is_word(keyword[-1]) else f"(?={WORD})"
    literal = "".join(c if is_word(c) else f"\\x{{{ord(c):x}}}" for c in keyword)
    count = F.regexp_count(text, F.lit(f"{before}{literal}{after}"))
    return F.when(F.contains(text, F.lit(keyword)), count).otherwise(F.lit(0))
