"""String column functions (STR-*). All return Columns, never collect."""

from __future__ import annotations

import sys
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema as S


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Characters Python's str.strip() removes, derived by rule rather than listed.
PY_WHITESPACE = "".join(ch for ch in map(chr, range(sys.maxunicode + 1)) if ch.isspace())
# \x{h..h} escapes read the same in Java regex (Spark) and RE2 (DuckDB oracle).
_WS_CLASS = "[" + "".join("\\x{%x}" % ord(ch) for ch in PY_WHITESPACE) + "]"
STRIP_PATTERN = "^" + _WS_CLASS + "+|" + _WS_CLASS + "+$"


def strip_ws(c) -> Column:
    """Python-style strip: removes all Unicode whitespace at both ends.

    Spark's ``trim`` only removes blanks, so a regex with the same character
    set as ``str.strip`` is used instead.
    """
    x = _col(c)
    ws = list(PY_WHITESPACE)
    # The regex only runs when an end character is whitespace (rare), so the
    # common path is two one-character lookups inside generated code.
    edge = F.substring(x, 1, 1).isin(ws) | F.substring(x, -1, 1).isin(ws)
    return F.when(edge, F.regexp_replace(x, STRIP_PATTERN, "")).otherwise(x)


def normalize_description(c="description") -> Column:
    """STR-1: stripped text, empty string -> NULL."""
    return F.nullif(strip_ws(c), F.lit(""))


def as_string(c) -> Column:
    """STR-2: identifiers as text."""
    return _col(c).cast("string")


def strip_code(c="stock_code") -> Column:
    """STR-2 (EDA only): stock code as stripped text."""
    return strip_ws(as_string(c))


def invoice_prefix(c="invoice_no") -> Column:
    """STR-3: first character of the invoice number (NULL for empty text)."""
    return F.nullif(F.substring(as_string(c), 1, 1), F.lit(""))


def starts(c, prefix: str) -> Column:
    """STR-4: case-sensitive startswith, NULL -> false."""
    return F.coalesce(as_string(c).startswith(prefix), F.lit(False))


def icontains(c, token: str) -> Column:
    """STR-5: case-blind contains, NULL -> false."""
    return F.coalesce(F.lower(as_string(c)).contains(token.lower()), F.lit(False))


def full_match(c, pattern: str) -> Column:
    """STR-7: regex validity test; NULL -> false."""
    return F.coalesce(as_string(c).rlike(pattern), F.lit(False))


def is_noise(c="description", words: Iterable[str] = S.NOISE_WORDS) -> Column:
    """MSK-12: lower(strip(text)) is a noise word or contains '?'; NULL -> false."""
    low = F.lower(strip_ws(c))
    return F.coalesce(low.isin(list(words)) | low.contains("?"), F.lit(False))
