"""Text expressions that mean the same in Spark, Python and DuckDB."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: White space as Python's ``str.split`` sees it: ASCII, separators of Unicode, NEL and the four information separators.
SPACE = r"[\s\p{Z}\x{85}\x{1c}-\x{1f}]"
#: Java's ``\w`` is ASCII only, and ``(?U)\w`` takes combining marks, which Python's does not.
WORD = r"[\p{L}\p{N}_]+"


def squeezed(c: Column | str) -> Column:
    """Runs of white space as one blank, ends trimmed; null stays null."""
    return F.trim(F.regexp_replace(c, SPACE + "+", " "))


def blank_as_null(c: Column | str) -> Column:
    """``squeezed``, with an empty text as null."""
    return F.nullif(squeezed(c), F.lit(""))


def words(c: Column | str) -> Column:
    """The lower-case words of a text, in order; an empty array for null."""
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(f"({WORD})"), F.lit(1))


def row_hash(*columns: Column) -> Column:
    """A 64-bit hash of the values in which null and the empty string are alike."""
    return F.xxhash64(*[F.coalesce(c, F.lit("")) for c in columns])


def _decomposed(batch: pd.Series) -> pd.Series:
    return batch.map(lambda s: unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode(), na_action="ignore")


_ascii = F.pandas_udf(_decomposed, StringType())
#: The letters that anchors spell out.
SPELT = {"æ": "ae", "ø": "oe", "å": "aa", "ß": "ss"}


def ascii_anchor(c: Column | str) -> Column:
    """A name in lower-case ASCII: the letters that are spelt out, then what compatible decomposition leaves."""
    c = F.lower(c)
    for a, b in SPELT.items():
        c = F.replace(c, F.lit(a), F.lit(b))
    return _ascii(c)
