"""Drug-code normalization to the 11-digit 5-4-2 billing form."""

from __future__ import annotations

import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_DIGITS = r"\A[0-9]{1,11}\z"
_THREE_PARTS = r"\A([^-]*)-([^-]*)-([^-]*)\z"
# Put a full pad before each part, then take off what is more than the part needs. Longer
# parts are never cut.
_PADDED = "00000$1-0000$2-00$3"
_EXCESS = r"\A0{0,5}([^-]{5,})-0{0,4}([^-]{4,})-0{0,2}([^-]{2,})\z"
# Blanks are dropped everywhere, other white space of Unicode at the ends.
_SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_EDGES = rf"\A{_SPACE}+|{_SPACE}+\z"
_READABLE = rf"{_DIGITS}|\A[^-]*-[^-]*-[^-]*\z"
_SPACES = "".join(c for c in map(chr, range(0x3001)) if re.fullmatch(_SPACE, c))


def _clean(raw: Column) -> Column:
    # No pattern: this runs for every row, and most texts have nothing to trim.
    return F.btrim(F.replace(raw.cast("string"), F.lit(" "), F.lit("")), F.lit(_SPACES))


def _hyphens(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("-"), F.lit("")))


def readable_code(raw: Column) -> Column:
    """Whether ``normalize_code`` gives a code: the same test, cheap enough for filters."""
    # The text is named once: a filter works out anew whatever it names twice.
    return _clean(raw).rlike(_READABLE)


def normalize_code(raw: Column) -> Column:
    """11-digit code for ``raw``, NULL when it cannot be read.

    Hyphenated codes need three parts, padded to 5, 4 and 2. Ten bare digits are read
    as 5-4-1, fewer are padded on the left. Digits are ASCII only, and a ``+`` or ``-`` is not a sign.
    """
    text = _clean(raw)

    def padded(part: Column, width: int) -> Column:  # longer parts are never cut
        return F.lpad(part, F.greatest(F.length(part), F.lit(width)), F.lit("0"))

    parts = F.concat(
        padded(F.substring_index(text, "-", 1), 5),
        padded(F.substring_index(F.substring_index(text, "-", 2), "-", -1), 4),
        padded(F.substring_index(text, "-", -1), 2),
    )
    bare = F.when(F.length(text) == 10, F.overlay(text, F.lit("0"), 10, 0)).otherwise(
        F.lpad(text, 11, "0")
    )
    # The first test, always made, names the text twice, so Spark cleans it once for all uses.
    return F.when(_hyphens(text) == 2, parts).when(text.rlike(_DIGITS), bare)


def register_sql_function(spark: SparkSession, name: str = "normalize_ndc") -> None:
    """Make the normalizer callable from SQL, as an inlined SQL function (no Python)."""
    digits, parts, excess, edges = (p.replace("\\", "\\\\") for p in (_DIGITS, _THREE_PARTS, _EXCESS, _EDGES))
    text = f"regexp_replace(replace(code, ' ', ''), '{edges}', '')"
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(code STRING) RETURNS STRING RETURN
        CASE
          WHEN {text} RLIKE '{digits}' THEN
            CASE WHEN length({text}) = 10 THEN overlay({text} PLACING '0' FROM 10 FOR 0)
                 ELSE lpad({text}, 11, '0') END
          WHEN {text} RLIKE '{parts}' THEN
            regexp_replace(regexp_replace({text}, '{parts}', '{_PADDED}'),
                           '{excess}', '$1$2$3')
        END"""
    )
