"""Text expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from terravane.fixed_values import MISSING_WORDS

# The characters that count as white space when text is stripped.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove white space of any kind from both ends."""
    return F.btrim(_col(c), F.lit(WHITE_SPACE))


def strip_quotes(c: Column | str) -> Column:
    return F.btrim(_col(c), F.lit("'"))


def title_case(c: Column | str) -> Column:
    """Upper-case each letter that follows a non-letter, lower-case the others."""
    letters = r"[\p{Lu}\p{Ll}\p{Lt}]"
    runs = F.regexp_extract_all(
        F.lower(_col(c)), F.lit(f"({letters}+|[^\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]+)"), F.lit(1)
    )
    return F.array_join(F.transform(runs, F.initcap), "")


def normalize_text(c: Column | str) -> Column:
    """Strip, lower-case, and turn the spellings of "missing" into NULL."""
    text = F.lower(strip(c))
    return F.when(~text.isin(MISSING_WORDS), text)


def iso_code_or_null(c: Column | str) -> Column:
    """Keep a three-letter upper-case code, anything else becomes NULL."""
    c = _col(c)
    return F.when(c.rlike("^[A-Z]{3}$"), c)


def preview(c: Column | str, length: int = 50, default: str = "N/A") -> Column:
    return F.substring(F.coalesce(_col(c), F.lit(default)), 1, length)


def contains_any(c: Column | str, words: Iterable[str]) -> Column:
    """True when any word occurs in the text as a substring, ignoring case."""
    text = F.lower(_col(c))
    match = F.lit(False)
    for word in words:
        match = match | text.contains(word.lower())
    return match


def is_not_entity(c: Column | str, entity: str, normalize=strip) -> Column:
    """Null-safe exclusion of one entity: a missing value is kept."""
    return ~normalize(_col(c)).eqNullSafe(F.lit(entity))


def strip_lower(c: Column | str) -> Column:
    return F.lower(strip(c))


def word_text(c: Column | str) -> Column:
    """Lower-cased words joined by single blanks, with a blank at both ends."""
    words = F.regexp_replace(F.lower(_col(c)), r"[^\p{L}]+", " ")
    return F.concat(F.lit(" "), F.btrim(words), F.lit(" "))
