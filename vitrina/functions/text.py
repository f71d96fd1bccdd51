"""Text rules: stripping, missing tokens, previews, JSON fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrina.spec import MISSING_TOKENS

# The characters with the Unicode property White_Space.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


_LONGEST_TOKEN = max(len(token) for token in MISSING_TOKENS)


def stripped(column: Column) -> Column:
    """The value as text without whitespace at either end (``trim`` drops spaces only).

    Stripping a set of characters is slow, so it is left to the texts whose first or
    last character is no printable ASCII character; they include all that begin or end
    with whitespace.
    """
    text = column.cast("string")
    last = F.substring(text, -1, 1)
    padded = (text < "!") | (text > "~") | (last < "!") | (last > "~")
    return F.when(padded, F.btrim(text, F.lit(WHITESPACE))).otherwise(text)


def without_tokens(text: Column) -> Column:
    """Stripped text, with missing tokens turned into NULL.

    Only a short text can be a token; longer ones need no lower case.
    """
    longer = F.octet_length(text) > _LONGEST_TOKEN
    return F.when(longer | ~F.lower(text).isin(*MISSING_TOKENS), text)


def is_missing(column: Column) -> Column:
    """True for NULL and for the missing tokens; never NULL."""
    return normalized(column).isNull()


def has_text(column: Column) -> Column:
    """True when the column holds real text."""
    return normalized(column).isNotNull()


def normalized(column: Column) -> Column:
    """Text stripped and freed of missing tokens."""
    return without_tokens(stripped(column))


def preview(column: Column, length: int = 500) -> Column:
    """The text, cut after ``length`` characters and marked with dots."""
    cut = F.concat(F.substring(column, 1, length), F.lit("..."))
    return F.when(F.length(column) > length, cut).otherwise(column)


def json_field(column: Column, path: str) -> Column:
    """The value at a JSON path as text; NULL when absent or not JSON."""
    return F.get_json_object(column, path)
