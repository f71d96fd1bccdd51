"""Multi-valued attributes kept as pipe-delimited text.

Whitespace around the pipes goes before a plain split: single spaces by replacing text, the
rest by a pattern that only those texts meet which still need it. No lambda runs per element,
so Spark compiles all of it. It mentions the column several times; what explodes or filters the
values has them as a column of their own first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The delimiter, and the pattern of an element that is empty.
# ``(?U)`` extends ``\s`` to all Unicode whitespace.
DELIMITER = "|"
DELIMITER_PATTERN = r"\|"
EMPTY_ELEMENT_PATTERN = r"(?U)(^\s*\|)|(\|\s*$)|(\|\s*\|)"
# Whitespace at a pipe, and characters that may be whitespace other than spaces.
PADDING_PATTERN = r"(?U)\|\s*+|(?<!\s)\s++(?=\|)"
RARE_PATTERN = "[^ -~]"
RARE_WHITESPACE_PATTERN = r"(?U)[^\S ]"


def _unpadded(column: Column) -> Column:
    """The text between two pipes, without whitespace at any pipe; there may be more pipes."""
    text = F.concat(F.lit(DELIMITER), column, F.lit(DELIMITER))
    text = F.replace(F.replace(text, F.lit(" |"), F.lit("|")), F.lit("| "), F.lit("|"))
    spaces = F.contains(text, F.lit(" |")) | F.contains(text, F.lit("| "))
    rare = text.rlike(RARE_PATTERN) & text.rlike(RARE_WHITESPACE_PATTERN)
    return F.when(spaces | rare, F.regexp_replace(text, PADDING_PATTERN, DELIMITER)).otherwise(text)


def listed_values(column: Column) -> Column:
    """All non-empty elements, stripped, repeats included; NULL for NULL."""
    return F.array_remove(F.split(_unpadded(column), DELIMITER_PATTERN), "")


def dimension_values(column: Column) -> Column:
    """The distinct non-empty elements in the order of their first appearance; NULL for NULL."""
    return F.array_distinct(listed_values(column))


def stored_values(column: Column) -> Column:
    """The elements of a text that ``dimension_text`` wrote: distinct, stripped, none empty."""
    return F.split(column, DELIMITER_PATTERN)


def dimension_text(values: Column) -> Column:
    """Elements joined by pipes; NULL when there is none."""
    return F.nullif(F.array_join(values, DELIMITER), F.lit(""))


def dimension_size(values: Column) -> Column:
    """Number of elements, 0 for NULL."""
    # size gives -1 or NULL for NULL, depending on the session.
    return F.greatest(F.size(values), F.lit(0))


def pipe_count(column: Column) -> Column:
    """Number of delimiters in the text."""
    return F.regexp_count(column, F.lit(r"\|")).cast("int")


def has_empty_element(column: Column) -> Column:
    """True when some element is blank; NULL for NULL."""
    return column.rlike(EMPTY_ELEMENT_PATTERN)
