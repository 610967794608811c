"""Throwing functions, error normalisation and the root-cause fingerprint."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The fingerprint must stay equal across implementations. The
# possessive ``*+`` matches the same as ``*`` here, without recursion per part.
STACK_FRAME = r"at (\w+(?:\.\w+)*+)"
DIGITS = r"\d+"
DIGITS_BECOME = "N"
QUOTES = "'\""
SEPARATOR = "|"
FUNCTIONS_KEPT = 10
FUNCTIONS_HASHED = 5

# The white space and line ends of ECMAScript, as a character set.
WHITESPACE = (
    r"\t-\r \x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}"
)


def named_functions(function_ids: Column) -> Column:
    """Keys of the function map in stored order, blank keys removed."""
    return F.filter(F.map_keys(function_ids), lambda name: name.rlike(f"[^{WHITESPACE}]"))


def stack_functions(stack: Column) -> Column:
    """The first frame name of every line.

    ``(?md)^.*?`` starts each match at a line start and cannot cross a line
    feed, so one pass over the whole text yields one name per line.
    """
    return F.regexp_extract_all(stack, F.lit("(?md)^.*?" + STACK_FRAME), F.lit(1))


def throwing_functions(names: Column, stack: Column) -> Column:
    """Ordered distinct union of map names and stack names, first ten."""
    both = F.array_distinct(F.concat(names, stack_functions(stack)))
    return F.slice(both, 1, FUNCTIONS_KEPT)


def normalized_error(message: Column) -> Column:
    """Lower case, digits as N, no quotes, single spaces, trimmed."""
    text = F.regexp_replace(F.lower(message), DIGITS, DIGITS_BECOME)
    text = F.translate(text, QUOTES, "")
    return F.trim(F.regexp_replace(text, f"[{WHITESPACE}]+", " "))


def root_cause_hash(message: Column, functions: Column) -> Column:
    """SHA-256 hex of the normalised error and its first five functions, sorted."""
    names = F.array_join(F.array_sort(F.slice(functions, 1, FUNCTIONS_HASHED)), SEPARATOR)
    return F.sha2(F.concat(normalized_error(message), F.lit(SEPARATOR), names), 256)
