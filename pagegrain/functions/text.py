"""String expressions, Column in and Column out. All stay on the JVM side."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ANY_CASE = "(?is)"


def _quote(literal: str) -> str:
    return "\\Q" + literal + "\\E"


def null_if_empty(c: Column) -> Column:
    """Null for the empty string. Unlike ``nullif`` it holds its input once, so that a chain of searches inside a
    condition does not double with every step."""
    return F.get(F.array_remove(F.array(c), F.lit("")), F.lit(0))


def find(c: Column, pattern: str) -> Column:
    """First match, ignoring case and with dot matching newline; null without a match."""
    return null_if_empty(F.regexp_extract(c, ANY_CASE + pattern, 0))


def find_nth(c: Column, pattern: str, n: int) -> Column:
    """The n-th (from 0) of all matches; null when there are fewer."""
    return F.get(F.regexp_extract_all(c, F.lit(ANY_CASE + pattern), F.lit(0)), F.lit(n))


def group(c: Column, pattern: str, idx: int = 1) -> Column:
    """Capture group of the first match; null without a match or with an empty group."""
    return null_if_empty(F.regexp_extract(c, pattern, idx))


def replace_n(c: Column, literal: str, repl: str, n: int) -> Column:
    """Replace at most the first n occurrences of a literal."""
    return F.array_join(F.split(c, _quote(literal), n + 1), repl)


def replace_all(c: Column, literal: str, repl: str = "") -> Column:
    return F.replace(c, F.lit(literal), F.lit(repl))


def inner_text(c: Column) -> Column:
    """Text between the first ``>`` and the next ``<``; null when there is no such pair."""
    return replace_all(replace_all(find(c, ">.*?<"), "<"), ">")


def quoted(c: Column) -> Column:
    """First double-quoted value, without its quotes."""
    return replace_all(find(c, '".*?"'), '"')


def attr_value(c: Column, name: str) -> Column:
    """Value of the first double-quoted attribute of that name; null when absent."""
    return quoted(find(c, name + '=".*?"'))


def decode_amp(c: Column, cap: int | None = None) -> Column:
    """``&amp;`` to ``&``, all of them or at most ``cap``."""
    return replace_all(c, "&amp;", "&") if cap is None else replace_n(c, "&amp;", "&", cap)


def decode_amp_twice(c: Column) -> Column:
    """Two passes, the first capped at two: doubly escaped ampersands come out single."""
    return decode_amp(decode_amp(c, 2))


def clean(c: Column) -> Column:
    """Drop tab, carriage return and newline."""
    return F.translate(c, "\t\r\n", "")


def drop_suffix(c: Column, suffix: str) -> Column:
    return F.regexp_replace(c, _quote(suffix) + "$", "")


def drop_prefix(c: Column, prefix: str) -> Column:
    return F.regexp_replace(c, "^" + _quote(prefix), "")


def trim_one(c: Column) -> Column:
    """Remove one space at each edge (not a full trim)."""
    return drop_prefix(drop_suffix(c, " "), " ")


def strip_ws(c: Column) -> Column:
    """Remove all white space at both edges."""
    return F.regexp_replace(c, "^\\s+|\\s+$", "")


def drop_words(c: Column, words: Iterable[str], cap: int | None = 2) -> Column:
    """Remove each phrase in turn, at most ``cap`` occurrences of each (None: all)."""
    for word in words:
        c = replace_all(c, word) if cap is None else replace_n(c, word, "", cap)
    return c


def in_parens(c: Column) -> Column:
    """Content of the first pair of parentheses; null without one."""
    return F.translate(find(c, "\\(.*?\\)"), "()", "")


def cash_category(c: Column) -> Column:
    """Class of a cash-back text: dollar sign first, then percent sign."""
    return (
        F.when(F.contains(c, F.lit("$")), "Absolute Cash Back")
        .when(F.contains(c, F.lit("%")), "Percentage Cash Back")
        .otherwise("unknown")
    )


def title_case(c: Column) -> Column:
    """Capital after every non-letter, the rest lower case."""
    return F.array_join(F.transform(F.split(F.lower(c), "(?<=\\P{L})"), F.initcap), "")


def join_text(arr: Column) -> Column:
    """Each piece stripped and followed by a newline; an empty list gives the empty string."""
    return F.array_join(F.transform(arr, lambda x: F.concat(strip_ws(x), F.lit("\n"))), "")


def fill(c: Column, default: str) -> Column:
    """Default for null and for the empty string."""
    return F.coalesce(null_if_empty(c), F.lit(default))


def description(arr: Column) -> Column:
    """Text list with the fixed default when it is empty or one blank node."""
    blank = (F.size(arr) == 0) | ((F.size(arr) == 1) & (clean(F.get(arr, F.lit(0))) == ""))
    return F.when(arr.isNull() | blank, F.array(F.lit("no description available"))).otherwise(arr)


def non_empty(arr: Column) -> Column:
    return F.filter(arr, lambda x: x != "")
