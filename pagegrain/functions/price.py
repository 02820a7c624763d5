"""Numbers and prices. Price text stays text; only the steps that compute cast it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagegrain.functions.text import clean, group


def to_number(c: Column) -> Column:
    """Text without ``%`` and ``$`` as double; null when it is no number."""
    return F.translate(c, "%$", "").try_cast("double")


def up_to(most: int | None) -> str:
    """Quantifier of a run: of any length, or of ``most`` characters."""
    return "+" if most is None else "{1,%d}" % most


def first_digits(c: Column, most: int | None = None) -> Column:
    """First run of digits as int; with ``most``, of its first so many."""
    return group(c, f"([0-9]{up_to(most)})").try_cast("int")


def price_digits(c: Column, most: int | None = None) -> Column:
    """First run of digits, dots and commas; with ``most``, its first so many."""
    return group(c, f"([0-9.,]{up_to(most)})")


def percent_text(value: Column) -> Column:
    return F.concat(value.cast("string"), F.lit("%"))


def discount_pct(retail: Column, price: Column) -> Column:
    """Discount as ``n%`` with two places; null when retail is zero."""
    return percent_text(F.round(F.try_divide(retail - price, retail) * 100, 2))


def best_percent(values: Column) -> Column:
    """Largest of a list of percentages as ``n%``; null when one of them is no number or there are none."""
    numbers = F.transform(values, to_number)
    return F.when(~F.exists(numbers, lambda x: x.isNull()), percent_text(F.array_max(numbers)))


def first_non_empty(*lists: Column) -> Column:
    """First list with at least one element; an empty list when there is none."""
    out = F.array().cast("array<string>")
    for arr in reversed(lists):
        out = F.when(F.size(arr) > 0, arr).otherwise(out)
    return out


def prices(sale: list[Column], standard: list[Column], joiner: str | None) -> tuple[Column, Column]:
    """(standard, sale) from candidate text lists in order; each fills the other when it is empty.

    With a joiner all texts of the chosen list become one; without one the first text is taken.
    """
    def settle(arr: Column) -> Column:
        if joiner is None:
            return F.slice(arr, 1, 1)
        return F.when(F.size(arr) > 0, F.array(clean(F.array_join(arr, joiner)))).otherwise(arr)

    new, old = settle(first_non_empty(*sale)), settle(first_non_empty(*standard))
    return (
        F.when(F.size(old) > 0, old).otherwise(new),
        F.when(F.size(new) > 0, new).otherwise(old),
    )


def has_digits(c: Column) -> Column:
    return F.coalesce(c.rlike("[0-9]"), F.lit(False))


def availability(price: Column, full: Column, sold_out: Column, badge: Column, alert: Column,
                 price_pattern: str = "[0-9]") -> Column:
    """struct(available, price, full_price, stock) of a detail page.

    Without a digit in the price the product is not available and both prices are ``0``. A sold-out mark
    sets the stock to 0. A badge text decides when present, otherwise an alert message makes it unavailable.
    """
    priced = F.coalesce(F.get(price, F.lit(0)).rlike(price_pattern), F.lit(False))
    zero = F.array(F.lit("0"))
    available = (
        F.when(sold_out, F.lit(False))
        .when(badge.isNotNull(), ~F.contains(F.lower(badge), F.lit("preorder")))
        .when(alert, F.lit(False))
        .otherwise(priced)
    )
    return F.struct(
        available.alias("available"),
        F.when(priced, price).otherwise(zero).alias("price"),
        F.when(priced, full).otherwise(zero).alias("full_price"),
        F.when(sold_out, 0).otherwise(1).alias("stock"),
    )
