"""Predicates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: menu entries that list no products
SKIPPED_LINK_PARTS = ("what+to+wear", "designer", "personal+styling", "in-the-mix", "stores", "blog")
SKIPPED_SUBCATEGORY = "spring look book"
LOOK_SUBCATEGORIES = ("chic this week", "style 3 ways", "chic escape", "resort report")
SKIPPED_LABEL = "home"


def in_stock(stock: Column) -> Column:
    """Stock text other than ``0``; unknown stock counts as in stock."""
    return F.coalesce(stock, F.lit("")) != "0"


def named(name: Column, least: int = 2) -> Column:
    return F.length(name) >= least


def has_anchor(link: Column) -> Column:
    return link.isNotNull()


def has_any(c: Column, parts: Iterable[str]) -> Column:
    """Whether the text holds one of the parts, as one alternation."""
    return F.coalesce(c.rlike("|".join("\\Q" + p + "\\E" for p in parts)), F.lit(False))


def followed_category(link: Column) -> Column:
    return ~has_any(link, SKIPPED_LINK_PARTS)


def followed_label(label: Column) -> Column:
    return ~has_any(F.lower(label), [SKIPPED_LABEL])


def followed_subcategory(label: Column) -> Column:
    return ~has_any(F.lower(label), [SKIPPED_SUBCATEGORY])


def page_kind(label: Column, has_report: Column, has_directory: Column) -> Column:
    """Kind of an overview page: looks, report, directory or grid."""
    return (
        F.when(has_any(F.lower(label), LOOK_SUBCATEGORIES), "looks")
        .when(has_report, "report")
        .when(has_directory, "directory")
        .otherwise("grid")
    )


def sellable(title: Column, sku: Column) -> Column:
    return (F.size(title) > 0) & (F.length(sku) > 0)


def priced_or_colored(color_code: Column, price: Column) -> Column:
    """A product without colours whose price is ``0`` is dropped."""
    return color_code.isNotNull() | (F.coalesce(F.get(price, F.lit(0)), F.lit("")) != "0")


def is_result_page(html: Column) -> Column:
    return F.contains(html, F.lit("Search results"))
