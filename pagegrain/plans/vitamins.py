"""Supplement product facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagegrain.functions import text as X
from pagegrain.functions.catalog import parse_title
from pagegrain.operators import nodes as N
from pagegrain.operators.quality import Facts, keep_where, with_failed
from pagegrain.session import scratch_path

# fixed values: the selectors of the product page
CELL = N.Test("td", "valign", "eq", "top")
HEAD = N.Test("h1", "class", "eq", "h1productHead")
BRAND = N.Test("a", "style", "starts", "text-decoration")
SIZE_MARK = "Selected Size:"
UPC_BOX = N.Test("span", "class", "starts", "size")
PRICE = N.Test("span", "itemprop", "eq", "price")
GRID = N.Test("td", "class", "eq", "gridProLinks")
ITEM_CELL = N.Test("td", "class", "eq", "newsText")
BRAND_LINK = "\\S+\\.com"
LETTER_URL = "http://www.evitamins.com/viewitems?l="

TESTS = [CELL, HEAD, BRAND, UPC_BOX, PRICE, N.Test("td"), N.Test("strong"), N.Test("span"), N.Test("a"),
         N.Test(N.TEXT)]


def _first(*path: N.Test) -> Column:
    return F.get(N.own_texts(N.ALL, *path), F.lit(0))


def _size_text() -> Column:
    """First own text of the cell whose strong child carries the size mark."""
    nodes = N.ALL
    strong = N.where(nodes, f"n.tag = 'strong' AND contains(n.text, {N.literal(SIZE_MARK)})")
    inner = N.descendants(N.select(nodes, CELL), N.select(nodes, N.Test("td")))
    cells = N.Nodes(N.let(strong, "marks", f"filter({inner}, c -> exists(marks, m -> m.parent = c.pre))"))
    return F.get(N.values(N.children(cells, N.select(nodes, N.Test(N.TEXT)))), F.lit(0))


def vitamin_facts(pages: DataFrame) -> DataFrame:
    """Facts of the product pages, whether they have a title or not."""
    docs = N.parse_nodes(pages.where(F.col("page_type") == "detail"), TESTS, ["page_id", "url"])
    nodes = N.ALL
    upc = N.values(N.children(N.under(nodes, CELL, UPC_BOX), N.select(nodes, N.Test("span", "itemprop", "has", ""))))
    image = N.values(N.children(N.under(nodes, CELL, N.Test("span")), N.select(nodes, N.Test("a"))), "href")
    raw = docs.select(
        "page_id", "url", _first(CELL, HEAD).alias("raw_title"), _first(CELL, BRAND).alias("brand"),
        _size_text().alias("size_text"), F.get(upc, F.lit(0)).alias("upc"),
        X.replace_all(_first(CELL, PRICE), "\n").alias("price"), F.get(image, F.lit(0)).alias("image_url"))
    facts = raw.select("*", parse_title(F.col("raw_title"), F.col("brand"), F.col("size_text")).alias("t"))
    return facts.select("page_id", "url", "t.title", "brand", "t.flavor", "t.size", "t.unit",
                        X.fill(F.col("upc"), "None").alias("upc"), X.fill(F.col("price"), "None").alias("price"),
                        "image_url")


def read(pages: DataFrame, staging: str | None = None) -> Facts:
    """The facts as a written table; pages without title fail."""
    return Facts({"detail": with_failed(vitamin_facts(pages), {"title": F.col("title").isNull()})}, staging or scratch_path(pages.sparkSession, "facts"))


def vitamin_products(pages: DataFrame) -> DataFrame:
    """title, brand, flavor, size, unit, upc, price, image_url of every product page with a title."""
    rows = vitamin_facts(pages)
    return keep_where(rows, F.col("title").isNotNull(), rows.columns)


def product_links(pages: DataFrame) -> DataFrame:
    """Distinct product urls of the grid pages."""
    docs = N.parse_nodes(pages, [GRID, N.Test("a")], ["page_id"])
    links = N.values(N.children(N.select(N.ALL, GRID), N.select(N.ALL, N.Test("a"))), "href")
    return docs.select(F.explode(links).alias("url")).distinct()
